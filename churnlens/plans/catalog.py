"""Named queries over a driver data directory: ``(spark, sf_dir) -> DataFrame``.

Each query reads the given tables (the ``events`` table through the fixture
adapter) and runs over all of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Tuning
from ..operators import balance, clean, derive, predictions, profile, users
from ..oracle import DESCRIBE_COLS, PROFILED
from ..schema import EXPLORE_COLUMNS, NOTEBOOK_BALANCE_K, PREDICTION
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import events as ev
from ..sources.events import load_clickstream
from .wrangle import wrangle_explore, wrangle_train

Query = Callable[[SparkSession, str], DataFrame]


def _cs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return load_clickstream(spark, sf_dir)


def _cast(spark, sf_dir):
    return clean.cast_columns(_cs(spark, sf_dir))


def _imputed(spark, sf_dir, tuning: Tuning = DEFAULT):
    return clean.impute_length(_cast(spark, sf_dir), tuning=tuning)


def q_adapt_events(spark, sf_dir):
    return _cs(spark, sf_dir)


def q_json_scan(spark, sf_dir):
    """The clickstream as JSON lines, read back with the explicit schema."""
    path = scratch_path(spark, "events-json")
    _cs(spark, sf_dir).write.mode("overwrite").json(path)
    return ev.read_events(spark, path)


def q_json_line_report(spark, sf_dir):
    """The clickstream as JSON lines, some of them cut short, and what the scan makes of them."""
    path = scratch_path(spark, "events-lines")
    line = F.to_json(F.struct("*"))
    lines = _cs(spark, sf_dir).select(line.alias("value"), (F.col("itemInSession") % 7 == 3).alias("cut"))
    (lines.select(F.when(F.col("cut"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
                  .alias("value")).write.mode("overwrite").text(path))
    return ev.line_report(spark, path)


def q_impute_length(spark, sf_dir):
    return _imputed(spark, sf_dir)


def q_wrangle_train(spark, sf_dir):
    return wrangle_train(_cs(spark, sf_dir))


def q_class_counts(spark, sf_dir):
    return balance.class_counts(q_wrangle_train(spark, sf_dir))


def q_null_profile(spark, sf_dir):
    """A3/A4 before and after imputation, in one pass: only ``length`` differs."""
    return profile.null_profile_stages(_cast(spark, sf_dir), clean.impute_length)


def q_describe_numeric(spark, sf_dir):
    return profile.describe_numeric(_imputed(spark, sf_dir), DESCRIBE_COLS)


def q_distinct_pages(spark, sf_dir):
    return profile.distinct_values(_cast(spark, sf_dir), "page")


def q_lower_strings(spark, sf_dir):
    return clean.lower_strings(_cast(spark, sf_dir))


def q_time_parts(spark, sf_dir):
    return derive.add_time_parts(_cast(spark, sf_dir), drop_ts=False).select(
        "userId", "sessionId", "itemInSession", "ts", "year", "month", "day", "hour")


def q_explode_states(spark, sf_dir):
    rows = clean.clean(_cs(spark, sf_dir), EXPLORE_COLUMNS)
    return (rows.transform(derive.add_state).transform(derive.explode_states, drop_location=False)
                .select("userId", "sessionId", "itemInSession", "location", "state"))


def q_wrangle_explore(spark, sf_dir):
    return wrangle_explore(_cs(spark, sf_dir))


def q_level_filter(spark, sf_dir):
    return balance.where_level(wrangle_explore(_cs(spark, sf_dir)), "free")


def q_random_rows(spark, sf_dir):
    cancels = balance.where_class(wrangle_explore(_cs(spark, sf_dir)), 2)
    return profile.random_rows(cancels, 5, ["userId", "sessionId", "itemInSession", "state"])


def q_class_sizes(spark, sf_dir):
    return balance.class_size_summary(q_class_counts(spark, sf_dir))


def q_balance_fractions(spark, sf_dir):
    return balance.balance_fractions(q_class_counts(spark, sf_dir))


def q_balanced_sample(spark, sf_dir):
    from ..operators.checkpoint import materialize
    return balance.balanced_sample(materialize(q_wrangle_train(spark, sf_dir), "wrangled"))


def q_balanced_sample_k2(spark, sf_dir):
    """B1 + B2 with the notebook's factor."""
    from ..operators.checkpoint import materialize
    return balance.balanced_sample(materialize(q_wrangle_train(spark, sf_dir), "wrangled"), k=NOTEBOOK_BALANCE_K)


def q_hash_split(spark, sf_dir):
    return (q_balanced_sample(spark, sf_dir).transform(balance.hash_split)
            .transform(balance.assign_folds))


def q_length_item_density(spark, sf_dir):
    return profile.density(wrangle_explore(_cs(spark, sf_dir), fan_out=False))


def q_string_index(spark, sf_dir):
    from ..ml.estimators import index_strings
    return index_strings(q_wrangle_train(spark, sf_dir)).select(
        "userId", "itemInSession", "length", "churn", "gender", "level")


def _rule_scored(spark, sf_dir):
    rows = wrangle_train(_cs(spark, sf_dir), keep_page=True).drop("churn")
    return predictions.rule_prediction(rows)


def q_weighted_metrics(spark, sf_dir):
    return predictions.weighted_metrics(predictions.rule_prediction(q_wrangle_train(spark, sf_dir)))


def q_flagged_rows(spark, sf_dir):
    return predictions.flagged_rows(_rule_scored(spark, sf_dir))


def q_flag_precision(spark, sf_dir):
    return predictions.flag_precision(q_flagged_rows(spark, sf_dir))


def q_at_risk_users(spark, sf_dir):
    return users.at_risk_users(q_flagged_rows(spark, sf_dir))


def q_user_churn(spark, sf_dir):
    return users.user_churn(wrangle_explore(_cs(spark, sf_dir), fan_out=False))


def q_group_rates(spark, sf_dir):
    return users.group_rates(wrangle_explore(_cs(spark, sf_dir), fan_out=False))


DETERMINISTIC: dict[str, Query] = {
    "adapt_events": q_adapt_events,
    "json_scan": q_json_scan,
    "json_line_report": q_json_line_report,
    "impute_length": q_impute_length,
    "wrangle_train": q_wrangle_train,
    "class_counts": q_class_counts,
    "null_profile": q_null_profile,
    "describe_numeric": q_describe_numeric,
    "distinct_pages": q_distinct_pages,
    "lower_strings": q_lower_strings,
    "time_parts": q_time_parts,
    "explode_states": q_explode_states,
    "wrangle_explore": q_wrangle_explore,
    "level_filter": q_level_filter,
    "random_rows": q_random_rows,
    "class_sizes": q_class_sizes,
    "balance_fractions": q_balance_fractions,
    "balanced_sample": q_balanced_sample,
    "balanced_sample_k2": q_balanced_sample_k2,
    "hash_split": q_hash_split,
    "length_item_density": q_length_item_density,
    "string_index": q_string_index,
    "weighted_metrics": q_weighted_metrics,
    "flagged_rows": q_flagged_rows,
    "flag_precision": q_flag_precision,
    "at_risk_users": q_at_risk_users,
    "user_churn": q_user_churn,
    "group_rates": q_group_rates,
}

# --- model, scoring and stream queries (no SQL oracle: fitted models) --------

def _prepared(spark, sf_dir):
    from .train import prepare_training
    return prepare_training(_cs(spark, sf_dir))


def _train(kind: str, name: str | None = None, features=None, grid=None):
    def q(spark, sf_dir):
        from ..schema import MODEL_FEATURES
        from .train import train_and_evaluate
        _, metrics = train_and_evaluate(_prepared(spark, sf_dir), kind,
                                        features or MODEL_FEATURES, grid, name=name)
        return metrics
    return q


def q_ablation(spark, sf_dir):
    """The two-feature tree against the four-feature tree."""
    from ..schema import MODEL_FEATURES, TWO_FEATURES
    from .train import train_and_evaluate
    prepared = _prepared(spark, sf_dir)
    _, two = train_and_evaluate(prepared, "dt", TWO_FEATURES, name="dt_2_features")
    _, four = train_and_evaluate(prepared, "dt", MODEL_FEATURES, name="dt_4_features")
    return two.unionByName(four)


def _saved_models(spark, prepared):
    """Fit the notebook's four models, each saved to its own folder, then loaded."""
    from ..schema import MODEL_FEATURES, TWO_FEATURES
    from ..sources.sinks import load_pipeline
    from .train import train_and_evaluate
    specs = {"dt_2_features": ("dt", TWO_FEATURES, None),
             "dt": ("dt", MODEL_FEATURES, None),
             "dt_deep": ("dt", MODEL_FEATURES, {"maxDepth": [10]}),
             "rf": ("rf", MODEL_FEATURES, None)}
    loaded = {}
    for name, (kind, feats, grid) in specs.items():
        path = scratch_path(spark, f"model-{name}")
        train_and_evaluate(prepared, kind, feats, grid, save_to=path, name=name)
        loaded[name] = load_pipeline(path)
    return loaded


def q_compare_models(spark, sf_dir):
    """Saved models compared on one test split, in one pass over it."""
    from ..ml.evaluate import compare_in_one_pass
    prepared = _prepared(spark, sf_dir)
    models = _saved_models(spark, prepared)
    return compare_in_one_pass(models, prepared.where(F.col("split") == "test"))


def _fitted_and_loaded(spark, prepared):
    """One decision-tree fit on the train split, and the same saved and loaded back."""
    from ..ml.estimators import build_model_pipeline
    from ..sources.sinks import load_pipeline, save_pipeline
    pipe, _ = build_model_pipeline("dt", index_on=prepared)
    model = pipe.fit(prepared.where(F.col("split") == "train"))
    path = scratch_path(spark, "model-dt")
    save_pipeline(model, path)
    return model, load_pipeline(path)


def _dt_model(spark, sf_dir):
    """The model a scoring query uploads against (the reference scores with a pre-trained archive)."""
    return _fitted_and_loaded(spark, _prepared(spark, sf_dir))[1]


def write_json_batches(df: DataFrame, path: str, n_batches: int = 3) -> tuple[str, int]:
    """Write events as ``n_batches`` JSON folders in event-time order (one write each).

    Cut points are whole UTC days from the data's own range; the writes run in
    order so the file source sees them in time order. Returns the path and the
    largest number of files in one batch (a ``maxFilesPerTrigger`` that makes
    one micro-batch per time batch).
    """
    from ..operators.checkpoint import materialize
    df = materialize(df, "upload")  # computed once; each batch below is a filtered scan
    day = F.floor(F.col("ts") / F.lit(86_400_000))
    lo, hi = df.agg(F.min(day), F.max(day)).first()
    width = (hi - lo) // n_batches + 1
    files = 0
    for i in range(n_batches):
        part = df.where((day >= lo + i * width) & (day < lo + (i + 1) * width))
        part.write.mode("overwrite").json(f"{path}/batch={i}")
        files = max(files, len(df.sparkSession.read.text(f"{path}/batch={i}").inputFiles()))
    return path, max(1, files)


def q_score_batch(spark, sf_dir):
    """C4 + S6: score an uploaded JSON file with a saved model; flagged rows to a table."""
    from .score import score_batch
    model = _dt_model(spark, sf_dir)
    upload = scratch_path(spark, "upload-json")
    _cs(spark, sf_dir).write.mode("overwrite").json(upload)
    return score_batch(ev.read_events(spark, upload), model, scratch_path(spark, "scored"))


def q_at_risk_model(spark, sf_dir):
    """R3 on a fitted model's flags."""
    return users.at_risk_users(q_score_batch(spark, sf_dir))


def q_score_stream(spark, sf_dir, delay: str = "31 days"):
    """R2: the same upload as three time-ordered file batches through Structured Streaming.

    ``delay`` covers the fixture's 30-day span, so late copies are dropped and
    the stream matches batch scoring by content.
    """
    from ..streaming.score_stream import mean_table, run_score_stream
    model = _dt_model(spark, sf_dir)
    source, per_batch = write_json_batches(_cs(spark, sf_dir), scratch_path(spark, "stream-in"))
    means = mean_table(ev.read_events(spark, source))
    sink = scratch_path(spark, "stream-out")
    q = run_score_stream(spark, source, model, means, sink, scratch_path(spark, "stream-ckpt"),
                         delay, max_files_per_trigger=per_batch)
    q.awaitTermination()
    return spark.read.parquet(sink)


# --- facts about training and scoring that hold whatever the fit (SQL oracle) ---

def q_training_splits(spark, sf_dir):
    """Rows of the training set per split and fold."""
    return _prepared(spark, sf_dir).groupBy("split", "fold").agg(F.count(F.lit(1)).alias("n"))


def q_saved_loaded(spark, sf_dir):
    """Rows per split, those the saved and the loaded model score apart, and those without a score."""
    prepared = _prepared(spark, sf_dir)
    fitted, loaded = _fitted_and_loaded(spark, prepared)
    rows = fitted.transform(prepared).select(*prepared.columns, F.col(PREDICTION).alias("fitted"))
    pred = F.col(PREDICTION)
    return loaded.transform(rows).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~pred.eqNullSafe(F.col("fitted"))).alias("mismatches"),
        F.count_if(pred.isNull()).alias("unscored"))


def q_scored_users(spark, sf_dir):
    """Rows that batch scoring gives per user."""
    from .score import score_events
    scored = score_events(_cs(spark, sf_dir), _dt_model(spark, sf_dir))
    return scored.groupBy("userId").agg(F.count(PREDICTION).alias("n_rows"))


def q_mllib_metrics(spark, sf_dir):
    """M11-M13 by MLlib's evaluator, on the rule prediction."""
    from ..ml.evaluate import mllib_metrics
    from ..operators.checkpoint import materialize
    rows = materialize(predictions.rule_prediction(q_wrangle_train(spark, sf_dir)), "rule-scored")
    m = mllib_metrics(rows)
    return spark.range(1).select(*[F.round(F.lit(m[k]), 9).alias(name) for k, name in (
        ("f1", "f1"), ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall"))])


def q_stream_rows(spark, sf_dir):
    """R2: the rows that the stream scores, without their predictions."""
    return q_score_stream(spark, sf_dir).drop(PREDICTION)


DETERMINISTIC |= {
    "training_splits": q_training_splits,
    "saved_loaded": q_saved_loaded,
    "scored_users": q_scored_users,
    "mllib_metrics": q_mllib_metrics,
    "stream_rows": q_stream_rows,
}

# --- the stream as one query (rule model, so that SQL can follow it) ---------------

#: A line whose item number leaves this rest by this divisor arrives cut short.
CUT_EVERY, CUT_REST = 50, 7


def write_lines(df: DataFrame, path: str) -> None:
    """Events as JSON lines, some cut short."""
    cut = F.col("itemInSession") % CUT_EVERY == CUT_REST
    (df.select(cut.alias("cut"), F.to_json(F.struct("*")).alias("line"))
       .select(F.when(F.col("cut"), F.expr("left(line, length(line) - 1)")).otherwise(F.col("line")).alias("value"))
       .write.mode("overwrite").text(path))


def _live_tables(spark, sf_dir, n_batches: int = 3) -> str:
    """The events in ``n_batches`` spans of days, one after the other, through the live query, which stops in between."""
    from ..ml.rules import rule_pipeline
    from ..operators.checkpoint import materialize_observed
    from ..session import state_partitions
    from ..streaming.live_scoring import run_live_scoring
    day = F.floor(F.col("ts") / F.lit(86_400_000))
    events, seen = materialize_observed(_cs(spark, sf_dir), "live-events", rows=F.count(F.lit(1)),
                                        lo=F.min(day), hi=F.max(day))
    base = scratch_path(spark, "live")
    lo, parts = seen["lo"], state_partitions(spark, seen["rows"])
    width = (seen["hi"] - lo) // n_batches + 1
    for i in range(n_batches):
        write_lines(events.where((day >= lo + i * width) & (day < lo + (i + 1) * width)), f"{base}/in/span={i}")
        run_live_scoring(spark, f"{base}/in", rule_pipeline("fraction"), f"{base}/tables", f"{base}/checkpoint",
                         "2 days", max_files_per_trigger=1_000_000, compact_every=2,
                         state_partitions=parts).awaitTermination()
    return f"{base}/tables"


def q_live_scoring(spark, sf_dir):
    """The sinks of the live query, each row filled from the means as of its batch."""
    from ..sources.batches import BatchTable
    from ..streaming.live_scoring import EVENT_COLUMNS, ROW_SCHEMA
    table = BatchTable(spark, f"{_live_tables(spark, sf_dir)}/rows", ROW_SCHEMA)
    return table.read(columns=["sink", *EVENT_COLUMNS, PREDICTION, "correct_prediction"])


def q_live_users(spark, sf_dir):
    """A1 and R3 kept up by the live query: a user's lengths so far, their mean, and the columns of ``at_risk_users``."""
    from ..streaming.running import live_at_risk, live_means
    tables = _live_tables(spark, sf_dir)
    means = live_means(spark, f"{tables}/means").latest().select(
        "userId", "n", (F.col("total") / F.col("n")).alias("mean_length"))
    return means.join(live_at_risk(spark, f"{tables}/at_risk").latest(), "userId", "full")


# --- sources that differ from the schema -----------------------------------------

def _drifted_lines(spark, sf_dir) -> str:
    """The clickstream as JSON lines of a producer that has changed: other types, further fields, cut lines."""
    item = F.col("itemInSession")
    status = F.col("status").cast("string")
    drifted = _cs(spark, sf_dir).select(
        F.to_json(F.struct(*[c for c in EXPLORE_COLUMNS if c not in ("status", "length", "sessionId", "gender")],
                           "gender")).alias("plain"),
        F.when(item % 11 == 0, F.concat(F.lit('"'), status, F.lit('"'))).otherwise(status).alias("status"),
        F.when(item % 13 == 0, F.lit('"n/a"')).otherwise(F.coalesce(F.col("length").cast("string"), F.lit("null")))
         .alias("length"),
        F.when(item % 17 == 0, F.concat(F.col("sessionId").cast("string"), F.lit(".5")))
         .otherwise(F.col("sessionId").cast("string")).alias("sessionId"),
        F.when(item % 19 == 0, F.lit(',"device":{"os":"x","version":1}')).otherwise(F.lit("")).alias("device"),
        F.when(item % 23 == 0, F.lit(',"tags":["a","b"]')).when(item % 23 == 1, F.lit(',"tags":7'))
         .otherwise(F.lit("")).alias("tags"), (item % CUT_EVERY == CUT_REST).alias("cut"))
    line = F.concat(F.expr("left(plain, length(plain) - 1)"), F.lit(',"status":'), "status", F.lit(',"length":'), "length",
                    F.lit(',"sessionId":'), "sessionId", "device", "tags", F.when(F.col("cut"), "").otherwise("}"))
    path = scratch_path(spark, "events-drifted")
    drifted.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def q_json_drift(spark, sf_dir):
    """What a changed producer's lines have in place of the event schema."""
    from ..sources.drift import drift_report, read_variants
    return drift_report(read_variants(spark, _drifted_lines(spark, sf_dir)))


def q_json_schema(spark, sf_dir):
    """The fields of the same lines with their merged types, decimals without their digits."""
    from ..sources.drift import inferred_fields, read_variants
    fields = inferred_fields(read_variants(spark, _drifted_lines(spark, sf_dir)))
    return fields.withColumn("merged_type", F.regexp_replace("merged_type", r"DECIMAL\(\d+,\d+\)", "DECIMAL"))


def q_json_open(spark, sf_dir):
    """The same lines read with the event schema; unknown fields, lost values and cut lines are kept."""
    from ..sources.drift import EXTRA, LOST, MALFORMED, read_events_open
    rows = read_events_open(spark, _drifted_lines(spark, sf_dir))
    return rows.select("userId", "itemInSession", "sessionId", "length", "status", "page", "ts",
                       F.expr(f"try_variant_get({EXTRA}, '$.device.os', 'string')").alias("device_os"),
                       F.expr(f"to_json({LOST})").alias("lost"), F.col(MALFORMED).isNotNull().alias("malformed"))


# --- models: comparison in one pass, nested grids, the jobs' facts -----------------

def q_compare_rules(spark, sf_dir):
    """Fixed rules on two, three and no features, compared on the test split in one pass."""
    from ..ml.evaluate import compare_in_one_pass
    from ..ml.rules import RULES, rule_pipeline
    test = _prepared(spark, sf_dir).where(F.col("split") == "test")
    return compare_in_one_pass({name: rule_pipeline(name) for name in RULES}, test, digits=9)


#: A small grid of the reference's parameters for the comparison with the full search.
NESTED_GRID = {"maxDepth": [2, 3], "maxIter": [2, 4]}


def q_nested_grid(spark, sf_dir):
    """M5, M7-M9: the nested search over boosted trees against Spark's own search over the whole grid.

    Per grid point: whether the mean metrics differ by more than 1e-9, whether
    both searches call it the best, the rows the two best models score apart,
    and the fits of the nested search.
    """
    from ..ml.estimators import cross_validator
    from ..ml.nested import NestedValidator
    from .train import BINARY_LABEL
    prepared = _prepared(spark, sf_dir)
    train = prepared.where(F.col("split") == "train")
    args = dict(kind="gbt_binary", grid=NESTED_GRID, label=BINARY_LABEL, index_on=prepared)
    nested, full = NestedValidator(**args).fit(train), cross_validator(**args).fit(train)
    best = max(range(len(full.avgMetrics)), key=lambda i: full.avgMetrics[i])
    points = [(p["maxDepth"], p["maxIter"], abs(m - full.avgMetrics[i]) > 1e-9, (p == nested.best) == (i == best), nested.fits)
              for i, (p, m) in enumerate(zip(nested.points, nested.metrics))]
    rows = nested.best_model.transform(prepared).select(*prepared.columns, F.col(PREDICTION).alias("nested"))
    apart = full.bestModel.transform(rows).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("nested") != F.col(PREDICTION)).alias("scored_apart"))
    fields = ("max_depth", "max_iter", "metrics_differ", "best_agrees", "fits")
    grid = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, p)]) for p in points]))
    return apart.select("*", grid.alias("point")).select("point.*", "n_rows", "scored_apart")


def q_training_facts(spark, sf_dir):
    """What the training job reports of its models whatever they learn: rows a split, scores in range."""
    from .train import train_and_evaluate
    prepared = _prepared(spark, sf_dir)
    told = [train_and_evaluate(prepared, kind, grid={"maxDepth": [3]}, name=kind)[1] for kind in ("dt", "rf")]
    return told[0].unionByName(told[1]).select(
        "model", "split", "n_rows", (F.col("f1").between(0, 1) & F.col("weighted_precision").between(0, 1)
                                     & F.col("weighted_recall").between(0, 1)
                                     & F.col("flagged_rows").between(0, F.col("n_rows"))).alias("in_range"))


def q_scored_table(spark, sf_dir):
    """A JSON upload scored with a saved and loaded rule, written to a table and read back."""
    from ..ml.rules import rule_pipeline
    from ..sources.sinks import load_pipeline, save_pipeline
    from .score import score_batch
    upload, saved = scratch_path(spark, "upload-json"), scratch_path(spark, "model-rule")
    _cs(spark, sf_dir).write.mode("overwrite").json(upload)
    save_pipeline(rule_pipeline("fraction"), saved)
    return score_batch(ev.read_events(spark, upload), load_pipeline(saved), scratch_path(spark, "scored"))


# --- exact class sizes -------------------------------------------------------------

def q_exact_sample(spark, sf_dir):
    """B1, B2: the balanced sample with exactly the wanted number of rows a class."""
    from ..operators.checkpoint import materialize
    from ..operators.exact_sample import exact_balanced_sample
    return exact_balanced_sample(materialize(q_wrangle_train(spark, sf_dir), "wrangled"), k=NOTEBOOK_BALANCE_K)


# --- rates on the way to churn -----------------------------------------------------

def q_churn_path(spark, sf_dir):
    """Actions per user and per hundred songs, by days and by songs before the churn event."""
    from ..operators.churn_path import churn_path
    return churn_path(clean.clean(_cs(spark, sf_dir), EXPLORE_COLUMNS).transform(derive.add_churn_label),
                      songs_per_cell=5, last_cell=20)


# --- profiles from stored states ---------------------------------------------------

def q_range_profile(spark, sf_dir):
    """A3-A6 of the middle days from states stored in three batches, one of them profiled twice.

    The exact parts as they are; the estimates as whether their error against the events is within its bound.
    """
    from ..operators import profile_store as store
    from ..operators.checkpoint import materialize
    events = materialize(_cast(spark, sf_dir).select(*PROFILED), "profiled-events")
    table = store.profile_table(spark, scratch_path(spark, "profile-states"))
    for batch in (0, 1, 2, 1):
        store.store_batch(table, events.where(F.pmod("itemInSession", F.lit(3)) == batch), batch)
    states = table.read()
    lo, hi = states.agg(F.min("day"), F.max("day")).first()
    first, last = lo + (hi - lo) // 4, hi - (hi - lo) // 4
    found = store.range_profile(states, first, last)
    day = F.floor(F.col("ts") / F.lit(store.DAY_MS))
    found = store.sketch_errors(found, events.where((day >= first) & (day <= last)))

    def digits(c):
        power = F.floor(F.log10(F.abs(c))) - 7
        up, down = F.pow(F.lit(10.0), power), F.pow(F.lit(10.0), -power)
        return F.when(F.coalesce(c == 0, F.lit(True)), c).when(power > 0, F.round(c / up) * up).otherwise(
            F.round(c * down) / down)
    return found.select("column_name", "n_rows", "null_count", digits(F.col("mean")).alias("mean"),
                        digits(F.col("std")).alias("std"), "min", "max", (F.col("rank_error") <= 0.02).alias("ranks_ok"),
                        (F.col("distinct_error") <= 0.06).alias("distinct_ok"))


DETERMINISTIC |= {
    "exact_sample": q_exact_sample,
    "churn_path": q_churn_path,
    "range_profile": q_range_profile,
    "compare_rules": q_compare_rules,
    "nested_grid": q_nested_grid,
    "training_facts": q_training_facts,
    "scored_table": q_scored_table,
    "json_drift": q_json_drift,
    "json_schema": q_json_schema,
    "json_open": q_json_open,
    "live_scoring": q_live_scoring,
    "live_users": q_live_users,
}

MODEL_QUERIES: dict[str, Query] = {
    "train_dt": _train("dt"),
    "train_rf": _train("rf"),
    "train_gbt_ovr": _train("gbt_ovr"),
    "train_gbt_binary": _train("gbt_binary", grid={"maxDepth": [5]}),
    "ablation": q_ablation,
    "compare_models": q_compare_models,
    "score_batch": q_score_batch,
    "at_risk_model": q_at_risk_model,
    "score_stream": q_score_stream,
}
