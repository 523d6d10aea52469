"""Command-line jobs: train, compare, score, stream, live, drift, profile, means.

    spark-submit -m churnlens.jobs train  --events PATH --model-out PATH [--kind dt|rf|gbt_ovr|gbt_binary]
    spark-submit -m churnlens.jobs compare --events PATH --model NAME=PATH [--model NAME=PATH ...]
    spark-submit -m churnlens.jobs score  --events PATH --model PATH --out PATH
    spark-submit -m churnlens.jobs stream --source DIR --model PATH --means PATH --out PATH
                                          --checkpoint PATH --delay "1 day"
    spark-submit -m churnlens.jobs live   --source DIR --model PATH --tables PATH --checkpoint PATH --delay "1 day"
                                          (one query: means kept up, scored, flagged, unfilled, malformed rows)
    spark-submit -m churnlens.jobs drift  --events PATH   (what the source has in place of the event schema)
    spark-submit -m churnlens.jobs profile --events PATH --out PATH
    spark-submit -m churnlens.jobs means  --events PATH --out PATH   (the stream's mean table)

``--events`` is JSON lines in the documented event schema (S1). The session
comes from ``spark-submit``; scratch tables go under its
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .schema import SCRIPT_BALANCE_K
from .session import ensure_checkpoint_dir


def _session(app: str) -> SparkSession:
    spark = SparkSession.builder.appName(app).getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def cmd_train(a) -> None:
    from .plans.train import prepare_training, train_and_evaluate
    from .schema import MODEL_FEATURES
    from .sources import read_events
    spark = _session("churnlens-train")
    prepared = prepare_training(read_events(spark, a.events), k=a.k, split_by=a.split_by)
    feats = a.features.split(",") if a.features else MODEL_FEATURES
    _, metrics = train_and_evaluate(prepared, a.kind, feats, save_to=a.model_out,
                                    parallelism=a.parallelism)
    for r in metrics.collect():  # two rows: valid, test
        print(json.dumps(r.asDict()))


def cmd_compare(a) -> None:
    from .ml.evaluate import compare_in_one_pass
    from .plans.train import prepare_training
    from .sources import load_pipeline, read_events
    spark = _session("churnlens-compare")
    models = {name: load_pipeline(path) for name, path in (m.split("=", 1) for m in a.model)}
    prepared = prepare_training(read_events(spark, a.events), k=a.k, split_by=a.split_by)
    for r in compare_in_one_pass(models, prepared.where("split = 'test'")).collect():  # one row per model
        print(json.dumps(r.asDict()))


def cmd_score(a) -> None:
    from .operators.predictions import flag_precision
    from .plans.score import score_batch
    from .sources import load_pipeline, read_events
    spark = _session("churnlens-score")
    flagged = score_batch(read_events(spark, a.events), load_pipeline(a.model), a.out, a.format)
    print(json.dumps(flag_precision(flagged).first().asDict()))


def cmd_stream(a) -> None:
    from .sources import load_pipeline
    from .streaming.score_stream import run_score_stream, run_unfilled_stream
    spark = _session("churnlens-stream")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    means = spark.read.parquet(a.means)
    running = [run_score_stream(spark, a.source, load_pipeline(a.model), means, a.out, a.checkpoint, a.delay,
                                a.max_files_per_trigger, every=a.every, flagged=a.flagged),
               run_unfilled_stream(spark, a.source, means, a.unfilled_out or f"{a.out}-unfilled",
                                   f"{a.checkpoint}-unfilled", a.delay, a.max_files_per_trigger, every=a.every)]
    for q in running:
        q.awaitTermination()


def cmd_live(a) -> None:
    from .sources import load_pipeline
    from .sources.batches import BatchTable
    from .streaming.live_scoring import ROW_SCHEMA, run_live_scoring
    spark = _session("churnlens-live")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    run_live_scoring(spark, a.source, load_pipeline(a.model), a.tables, a.checkpoint, a.delay,
                     a.max_files_per_trigger, a.every, compact_every=a.compact_every).awaitTermination()
    last = BatchTable(spark, f"{a.tables}/rows", ROW_SCHEMA).batches().orderBy("batch_id", ascending=False).first()
    print(json.dumps({"batch_id": last["batch_id"], **last["counts"]} if last else {}))


def cmd_drift(a) -> None:
    from .sources.drift import drift_report, inferred_fields, read_variants
    spark = _session("churnlens-drift")
    variants = read_variants(spark, a.events)
    drift_report(variants).orderBy("field", "type").write.mode("overwrite").parquet(f"{a.out}/drift")
    inferred_fields(variants).orderBy("field").write.mode("overwrite").parquet(f"{a.out}/fields")


def cmd_profile(a) -> None:
    from .operators.clean import cast_columns, impute_length
    from .operators.profile import describe_numeric, null_profile_stages
    from .sources import read_events, write_table
    spark = _session("churnlens-profile")
    cast = cast_columns(read_events(spark, a.events))
    write_table(null_profile_stages(cast, impute_length), f"{a.out}/null_profile")
    write_table(describe_numeric(impute_length(cast)), f"{a.out}/describe")


def cmd_means(a) -> None:
    from .operators.clean import cast_columns, user_means
    from .sources import read_events, write_table
    spark = _session("churnlens-means")
    write_table(user_means(cast_columns(read_events(spark, a.events))).drop("__rows"), a.out)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="churnlens.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--events", required=True)
    t.add_argument("--model-out", required=True)
    t.add_argument("--kind", default="dt", choices=["dt", "rf", "gbt_ovr", "gbt_binary"])
    t.add_argument("--features", default="")
    t.add_argument("--k", type=float, default=SCRIPT_BALANCE_K)
    t.add_argument("--split-by", default="row", choices=["row", "user"])
    t.add_argument("--parallelism", type=int, default=8)
    t.set_defaults(fn=cmd_train)
    c = sub.add_parser("compare")
    c.add_argument("--events", required=True, help="the events the models were trained on; their test split is compared")
    c.add_argument("--model", required=True, action="append", help="NAME=PATH of a saved model; repeat")
    c.add_argument("--k", type=float, default=SCRIPT_BALANCE_K)
    c.add_argument("--split-by", default="row", choices=["row", "user"])
    c.set_defaults(fn=cmd_compare)
    s = sub.add_parser("score")
    s.add_argument("--events", required=True)
    s.add_argument("--model", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--format", default="parquet")
    s.set_defaults(fn=cmd_score)
    st = sub.add_parser("stream")
    st.add_argument("--source", required=True)
    st.add_argument("--model", required=True)
    st.add_argument("--means", required=True, help="parquet table userId, mean_length")
    st.add_argument("--out", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--delay", required=True, help="must cover the longest gap between arrivals of copies")
    st.add_argument("--every", default=None, help="keep running, a micro-batch every so often (e.g. '1 minute')")
    st.add_argument("--flagged", action="store_true", help="write flagged rows only, with correct_prediction")
    st.add_argument("--unfilled-out", default="", help="rows that no mean fills (default: OUT-unfilled)")
    st.add_argument("--max-files-per-trigger", type=int, default=1000)
    st.set_defaults(fn=cmd_stream)
    lv = sub.add_parser("live")
    lv.add_argument("--source", required=True)
    lv.add_argument("--model", required=True)
    lv.add_argument("--tables", required=True, help="folder of the sinks, the running means and the users at risk")
    lv.add_argument("--checkpoint", required=True)
    lv.add_argument("--delay", required=True, help="must cover the longest gap between arrivals of copies")
    lv.add_argument("--every", default=None, help="keep running, a micro-batch every so often (e.g. '1 minute')")
    lv.add_argument("--compact-every", type=int, default=20, help="parts of running aggregates merged into one base")
    lv.add_argument("--max-files-per-trigger", type=int, default=1000)
    lv.set_defaults(fn=cmd_live)
    dr = sub.add_parser("drift")
    dr.add_argument("--events", required=True)
    dr.add_argument("--out", required=True)
    dr.set_defaults(fn=cmd_drift)
    pr = sub.add_parser("profile")
    pr.add_argument("--events", required=True)
    pr.add_argument("--out", required=True)
    pr.set_defaults(fn=cmd_profile)
    mn = sub.add_parser("means")
    mn.add_argument("--events", required=True)
    mn.add_argument("--out", required=True)
    mn.set_defaults(fn=cmd_means)
    a = p.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main()
