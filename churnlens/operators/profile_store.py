"""Profiles of any range of days from stored states (A3-A6), without reading the events again.

Each batch of events is reduced to one state per day and column: counts,
extremes, moments, a KLL sketch for quantiles and an HLL sketch for distinct
values. States of a batch are kept in a ``BatchTable``, so a batch that is
profiled again replaces its part and counts once. A profile merges the states
of the days asked for; its cost is in days, batches and columns, not in events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.batches import BatchTable
from .profile import numeric_columns

#: Entries of a KLL sketch: about 0.7 % of the rows in rank, at 99 % confidence.
KLL_SIZE = 400
#: HLL registers as a power of two: 1.6 % standard error.
HLL_BITS = 12
DAY_MS = 86_400_000

STATE = T.StructType([
    T.StructField("day", T.LongType()), T.StructField("column_name", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()),
    T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType()),
    T.StructField("ranks", T.BinaryType()), T.StructField("distinct", T.BinaryType())])


def day_states(events: DataFrame, ts: str = "ts", cols: Sequence[str] | None = None, kll_size: int = KLL_SIZE,
               hll_bits: int = HLL_BITS) -> DataFrame:
    """``STATE`` rows: one per UTC day (days since the epoch; null where ``ts`` is) and column.

    One aggregation for all columns, combined in the tasks before the shuffle, so a
    day with much of the data costs its tasks one row each. NaN counts as
    missing. Numbers are sketched as doubles (longs are exact up to 2**53);
    other columns have no extremes, moments and quantiles, and their distinct
    values are those of their text.
    """
    cols = list(cols or events.columns)
    numbers = set(numeric_columns(events))
    aggs, states = [F.count(F.lit(1)).alias("rows")], []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        if c in numbers:
            v = v.cast("double")
            v = F.when(~F.isnan(v), v)
            aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.avg(v).alias(f"mean{i}"),
                     (F.var_pop(v) * F.count(v)).alias(f"m{i}"), F.kll_sketch_agg_double(v, kll_size).alias(f"q{i}")]
        aggs += [F.count(v).alias(f"n{i}"), F.hll_sketch_agg(v.cast("string"), hll_bits).alias(f"d{i}")]
        parts = {f"n{i}": "n", f"lo{i}": "lo", f"hi{i}": "hi", f"mean{i}": "mean", f"m{i}": "m2", f"q{i}": "ranks",
                 f"d{i}": "distinct"}
        types = {f.name: f.dataType for f in STATE.fields}
        states.append(F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("n_rows"), *[
            (F.col(k) if c in numbers or k[0] in "nd" else F.lit(None)).cast(types[name]).alias(name)
            for k, name in parts.items()]))
    by_day = events.groupBy(F.floor(F.col(ts) / F.lit(DAY_MS)).cast("long").alias("day")).agg(*aggs)
    return by_day.select("day", F.inline(F.array(*states))).select(*STATE.names)


def profile_table(spark: SparkSession, path: str) -> BatchTable:
    """The store of states at ``path``."""
    return BatchTable(spark, path, STATE, sink="kind")


def store_batch(table: BatchTable, events: DataFrame, batch_id: int, **options) -> None:
    """Profile ``events`` as the batch; an earlier profile of the same batch is replaced."""
    table.replace(day_states(events, **options).withColumn("kind", F.lit("state")), batch_id)


def merge_states(states: DataFrame) -> DataFrame:
    """One row per column from the ``STATE`` rows of any days and batches, still mergeable (``day`` is gone)."""
    seen = F.col("n") > 0
    means = states.where(seen).groupBy("column_name").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    apart = F.col("mean") - F.col("_mean")
    return (states.join(F.broadcast(means), "column_name", "left")  # one row per column of the events
            .groupBy("column_name").agg(
                F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                F.max("_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"),
                F.kll_merge_agg_double(F.when(seen, F.col("ranks"))).alias("ranks"),
                F.hll_union_agg("distinct").alias("distinct")))


def range_profile(states: DataFrame, first: int | None = None, last: int | None = None,
                  probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A3-A6 of the days ``first`` to ``last`` (days since the epoch, both included; open where None).

    ``column_name, n_rows, null_count, null_pct, n_distinct, mean, std, min,
    q.., max``; quantiles and ``n_distinct`` are estimates. Rows without a day
    count only when both ends are open. A range without events has no row.
    """
    day = F.col("day")
    if first is not None:
        states = states.where(day >= first)
    if last is not None:
        states = states.where(day <= last)
    some = F.col("n") > 0

    def quantile(p: float) -> Column:
        return F.when(some & F.col("lo").isNotNull(), F.kll_sketch_get_quantile_double("ranks", F.lit(float(p))))
    return merge_states(states).select(
        "column_name", "n_rows", (F.col("n_rows") - F.col("n")).alias("null_count"),
        ((F.col("n_rows") - F.col("n")) * F.lit(100.0) / F.col("n_rows")).alias("null_pct"),
        F.hll_sketch_estimate("distinct").alias("n_distinct"), "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"), F.col("lo").alias("min"),
        *[quantile(p).alias(f"q{int(round(p * 100))}") for p in probs], F.col("hi").alias("max"))


def sketch_errors(profile: DataFrame, events: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``profile`` with its errors against the events it stands for, in one pass over them.

    ``rank_error``: the farthest that a quantile's rank in the events is from
    its probability; ``distinct_error``: relative. Counting distinct values is
    exact here, which is what the stored states save.
    """
    rows = profile.collect()  # one row per column
    numbers = set(numeric_columns(events))
    aggs = []
    for i, r in enumerate(rows):
        v = F.col(f"`{r['column_name']}`")
        if r["column_name"] in numbers:
            v = F.when(~F.isnan(v.cast("double")), v)
        aggs.append(F.count_distinct(v).alias(f"d{i}"))
        for j, p in enumerate(probs):
            q = r[f"q{int(round(p * 100))}"]
            if q is not None:
                n = F.count(v)
                aggs.append(F.greatest(F.lit(0.0), F.count_if(v.cast("double") < q) / n - p,
                                       p - F.count_if(v.cast("double") <= q) / n).alias(f"e{i}_{j}"))
    if not rows:
        return profile.withColumns({"rank_error": F.lit(0.0), "distinct_error": F.lit(0.0)})
    got = events.agg(*aggs)
    out = []
    for i, r in enumerate(rows):
        errors = [F.col(f"e{i}_{j}") for j in range(len(probs)) if f"e{i}_{j}" in got.columns]
        out.append(F.struct(F.lit(r["column_name"]).alias("column_name"),
                            (F.greatest(*errors, F.lit(0.0)) if errors else F.lit(0.0)).alias("rank_error"),
                            (F.abs(F.lit(r["n_distinct"]) - F.col(f"d{i}")) / F.greatest(F.col(f"d{i}"), F.lit(1)))
                            .alias("distinct_error")))
    return profile.join(F.broadcast(got.select(F.inline(F.array(*out)))), "column_name")  # one row per column
