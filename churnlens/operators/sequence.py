"""Position of each row within its group, safe for a group holding much of the data.

A window ``row_number() OVER (PARTITION BY g ORDER BY o)`` sends a whole
group to one task. ``row_number_within`` first bounds the largest group (by
the input row count, else one partially aggregated pass). If every group
fits one task (``Tuning.task_rows``, or an even share of all rows) it uses
that window. Otherwise it numbers rows through range partitioning:

1. ``repartitionByRange`` on ``(g, o)`` splits a large group across several
   tasks; each row gets ``monotonically_increasing_id`` (task id, position);
   the result is written to the shared checkpoint folder so both uses below
   see the same ids;
2. one row per (task, group) *segment*: its first position and row count
   (an aggregate; a group has at most one segment per task);
3. a window over segments -- per group, at most one row per task -- gives
   the rows of the same group in earlier tasks (carry);
4. position = carry + (position in task - segment start), joined back per
   segment; a segment never exceeds one task's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Tuning
from .checkpoint import materialize, materialize_counted

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row in partition


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def row_number_within(df: DataFrame, groups: Sequence[str], order: Sequence[str], out: str,
                      tuning: Tuning = DEFAULT, method: str = "auto") -> DataFrame:
    """Add ``out``: 0-based position within ``groups`` by ``order`` (ties must not occur).

    ``method``: ``"auto"`` (measure, then choose), ``"window"`` or ``"range"``.
    """
    groups, order = list(groups), list(order)
    if method == "auto":
        # No group can be larger than the whole input: a cheap bound first
        # (a parquet row count reads footers only), the exact largest group
        # only when the input is larger than one task's rows.
        total = df.count()
        largest = total
        if total > tuning.task_rows:
            largest = (df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
                         .agg(F.max("n")).first()[0] or 0)
        method = "window" if largest <= tuning.task_rows else "range"
    if method == "window":
        w = Window.partitionBy(*groups).orderBy(*order)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))

    keys = groups + order
    ranged = materialize(df.repartitionByRange(_partitions(df), *keys)
                           .sortWithinPartitions(*keys)
                           .withColumn("__id", F.monotonically_increasing_id()), "ranged")
    ranged = (ranged.withColumn("__task", F.shiftright("__id", _POS_BITS))
                    .withColumn("__pos", F.col("__id").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
                    .drop("__id"))
    seg_keys = ["__task", *groups]
    earlier = Window.partitionBy(*groups).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    segments = (ranged.groupBy(*seg_keys)
                      .agg(F.min("__pos").alias("__start"), F.count(F.lit(1)).alias("__n"))
                      .withColumn("__carry", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
                      .drop("__n"))
    segments, n_segments = materialize_counted(segments, "segments")
    side = F.broadcast(segments) if n_segments <= tuning.broadcast_max_rows else segments
    cond = [ranged[c].eqNullSafe(side[c]) for c in seg_keys]
    joined = ranged.join(side, cond, "inner")
    return joined.select(
        *[ranged[c] for c in df.columns],
        (side["__carry"] + ranged["__pos"] - side["__start"]).cast("long").alias(out))


def _largest_group(df: DataFrame, groups: list[str], bound: int) -> int:
    """Rows of the largest group, or of the whole input where that is within ``bound`` already."""
    total = df.count()
    if total <= bound:
        return total
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def running_count_within(df: DataFrame, groups: Sequence[str], order: Sequence[str], flag: Column, out: str,
                         tuning: Tuning = DEFAULT, method: str = "auto") -> DataFrame:
    """Add ``out``: rows of the group with ``flag`` at or before the row in ``order``; rows that tie share it.

    The counterpart of ``row_number_within`` for a count of some of the rows,
    with the same choice of ``method``. In the range form equal keys meet in
    one range, a window runs inside a (range, group) segment only, and a
    segment's carry is the flagged rows of the same group in earlier ranges.
    """
    groups, order = list(groups), list(order)
    if method == "auto":
        method = "window" if _largest_group(df, groups, tuning.task_rows) <= tuning.task_rows else "range"
    one = F.when(flag, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    up_to = (Window.unboundedPreceding, Window.currentRow)
    if method == "window":
        return df.withColumn(out, F.sum(one).over(Window.partitionBy(*groups).orderBy(*order).rangeBetween(*up_to)))

    ranged = materialize(df.repartitionByRange(_partitions(df), *groups, *order)
                           .withColumns({"__one": one, "__task": F.spark_partition_id()}), "ranged")
    seg_keys = ["__task", *groups]
    earlier = Window.partitionBy(*groups).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    segments, n_segments = materialize_counted(
        ranged.groupBy(*seg_keys).agg(F.sum("__one").alias("__n"))
              .withColumn("__carry", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n"), "segments")
    side = F.broadcast(segments) if n_segments <= tuning.broadcast_max_rows else segments
    local = ranged.withColumn("__local", F.sum("__one").over(
        Window.partitionBy(*seg_keys).orderBy(*order).rangeBetween(*up_to)))
    joined = local.join(side, [local[c].eqNullSafe(side[c]) for c in seg_keys])
    return joined.select(*[local[c] for c in df.columns], (side["__carry"] + local["__local"]).cast("long").alias(out))
