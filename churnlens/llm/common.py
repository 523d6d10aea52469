"""Helpers shared by the training-data operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.checkpoint import materialize

#: White space between words: the blank and the control characters from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: A table may be broadcast when its measured rows times its row width stay below this.
BROADCAST_BYTES = 64 << 20


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that clash, in any letter case, with ``names``."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast hint for a table of ``rows`` measured rows; a larger one is joined by shuffle."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Null-safe equality on ``names``."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_totals(df: DataFrame, order: list[str], amount: str) -> DataFrame:
    """Add ``before`` (sum of ``amount`` ahead of the row) and ``rank`` in the global order.

    Rows are cut into ranges of ``order`` (a key with very many rows is spread
    when ``order`` goes on to a finer column), written once, and summed per
    range. The offsets are a window over one row per range; the running sum
    inside a range is a window over that range only. The result is written, so
    rows that tie in ``order`` keep one rank whatever is recomputed later.
    """
    parts = shuffle_partitions(df)
    cut = materialize(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()),
                      "ranges")
    totals = cut.groupBy("_part").agg(F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("_part", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_sum0"),
                            F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_n0"))
    inside = Window.partitionBy("_part").orderBy(*order)
    local = cut.select("*", F.coalesce(F.sum(amount).over(
        inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_sum1"),
        (F.row_number().over(inside) - 1).alias("_n1"))
    out = (local.join(F.broadcast(offsets), "_part")  # at most one row per range
           .withColumn("before", (F.col("_sum0") + F.col("_sum1")).cast("long"))
           .withColumn("rank", (F.col("_n0") + F.col("_n1")).cast("long"))
           .drop("_part", "_sum0", "_sum1", "_n0", "_n1"))
    return materialize(out, "running")
