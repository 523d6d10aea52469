"""Aggregates per key that every micro-batch adds to (A1 and R3 on a stream).

A batch writes the partial aggregates of its own rows to a folder named by its
number, so a batch that runs again replaces its part and counts once. Once
``compact_every`` parts have come together they are merged into a base. The state as of a
batch is the newest base below it merged with the parts after that base: it
stays readable for every batch not compacted away, and a replayed batch sees
what its first run saw.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import make_folder, partition_values, remove_folder

_MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


class RunningAggregate:
    """``merge`` gives the aggregate of every value column: sum, max or min. Rows with a null key are left out."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType, merge: Mapping[str, str],
                 compact_every: int = 20):
        self.spark, self.path, self.key, self.schema = spark, path, key, schema
        self.merge, self.compact_every = dict(merge), compact_every
        for part in ("parts", "base"):
            make_folder(spark, f"{path}/{part}")

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.key).agg(*[_MERGE[how](c).alias(c) for c, how in self.merge.items()])

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Take the batch's rows (key and value columns; combined here) in place of an earlier run's."""
        kept = rows.where(F.col(self.key).isNotNull()).select(*self.schema.names)
        self._merged(kept).select(*self.schema.names).write.mode("overwrite").parquet(
            f"{self.path}/parts/batch_id={batch_id}")

    def as_of(self, batch_id: int, keys: DataFrame | None = None) -> DataFrame:
        """The state after ``batch_id``, of the keys in ``keys`` only if given (one column, the key).

        Bases of the batch itself or later ones are not used: a run that was
        lost may have left them half written.
        """
        bases = [b for b in partition_values(self.spark, f"{self.path}/base", "upto") if b < batch_id]
        paths = [f"{self.path}/base/upto={bases[-1]}"] if bases else []
        after = bases[-1] if bases else -1
        paths += [f"{self.path}/parts/batch_id={b}" for b in partition_values(
            self.spark, f"{self.path}/parts", "batch_id") if after < b <= batch_id]
        reader = self.spark.read.schema(self.schema)
        rows = reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        if keys is not None:
            rows = rows.join(keys, self.key, "left_semi")
        return self._merged(rows)

    def latest(self) -> DataFrame:
        found = partition_values(self.spark, f"{self.path}/parts", "batch_id")
        found += partition_values(self.spark, f"{self.path}/base", "upto")
        return self.as_of(max(found, default=-1))

    def compact(self, batch_id: int) -> bool:
        """Write the base of the batch if it is due, and remove what no batch after it needs."""
        bases = [b for b in partition_values(self.spark, f"{self.path}/base", "upto") if b < batch_id]
        parts = partition_values(self.spark, f"{self.path}/parts", "batch_id")
        if sum(b > (bases[-1] if bases else -1) for b in parts) < self.compact_every:
            return False
        self.as_of(batch_id).select(*self.schema.names).write.mode("overwrite").parquet(
            f"{self.path}/base/upto={batch_id}")
        # A replay of this batch still needs the base before it and the parts since.
        for b in bases[:-1]:
            remove_folder(self.spark, f"{self.path}/base/upto={b}")
        for b in parts:
            if bases and b <= bases[-1]:
                remove_folder(self.spark, f"{self.path}/parts/batch_id={b}")
        return True


def live_means(spark: SparkSession, path: str, compact_every: int = 20) -> RunningAggregate:
    """A1 on a stream: the sum and the number of a user's lengths."""
    schema = T.StructType([T.StructField("userId", T.LongType()), T.StructField("total", T.DoubleType()),
                           T.StructField("n", T.LongType())])
    return RunningAggregate(spark, path, "userId", schema, {"total": "sum", "n": "sum"}, compact_every)


def has_length() -> Column:
    return F.col("length").isNotNull() & ~F.isnan("length")


def user_lengths(rows: DataFrame, **more: Column) -> DataFrame:
    """One row per user; what those with ``n`` above 0 add to ``live_means``, and further aggregates."""
    has = has_length()
    return rows.groupBy("userId").agg(F.sum(F.when(has, F.col("length"))).alias("total"), F.count_if(has).alias("n"),
                                      *[c.alias(k) for k, c in more.items()])


def mean_of(state: DataFrame) -> DataFrame:
    return state.select("userId", (F.col("total") / F.col("n")).alias("mean_length"))


def live_at_risk(spark: SparkSession, path: str, compact_every: int = 20) -> RunningAggregate:
    """R3 on a stream: the columns of ``at_risk_users``."""
    counts = ["flagged_events", "cancel_flags", "downgrade_flags", "confirmed_flags"]
    schema = T.StructType([T.StructField("userId", T.LongType()), *[T.StructField(c, T.LongType()) for c in counts],
                           T.StructField("max_risk", T.DoubleType())])
    return RunningAggregate(spark, path, "userId", schema, {**dict.fromkeys(counts, "sum"), "max_risk": "max"},
                            compact_every)

