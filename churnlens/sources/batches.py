"""S6 for streams: a table written batch by batch, each batch at once or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import make_folder, remove_folder, sub_folders

_COMMIT = T.StructType([T.StructField("attempt", T.StringType()),
                        T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
                        T.StructField("batch_id", T.LongType())])


class BatchTable:
    """A Parquet table whose rows come in numbered batches.

    An attempt at a batch writes its rows to a folder of its own and then one
    commit record that names the folder. Readers join the rows with the commit
    records, so they see all sinks of a batch together, and nothing of an
    attempt that was lost. ``done`` tells that a batch needs no further
    attempt; ``replace`` writes it again all the same and the new attempt takes
    the old one's place. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, sink: str = "sink"):
        self.spark, self.path, self.sink = spark, path, sink
        self.schema = T.StructType([*schema.fields, T.StructField(sink, T.StringType()),
                                    T.StructField("batch_id", T.LongType()), T.StructField("attempt", T.StringType())])
        for part in ("rows", "commits"):
            make_folder(spark, f"{path}/{part}")

    def batches(self) -> DataFrame:
        """One row per committed batch: batch_id, attempt, counts."""
        return (self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits")
                .select("batch_id", "attempt", "counts"))

    def done(self, batch_id: int) -> bool:
        return not self.batches().where(F.col("batch_id") == batch_id).isEmpty()

    def stage(self, rows: DataFrame, batch_id: int, **counts: Column) -> tuple[str, dict[str, int]]:
        """Write ``rows`` (with the sink column) as an attempt at the batch, in one job; nobody reads it yet.

        Returns the attempt's name and ``counts``, taken on the way (default: all rows).
        """
        attempt = uuid.uuid4().hex
        seen = Observation(f"batch-{attempt}")
        counted = rows.observe(seen, *[c.alias(k) for k, c in (counts or {"rows": F.count(F.lit(1))}).items()])
        counted.write.partitionBy(self.sink).parquet(self._folder(batch_id, attempt))
        return attempt, {k: int(v) for k, v in seen.get.items()}

    def staged(self, batch_id: int, attempt: str) -> DataFrame:
        """The rows of one attempt."""
        schema = T.StructType([f for f in self.schema.fields if f.name not in ("batch_id", "attempt")])
        return self.spark.read.schema(schema).parquet(self._folder(batch_id, attempt))

    def commit(self, batch_id: int, attempt: str, counts: dict[str, int]) -> None:
        """From now on the batch's rows are those of this attempt."""
        pairs = [F.lit(x) for pair in counts.items() for x in pair]
        record = self.spark.range(0, 1, 1, 1).select(
            F.lit(attempt).alias("attempt"), F.create_map(*pairs).cast(_COMMIT["counts"].dataType).alias("counts"))
        record.write.mode("overwrite").parquet(f"{self.path}/commits/batch_id={batch_id}")

    def replace(self, rows: DataFrame, batch_id: int, **counts: Column) -> dict[str, int]:
        """``stage`` and ``commit``."""
        attempt, got = self.stage(rows, batch_id, **counts)
        self.commit(batch_id, attempt, got)
        return got

    def _folder(self, batch_id: int, attempt: str) -> str:
        return f"{self.path}/rows/batch_id={batch_id}/attempt={attempt}"

    def read(self, sink: str | None = None, columns: list[str] | None = None) -> DataFrame:
        """The rows of all committed batches, of one sink if named; a scan of the committed folders only."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        if sink is not None:
            rows = rows.where(F.col(self.sink) == sink)
        out = rows.join(self.batches().select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi")
        return out.select(*(columns or [c for c in self.schema.names if c != "attempt"]))

    def vacuum(self, keep_from: int = 0) -> int:
        """Remove folders of lost attempts, and whole batches below ``keep_from``; how many folders went.

        Run it from the writer, between batches.
        """
        kept = {(r["batch_id"], r["attempt"]) for r in self.batches().collect()  # a row a batch that is kept
                if r["batch_id"] >= keep_from}
        gone = 0
        for name in sub_folders(self.spark, f"{self.path}/rows"):
            batch_id, folder = int(name.removeprefix("batch_id=")), f"{self.path}/rows/{name}"
            for attempt in sub_folders(self.spark, folder):
                if (batch_id, attempt.removeprefix("attempt=")) not in kept:
                    remove_folder(self.spark, f"{folder}/{attempt}")
                    gone += 1
            if batch_id < keep_from:
                remove_folder(self.spark, f"{self.path}/commits/{name}")
                remove_folder(self.spark, folder)
        return gone
