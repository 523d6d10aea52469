"""Stream scoring (R2): JSON files arriving in a folder -> scored rows in a table.

``readStream`` with the explicit event schema -> casts -> stream-static join
with a saved per-user mean table -> drop incomplete rows -> dedupe within a
watermark -> the fitted pipeline -> ``writeStream`` to parquet.

The watermark runs on the time of arrival, which never goes back, so no row is
too late, however old its event and in whatever order files come. ``delay``
must cover the longest gap between the arrivals of two copies, or the later
copy gets through as an extra row; state is kept for ``delay``. A row that
lacks only ``length``, of a user without a mean, cannot be scored; a second
stream writes such rows to a side table (label events of new users are among
them), so that every complete row is in one of the two.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Tuning
from ..operators.checkpoint import materialize
from ..operators.clean import cast_columns, user_means
from ..operators.predictions import flagged_rows
from ..schema import EVENT_SCHEMA, TRAIN_COLUMNS
from ..session import scratch_path
from ..plans.score import SCORED_COLUMNS

ARRIVED = "arrived"


def mean_table(events: DataFrame) -> DataFrame:
    """The static per-user mean table a stream imputes from (written once)."""
    return materialize(user_means(cast_columns(events)).drop("__rows"), "stream-user-means")


def bucketed_by_user(means: DataFrame, buckets: int | None = None) -> DataFrame:
    """The mean table written once, bucketed and sorted by ``userId``.

    For a table too large to broadcast: each micro-batch then shuffles only
    its own rows to the bucket layout, instead of re-shuffling the whole
    static table every batch. Stored as an external table under the shared
    checkpoint folder.
    """
    spark = means.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    path = scratch_path(spark, "user-means-bucketed")
    name = "churnlens_user_means_" + path.rsplit("-", 1)[-1]
    (means.write.bucketBy(n, "userId").sortBy("userId").option("path", path)
          .mode("overwrite").saveAsTable(name))
    return spark.table(name)


def filled_stream(spark: SparkSession, source_dir: str, means: DataFrame, delay: str,
                  max_files_per_trigger: int = 1, broadcast_means: bool = False) -> DataFrame:
    """Distinct events with ``length`` filled where a mean is known; null (never NaN) where not.

    Rows that miss another training column (logged-out ones) are dropped, as in
    batch (P6). ``broadcast_means`` should only be set for a mean table whose
    size was checked; otherwise Spark picks the join per micro-batch.
    """
    stream = (spark.readStream.schema(EVENT_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .json(source_dir))
    side = F.broadcast(means) if broadcast_means else means
    length = F.coalesce(F.col("length"), F.col("mean_length"))
    return (cast_columns(stream)
            .join(side, "userId", "left")
            .withColumn("length", F.when(~F.isnan(length), length))
            .withColumn(ARRIVED, F.current_timestamp())
            .select(*TRAIN_COLUMNS, ARRIVED)
            .dropna(how="any", subset=[c for c in TRAIN_COLUMNS if c != "length"])
            .withWatermark(ARRIVED, delay)
            .dropDuplicatesWithinWatermark(TRAIN_COLUMNS))


def scored_stream(spark: SparkSession, source_dir: str, model: PipelineModel, means: DataFrame,
                  delay: str, max_files_per_trigger: int = 1, broadcast_means: bool = False,
                  flagged: bool = False) -> DataFrame:
    """The streaming DataFrame of scored rows (not started); with ``flagged``, P9 and F9 on it."""
    rows = filled_stream(spark, source_dir, means, delay, max_files_per_trigger, broadcast_means)
    scored = model.transform(rows.filter("length IS NOT NULL")).select(*SCORED_COLUMNS)
    return flagged_rows(scored) if flagged else scored


def _sized(means: DataFrame, tuning: Tuning) -> tuple[DataFrame, bool]:
    small = means.count() <= tuning.broadcast_max_rows
    return (means if small else bucketed_by_user(means)), small


def _start(rows: DataFrame, sink_path: str, checkpoint_path: str, every: str | None) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (rows.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint_path)
            .trigger(**trigger)
            .start(sink_path))


def run_score_stream(spark: SparkSession, source_dir: str, model: PipelineModel,
                     means: DataFrame, sink_path: str, checkpoint_path: str,
                     delay: str, max_files_per_trigger: int = 1, tuning: Tuning = DEFAULT,
                     every: str | None = None, flagged: bool = False) -> StreamingQuery:
    """Start scoring: what is there and then stop, or a micro-batch ``every`` so often.

    The checkpoint location makes the query restartable after a failure with
    exactly-once output to the file sink.
    """
    means, small = _sized(means, tuning)
    return _start(scored_stream(spark, source_dir, model, means, delay, max_files_per_trigger, small, flagged),
                  sink_path, checkpoint_path, every)


def run_unfilled_stream(spark: SparkSession, source_dir: str, means: DataFrame, sink_path: str,
                        checkpoint_path: str, delay: str, max_files_per_trigger: int = 1,
                        tuning: Tuning = DEFAULT, every: str | None = None) -> StreamingQuery:
    """Start the side table: complete rows but for a ``length`` that no mean fills."""
    means, small = _sized(means, tuning)
    rows = filled_stream(spark, source_dir, means, delay, max_files_per_trigger, small)
    return _start(rows.filter("length IS NULL").select(*TRAIN_COLUMNS), sink_path, checkpoint_path, every)
