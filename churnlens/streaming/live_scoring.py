"""R2 as one query: events in, means kept up, scored, flagged, unfilled and malformed rows out.

``readStream`` -> casts -> copies of an event dropped within the watermark, the
only state -> ``foreachBatch``. A batch lands its rows once; from the landed
rows it adds to the running means (A1), fills lengths from the means as of this
batch (J1, P5), scores (M10), flags (P9, F9), adds to the users at risk (R3)
and commits all sinks together (S6). A batch that was committed is skipped when
the engine sends it again; one that was lost half way replaces what it had
written. So each event counts once in the means and stands once in the sinks.

Unlike in batch scoring, where means come from the whole upload, a row is filled
from what its user has played up to its own batch; rows whose user has no length
yet go to the sink ``unfilled``. The grain is the event: rows that differ in
session or time alone stay apart (A7 is the reader's ``distinct``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Tuning
from ..functions import prediction_correct
from ..operators.clean import cast_columns
from ..operators.joins import attach_by_key
from ..operators.users import at_risk_users
from ..schema import AT_RISK_CLASSES, EVENT_SCHEMA, PREDICTION, TRAIN_COLUMNS
from ..session import STATE_CONF, with_conf
from ..sources.batches import BatchTable
from ..sources.files import make_folder, remove_folder, sub_folders
from .running import has_length, live_at_risk, live_means, mean_of, user_lengths

ARRIVED = "arrived"
MALFORMED = "_malformed"
#: What tells two events apart.
EVENT_COLUMNS = [*TRAIN_COLUMNS, "sessionId", "ts"]
SINKS = ("scored", "flagged", "unfilled", "malformed")

ROW_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()), T.StructField("gender", T.StringType()),
    T.StructField("itemInSession", T.LongType()), T.StructField("level", T.StringType()),
    T.StructField("length", T.DoubleType()), T.StructField("page", T.StringType()),
    T.StructField("sessionId", T.LongType()), T.StructField("ts", T.LongType()),
    T.StructField(PREDICTION, T.DoubleType()), T.StructField("correct_prediction", T.BooleanType()),
    T.StructField("line", T.StringType())])


def live_events(spark: SparkSession, source_dir: str, delay: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The events as they arrive, copies dropped; a malformed line is a row with its text in ``_malformed``.

    ``delay`` must cover the longest gap between the arrivals of two copies. The
    watermark runs on arrival, so no event is too late, however old.
    """
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(MALFORMED, T.StringType())])
    stream = (spark.readStream.schema(schema).option("columnNameOfCorruptRecord", MALFORMED)
              .option("maxFilesPerTrigger", max_files_per_trigger).json(source_dir))
    columns = [*EVENT_COLUMNS, MALFORMED]
    return (cast_columns(stream).withColumn(ARRIVED, F.current_timestamp()).select(*columns, ARRIVED)
            .withWatermark(ARRIVED, delay).dropDuplicatesWithinWatermark(columns).drop(ARRIVED))


class LiveScorer:
    """The work of a micro-batch and the tables it keeps under ``tables``.

    ``rows``: the sinks; ``means``, ``at_risk``: running aggregates;
    ``landed``: the events of the last ``keep_landed`` batches.
    """

    def __init__(self, spark: SparkSession, tables: str, model: Transformer, tuning: Tuning = DEFAULT,
                 compact_every: int = 20, keep_landed: int = 2):
        self.spark, self.tables, self.model, self.tuning = spark, tables, model, tuning
        self.keep_landed = keep_landed
        self.rows = BatchTable(spark, f"{tables}/rows", ROW_SCHEMA)
        self.means = live_means(spark, f"{tables}/means", compact_every)
        self.at_risk = live_at_risk(spark, f"{tables}/at_risk", compact_every)
        make_folder(spark, f"{tables}/landed")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.rows.done(batch_id):
            return
        landed = self.land(batch, batch_id)
        if landed.isEmpty():  # the engine's batches that only drop old state
            return
        users = self.batch_users(landed, batch_id)
        self.means.add(users.where("n > 0"), batch_id)
        out = self.sink_rows(self.fill(landed, users, batch_id), landed)
        attempt, counts = self.rows.stage(out, batch_id, **{s: F.count_if(F.col("sink") == s) for s in SINKS})
        flagged = self.rows.staged(batch_id, attempt).where(F.col("sink") == "flagged")
        self.at_risk.add(at_risk_users(flagged), batch_id)
        self.rows.commit(batch_id, attempt, counts)
        for kept in (self.means, self.at_risk):
            kept.compact(batch_id)
        self.tidy(batch_id)

    def land(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch written once: the stream's plan, with its state, runs a single time."""
        path = f"{self.tables}/landed/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path)

    def batch_users(self, landed: DataFrame, batch_id: int) -> DataFrame:
        """What the batch has of each user, from one pass over it, written once.

        ``total`` and ``n`` of the lengths, and ``__rows``: the rows that P6 keeps and that lack a length.
        """
        kept = reduce(and_, [F.col(c).isNotNull() for c in TRAIN_COLUMNS if c != "length"])
        users = user_lengths(landed.where(F.col(MALFORMED).isNull()), __rows=F.count_if(kept & ~has_length()))
        path = f"{self.tables}/users/batch_id={batch_id}"
        users.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(users.schema).parquet(path)

    def fill(self, landed: DataFrame, users: DataFrame, batch_id: int) -> DataFrame:
        """P6 on all columns but ``length``, then J1 and P5 with the means as of the batch.

        Only users who lack a length in this batch are looked up; the join
        broadcasts their means by measured size or salts hot users.
        """
        rows = landed.where(F.col(MALFORMED).isNull()).select(*EVENT_COLUMNS).withColumn(
            "length", F.when(~F.isnan("length"), F.col("length")))
        rows = rows.dropna(how="any", subset=[c for c in TRAIN_COLUMNS if c != "length"])
        lacking = users.where("__rows > 0").select("userId", "__rows")
        means = mean_of(self.means.as_of(batch_id, lacking.select("userId"))).join(lacking, "userId")
        joined = attach_by_key(rows, means, "userId", "__rows", self.tuning,
                               path=f"{self.tables}/side/batch_id={batch_id}")
        return joined.withColumn("length", F.coalesce("length", "mean_length")).select(*EVENT_COLUMNS)

    def sink_rows(self, filled: DataFrame, landed: DataFrame) -> DataFrame:
        """The rows of all sinks: a flagged row is in ``scored`` as well."""

        def shaped(df: DataFrame, *extra: str) -> DataFrame:
            return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                               for f in ROW_SCHEMA.fields], *extra)

        full = F.col("length").isNotNull()
        at_risk = F.col(PREDICTION).isin(*[float(k) for k in AT_RISK_CLASSES])
        both = F.array(F.lit("scored"), F.lit("flagged"))
        scored = (self.model.transform(filled.where(full)).select(*EVENT_COLUMNS, PREDICTION)
                  .withColumn("correct_prediction", F.when(at_risk, prediction_correct()))
                  .withColumn("sink", F.explode(F.when(at_risk, both).otherwise(F.array(F.lit("scored"))))))
        unfilled = filled.where(~full).withColumn("sink", F.lit("unfilled"))
        malformed = (landed.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("line"))
                     .withColumn("sink", F.lit("malformed")))
        return shaped(scored, "sink").unionByName(shaped(unfilled, "sink")).unionByName(shaped(malformed, "sink"))

    def tidy(self, batch_id: int) -> None:
        """Remove the working folders of batches that no replay can need."""
        for part in ("landed", "side", "users"):
            keep = self.keep_landed if part == "landed" else 1
            for name in sub_folders(self.spark, f"{self.tables}/{part}"):
                if int(name.removeprefix("batch_id=")) <= batch_id - keep:
                    remove_folder(self.spark, f"{self.tables}/{part}/{name}")


def run_live_scoring(spark: SparkSession, source_dir: str, model: Transformer, tables: str, checkpoint: str,
                     delay: str, max_files_per_trigger: int = 1, every: str | None = None, tuning: Tuning = DEFAULT,
                     compact_every: int = 20, on_batch: Callable[[DataFrame, int], None] | None = None,
                     state_partitions: int | None = None) -> StreamingQuery:
    """Start the query: what is there and then stop, or a micro-batch ``every`` so often.

    ``tables`` belongs to ``checkpoint``: batch numbers start anew with a new
    checkpoint, so a folder of tables that another one has filled is refused.
    ``on_batch`` stands in for the scorer in tests. ``state_partitions`` holds
    from the checkpoint's first run on (default: the session's shuffle
    partitions). A run that stops by itself starts no batch without rows: the
    next run's first batch drops what has expired.
    """
    claim(spark, tables, checkpoint)
    work = on_batch or LiveScorer(spark, tables, model, tuning, compact_every)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    conf = dict(STATE_CONF)
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    if not every:
        conf["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    with with_conf(spark, conf):
        return (live_events(spark, source_dir, delay, max_files_per_trigger).writeStream
                .foreachBatch(work).outputMode("append").option("checkpointLocation", checkpoint)
                .trigger(**trigger).start())


def claim(spark: SparkSession, tables: str, checkpoint: str) -> None:
    """Note the checkpoint that fills ``tables``; an error if it is another one."""
    owner = f"{make_folder(spark, tables)}/owner"
    had = [r["value"] for r in spark.read.text(owner).collect()] if "owner" in sub_folders(spark, tables) else []
    if had and had != [checkpoint]:
        raise ValueError(f"{tables} is filled from the checkpoint {had[0]}, not {checkpoint}")
    if not had:
        spark.range(0, 1, 1, 1).select(F.lit(checkpoint).alias("value")).write.mode("overwrite").text(owner)
