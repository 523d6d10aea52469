"""Event sources (S1, S2) and the fixture adapter over the driver's ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequence import row_number_within
from ..schema import CANCEL_PAGE, DOWNGRADE_PAGE, EVENT_SCHEMA


def read_events(spark: SparkSession, path: str | list[str], mode: str = "PERMISSIVE",
                corrupt_column: str | None = None) -> DataFrame:
    """Read JSON-lines events with the explicit event schema.

    No inference pass over the data (the reference infers on every read), and
    the same schema serves ``readStream``. ``mode`` is Spark's JSON parse mode
    (``PERMISSIVE`` keeps malformed lines as nulls, ``DROPMALFORMED`` drops
    them, ``FAILFAST`` raises). With ``corrupt_column`` a malformed line is
    kept whole in that column, which is null in the other rows.
    """
    reader = spark.read.option("mode", mode)
    if corrupt_column is None:
        return reader.schema(EVENT_SCHEMA).json(path)
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(corrupt_column, T.StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", corrupt_column).json(path)


def line_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``lines``, ``malformed`` and ``parsed`` counts and the newest parsed ``ts``, one row.

    Cleaning drops a malformed line, which has no user; this tells how many.
    """
    rows = read_events(spark, path, corrupt_column="_malformed")
    good = F.col("_malformed").isNull()
    return rows.agg(F.count(F.lit(1)).alias("lines"), F.count("_malformed").alias("malformed"),
                    F.count_if(good).alias("parsed"), F.max(F.when(good, F.col("ts"))).alias("newest_ts"))


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    """The column names and types (``printSchema`` as data)."""
    return df.dtypes


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (``show(n)`` as a DataFrame); a limit is the feature."""
    return df.limit(n)


# --- fixture adapter ---------------------------------------------------------
# Fixed values of the adapter specification (FIXTURES.md section 3).
LOCATIONS = [
    "Boston-Cambridge-Newton, MA-NH",
    "New York-Newark-Jersey City, NY-NJ-PA",
    "Los Angeles-Long Beach-Anaheim, CA",
    "Remote",
]
SONG_EVENTS = ["click", "view", "purchase"]
MISSING_USER_EVERY = 41


def adapt_events(events: DataFrame, numbering: str = "auto") -> DataFrame:
    """Map the driver's ``events`` table onto the documented clickstream columns.

    Output: userId (string, ``''`` for logged-out rows), gender, itemInSession,
    sessionId, level, length, page, location, method, status, ts (epoch ms).
    Every column is a built-in expression. ``itemInSession`` is the position
    within one user-day (the session), from ``row_number_within``, which
    splits a user-day too large for one task (``numbering``: auto, window,
    range).
    """
    e = events.select("event_id", "ts", "user_id", "event_type", "value",
                      F.dayofmonth("ts").alias("__day"))
    e = row_number_within(e, ["user_id", "__day"], ["ts", "event_id"], "__item", method=numbering)
    day = F.col("__day")
    missing = (F.col("event_id") % MISSING_USER_EVERY) == 0
    uid = F.col("user_id")
    etype = F.col("event_type")
    eid_mod10 = F.col("event_id") % 10
    # Epoch microseconds of a TIMESTAMP_NTZ, independent of the session zone.
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              F.col("ts"))
    ts_ms = ((micros - F.pmod(micros, F.lit(1000))) / F.lit(1000)).cast("long")
    location = F.element_at(F.array(*[F.lit(x) for x in LOCATIONS]),
                            (F.pmod(uid, F.lit(len(LOCATIONS))) + 1).cast("int"))
    return e.select(
        F.when(missing, F.lit("")).otherwise(uid.cast("string")).alias("userId"),
        F.when(missing, F.lit(None).cast("string"))
         .when(F.pmod(uid, F.lit(5)) < 3, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.col("__item").alias("itemInSession"),
        (uid * 100 + day).cast("long").alias("sessionId"),
        F.when(F.pmod(uid + F.floor(day / 10), F.lit(4)) == 0, F.lit("free"))
         .otherwise(F.lit("paid")).alias("level"),
        F.when(etype.isin(*SONG_EVENTS), F.round(F.col("value") * 100)).cast("double").alias("length"),
        F.when(etype.isin(*SONG_EVENTS), F.lit("NextSong"))
         .when((etype == "error") & (eid_mod10 == 0), F.lit(CANCEL_PAGE))
         .when((etype == "error") & eid_mod10.between(1, 4), F.lit(DOWNGRADE_PAGE))
         .when(etype == "error", F.lit("Error"))
         .when(etype == "signup", F.lit("Home")).alias("page"),
        location.alias("location"),
        F.when(etype == "view", F.lit("GET")).otherwise(F.lit("PUT")).alias("method"),
        F.when(etype == "error", F.lit(404)).when(etype == "signup", F.lit(307))
         .otherwise(F.lit(200)).cast("long").alias("status"),
        ts_ms.alias("ts"),
    )


def load_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def load_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapted clickstream for a driver data directory."""
    return adapt_events(load_events_table(spark, sf_dir))
