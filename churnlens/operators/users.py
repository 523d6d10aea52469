"""User-level views: at-risk users, user churn, action rates by group.

All are two-level aggregations (events -> user-day or user-page -> user or
group), so every shuffle carries partially aggregated rows and a user with a
huge share of events is combined map-side before any exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checkpoint import materialize
from ..schema import CANCEL_PAGE, CLASS_CANCEL, CLASS_DOWNGRADE, DOWNGRADE_PAGE, LABEL, PREDICTION

SONG_PAGE = "NextSong"


def at_risk_users(flagged: DataFrame, pred: str = PREDICTION) -> DataFrame:
    """One row per user with at least one flagged event."""
    return flagged.groupBy("userId").agg(
        F.count(F.lit(1)).alias("flagged_events"),
        F.count_if(F.col(pred) == float(CLASS_CANCEL)).alias("cancel_flags"),
        F.count_if(F.col(pred) == float(CLASS_DOWNGRADE)).alias("downgrade_flags"),
        F.max(pred).alias("max_risk"),
        F.count_if(F.col("correct_prediction")).alias("confirmed_flags"))


def page_day_counts(events: DataFrame) -> DataFrame:
    """Events per (user, page, day): the one aggregate R4 and R5 are derived from.

    The label is a function of the page, so the user's churn class, songs,
    downgrades and cancellations all follow from these counts.
    """
    return events.groupBy("userId", "page", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"), F.max(LABEL).alias("churn_max"))


def _user_days(counts: DataFrame) -> DataFrame:
    n = F.col("n")
    return counts.groupBy("userId", "year", "month", "day").agg(
        F.sum(n).alias("n"),
        F.sum(F.when(F.col("page") == SONG_PAGE, n).otherwise(F.lit(0))).alias("songs"),
        F.sum(F.when(F.col("page") == DOWNGRADE_PAGE, n).otherwise(F.lit(0))).alias("downgrades"),
        F.sum(F.when(F.col("page") == CANCEL_PAGE, n).otherwise(F.lit(0))).alias("cancels"),
        F.max("churn_max").alias("churn_max"))


def _user_churn_from_counts(counts: DataFrame) -> DataFrame:
    return _user_days(counts).groupBy("userId").agg(
        F.max("churn_max").alias("user_churn"),
        F.sum("n").alias("n_events"), F.sum("songs").alias("n_songs"),
        F.sum("downgrades").alias("n_downgrades"), F.sum("cancels").alias("n_cancels"),
        F.count(F.lit(1)).alias("active_days"))


def user_churn(events: DataFrame) -> DataFrame:
    """User-level churn class = the highest event label of the user.

    ``events``: the exploration wrangle without state fan-out (needs userId,
    page, churn and the date parts).
    """
    return _user_churn_from_counts(page_day_counts(events))


def group_rates(events: DataFrame) -> DataFrame:
    """Per user-churn group and page, events per active user-day and per song.

    The events are aggregated once to (user, page, day) counts, written to the
    shared checkpoint folder, and every later step reads that small table.
    """
    counts = materialize(page_day_counts(events), "page-day-counts")
    users = _user_churn_from_counts(counts).select("userId", "user_churn", "n_songs",
                                                   "active_days")
    per_user_page = counts.groupBy("userId", "page").agg(F.sum("n").alias("n"))
    joined = per_user_page.join(users.select("userId", "user_churn"), "userId")
    totals = users.groupBy("user_churn").agg(
        F.count(F.lit(1)).alias("group_users"), F.sum("active_days").alias("group_days"),
        F.sum("n_songs").alias("group_songs"))
    pages = joined.groupBy("user_churn", "page").agg(F.sum("n").alias("n_events"),
                                                     F.count(F.lit(1)).alias("n_users"))
    return (pages.join(F.broadcast(totals), "user_churn")  # <= number of classes rows
                 .select("user_churn", "page", "n_events", "n_users", "group_users",
                         (F.col("n_events").cast("double") / F.col("group_days"))
                         .alias("events_per_user_day"),
                         F.when(F.col("group_songs") > 0, F.col("n_events").cast("double")
                                / F.col("group_songs")).alias("events_per_song")))
