"""Derived columns: label, time parts, state, state fan-out (F1-F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (churn_label, epoch_ms_day, epoch_ms_hour, epoch_ms_month,
                         epoch_ms_year, split_states, state_of)
from ..schema import LABEL


def add_churn_label(df: DataFrame, page: str = "page", drop_page: bool = False) -> DataFrame:
    """integer label from the page (per event)."""
    out = df.withColumn(LABEL, churn_label(page))
    return out.drop(page) if drop_page else out


def add_time_parts(df: DataFrame, ts: str = "ts", drop_ts: bool = True) -> DataFrame:
    """UTC year, month, day and hour of epoch-ms ``ts`` (ints)."""
    out = df.withColumns({
        "year": epoch_ms_year(ts), "month": epoch_ms_month(ts),
        "day": epoch_ms_day(ts), "hour": epoch_ms_hour(ts),
    })
    return out.drop(ts) if drop_ts else out


def add_state(df: DataFrame, location: str = "location") -> DataFrame:
    """F6."""
    return df.withColumn("state", state_of(location))


def explode_states(df: DataFrame, drop_location: bool = True) -> DataFrame:
    """F7 + F8: one row per ``-``-separated state (fan-out duplicates rows)."""
    out = df.withColumn("state", F.explode(split_states("state")))
    return out.drop("location") if drop_location else out
