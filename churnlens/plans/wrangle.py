"""Composite wrangles C1 (training) and C2 (exploration)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import DEFAULT, Tuning
from ..operators.clean import clean
from ..operators.derive import add_churn_label, add_state, add_time_parts, explode_states
from ..schema import EXPLORE_COLUMNS, TRAIN_COLUMNS


def wrangle_train(events: DataFrame, keep_page: bool = False, tuning: Tuning = DEFAULT) -> DataFrame:
    """C1 up to the label: userId, gender, itemInSession, level, length, churn.

    Dedupes on the script's column list (no ``ts``/``sessionId``), so one
    item position repeated in two sessions collapses, as in the reference.
    ``keep_page`` retains ``page`` for scoring, where the page is the truth.
    """
    out = clean(events, TRAIN_COLUMNS, tuning).transform(add_churn_label)
    return out if keep_page else out.drop("page")


def wrangle_explore(events: DataFrame, fan_out: bool = True, tuning: Tuning = DEFAULT) -> DataFrame:
    """The notebook's wrangle with label, UTC time parts and state.

    ``fan_out`` explodes multi-state locations into one row per state (the
    notebook does; it duplicates events, so keep it out of training).
    """
    out = (clean(events, EXPLORE_COLUMNS, tuning)
           .transform(add_churn_label)
           .transform(add_time_parts)
           .transform(add_state))
    return out.transform(explode_states) if fan_out else out.drop("location")
