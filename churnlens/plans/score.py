"""Batch scoring (C4): read events -> clean -> predict -> flag -> write a table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..config import DEFAULT, Tuning
from ..operators.clean import clean
from ..operators.predictions import flagged_rows
from ..schema import PREDICTION, TRAIN_COLUMNS
from ..sources.sinks import write_table

SCORED_COLUMNS = TRAIN_COLUMNS + [PREDICTION]


def score_events(events: DataFrame, model: PipelineModel, tuning: Tuning = DEFAULT) -> DataFrame:
    """M10 on cleaned events: userId, gender, itemInSession, level, length, page, churn_pred.

    Means for imputation come from the batch being scored (as in the
    reference). The model carries its own indexer, so no refit happens here.
    """
    rows = clean(events, TRAIN_COLUMNS, tuning)
    return model.transform(rows).select(*SCORED_COLUMNS)


def score_batch(events: DataFrame, model: PipelineModel, out_path: str | None = None,
                fmt: str = "parquet", tuning: Tuning = DEFAULT) -> DataFrame:
    """C4: flagged rows with ``correct_prediction``; written to ``out_path`` when given."""
    flagged = flagged_rows(score_events(events, model, tuning))
    if out_path is None:
        return flagged
    write_table(flagged, out_path, fmt)
    return flagged.sparkSession.read.format(fmt).load(out_path)
