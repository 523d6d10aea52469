"""Training job (C3): wrangle -> balance -> split/folds -> cross-validate -> evaluate -> save."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Tuning
from ..ml.estimators import cross_validator
from ..ml.evaluate import evaluate_model
from ..ml.nested import NestedValidator
from ..operators.balance import assign_folds, balanced_sample, hash_split
from ..operators.checkpoint import materialize
from ..schema import LABEL, MODEL_FEATURES, SCRIPT_BALANCE_K
from ..sources.sinks import save_pipeline
from .wrangle import wrangle_train

BINARY_LABEL = "churn_any"


def prepare_training(events: DataFrame, k: float = SCRIPT_BALANCE_K, split_by: str = "row",
                     tuning: Tuning = DEFAULT) -> DataFrame:
    """C1 end to end: wrangled rows, class-balanced, with ``split`` and ``fold``.

    Written once to the shared checkpoint folder: every CV fit and evaluation
    restarts from this table instead of re-running the wrangle (the reference
    re-reads the JSON on each action).
    """
    # The sample reads the wrangled rows twice (class counts, then rows): write
    # them once so the wrangle is not recomputed.
    wrangled = materialize(wrangle_train(events, tuning=tuning), "wrangled")
    rows = (wrangled
            .transform(balanced_sample, k=k)
            .transform(hash_split, split_by=split_by, tuning=tuning)
            .transform(assign_folds, tuning=tuning)
            .withColumn(BINARY_LABEL, (F.col(LABEL) > 0).cast("int")))
    return materialize(rows, "training-set")


def fit_best(prepared: DataFrame, kind: str = "dt", features: Sequence[str] = MODEL_FEATURES,
             grid: dict | None = None, parallelism: int = 8) -> PipelineModel:
    """Cross-validate on the train split and return the refitted best pipeline (M9).

    Boosted trees take the nested search: the same best model from half the fits.
    """
    label = BINARY_LABEL if kind == "gbt_binary" else LABEL
    train = prepared.where(F.col("split") == "train")
    if kind.startswith("gbt"):
        return NestedValidator(kind, features, grid, parallelism, label, index_on=prepared).fit(train).best_model
    cv = cross_validator(kind, features, grid, parallelism, label, index_on=prepared).fit(train)
    return cv.bestModel


def train_and_evaluate(prepared: DataFrame, kind: str = "dt",
                       features: Sequence[str] = MODEL_FEATURES, grid: dict | None = None,
                       save_to: str | None = None, name: str | None = None,
                       parallelism: int = 8) -> tuple[PipelineModel, DataFrame]:
    """Fit, score the validation and test splits, optionally save.

    Returns the model and a metrics table (one row per split).
    """
    model = fit_best(prepared, kind, features, grid, parallelism)
    if save_to:
        save_pipeline(model, save_to)
    label = BINARY_LABEL if kind == "gbt_binary" else LABEL
    name = name or kind
    metrics = None
    for split in ("valid", "test"):
        part = prepared.where(F.col("split") == split)
        row = evaluate_model(model, part, name, split, label)
        metrics = row if metrics is None else metrics.unionByName(row)
    return model, metrics
