"""Model evaluation and comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.predictions import weighted_metrics
from ..schema import LABEL, PREDICTION
from .estimators import evaluator


def mllib_metrics(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    """M11-M13 with MLlib's evaluator (each call is one distributed pass)."""
    return {m: evaluator(m, label).evaluate(predictions)
            for m in ("f1", "weightedPrecision", "weightedRecall")}


def evaluate_model(model: PipelineModel, data: DataFrame, name: str, split: str = "test",
                   label: str = LABEL) -> DataFrame:
    """M10 + M11-M13 + flagged-row count, as a one-row DataFrame."""
    pred = model.transform(data)
    metrics = weighted_metrics(pred, label=label, digits=None)
    return metrics.select(F.lit(name).alias("model"), F.lit(split).alias("split"), "*")


def side_by_side(models: Mapping[str, Transformer], data: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and one row per model: ``model`` and its prediction.

    The models' stages stand one after the other in one map-only plan; each
    one's working columns are dropped before the next. Rows are exploded after
    the last, so ``data`` is read once whatever the number of models.
    """
    names, out = list(models), data
    for i, name in enumerate(names):
        done = [f"__p{k}" for k in range(i)]
        out = models[name].transform(out).select(*data.columns, *done, F.col(PREDICTION).alias(f"__p{i}"))
    pairs = F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"__p{i}").alias(PREDICTION))
                      for i, n in enumerate(names)])
    return out.select(*keep, F.explode(pairs).alias("__pair")).select(*keep, "__pair.*")


def compare_in_one_pass(models: Mapping[str, Transformer], data: DataFrame, label: str = LABEL,
                        split: str = "test", digits: int | None = None) -> DataFrame:
    """M15 with one scan and one aggregation for all models: the rows of ``compare_models``.

    Partial sums of the confusion cells, at most models times classes squared
    rows a task, are all that is shuffled. A model that predicts on no row at
    all has no row here.
    """
    metrics = weighted_metrics(side_by_side(models, data, [label]), label=label, digits=digits, by="model")
    return metrics.select("model", F.lit(split).alias("split"), "f1", "weighted_precision", "weighted_recall",
                          "n_rows", "flagged_rows")


def compare_models(models: Mapping[str, PipelineModel], data: DataFrame,
                   label: str = LABEL) -> DataFrame:
    """Every model on one test set -> one metrics row per model."""
    out = None
    for name, m in models.items():
        row = evaluate_model(m, data, name, label=label)
        out = row if out is None else out.unionByName(row)
    return out
