"""Spark ML stages: string indexing, feature assembly, classifiers, grids.

The string indexer sits inside the fitted pipeline with alphabetical order
and ``handleInvalid="keep"``, so scoring reuses the training codes (the
reference refits indexers on every upload, which can swap codes) and an
unseen category lands in the extra bucket instead of failing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame

from ..schema import (DT_GRID, GBT_GRID, GBT_MAX_ITER, LABEL, MODEL_FEATURES, NUM_FOLDS,
                      PREDICTION, RF_GRID, SEED, STRING_FEATURES)

KINDS = ("dt", "rf", "gbt_ovr", "gbt_binary")


def _indexer(cols: Sequence[str]) -> StringIndexer:
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}__idx" for c in cols],
                         stringOrderType="alphabetAsc", handleInvalid="keep")


def index_strings(df: DataFrame, cols: Sequence[str] = STRING_FEATURES) -> DataFrame:
    """M1 as a standalone step: replace each string column by its index (double)."""
    out = _indexer(cols).fit(df).transform(df)
    for c in cols:
        out = out.drop(c).withColumnRenamed(f"{c}__idx", c)
    return out


def make_classifier(kind: str, label: str = LABEL):
    """M3-M5. ``gbt_ovr`` wraps binary GBT in one-vs-rest for the three classes;
    ``gbt_binary`` predicts ``churn > 0`` (the caller supplies that label)."""
    common = dict(featuresCol="features", labelCol=label, predictionCol=PREDICTION)
    if kind == "dt":
        return DecisionTreeClassifier(seed=SEED, **common)
    if kind == "rf":
        return RandomForestClassifier(seed=SEED, **common)
    if kind == "gbt_binary":
        return GBTClassifier(maxIter=GBT_MAX_ITER, seed=SEED, **common)
    if kind == "gbt_ovr":
        inner = GBTClassifier(maxIter=GBT_MAX_ITER, seed=SEED, featuresCol="features",
                              labelCol=label)
        # The per-class binary models are independent: fit them concurrently.
        return OneVsRest(classifier=inner, parallelism=3, **common)
    raise ValueError(f"unknown classifier kind {kind!r}; expected one of {KINDS}")


def build_model_pipeline(kind: str = "dt", features: Sequence[str] = MODEL_FEATURES,
                         label: str = LABEL, index_on: DataFrame | None = None
                         ) -> tuple[Pipeline, object]:
    """M2 + M6: [indexer] -> assembler -> classifier. Returns (pipeline, classifier).

    With ``index_on`` the indexer is fitted once on that table (as the
    reference indexes the whole wrangled table before splitting) and enters
    the pipeline as a fitted stage, so cross-validation does not refit it per
    fold; otherwise it is fitted with the pipeline.
    """
    strings = [c for c in features if c in STRING_FEATURES]
    stages = []
    if strings:
        stages = [_indexer(strings).fit(index_on) if index_on is not None else _indexer(strings)]
    inputs = [f"{c}__idx" if c in strings else c for c in features]
    clf = make_classifier(kind, label)
    stages += [VectorAssembler(inputCols=inputs, outputCol="features"), clf]
    return Pipeline(stages=stages), clf


def param_grid(kind: str, clf, grid: dict | None = None) -> list:
    """M7: the reference's grid for each classifier (override with ``grid``)."""
    target = clf.getClassifier() if isinstance(clf, OneVsRest) else clf
    spec = grid if grid is not None else {"dt": DT_GRID, "rf": RF_GRID}.get(kind, GBT_GRID)
    b = ParamGridBuilder()
    for name, values in spec.items():
        b = b.addGrid(target.getParam(name), list(values))
    return b.build()


def evaluator(metric: str = "f1", label: str = LABEL) -> MulticlassClassificationEvaluator:
    """M11-M13 (``f1``, ``weightedPrecision``, ``weightedRecall``)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=PREDICTION,
                                             metricName=metric)


def cross_validator(kind: str = "dt", features: Sequence[str] = MODEL_FEATURES,
                    grid: dict | None = None, parallelism: int = 8,
                    label: str = LABEL, index_on: DataFrame | None = None) -> CrossValidator:
    """M8: k-fold CV on a precomputed ``fold`` column, best by weighted F1.

    Hash folds make the folds independent of partitioning; ``parallelism``
    fits grid points concurrently (the reference fits them in sequence).
    """
    pipe, clf = build_model_pipeline(kind, features, label, index_on)
    return CrossValidator(estimator=pipe, estimatorParamMaps=param_grid(kind, clf, grid),
                          evaluator=evaluator("f1", label), numFolds=NUM_FOLDS, foldCol="fold",
                          parallelism=parallelism, seed=SEED)
