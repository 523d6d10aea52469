"""M7-M9 for boosted trees: one fit serves every grid point that differs in the number of rounds alone.

Boosting adds trees one after the other, so the model of 20 rounds holds the
model of 10 as its first 10 trees. ``NestedValidator`` fits each other
combination of parameters once a fold, with the largest ``maxIter``, cuts the
shorter models out of it, and scores all of them side by side in one pass over
the fold. The reference's grid needs half the fits (6 for 12, before the last
one on all rows), with the metrics, best point and best model of the full grid.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, OneVsRestModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import GBT_GRID, LABEL, MODEL_FEATURES, NUM_FOLDS
from .estimators import build_model_pipeline
from .evaluate import compare_in_one_pass

ROUNDS = "maxIter"


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model after its first ``rounds`` trees, with the columns of the whole one."""
    if rounds >= len(model.trees):
        return model
    spark = SparkSession.active()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    whole = model._java_obj
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = whole.trees()[i], whole.treeWeights()[i]
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{whole.uid()}_{rounds}", trees, weights)
    for name in ("featuresCol", "predictionCol", "rawPredictionCol", "probabilityCol"):
        cut.set(cut.getParam(name), whole.getOrDefault(whole.getParam(name)))
    return GBTClassificationModel(cut)


def first_rounds_of(model: PipelineModel, rounds: int) -> PipelineModel:
    """``first_rounds`` of the classifier at a pipeline's end, of every class's if it is one-vs-rest."""
    last = model.stages[-1]
    if isinstance(last, OneVsRestModel):
        cut = OneVsRestModel(models=[first_rounds(m, rounds) for m in last.models])
        last._copyValues(cut)  # columns, and the classifier that a saved model names
    else:
        cut = first_rounds(last, rounds)
    return PipelineModel(stages=[*model.stages[:-1], cut])


@dataclass
class NestedResult:
    """``points``: the grid in its order; ``metrics``: the mean weighted F1 of each; the best point and its model."""

    points: list[dict]
    metrics: list[float]
    best: dict
    best_model: PipelineModel
    fits: int


class NestedValidator:
    """k-fold validation on the column ``fold`` as ``cross_validator``, for ``gbt_ovr`` and ``gbt_binary``."""

    def __init__(self, kind: str = "gbt_ovr", features: Sequence[str] = MODEL_FEATURES,
                 grid: Mapping[str, Sequence] | None = None, parallelism: int = 8, label: str = LABEL,
                 index_on: DataFrame | None = None, folds: int = NUM_FOLDS):
        self.kind, self.features, self.label, self.index_on = kind, list(features), label, index_on
        self.grid = {k: list(v) for k, v in (GBT_GRID if grid is None else grid).items()}
        self.parallelism, self.folds = parallelism, folds

    def _fit(self, train: DataFrame, point: Mapping) -> PipelineModel:
        pipe, clf = build_model_pipeline(self.kind, self.features, self.label, self.index_on)
        target = clf.getClassifier() if self.kind == "gbt_ovr" else clf
        return pipe.fit(train, {target.getParam(k): v for k, v in point.items()})

    def fit(self, train: DataFrame) -> NestedResult:
        """Fit the longest models of every fold at once, score all their prefixes, refit the best point on all rows."""
        names = list(self.grid)
        points = [dict(zip(names, values)) for values in product(*self.grid.values())]
        others = [n for n in names if n != ROUNDS]
        chains: dict[tuple, list[int]] = {}
        for i, p in enumerate(points):
            chains.setdefault(tuple(p[n] for n in others), []).append(i)

        def run(job: tuple[int, tuple]) -> dict[int, float]:
            fold, key = job
            members = chains[key]
            longest = max(members, key=lambda i: points[i].get(ROUNDS, 0))
            model = self._fit(train.where(F.col("fold") != fold), points[longest])
            models = {str(i): first_rounds_of(model, points[i][ROUNDS]) if ROUNDS in points[i] else model
                      for i in members}
            rows = compare_in_one_pass(models, train.where(F.col("fold") == fold), self.label).collect()  # a row a model
            return {int(r["model"]): r["f1"] for r in rows}

        jobs = [(fold, key) for fold in range(self.folds) for key in chains]
        with ThreadPoolExecutor(self.parallelism) as pool:
            told = list(pool.map(run, jobs))
        metrics = [sum(t.get(i, 0.0) for t in told if i in t) / self.folds for i in range(len(points))]
        best = max(range(len(points)), key=lambda i: metrics[i])
        return NestedResult(points, metrics, points[best], self._fit(train, points[best]), len(jobs) + 1)


def metric_rows(result: NestedResult, spark: SparkSession) -> DataFrame:
    """One row per grid point: its parameters, its mean F1, whether it is the best."""
    rows = [(*p.values(), m, p == result.best) for p, m in zip(result.points, result.metrics)]
    kinds = ["double" if isinstance(v, float) else "int" if isinstance(v, int) else "string"
             for v in result.points[0].values()]
    ddl = ", ".join(f"`{n}` {k}" for n, k in zip(result.points[0], kinds))
    return spark.createDataFrame(rows, f"{ddl}, f1 double, best boolean")


__all__ = ["NestedResult", "NestedValidator", "first_rounds", "first_rounds_of", "metric_rows"]
