"""Nested grids against the full search, models cut to their first rounds, comparison in one pass."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from churnlens.ml.estimators import build_model_pipeline, cross_validator
from churnlens.ml.evaluate import compare_in_one_pass, compare_models, mllib_metrics, side_by_side
from churnlens.ml.nested import NestedValidator, first_rounds_of, metric_rows
from churnlens.ml.rules import RULES, rule_pipeline
from churnlens.plans.train import BINARY_LABEL, prepare_training
from churnlens.schema import LABEL
from churnlens.sources import load_clickstream


@pytest.fixture(scope="module")
def prepared(spark):
    return prepare_training(load_clickstream(spark, SF_SMALL))


def _fit(prepared, kind, label, rounds):
    pipe, clf = build_model_pipeline(kind, label=label, index_on=prepared)
    target = clf.getClassifier() if kind == "gbt_ovr" else clf
    return pipe.fit(prepared, {target.maxIter: rounds, target.maxDepth: 3})


@pytest.mark.parametrize("kind,label", [("gbt_binary", BINARY_LABEL), ("gbt_ovr", LABEL)])
def test_first_rounds_are_the_shorter_model(spark, prepared, scratch, kind, label):
    long, short = _fit(prepared, kind, label, 3), _fit(prepared, kind, label, 2)
    cut = first_rounds_of(long, 2)

    def predicted(model):
        return [r["churn_pred"] for r in model.transform(prepared).select("churn_pred").collect()]

    assert predicted(cut) == predicted(short)
    assert first_rounds_of(long, 9).transform(prepared).count() == prepared.count()
    cut.write().overwrite().save(f"{scratch}/cut")  # a cut model is a model like any other
    assert predicted(type(cut).load(f"{scratch}/cut")) == predicted(short)


def test_nested_search_equals_the_full_one(spark, prepared):
    grid, train = {"maxDepth": [2, 3], "maxIter": [1, 3, 2]}, prepared.where("split = 'train'")
    nested = NestedValidator("gbt_binary", grid=grid, label=BINARY_LABEL, index_on=prepared).fit(train)
    full = cross_validator("gbt_binary", grid=grid, label=BINARY_LABEL, index_on=prepared).fit(train)
    assert nested.metrics == pytest.approx(list(full.avgMetrics), abs=1e-12)
    assert nested.fits == 7 and len(nested.points) == 6  # 18 and the last one otherwise
    best = full.getEstimatorParamMaps()[max(range(6), key=lambda i: full.avgMetrics[i])]
    assert nested.best == {p.name: v for p, v in best.items()}
    assert nested.best_model.transform(prepared).select("churn_pred").collect() == \
        full.bestModel.transform(prepared).select("churn_pred").collect()
    rows = metric_rows(nested, spark).collect()
    assert [(r["maxDepth"], r["maxIter"]) for r in rows if r["best"]] == [(nested.best["maxDepth"], nested.best["maxIter"])]


def test_a_grid_without_rounds(prepared):
    train = prepared.where("split = 'train'")
    got = NestedValidator("gbt_binary", grid={"maxDepth": [1]}, label=BINARY_LABEL, index_on=prepared).fit(train)
    assert got.points == [{"maxDepth": 1}] and got.fits == 4


def test_one_pass_equals_a_pass_per_model(spark, prepared):
    dt = build_model_pipeline("dt", index_on=prepared)[0].fit(prepared)
    models = {"dt": dt, **{name: rule_pipeline(name) for name in RULES}}
    a = {r["model"]: r for r in compare_in_one_pass(models, prepared).collect()}
    b = {r["model"]: r for r in compare_models(models, prepared).collect()}
    assert a.keys() == b.keys() == models.keys()
    for name, r in a.items():
        assert r.asDict() == pytest.approx(b[name].asDict(), abs=1e-12)
    f1 = mllib_metrics(rule_pipeline("position").transform(prepared))["f1"]
    assert a["position"]["f1"] == pytest.approx(f1, abs=1e-12)
    assert compare_in_one_pass(models, prepared.limit(0)).count() == 0


def test_one_scan_for_all_models(spark, prepared):
    models = {name: rule_pipeline(name) for name in RULES}
    one = compare_in_one_pass(models, prepared)
    one.collect()
    plan = one._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "Python" not in plan
    assert side_by_side(models, prepared, [LABEL]).groupBy("model").count().where(
        F.col("count") != prepared.count()).isEmpty()
