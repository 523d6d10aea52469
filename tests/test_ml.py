"""Model pipeline: metrics agree with MLlib, save/load round trip, unseen categories."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from churnlens.ml.estimators import build_model_pipeline, index_strings
from churnlens.ml.evaluate import mllib_metrics
from churnlens.operators.predictions import rule_prediction, weighted_metrics
from churnlens.plans.train import prepare_training, train_and_evaluate
from churnlens.sources import load_clickstream, load_pipeline


@pytest.fixture(scope="module")
def prepared(spark):
    return prepare_training(load_clickstream(spark, SF_SMALL))


def test_split_is_disjoint_and_covering(prepared):
    counts = {r.split: r["count"] for r in prepared.groupBy("split").count().collect()}
    assert set(counts) <= {"train", "valid", "test"}
    assert sum(counts.values()) == prepared.count()
    assert set(r.fold for r in prepared.select("fold").distinct().collect()) == {0, 1, 2}


def test_aggregate_metrics_equal_mllib(spark, prepared):
    pred = rule_prediction(prepared)
    ours = weighted_metrics(pred, digits=None).first()
    ml = mllib_metrics(pred)
    assert ours.f1 == pytest.approx(ml["f1"], abs=1e-12)
    assert ours.weighted_precision == pytest.approx(ml["weightedPrecision"], abs=1e-12)
    assert ours.weighted_recall == pytest.approx(ml["weightedRecall"], abs=1e-12)


def test_saved_model_equals_loaded_model(spark, prepared, scratch):
    path = os.path.join(scratch, "dt")
    model, metrics = train_and_evaluate(prepared, "dt", grid={"maxDepth": [5]}, save_to=path)
    assert metrics.count() == 2
    loaded = load_pipeline(path)
    a = model.transform(prepared).select("churn_pred").collect()
    b = loaded.transform(prepared).select("churn_pred").collect()
    assert a == b


def test_unseen_category_goes_to_extra_bucket(spark, prepared):
    pipe, _ = build_model_pipeline("dt")
    model = pipe.fit(prepared.where(F.col("split") == "train"))
    odd = prepared.limit(3).withColumn("gender", F.lit("X"))
    assert model.transform(odd).count() == 3


def test_index_is_alphabetical(spark):
    df = spark.createDataFrame([("M",), ("F",), ("M",)], "gender string")
    out = sorted((r.gender) for r in index_strings(df, ["gender"]).collect())
    assert out == [0.0, 1.0, 1.0]


def test_one_vs_rest_gbt_fits(spark, prepared):
    _, metrics = train_and_evaluate(prepared, "gbt_ovr", grid={"maxDepth": [3], "maxIter": [3]})
    rows = metrics.collect()
    assert len(rows) == 2 and all(0.0 <= r.f1 <= 1.0 for r in rows)


def test_binary_gbt_fits(spark, prepared):
    _, metrics = train_and_evaluate(prepared, "gbt_binary", grid={"maxDepth": [3], "maxIter": [3]})
    assert metrics.count() == 2
