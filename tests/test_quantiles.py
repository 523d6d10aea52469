"""Exact quantiles by refinement equal numpy's linear-interpolation quantiles."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from churnlens.operators.clean import clean
from churnlens.operators.profile import describe_numeric
from churnlens.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("seed", [0, 1])
def test_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    ints = rng.integers(0, 50, 3000)                    # many ties
    floats = rng.exponential(1e9, 3000)                 # skewed, wide range
    rows = [(int(a), float(b)) for a, b in zip(ints, floats)]
    df = spark.createDataFrame(rows, "a long, b double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    # Tiny buckets and fetch size force several refinement rounds.
    got = exact_quantiles(df, ["a", "b"], probs, buckets=4, fetch_max=10)
    for col, arr in (("a", ints.astype(float)), ("b", floats)):
        for p in probs:
            assert got[col][p] == pytest.approx(float(np.quantile(arr, p)), rel=1e-12, abs=1e-9)


def test_nulls_are_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5])["x"][0.5] == 2.0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_property_matches_numpy(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    got = exact_quantiles(df, ["x"], [p], buckets=3, fetch_max=4)["x"][p]
    assert got == pytest.approx(float(np.quantile(np.array(values, dtype=float), p)),
                                rel=1e-12, abs=1e-6)


def test_describe_counts_nan_as_missing_and_bears_infinity(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, 1.0), (nan, -inf), (3.0, inf), (None, 2.0)], "x double, y double")
    x, y = sorted(describe_numeric(df).collect(), key=lambda r: r["column_name"])
    assert (x["count"], x["mean"], x["min"], x["q50"], x["max"]) == (2, 2.0, 1.0, 2.0, 3.0)
    assert (y["count"], y["min"], y["q50"], y["max"]) == (4, -inf, 1.5, inf)


def test_describe_wide_longs(spark):
    lo, hi = -2**63, 2**63 - 1
    row = describe_numeric(spark.createDataFrame([(lo,), (hi,), (0,)], "x long")).first()
    assert row["mean"] == pytest.approx(-1 / 3) and row["std"] == pytest.approx(2.0**63, rel=1e-9)
    assert (row["min"], row["q50"], row["max"]) == (float(lo), 0.0, float(hi))


def test_large_user_ids_stay(spark):
    df = spark.createDataFrame([("3000000000", 1.0), ("5", 2.0), ("", 3.0)], "userId string, length double")
    assert sorted(r["userId"] for r in clean(df, ["userId", "length"]).collect()) == [5, 3000000000]
