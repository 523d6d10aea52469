"""Exact class sizes: a threshold search in place of a sort."""

import hashlib

import pytest
from pyspark.sql import functions as F

from churnlens.config import DEFAULT
from churnlens.operators import exact_sample as ex

SCHEMA = "userId long, churn int, x string"


def rows(n=3000):
    data = [(i % 700, (0 if i % 3 else 1 if i % 2 else 2 if i % 5 else None), f"r{i % 900}") for i in range(n)]
    return data + [(1, 0, "same")] * (n // 3)  # a third of all rows is one row


def brute(data, sizes, keys):
    def bits(r):
        parts = [str(r[k]) for k in keys if r[k] is not None] + ["sample"]
        return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:15], 16)
    out = []
    for label, n in sizes.items():
        mine = sorted((r for r in data if r[1] == label), key=lambda r: (bits(r), r[0], r[2]))
        out += mine[:max(0, n or 0)]
    return sorted(out, key=str)


def sample(spark, data, sizes, keys, parts=5, tuning=DEFAULT):
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    wanted = spark.createDataFrame(list(sizes.items()), "churn int, n_keep long")
    return sorted((tuple(r) for r in ex.exact_class_sample(df, wanted, keys, tuning=tuning).collect()), key=str)


@pytest.mark.parametrize("sizes", [{0: 100, 1: 7, 2: 1, None: 3}, {0: 2500, 2: 10 ** 9}, {0: 0, 1: None, 7: 5, 2: -1},
                                   {0: 1801, 1: 499, 2: 399, None: 99}])
def test_exact_rows(spark, sizes):
    data = rows()
    want = brute(data, sizes, [0, 1, 2])
    assert sample(spark, data, sizes, ["userId", "churn", "x"]) == want
    assert sample(spark, data, sizes, ["userId", "churn", "x"], 2) == want


def test_keys_that_tie(spark):
    """One hash for all rows of a class: every row is a tie, ordered by its columns, over many tasks."""
    data = rows(900)
    sizes = {0: 333, 1: 50, 2: 11, None: 2}
    want = brute(data, sizes, [1])
    assert sample(spark, data, sizes, ["churn"]) == want
    assert sample(spark, data, sizes, ["churn"], tuning=DEFAULT.with_(task_rows=50)) == want


def test_every_size_of_a_class(spark):
    data = [(i, 0, "a") for i in range(40)]
    for n in (1, 13, 39, 40, 41):
        assert sample(spark, data, {0: n}, ["userId"], 3) == brute(data, {0: n}, [0])


def test_empty(spark):
    assert sample(spark, [], {0: 5}, ["userId"]) == []
    assert sample(spark, rows(30), {}, ["userId"]) == []


def test_balanced_sizes(spark):
    df = spark.createDataFrame([(i, 0 if i < 70 else 1 if i < 95 else 2, "a") for i in range(100)], SCHEMA)
    got = ex.exact_balanced_sample(df, 2.5, ["userId"]).groupBy("churn").agg(F.count("*")).collect()
    assert {r[0]: r[1] for r in got} == {0: 12, 1: 12, 2: 5}
