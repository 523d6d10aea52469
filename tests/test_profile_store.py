"""Profiles of day ranges from stored, mergeable states."""

import random

import pytest
from pyspark.sql import functions as F

from churnlens.operators import profile_store as store
from churnlens.operators.profile import describe_numeric, null_profile

SCHEMA = "ts long, v double, w long, s string, none double"


def events(spark, n=6000, seed=3):
    """Ten days; the fourth holds a third of the rows; NaN, nulls, a column without values, rows without a time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = 3 if rng.random() < 1 / 3 else rng.randrange(10)
        ts = None if i % 500 == 7 else day * store.DAY_MS + rng.randrange(store.DAY_MS)
        v = None if i % 11 == 0 else float("nan") if i % 97 == 5 else rng.gauss(1e9, 2.0)
        rows.append((ts, v, rng.randrange(10 ** 12) if i % 3 else None, rng.choice(["a", "b", None, f"u{i}"]), None))
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


def as_dict(df):
    return {r["column_name"]: r.asDict() for r in df.collect()}


def test_range_equals_exact_profile(spark):
    df = events(spark).cache()
    states = store.day_states(df)
    day = F.floor(F.col("ts") / F.lit(store.DAY_MS))
    for first, last in [(None, None), (2, 5), (3, 3), (None, 4), (8, None)]:
        rows = df
        if first is not None:
            rows = rows.where(day >= first)
        if last is not None:
            rows = rows.where(day <= last)
        found = store.range_profile(states, first, last)
        got, exact = as_dict(found), as_dict(describe_numeric(rows))
        missing = as_dict(null_profile(rows))
        assert set(got) == set(df.columns)
        for c, r in got.items():
            assert r["n_rows"] == rows.count()
            assert r["null_count"] == missing[c]["null_count"]
            assert r["null_pct"] == pytest.approx(missing[c]["null_pct"])
            if c in exact:
                assert (r["min"], r["max"]) == (exact[c]["min"], exact[c]["max"])
                for k in ("mean", "std"):
                    assert (r[k] is None) == (exact[c][k] is None)
                    assert r[k] is None or r[k] == pytest.approx(exact[c][k], rel=1e-6)
        for r in store.sketch_errors(found, rows).collect():
            assert r["rank_error"] <= 0.02 and r["distinct_error"] <= 0.06


def test_batches_count_once_and_merge_in_any_order(spark, scratch):
    df = events(spark).cache()
    table = store.profile_table(spark, f"{scratch}/states")
    part = F.pmod(F.xxhash64("w", "s"), F.lit(3))
    for batch in (2, 0, 1, 2, 2):  # a late batch and repeated ones
        store.store_batch(table, df.where(part == batch), batch)
    whole, merged = as_dict(store.range_profile(store.day_states(df))), as_dict(store.range_profile(table.read()))
    for c, r in whole.items():
        for k, x in r.items():
            if k.startswith("q"):
                continue  # estimates, each within its own bound
            near = 1e-6 if isinstance(x, float) else 0.06 if k == "n_distinct" else 0
            assert merged[c][k] == (pytest.approx(x, rel=near) if near else x), (c, k)
    store.store_batch(table, df.where(part == 2).limit(0), 2)  # the batch turns out empty: its part goes
    assert as_dict(store.range_profile(table.read()))["ts"]["n_rows"] == df.where(part != 2).count()


def test_merged_states_merge_again(spark):
    df = events(spark, 2000)
    states = store.day_states(df)
    halves = [store.merge_states(states.where(c)).withColumn("day", F.lit(0).cast("long")).select(*store.STATE.names)
              for c in (F.col("day") < 4, (F.col("day") >= 4) | F.col("day").isNull())]
    once, twice = as_dict(store.range_profile(states)), as_dict(store.range_profile(halves[0].union(halves[1])))
    for c in once:
        for k in ("n_rows", "null_count", "min", "max"):
            assert once[c][k] == twice[c][k]
        assert twice[c]["n_distinct"] == pytest.approx(once[c]["n_distinct"], rel=0.06)
        assert once[c]["std"] is None or twice[c]["std"] == pytest.approx(once[c]["std"], rel=1e-6)


def test_empty_and_outside(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert store.range_profile(store.day_states(none)).count() == 0
    assert store.sketch_errors(store.range_profile(store.day_states(none)), none).count() == 0
    assert store.range_profile(store.day_states(events(spark, 200)), 50, 60).count() == 0


def test_profile_reads_no_events(spark, scratch):
    table = store.profile_table(spark, f"{scratch}/states")
    store.store_batch(table, events(spark, 500), 0)
    files = store.range_profile(table.read(), 1, 2).inputFiles()
    assert files and all(f"{scratch}/states" in f for f in files)
