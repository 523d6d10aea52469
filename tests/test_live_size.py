"""What the live query spends besides its rows: state partitions, batches without rows, passes over a batch."""

import json
import os
from datetime import datetime, timedelta

import pytest

from churnlens.config import Tuning
from churnlens.ml.rules import rule_pipeline
from churnlens.plans.catalog import _live_tables
from churnlens.session import state_partitions
from churnlens.streaming.live_scoring import EVENT_COLUMNS, MALFORMED, LiveScorer

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_state_is_sized_by_the_events(spark, scratch, many_partitions):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(hours=i), i % 5, ("click", "error", "view")[i % 3], i / 4, "{}") for i in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                                "props string").write.parquet(f"{scratch}/events.parquet")
    names = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass",
             "spark.sql.streaming.noDataMicroBatches.enabled")
    had = [spark.conf.get(n) for n in names]
    ckpt = f"{os.path.dirname(_live_tables(spark, scratch))}/checkpoint".removeprefix("file:")
    kept = [n for n in os.listdir(f"{ckpt}/state/0") if n.isdigit()]
    assert len(kept) == spark.sparkContext.defaultParallelism < 64
    offsets = sorted(n for n in os.listdir(f"{ckpt}/offsets") if n.isdigit())
    assert offsets == ["0", "1", "2"]  # one batch a span of days, none without rows
    with open(f"{ckpt}/offsets/2") as f:
        conf = json.loads(f.read().split("\n")[1])["conf"]
    assert conf["spark.sql.streaming.stateStore.providerClass"] == ROCKSDB
    assert [spark.conf.get(n) for n in names] == had  # the session is as it was


def test_state_partitions_follow_the_rows(spark, many_partitions):
    cores = spark.sparkContext.defaultParallelism
    assert state_partitions(spark, 10) == cores
    assert state_partitions(spark, 41, Tuning(state_rows=2)) == 21
    assert state_partitions(spark, 10**9) == 64  # never more than the session has


def test_one_pass_tells_what_a_batch_has_of_each_user(spark, scratch):
    def row(user, length, gender="F", bad=None):
        return (user, gender, 1, "paid", length, "Home", 1, 1, bad)

    landed = spark.createDataFrame(
        [row(1, 2.0), row(1, 3.0), row(1, None), row(1, float("nan")), row(1, None, None), row(2, None), row(3, 1.0, None),
         row(None, 5.0), row(None, None), row(4, 9.0, bad="{")],
        ", ".join(f"{c} {t}" for c, t in zip([*EVENT_COLUMNS, MALFORMED], (
            "long", "string", "long", "string", "double", "string", "long", "long", "string"))))
    scorer = LiveScorer(spark, f"{scratch}/tables", rule_pipeline("fraction"))
    users = scorer.batch_users(landed, 0)
    assert {r["userId"]: (r["total"], r["n"], r["__rows"]) for r in users.collect()} == {
        1: (5.0, 2, 2), 2: (None, 0, 1), 3: (1.0, 1, 0), None: (5.0, 1, 0)}
    scorer(landed, 0)
    assert {r["userId"]: (r["total"], r["n"]) for r in scorer.means.latest().collect()} == {1: (5.0, 2), 3: (1.0, 1)}
    got = sorted((r["sink"], r["userId"] or 0, r["length"] or 0.0) for r in scorer.rows.read().collect())
    assert got == [("flagged", 1, 2.5), ("flagged", 1, 2.5), ("malformed", 0, 0.0), ("scored", 1, 2.0), ("scored", 1, 2.5),
                   ("scored", 1, 2.5), ("scored", 1, 3.0), ("unfilled", 2, 0.0)]
