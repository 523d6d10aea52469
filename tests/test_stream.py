"""Stream scoring equals batch scoring by content over several micro-batches."""

import json
import os

import pytest

from conftest import SF_MID
from churnlens.plans.catalog import write_json_batches
from churnlens.plans.score import score_events
from churnlens.plans.train import prepare_training, train_and_evaluate
from churnlens.sources import load_clickstream, read_events
from churnlens.streaming.score_stream import mean_table, run_score_stream, run_unfilled_stream


@pytest.fixture(scope="module")
def setup(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("stream"))
    cs = load_clickstream(spark, SF_MID)
    model, _ = train_and_evaluate(prepare_training(cs), "dt", grid={"maxDepth": [5]})
    source, per_batch = write_json_batches(cs, os.path.join(base, "in"))
    means = mean_table(read_events(spark, source))
    batch = score_events(read_events(spark, source), model)
    return base, model, source, means, batch, per_batch


def _run(spark, setup, name, delay):
    base, model, source, means, _, per_batch = setup
    q = run_score_stream(spark, source, model, means, os.path.join(base, name),
                         os.path.join(base, name + "-ckpt"), delay, per_batch)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3  # one micro-batch per time batch at least
    return spark.read.parquet(os.path.join(base, name))


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_stream_equals_batch_with_covering_delay(spark, setup):
    out = _run(spark, setup, "covering", "40 days")
    assert _rows(out) == _rows(setup[4])


def test_short_delay_keeps_old_events(spark, setup):
    """The delay runs on arrival: files that arrive together need no long one, however old their events."""
    assert _rows(_run(spark, setup, "short", "1 hour").distinct()) == _rows(setup[4])


def test_out_of_order_file_and_new_user(spark, setup):
    """An event 19 days older than the newest is scored; a new user's cancellation is in the side table."""
    base, model = setup[:2]
    source, day = os.path.join(base, "late"), 86_400_000
    song = {"userId": "3000000000", "gender": "F", "itemInSession": 0, "level": "paid", "page": "NextSong"}
    files = [[{**song, "length": 200.0, "ts": 20 * day}],
             [{**song, "length": 100.0, "ts": day}, {**song, "length": 200.0, "ts": day},
              {**song, "userId": "9", "page": "Cancellation Confirmation", "ts": day}]]
    os.makedirs(source)
    for i, rows in enumerate(files):
        with open(os.path.join(source, f"{i}.json"), "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(os.path.join(source, f"{i}.json"), (1_000 + i, 1_000 + i))
    means = spark.createDataFrame([(3000000000, 150.0)], "userId long, mean_length double")
    out, side = os.path.join(base, "late-out"), os.path.join(base, "late-side")
    run_score_stream(spark, source, model, means, out, out + "-ckpt", "1 hour").awaitTermination()
    run_unfilled_stream(spark, source, means, side, side + "-ckpt", "1 hour").awaitTermination()
    scored, unfilled = spark.read.parquet(out), spark.read.parquet(side)
    assert sorted(r["length"] for r in scored.collect()) == [100.0, 200.0]
    assert [(r["userId"], r["page"], r["length"]) for r in unfilled.collect()] == [
        (9, "Cancellation Confirmation", None)]


def test_large_mean_table_is_bucketed_not_broadcast(spark, setup):
    """Beyond the broadcast bound the static side is a bucketed table; same result."""
    from churnlens.config import Tuning
    base, model, source, means, batch, per_batch = setup
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = run_score_stream(spark, source, model, means, os.path.join(base, "bucketed"),
                             os.path.join(base, "bucketed-ckpt"), "40 days", per_batch,
                             tuning=Tuning(broadcast_max_rows=0))
        q.awaitTermination()
        plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # Only the micro-batch side is shuffled on userId; the bucketed table is read in place.
    assert plan.count("Exchange hashpartitioning(userId") == 1, plan
    assert _rows(spark.read.parquet(os.path.join(base, "bucketed"))) == _rows(batch)
