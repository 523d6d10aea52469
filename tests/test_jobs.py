"""Command-line jobs run end to end on JSON events (inside the test session)."""

import os

from conftest import SF_SMALL
from churnlens.jobs import main
from churnlens.sources import load_clickstream, read_events
from churnlens.streaming.score_stream import mean_table


def test_train_score_stream_profile(spark, scratch, capsys):
    events = os.path.join(scratch, "events")
    load_clickstream(spark, SF_SMALL).write.json(events)
    model = os.path.join(scratch, "model")
    main(["train", "--events", events, "--model-out", model, "--kind", "dt"])
    assert capsys.readouterr().out.count('"split"') == 2
    main(["compare", "--events", events, "--model", f"a={model}", "--model", f"b={model}"])
    assert capsys.readouterr().out.count('"split": "test"') == 2
    scored = os.path.join(scratch, "scored")
    main(["score", "--events", events, "--model", model, "--out", scored])
    assert spark.read.parquet(scored).count() > 0
    means = os.path.join(scratch, "means")
    main(["means", "--events", events, "--out", means])
    assert spark.read.parquet(means).count() == mean_table(read_events(spark, events)).count()
    streamed = os.path.join(scratch, "streamed")
    main(["stream", "--source", events, "--model", model, "--means", means, "--out", streamed,
          "--checkpoint", os.path.join(scratch, "ckpt"), "--delay", "40 days"])
    assert spark.read.parquet(streamed).count() == 815
    prof = os.path.join(scratch, "profile")
    main(["profile", "--events", events, "--out", prof])
    desc = {r.column_name: r for r in spark.read.parquet(f"{prof}/describe").collect()}
    assert len(desc) == 7  # the six fixture columns plus registration (all null)
    assert desc["registration"]["count"] == 0 and desc["registration"].q50 is None


def test_cluster_conf_sizes_partitions():
    from churnlens.session import cluster_conf
    conf = cluster_conf(100 * 2**40)  # 100 TiB
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(1)["spark.sql.shuffle.partitions"]) == 200
