"""The live query against the batch forms: sinks, running means, users at risk, replays, crashes, restarts."""

import json
import os
from collections import Counter, defaultdict

import pytest

from churnlens.config import Tuning
from churnlens.ml.rules import rule_pipeline
from churnlens.operators.users import at_risk_users
from churnlens.sources.batches import BatchTable
from churnlens.sources.files import partition_values, sub_folders
from churnlens.streaming.live_scoring import MALFORMED, ROW_SCHEMA, LiveScorer, live_events, run_live_scoring
from churnlens.streaming.running import RunningAggregate, live_means

DAY = 86_400_000


@pytest.fixture(autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def event(user, item, length=None, page="NextSong", day=1, session=1, **more):
    return {"userId": str(user), "gender": "F", "itemInSession": item, "level": "paid", "page": page,
            "sessionId": session, "ts": day * DAY, **({} if length is None else {"length": length}), **more}


def put(folder, name, events, raw=()):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{name}.json")
    with open(path, "w") as f:
        f.writelines([json.dumps(e) + "\n" for e in events] + [line + "\n" for line in raw])
    os.utime(path, (1_000 + name, 1_000 + name))


def run(spark, base, on_batch=None, **kw):
    run_live_scoring(spark, f"{base}/in", rule_pipeline("fraction"), f"{base}/tables", f"{base}/ckpt", "1 hour",
                     on_batch=on_batch, **kw).awaitTermination()


def sinks(spark, base):
    rows = BatchTable(spark, f"{base}/tables/rows", ROW_SCHEMA).read()
    return Counter((r["sink"], r["userId"], r["itemInSession"], r["length"], r["page"], r["churn_pred"],
                    r["correct_prediction"]) for r in rows.collect())


def brute(batches):
    """Event by event: means of all events so far at the end of each batch, then the batch's rows."""
    seen, total, n, out = set(), defaultdict(float), Counter(), Counter()
    for batch in batches:
        new = []
        for e in batch:
            key = json.dumps(e, sort_keys=True)
            if key not in seen:
                seen.add(key)
                new.append(e)
        for e in new:
            if e.get("length") is not None and e["userId"]:
                total[e["userId"]] += e["length"]
                n[e["userId"]] += 1
        for e in new:
            if not e["userId"] or e["gender"] is None:
                continue
            u = e["userId"]
            length = e.get("length", total[u] / n[u] if n[u] else None)
            row = (int(u), e["itemInSession"], length, e["page"])
            if length is None:
                out["unfilled", *row, None, None] += 1
                continue
            odd = length != int(length)
            pred = 2.0 if odd and e["itemInSession"] % 2 == 0 else 1.0 if odd else 0.0
            right = {"Cancellation Confirmation": 2.0, "Downgrade": 1.0}.get(e["page"]) == pred if odd else None
            out["scored", *row, pred, right] += 1
            if odd:
                out["flagged", *row, pred, right] += 1
    return out


BATCHES = [
    [event(1, 0, 100.0), event(1, 1, 101.0), event(1, 2, page="Downgrade"), event(2, 0, page="Home"),
     event("", 5, 900.0), {**event(4, 1, 10.0), "gender": None}, event(4, 2, page="Help")],
    # a copy of an event, a late one, user 2's first song, user 3 without any
    [event(1, 0, 100.0), event(2, 1, 55.0, day=-3), event(2, 2, page="Cancellation Confirmation"),
     event(3, 0, page="Downgrade")],
    [event(1, 3, 105.0), event(1, 4, page="Downgrade"), event(1, 4, page="Downgrade", session=2), event(2, 4, page="Home")],
]


def test_sinks_equal_the_brute_force(spark, scratch):
    for i, b in enumerate(BATCHES):
        put(f"{scratch}/in", i, b, raw=['{"userId": "7", "page"'] if i == 1 else ())
        run(spark, scratch)  # the query stops and starts anew from its checkpoint
    assert sinks(spark, scratch) == brute(BATCHES) + Counter({("malformed", *[None] * 6): 1})
    table = BatchTable(spark, f"{scratch}/tables/rows", ROW_SCHEMA)
    assert [r["line"] for r in table.read("malformed").collect()] == ['{"userId": "7", "page"']
    counts = [r["counts"] for r in table.batches().orderBy("batch_id").collect()]
    assert [c["malformed"] for c in counts] == [0, 1, 0] and counts[0]["unfilled"] == 1


def test_users_at_risk_and_means_after_every_batch(spark, scratch):
    scorer = LiveScorer(spark, f"{scratch}/tables", rule_pipeline("fraction"), compact_every=2)
    told = []

    def work(batch, batch_id):
        scorer(batch, batch_id)
        flagged = scorer.rows.read("flagged")
        told.append((Counter(map(tuple, scorer.at_risk.latest().select(sorted(at_risk_users(flagged).columns)).collect())),
                     Counter(map(tuple, at_risk_users(flagged).select(sorted(at_risk_users(flagged).columns)).collect()))))

    for i, b in enumerate(BATCHES):
        put(f"{scratch}/in", i, b)
    run(spark, scratch, work)
    assert len(told) >= 3 and all(live == whole for live, whole in told)
    assert {r["userId"]: (r["total"], r["n"]) for r in scorer.means.latest().collect()} == {
        1: (306.0, 3), 2: (55.0, 1), 4: (10.0, 1)}
    assert partition_values(spark, f"{scratch}/tables/means/base", "upto")  # was compacted on the way


@pytest.mark.parametrize("where", ["add", "commit"])
def test_a_batch_lost_half_way_counts_once(spark, scratch, where):
    """The job dies inside batch 1, after some of its writes; the restarted query gives the same tables."""
    for i, b in enumerate(BATCHES):
        put(f"{scratch}/in", i, b)
    scorer, broken = LiveScorer(spark, f"{scratch}/tables", rule_pipeline("fraction")), []
    at = {"add": scorer.at_risk, "commit": scorer.rows}[where]
    real = getattr(at, where)

    def dies(*args, **kw):
        batch_id = args[0] if where == "commit" else args[1]
        if batch_id == 1 and not broken:
            broken.append(batch_id)
            if where != "commit":
                real(*args, **kw)
            raise RuntimeError("lost")
        return real(*args, **kw)

    setattr(at, where, dies)
    with pytest.raises(Exception, match="lost"):
        run(spark, scratch, scorer)
    seen = scorer.rows.read().select("batch_id").distinct().collect()
    assert [r["batch_id"] for r in seen] == [0]  # nothing of the lost batch can be read
    run(spark, scratch, scorer)
    assert broken and sinks(spark, scratch) == brute(BATCHES)
    assert {r["userId"]: r["n"] for r in scorer.means.latest().collect()} == {1: 3, 2: 1, 4: 1}
    lost = scorer_lost(scorer, spark)
    assert len(lost) == 1 and scorer.rows.vacuum() == 1
    assert sinks(spark, scratch) == brute(BATCHES)


def scorer_lost(scorer, spark):
    """Folders of attempts that no commit names."""
    kept = {(r["batch_id"], r["attempt"]) for r in scorer.rows.batches().collect()}
    path = f"{scorer.rows.path}/rows"
    return [a for n in sub_folders(spark, path) for a in sub_folders(spark, f"{path}/{n}")
            if (int(n.split("=")[1]), a.split("=")[1]) not in kept]


def test_a_batch_sent_again_writes_nothing_twice(spark, scratch):
    scorer = LiveScorer(spark, f"{scratch}/tables", rule_pipeline("fraction"))
    frames = {}

    def work(batch, batch_id):
        scorer(batch, batch_id)
        landed = spark.read.parquet(f"{scratch}/tables/landed/batch_id={batch_id}")
        frames[batch_id] = spark.createDataFrame(landed.collect(), landed.schema)
        scorer(frames[batch_id], batch_id)

    for i, b in enumerate(BATCHES):
        put(f"{scratch}/in", i, b)
    run(spark, scratch, work)
    assert sinks(spark, scratch) == brute(BATCHES)
    # Without the commit record it is written again, in place of what was there.
    last = max(r["batch_id"] for r in scorer.rows.batches().collect())
    assert frames[last].where(f"{MALFORMED} IS NULL").count()
    scorer.rows.done = lambda batch_id: False
    scorer(frames[last], last)
    assert sinks(spark, scratch) == brute(BATCHES)


def test_hot_user_beyond_the_broadcast_bound(spark, scratch):
    batch = [event(1, k, float(k % 9)) for k in range(60)] + [event(1, k, page="Home") for k in range(60, 100)] + [
        event(u, k, None if k else 3.5, page="Downgrade") for u in range(2, 30) for k in range(3)]
    put(f"{scratch}/in", 0, batch)
    run(spark, scratch, tuning=Tuning(broadcast_max_rows=0))
    assert sinks(spark, scratch) == brute([batch])


def test_tables_belong_to_one_checkpoint(spark, scratch):
    put(f"{scratch}/in", 0, BATCHES[0])
    run(spark, scratch)
    with pytest.raises(ValueError, match="is filled from"):
        run_live_scoring(spark, f"{scratch}/in", rule_pipeline("nobody"), f"{scratch}/tables", f"{scratch}/other", "1 hour")


def test_only_the_copies_are_held_in_state(spark, scratch):
    put(f"{scratch}/in", 0, BATCHES[0])
    q = run_live_scoring(spark, f"{scratch}/in", rule_pipeline("fraction"), f"{scratch}/tables", f"{scratch}/ckpt", "1 hour")
    q.awaitTermination()
    operators = [o["operatorName"] for p in q.recentProgress for o in p["stateOperators"]]
    assert set(operators) == {"dedupeWithinWatermark"}
    assert live_events(spark, f"{scratch}/in", "1 hour").isStreaming


def test_running_aggregate_versions(spark, scratch):
    store = live_means(spark, f"{scratch}/m", compact_every=2)

    def add(batch_id, *rows):
        store.add(spark.createDataFrame(list(rows), "userId long, total double, n long"), batch_id)
        return store.compact(batch_id)

    def state(batch_id):
        return {r["userId"]: (r["total"], r["n"]) for r in store.as_of(batch_id).collect()}

    assert store.latest().count() == 0
    assert not add(0, (1, 10.0, 1), (None, 5.0, 1))
    assert add(1, (1, 20.0, 1), (2, 1.0, 1), (2, 2.0, 1))
    assert state(0) == {1: (10.0, 1)} and state(1) == {1: (30.0, 2), 2: (3.0, 2)}
    add(1, (1, 20.0, 1), (2, 1.0, 1), (2, 2.0, 1))  # again: counts once
    assert state(1) == {1: (30.0, 2), 2: (3.0, 2)}
    add(4, (3, 7.0, 1))
    assert state(4) == {1: (30.0, 2), 2: (3.0, 2), 3: (7.0, 1)} == {
        r["userId"]: (r["total"], r["n"]) for r in store.latest().collect()}
    some = store.as_of(4, spark.createDataFrame([(2,), (9,)], "userId long"))
    assert [r["userId"] for r in some.collect()] == [2]
    assert isinstance(store, RunningAggregate)


def test_batch_table_replace_and_vacuum(spark, scratch):
    table = BatchTable(spark, f"{scratch}/t", spark.createDataFrame([], "x long").schema)

    def rows(*xs):
        return spark.createDataFrame([(x, "even" if x % 2 == 0 else "odd") for x in xs], "x long, sink string")

    assert table.read().count() == 0 and not table.done(0)
    assert table.replace(rows(1, 2, 3), 0) == {"rows": 3}
    table.replace(rows(4), 1)
    table.stage(rows(99), 2)  # never committed
    assert table.done(0) and not table.done(2)
    table.replace(rows(2, 6), 0)  # its odd rows are gone, batch 1 is as before
    assert sorted(tuple(r) for r in table.read(columns=["batch_id", "sink", "x"]).collect()) == [
        (0, "even", 2), (0, "even", 6), (1, "even", 4)]
    assert table.read("odd").count() == 0
    assert table.vacuum() == 2 and table.read().count() == 3
    assert table.vacuum(keep_from=1) == 1 and [r["x"] for r in table.read().collect()] == [4]
