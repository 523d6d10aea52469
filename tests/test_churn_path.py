"""Rates on the way to churn against a brute force; the song clock of a hot user."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from churnlens.config import DEFAULT
from churnlens.operators.churn_path import DAY_MS, churn_path, with_song_clock
from churnlens.operators.sequence import running_count_within

SCHEMA = "userId long, page string, churn int, ts long, sessionId long, itemInSession long"
PAGES = {"NextSong": 0, "Home": 0, "Downgrade": 1, "Cancellation Confirmation": 2}


def rows(n=900, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        user = 1 if i % 3 == 0 else None if i % 50 == 1 else rng.randrange(2, 30)  # user 1 has a third
        page = rng.choices(list(PAGES), [70, 25, 2, 1])[0]
        out.append((user, page, PAGES[page], rng.randrange(30 * DAY_MS), rng.randrange(2), rng.randrange(40)))
    return out + out[:40]  # repeated rows tie


def brute(data, width, last):
    users = defaultdict(list)
    for r in data:
        if r[0] is not None:
            users[r[0]].append(r)
    events, reach = defaultdict(int), defaultdict(list)
    for user, mine in users.items():
        def songs(key):
            return sum(r[1] == "NextSong" and r[3:] <= key for r in mine)
        ends = {k: min((r[3:] for r in mine if r[2] == k), default=None) for k in (1, 2)}
        ends[0] = None if ends[1] or ends[2] else max(r[3:] for r in mine)
        for k, end in ends.items():
            cells = [(min((end[0] - r[3]) // DAY_MS, last), min((songs(end) - songs(r[3:])) // width, last), r[1])
                     for r in mine if end and r[3:] < end]
            for d, s, page in cells:
                events[k, "days", d, page] += 1
                events[k, "songs", s, page] += 1
            if cells:
                reach[k, "days"].append(max(c[0] for c in cells))
                reach[k, "songs"].append(max(c[1] for c in cells))
    out = {}
    for (k, axis, cell, page), n in events.items():
        n_users = sum(x >= cell for x in reach[k, axis])
        n_songs = events.get((k, axis, cell, "NextSong"), 0)
        out[k, axis, cell, page] = (n, n_users, n_songs, n / n_users, 100.0 * n / n_songs if n_songs else None)
    return out


def found(df):
    return {(r["churn"], r["axis"], r["cell"], r["page"]): tuple(r)[4:] for r in df.collect()}


@pytest.mark.parametrize("tuning, method", [
    (DEFAULT, "auto"), (DEFAULT, "range"),
    (DEFAULT.with_(broadcast_max_rows=0, task_rows=100), "auto")])  # salted joins, the hot user's clock in ranges
def test_equals_brute_force(spark, tuning, method):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert found(churn_path(df, 7, 9, tuning, method)) == brute(data, 7, 9)


def test_last_cell_keeps_all_events(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    wide, narrow = (churn_path(df, 3, last).groupBy("churn", "axis").agg(F.sum("n_events")).collect() for last in (10 ** 6, 1))
    assert sorted(wide) == sorted(narrow)


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert churn_path(none).count() == 0
    odd = [(None, "Home", 0, 1, 1, 1), (5, "Downgrade", 1, 5, 1, 1), (6, "Home", 0, 1, 1, 1), (6, "Home", 0, 1, 1, 1)]
    assert churn_path(spark.createDataFrame(odd, SCHEMA)).count() == 0  # nothing lies strictly before an anchor
    plain = spark.createDataFrame([*odd, (6, "NextSong", 0, 0, 1, 1)], SCHEMA)
    extra = plain.withColumns({"songs": F.lit("x"), "n": F.lit(1)})
    assert found(churn_path(extra)) == found(churn_path(plain)) == brute(
        [tuple(r) for r in plain.collect()], 100, 1000)


def test_clock_forms_agree(spark):
    df = spark.createDataFrame(rows(600, 4), SCHEMA).repartition(6)
    window, ranged = (sorted(with_song_clock(df, method=m).collect(), key=str) for m in ("window", "range"))
    assert window == ranged
    flagged = running_count_within(df, ["userId"], ["ts"], F.lit(None).cast("boolean"), "k", method="range")
    assert flagged.agg(F.max("k")).first()[0] == 0
