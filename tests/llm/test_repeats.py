"""Ids that repeat or are missing, hostile pages: nothing is lost, multiplied or fatal."""

import time
from collections import Counter

import pytest

from churnlens.llm import decontaminate, extract, jaccard, mixing

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOC)


# --- mixing: as many rows as the plan draws ----------------------------------------

@pytest.mark.parametrize("rows", [
    [(None, f"null id {k}", "a") for k in range(20)],
    [(1, "first text", "a"), (1, "second text here", "a"), (2, "x y z", "a"), (3, "b", "b")],
    [(1, "same", "a")] * 5 + [(1, "same", "b")] * 2 + [(None, "n", None)] * 3 + [(4, None, "a")],
    []])
def test_mixing_divides_draws_over_shared_ids(spark, rows):
    df = docs(spark, *rows)
    plan = Counter((r["source"], r["doc_id"]) for r in mixing.mix_plan(df).collect())
    got = mixing.mix_documents(df)
    assert got.columns == df.columns
    rows_back = got.collect()
    assert Counter((r["source"], r["doc_id"]) for r in rows_back) == plan
    # Rows of one key differ by one draw at most, and every row of a key with enough draws is there.
    times = Counter((r["source"], r["doc_id"], r["text"]) for r in rows_back)
    have = Counter((s, i, t) for i, t, s in rows)
    shared = Counter((s, i) for i, _, s in rows)
    for key, k in have.items():
        n = plan[key[:2]]
        assert k * (n // shared[key[:2]]) <= times[key] <= k * -(-n // shared[key[:2]])


# --- leaks: a document is an id and a text ------------------------------------------

ITEM = "Alice paid 12 dollars for 3 apples and 5 pears at the market on the corner yesterday morning."
OTHER = "Nothing of the kind stands in this text, which only talks about the weather in the hills today."


def test_leaks_with_repeated_and_missing_ids(spark):
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    leak = f"Once more. {ITEM} That was all."
    for rows in ([(1, leak, "a"), (1, OTHER, "a")], [(None, leak, "a"), (None, OTHER, "a")],
                 [(1, leak, "a"), (1, f"9 dollars, {OTHER}", "a"), (1, leak, "a"), (2, OTHER, "a")]):
        df = docs(spark, *rows)
        leaks = decontaminate.find_leaks(df, bench)
        assert [(r["doc_id"], r["item_id"], r["exact"]) for r in leaks.collect()] == [(rows[0][0], 7, True)]
        keyed = decontaminate.find_leaks(df, bench, keyed=True)
        left = decontaminate.drop_leaks(df, keyed)
        assert Counter(r["text"] for r in left.collect()) == Counter(t for _, t, _ in rows if t != leak)
        assert left.columns == df.columns


# --- near duplicates: one row of each group, all groups -------------------------------

def test_keep_one_keeps_every_group(spark):
    x, y, z = (" ".join(f"{c}{k}" for k in range(40)) for c in "xyz")
    near = x.replace("x39", "x99")
    rows = [(1, x, "a"), (1, y, "a"),  # one id, texts without a link
            (5, near, "a"), (6, y, "a"),  # links to both
            (None, z, "a"), (None, z, "a"), (None, f"{z} more", "a"),  # a group without an id
            (None, x, "a"),  # a null id comes after 1
            (8, "", "a"), (9, None, "a"), (9, None, "a")]
    got = jaccard.keep_one(docs(spark, *rows)).collect()
    kept = Counter((r["doc_id"], r["text"]) for r in got)
    assert kept[1, x] == kept[1, y] == 1 and kept[8, ""] == 1 and kept[9, None] == 1
    assert sum(n for (i, t), n in kept.items() if i is None) == 1 and len(got) == 5
    assert jaccard.keep_one(docs(spark, *rows[:0])).count() == 0


def test_copies_signed_by_several_tasks(spark):
    """Sets whose copies lie in different partitions keep their links to near copies."""
    rows, want = [], {}
    for k in range(12):
        text = " ".join(f"f{k}w{i}" for i in range(30))
        ids = [100 * k + i for i in range(6)]
        rows += [(i, text, "a") for i in ids[:5]] + [(ids[5], text + " end", "a")]
        want |= dict.fromkeys(ids, ids[0])
    df = docs(spark, *rows).repartition(6)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.link_groups(df).collect()} == want


# --- pages ---------------------------------------------------------------------------

SENTENCE = "Some words, of the story, that is long enough to count. "


@pytest.mark.parametrize("html", [
    "<div>" * 10_000 + f"<p>{SENTENCE * 3}</p>" + "</div>" * 10_000,
    "<span>" * 60_000 + "</p>" * 60_000 + SENTENCE,
    "<span>" * 40_000 + "<div></div>" * 40_000 + SENTENCE,
    "<li><ul>" + "<div>" * 40_000 + "<li></li>" * 40_000 + SENTENCE,
    "<b>" + "<div>" * 40_000 + "</b>" * 40_000 + SENTENCE,
    "<div><header>x</header>" * 10_000 + f"<p>{SENTENCE * 3}</p>"], ids=["deep", "stray", "divs", "items", "inline", "headers"])
def test_hostile_pages_take_linear_time(html):
    began = time.process_time()
    assert "Some words, of the story" in extract.extract(html)
    assert time.process_time() - began < 6  # under a second alone; the quadratic form took minutes


def test_a_class_word_does_not_drop_the_article():
    story, other = f"<p>{SENTENCE * 9}</p>", f"<p>{SENTENCE}</p>"
    for name in ("social-history", "search-history", "form", "shared-memory related"):
        page = f"<body><div class='{name}'>{story}</div><div>{other}</div></body>"
        assert extract.extract(page).count("Some words") >= 9
    side = f"<body><div>{story}</div><div class='related'>{other}</div><div class='social'>{other}</div></body>"
    assert extract.extract(side).count("Some words") == 9
    # Reader comments go, however long.
    page = f"<body><div>{story}</div><div class='comments'>{story * 3}</div></body>"
    assert extract.extract(page).count("Some words") == 9


def test_points_fall_off_with_distance():
    """Brute-force scores of every container of a small page."""
    page = ("<body><div><section><p>" + "a" * 130 + ",b</p><p>short</p><p>" + "c, " * 20 + "</p></section></div>"
            "<div><p>" + "d" * 30 + "<a>" + "e" * 30 + "</a></p></div></body>")
    order = extract._prune(extract.parse(page))
    extract._score(order)
    score = {}
    for n in order:
        score.setdefault(n.tag, []).append(n.score)
    first, second, third = 1 + 1 + 1, 1 + 20 + 0, (1 + 0 + 0) * 0.5
    assert score["section"] == [pytest.approx(first + second)]
    assert score["div"] == [pytest.approx((first + second) / 2), pytest.approx(third)]
    assert score["body"] == [pytest.approx((first + second) / 4 + third / 2)]
    assert score["p"] == [0, 0, 0, 0]
