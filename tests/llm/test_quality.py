"""Quality rules against a brute force of counts, distances and verdicts; labels with little text."""

import math
import random
from collections import Counter, defaultdict

import pytest

from churnlens.llm import quality

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def split(text):
    return "".join(" " if c in SPACE else c for c in text or "").split(" ")


def words(text):
    return [w for w in split(text) if w]


def classes(text):
    out = [0] * 7
    for c in text or "":
        out[0 if "a" <= c <= "z" else 1 if c in SPACE else 2 if "A" <= c <= "Z" else 3 if "0" <= c <= "9"
            else 4 if c in "#*$%&|<>" else 5 if c.isalpha() else 6] += 1
    return out


def distance(p, q):
    tp, tq = sum(p), sum(q)
    if not tp or not tq:
        return None
    js = 0.0
    for x, y in zip(p, q):
        a, b = x / tp, y / tq
        js += (a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0)
    return math.sqrt(max(js / 2, 0))


def repeated(w):
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    return len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)})


def brute(rows, min_docs=20, min_share=0.001):
    """``[(n_words, class_distance, word_distance, base_failed, kept)]`` of ``(text, lang)`` rows."""
    langs, pool = defaultdict(list), [0] * 7
    for text, lang in rows:
        langs[lang or ""].append(text or "")
        pool = [a + b for a, b in zip(pool, classes(text))]
    total = sum(len(t.encode()) for texts in langs.values() for t in texts)
    refs = {}
    for lang, texts in langs.items():
        if len(texts) >= min_docs and sum(len(t.encode()) for t in texts) >= min_share * total:
            counts = Counter(w for t in texts for w in words(t))
            common = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:16]
            refs[lang] = ([sum(c) for c in zip(*map(classes, texts))], common, sum(counts.values()))
    out = []
    for text, lang in rows:
        w, t = words(text), text or ""
        ref = refs.get(lang or "")
        cd = distance(classes(t), ref[0] if ref else pool) if len(t) >= 200 else None
        wd, few = None, False
        if ref and len(w) >= 60:
            top = sum(n for _, n in ref[1])
            mine = Counter(w)
            held = [mine[c] for c, _ in ref[1]]
            wd = distance([len(w) - sum(held), *held], [ref[2] - top, *[n for _, n in ref[1]]])
            few = sum(held) * ref[2] < 0.5 * len(w) * top
        failed = len(w) < 10 or 100 * repeated(w) > 20 * len(w)
        out.append((len(w), cd, wd, failed, not failed and not few and (cd or 0) <= 0.25 and (wd or 0) <= 0.45))
    return out


def check(spark, rows, **limits):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, text string, lang string").repartition(5)
    got = {r["i"]: r for r in quality.quality_rules(df, min_ref_docs=limits.get("min_docs", 20),
                                                    min_ref_share=limits.get("min_share", 0.001)).collect()}
    want = brute(rows, **limits)
    for i, (n, cd, wd, failed, kept) in enumerate(want):
        r = got[i]
        assert (r["n_words"], r["base_failed"], r["kept"]) == (n, failed, kept), (i, rows[i], r)
        for x, y in ((r["class_distance"], cd), (r["word_distance"], wd)):
            assert (x is None) == (y is None) and (x is None or x == pytest.approx(y, abs=1e-9)), (i, x, y)
    return [got[i] for i in range(len(rows))]


JUNK = " ".join(f"{i}#%&{i * 7919}|$" for i in range(80))


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    letters = "abcdefgh"
    rows += [(" ".join("".join(rng.choices(letters, k=4)) for _ in range(90)), "en") for _ in range(3)]
    rows += [(JUNK, x) for x in ("en", "zz", None, "")] + [(None, "en"), ("", None), (" \n\t", "de"), ("a b", "zz"),
                                                         ("word " * 3000, "en"), ("É漢字½ … " * 40, "fr")]
    got = check(spark, rows)
    assert sum(r["kept"] for r in got) > 0.5 * len(got)


def test_a_label_does_not_judge_itself(spark):
    """The same junk is rejected under a usual label, a label of its own, and as many labels as there are copies."""
    docs = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = check(spark, docs + [(JUNK, "en")] + [(JUNK, f"z{i}") for i in range(12)])
    assert not any(r["kept"] for r in got[len(docs):])
    assert all(r["class_distance"] > 0.25 for r in got[len(docs):])


def test_clean_text_with_a_rare_label_is_kept(spark):
    docs = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    before = check(spark, docs)
    some = [i for i, r in enumerate(before) if r["kept"]][:15]
    got = check(spark, docs + [(docs[i][0], f"rare{i}") for i in some])
    assert all(r["kept"] for r in got[len(docs):])


def test_floors(spark):
    rows = [("one two three four five six seven eight nine ten " + "x" * k, "aa") for k in range(25)] + [("b c", "bb")]
    for limits in ({"min_docs": 1, "min_share": 0.0}, {"min_docs": 26}, {"min_share": 2.0}):
        check(spark, rows, **limits)
