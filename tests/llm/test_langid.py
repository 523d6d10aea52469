"""Language filters against exact sets of n-grams (operator 7)."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import langid

MID = "/root/testdata/sf0.01"


def plain_grams(text):
    """The 4-byte runs of a text by the definition: lower-cased letters, other runs one blank, blanks around."""
    out = bytearray(b" ")
    for c in text.encode():
        c = c if c >= 128 else ord(chr(c).lower()) if chr(c).isalpha() else 32
        if not (c == 32 and out[-1] == 32):
            out.append(c)
    if out[-1] != 32:
        out.append(32)
    return [int.from_bytes(out[i:i + 4], "big") for i in range(len(out) - 3)]


def exact_sets(rows, min_share, min_ratio):
    counts = {}
    for lang, text in rows:
        counts.setdefault(lang, Counter()).update(plain_grams(text))
    total = {x: sum(c.values()) for x, c in counts.items()}
    top = Counter()
    for x, c in counts.items():
        for g, n in c.items():
            top[g] = max(top[g], n / total[x])
    return {x: {g for g, n in c.items() if n / total[x] >= min_share and n / total[x] >= min_ratio * top[g]}
            for x, c in counts.items()}


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    train = docs.filter(~held_out)
    rows = [(r["lang"], r["text"]) for r in train.collect() if r["lang"] is not None and r["text"] is not None]
    return langid.fit(train), exact_sets(rows, 1e-6, 0.1), docs.filter(held_out).collect()


def test_grams_by_definition():
    for text in ["", "a", "abc", "Ab, cd  efg!", "12 12", "é漢字 x", "  lead"]:
        got, n = langid.grams([text.encode(), b"zz"])
        assert got[:n[0]].tolist() == plain_grams(text)


def test_every_ngram_is_in_its_filters(fitted):
    model, sets, _ = fitted
    assert model.langs == sorted(sets)
    assert max(len(s) for s in sets.values()) > 4096  # beyond any fixed number of n-grams
    every = np.array(sorted(set().union(*sets.values())))
    a, b = langid._slots(every, len(model.slots).bit_length() - 1)
    masks = model.slots[a, 0] & model.slots[b, 0]
    for i, lang in enumerate(model.langs):
        has = (masks >> np.uint64(i)) & np.uint64(1) == 1
        inside = np.isin(every, np.array(sorted(sets[lang])))
        assert has[inside].all()
        assert abs(has[~inside].mean() - model.false_rate[i]) < 0.02


def test_predictions_equal_exact_sets(fitted):
    model, sets, held_out = fitted
    texts = [r["text"] for r in held_out if r["text"] and any(c.isalpha() for c in r["text"])]
    texts += [" ".join(t.split()[k:k + 4]) for t in texts for k in (0, 20)]
    best, score = langid._classify([t.encode() for t in texts], model)
    same = 0
    for t, i, s in zip(texts, best, score):
        hits = [sum(g in sets[x] for g in plain_grams(t)) for x in model.langs]
        same += hits[i] == max(hits)
        assert abs(s - max(hits) / max(1, sum(hits))) < 0.3
    assert same >= 0.995 * len(texts)


def test_long_tail_and_rare_language(spark):
    """A language of one text, and far more n-grams than the old number, still answer by their own words."""
    rare = "zxqv wvkq qqzx"
    words = ["".join(chr(97 + (i // 26 ** k + 7 * k) % 26) for k in range(6)) for i in range(6000)]
    rows = [("aa", " ".join(words)), ("bb", rare), (None, "zz"), ("cc", None)]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.langs == ["aa", "bb"]
    asked = spark.createDataFrame([(words[-1] + " " + words[-2],), ("wvkq",), ("12",), (None,), ("ñ",)], "text string")
    got = {r["text"]: (r["lang_pred"], r["score"]) for r in langid.predict(asked, model).collect()}
    assert got[words[-1] + " " + words[-2]][0] == "aa" and got["wvkq"][0] == "bb"
    assert got["12"] == got[None] == ("und", 0.0)
    assert got["ñ"][0] in ("aa", "bb")


def test_layout_does_not_matter(spark, fitted):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("lang", "text").filter(
        F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    again = langid.fit(docs.repartition(5))
    assert again.langs == fitted[0].langs and again.usual == fitted[0].usual
    assert (again.slots == fitted[0].slots).all()


def test_quoted_words_enter_no_filter(spark):
    counts = spark.createDataFrame([("aa", 1, 900), ("aa", 2, 100), ("bb", 1, 1), ("bb", 3, 999)],
                                   "lang string, gram long, n long")
    got = {(r["lang"], r["gram"]) for r in langid.members(counts, 1e-6, 0.1).collect()}
    assert got == {("aa", 1), ("aa", 2), ("bb", 3)}
    assert {(r["lang"], r["gram"]) for r in langid.members(counts, 0.5, 0.0).collect()} == {("aa", 1), ("bb", 3)}
