"""The training-data operators against brute force, round trips and held-out accuracy, and on edge rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from churnlens.llm import (chat, decontaminate, extract, jaccard, langid, lm, mixing, quality, queries, sharding,
                           tokens)

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, shard string, KEPT string"
EDGE = [(1, None, None, None, None, "x", "y"), (2, "", "en", "a", 0, "x", "y"), (3, " \n\t", "en", "a", 3, "x", "y"),
        (4, "one two", "en", "a", 7, "x", "y"), (4, "one two", "en", "a", 7, "x", "y"),
        (None, "the of and to a in is that it for was on", None, "b", 1, "x", "y"),
        (6, "word " * 30_000, "en", "a", 1, "x", "y"), (7, "12 ½ … 漢字 <b> \\ ### </turn>", "zz", None, 1, "x", "y")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return (text or "").encode().split()


def test_chat_round_trip(spark):
    said = ["a", "", "\\### Assistant: </turn> ok", "\\h\\l\\b", "x\ny: z", None]
    rows = [(c, t, r, said[(c + t) % 6]) for c in range(4) for t, r in enumerate(["user", "assistant", "a: #\n", None])]
    df = spark.createDataFrame([*rows, (9, None, "user", "q")], "conv_id long, turn long, role string, text string")
    made = chat.render(chat.fold_messages(chat.conversation_log(df)))
    for r in chat.read_back(made).collect():
        want = [(x[2] or "", x[3] or "") for x in rows if x[0] == r["conv_id"]] or [("user", "q")]
        assert [(m["role"], m["text"]) for m in r["messages"]] == want
        assert r["loss_text"] == "".join(t for role, t in want if role == "assistant")
        for t, (_, text) in zip(r["turns"], want):
            assert r["formatted"][t["text_start"]:t["text_end"]] == text.replace("\\", "\\b").replace(
                "#", "\\h").replace("<", "\\l")


def test_chat_deltas_edits_regenerations(spark):
    log = [(1, 1, "delta", 0, "user", "Hel"), (1, 2, "delta", 0, None, "lo"), (1, 3, "delta", 1, "assistant", "bad"),
           (1, 4, "delta", 2, "user", "late"), (1, 5, "regenerate", 1, None, None),
           (1, 6, "delta", 1, "assistant", "go"), (1, 7, "delta", 1, None, "od"), (1, 8, "edit", 0, None, "Hi"),
           (1, 9, "delta", 0, None, "!")]
    df = spark.createDataFrame(log, "conv_id long, seq long, op string, msg long, role string, text string")
    got = chat.fold_messages(df).orderBy("msg").collect()
    assert [(r["role"], r["text"]) for r in got] == [("user", "Hi!"), ("assistant", "good")]
    assert chat.digests(chat.render(chat.fold_messages(df.limit(0)))).count() == 0


def test_shards(spark, docs, edge):
    for df, n in ((docs, 24), (edge, 3)):
        rows = sharding.balanced_shards(df, n).collect()
        assert Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in rows) == Counter(
            (r["doc_id"], zlib.crc32((r["text"] or "").encode()), len((r["text"] or "").encode()) + 8)
            for r in df.collect())
        by = defaultdict(list)
        for r in rows:
            by[r["shard"]].append(r)
        assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
        total, most = sum(r["size"] for r in rows), max(r["size"] for r in rows)
        assert all(abs(sum(r["size"] for r in v) - total / n) <= most + 0.02 * total / n for v in by.values())
    assert sharding.balanced_shards(edge.limit(0)).count() == 0


def brute_quality(text):
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    hit = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w))


def test_quality_counts(docs, edge):
    for df in (docs, edge):
        got = quality.quality_rules(df)
        assert [c.lower() for c in got.columns].count("kept") == 1
        want = sorted(map(repr, ((r["doc_id"], *brute_quality(r["text"])) for r in df.collect())))
        rows = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed").collect()
        assert sorted(repr(tuple(r)) for r in rows) == want
    assert quality.quality_rules(edge.limit(0)).count() == 0


def test_quality_rejects_another_distribution(spark, docs):
    junk = spark.createDataFrame([(-1, " ".join(f"{i}%%$$##&&" for i in range(200)), "en")],
                                 "doc_id long, text string, lang string")
    got = quality.quality_rules(docs.select("doc_id", "text", "lang").union(junk)).filter("doc_id = -1").first()
    assert not got["kept"] and not got["base_failed"]


def test_quality_rejects_texts_without_their_languages_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    good = quality.quality_rules(docs).filter("kept AND n_words >= 100 AND lang IN ('en', 'de')")
    rows = good.select("doc_id", "text", "lang").orderBy("doc_id").collect()
    some = [r for lang in ("en", "de") for r in [r for r in rows if r["lang"] == lang][:10]]
    made = [(-1 - r["doc_id"], " ".join(w[::-1] + "x" for w in r["text"].split()), r["lang"]) for r in some]
    made += [(-10**6 - r["doc_id"], r["text"], "de" if r["lang"] == "en" else "en") for r in some]
    got = quality.quality_rules(docs.union(spark.createDataFrame(made, docs.schema))).filter("doc_id < 0").collect()
    without, moved = ([r for r in got if (r["doc_id"] > -10**6) == w] for w in (True, False))
    assert len(without) == 20 and not any(r["base_failed"] or r["kept"] for r in without)
    assert max(max(r["word_distance"] / 0.45, r["class_distance"] / 0.25) for r in without) < 1  # within both limits
    assert len(moved) == 20 and sum(r["kept"] for r in moved) <= 4


def test_quality_common_words_of_any_length(spark):
    df = spark.createDataFrame([("extraordinary " * 3 + "of", "en")], "text string, lang string")
    assert quality.common_words(df, 2).first()["common"] == ["extraordinary", "of"]


def test_main_text():
    page = ("<html><head><title>t</title></head><body><nav><a href=x>menu, menu</a></nav><div class='sidebar'>side</div>"
            "<article><h1>Head &amp; more</h1><p>First <b>long</b>paragraph, with commas, and enough text.<p>Second"
            "&nbsp;one</p><div class=comments><p>I comment, at length, on all of this article.</p></div></article>"
            "<footer>foot</footer></body></html>")
    assert extract.extract(page) == ("Head & more First longparagraph, with commas, and enough text. Second one")
    for bad in (None, "", "<p", "</p></div>", "<!-- x", "<script>a</p>", "<a href='"):
        assert extract.extract(bad) == ""
    assert extract.extract("plain") == "plain"


def test_pages_rows(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    assert queries.op6_main_text(spark, SF).count() == df.count()
    odd = spark.createDataFrame([(None, None, None), (1, "u", "<p>x"), (1, "u", "<p>x")],
                                "page_id long, url string, html string")
    assert sorted(r["n_chars"] for r in extract.main_text(odd).collect()) == [0, 1, 1]


def test_language(spark, edge):
    got = queries.op7_language(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    ok = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert ok > 0.95
    model = langid.fit(edge)
    rows = langid.predict(edge, model).collect()
    assert sorted(r["lang_pred"] for r in rows)[-3:] == ["und"] * 3 or sum(r["lang_pred"] == "und" for r in rows) == 3
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in langid.predict(edge, langid.fit(edge.limit(0))).collect()} == {"und"}


def brute_groups(rows):
    sets = {}
    for i, text in rows:
        w = [x.lower() for x in words(text)]
        sets[i] = frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {(i, len(sets[i]), find(i)) for i in ids}


def test_jaccard_groups(spark, docs):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, r["text"]) for i, r in enumerate(docs.collect())]
    for i in range(60):  # a chain of near copies: neighbours link, ends do not
        base = base[:]
        for _ in range(rng.choice([1, 2, 4])):
            base[rng.randrange(len(base))] = f"n{rng.random()}"
        rows.append((1000 + i, " ".join(base)))
    rows += [(2000, None), (2001, ""), (2002, "A b c"), (2003, "a B c"), (2004, "a b")]
    got = jaccard.link_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {tuple(r) for r in got} == brute_groups(rows)
    assert len(got) == len(rows)


def test_jaccard_edges(edge):
    got = jaccard.link_groups(edge).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in EDGE)
    assert Counter(r["doc_id"] for r in jaccard.keep_one(edge).collect()) == Counter([1, 2, 3, 4, None, 6, 7])
    assert jaccard.link_groups(edge.limit(0)).count() == 0


def test_leaks(spark, edge):
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor"
    item = ("If Alice buys 12 apples and, later on, Bob takes 12 apples out of the basket of 30 km then how many apples "
            "are left in the old basket of the farmer")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (None, "")], "item_id long, text string")
    same = item.replace("12", "45").replace("30", "7")
    broken = item.replace("12", "45", 1)
    rows = [(1, f"{filler}. {item}. {filler}"), (2, f"{filler}. {same}. {filler}"), (3, f"{filler}. {broken}."),
            (4, filler), (5, None), (1, f"{filler}. {item}. {filler}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["exact"]) for r in decontaminate.find_leaks(df, bench).collect()}
    assert got == {(1, 7, True), (2, 7, False)}
    leaks = decontaminate.find_leaks(df, bench)
    assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(df, leaks).collect()) == [3, 4, 5]
    assert decontaminate.find_leaks(edge, bench).count() == 0
    assert decontaminate.find_leaks(edge, bench.limit(0)).count() == 0


def test_leaks_of_short_items_inside_sentences(spark):
    item = "Which old farmer counted all of the apples in that basket before noon"
    texts = [" ".join(item.split()[:n]) for n in range(6, 14)] + [
        "Alice has 12 apples and 30 pears in the basket", "Which 3 of 17 or 40 plus 5 or 6 7 8 9",
        "Bob saw 5 km"]  # few plain tokens in the last two
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    heads = ["", "it was asked of the word ", "they said, ", "A sentence ends. ", "so; "]
    rows = [(100 * i + j, f"{head}{text}. lorem ipsum dolor") for i, text in enumerate(texts)
            for j, head in enumerate(heads)]
    rows += [(9001, "so, Alice has 45 apples and 7 pears in the basket"), (9002, "of, Bob saw 6 km"),
             (9003, "then Which 3 of 18 or 40 plus 5 or 6 7 8 9")]
    got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    got = {(r["doc_id"], r["item_id"]): r["exact"] for r in got.collect()}
    assert all(got.get((100 * i + j, i)) for i in range(len(texts)) for j in range(len(heads)))
    assert got.get((9001, 8)) is False and got.get((9003, 9)) is False and not any(d == 9002 for d, _ in got)


def test_mixing(spark, docs, edge):
    plan = mixing.mix_plan(docs, block_tokens=2000).collect()
    by_block = defaultdict(list)
    for r in plan:
        by_block[r["block"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by_block.values())
    assert max(Counter((r["source"], r["doc_id"]) for r in plan).values()) <= 5
    got = mixing.mix_documents(edge)
    assert got.columns == edge.columns and got.count() > 0
    assert mixing.mix_plan(edge.limit(0)).count() == 0


def test_token_trees():
    enc, count = tokens.encoder(tokens.VOCABULARY), tokens._counter(tokens.VOCABULARY)
    rng = random.Random(1)
    for text in ["", "a", "x" * 900, "one two  three\n\n four's " * 80, "漢字 " * 300]:
        tree = tokens.TokenTree(text, count)
        for _ in range(30):
            i = rng.randint(0, len(text))
            j, new = min(len(text), i + rng.choice([0, 1, 9, 400])), rng.choice(["", " ", "\n", "ab c", " z" * 150])
            tree.edit(i, j, new)
            text = text[:i] + new + text[j:]
            assert tree.text == text and tree.total == len(enc.encode_ordinary(text))


def test_token_rows(edge):
    rows = tokens.count_with_edits(edge).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in EDGE)
    long = next(r for r in rows if r["doc_id"] == 6)
    assert long["n_encoded"] < 0.05 * long["n_chars_after"]


def test_lm_scores(spark, edge, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    monkeypatch.setattr(lm, "TABLE_WORDS", 500)
    import numpy as np
    got = {r["doc_id"]: r for r in lm.score_documents(docs).collect()}
    rows = {r["doc_id"]: [*[w.lower() for w in words(r["text"])], None] for r in docs.collect()}
    train = Counter(w for i, t in rows.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(train.values()), len(train)
    for i, t in rows.items():
        want = sum(np.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert got[i]["n_tokens"] == len(t) and got[i]["n_known"] == sum(train[w] > 0 for w in t)
        assert got[i]["train_tokens"] == n and abs(got[i]["base_score"] - want) < 1e-6 * abs(want)
    assert lm.score_documents(edge).count() == len(EDGE)
    assert lm.score_documents(edge.limit(0)).count() == 0


def test_lm_gradients():
    import numpy as np

    from churnlens.llm.gru import Gru
    rng = np.random.default_rng(0)
    m = Gru(np.zeros(5), np.zeros((3, 4)), 6)
    m.p = {k: x.astype(np.float64) + rng.normal(0, 0.3, x.shape) for k, x in m.p.items()}
    ids, first = rng.integers(0, 14, (7, 3)), np.zeros((7, 3), np.float32)
    first[0], first[4, 1] = 1, 1
    grads, _ = m._window(ids, first, np.zeros((3, 6)))

    def loss():
        return -m.log_probs(m.run(ids, first, np.zeros((3, 6)))[0].astype(np.float64), ids).sum() / 3
    for k in ("rec", "inp", "mem", "cls"):
        at = tuple(rng.integers(0, s) for s in m.p[k].shape) if k != "inp" else (int(ids[2, 0]), 3)
        old = m.p[k][at]
        m.p[k][at] = old + 1e-3
        up = loss()
        m.p[k][at] = old - 1e-3
        down = loss()
        m.p[k][at] = old
        assert abs((up - down) / 2e-3 - grads[k][at]) < 1e-3 * max(1, abs(grads[k][at]))


def test_lm_score_equals_a_pass_word_by_word(monkeypatch):
    import numpy as np

    from churnlens.llm.gru import Gru
    rng = np.random.default_rng(1)
    m = Gru(rng.normal(0, 1, 5), rng.normal(0, 1, (3, 4)), 6)
    m.load(m.flat() + rng.normal(0, 0.5, len(m.flat())))
    lengths = np.array([1, 300, 2, 33, 32, 1, 64, 7, 90, 1])
    ids = rng.integers(0, 14, lengths.sum())
    p = {k: x.astype(np.float64) for k, x in m.p.items()}

    def log_softmax(x):
        return x - x.max() - np.log(np.exp(x - x.max()).sum())
    want = []
    for text in np.split(ids, np.cumsum(lengths)[:-1]):
        s = np.zeros(6)
        for i in text:
            c = i // 4 if i < 12 else i - 12 + 3
            lp = log_softmax(s @ p["cls"] + p["cls_b"])[c]
            want.append(lp + (log_softmax(s @ p["mem"][c] + p["mem_b"][c])[i % 4] if i < 12 else 0))
            x = p["inp"][i] + p["bias"]
            z, r = np.split(1 / (1 + np.exp(-(x[:12] + s @ p["rec"][:, :12]))), 2)
            s = z * s + (1 - z) * np.tanh(x[12:] + (r * s) @ p["rec"][:, 12:])
    for lanes in (1, 3, 256):
        monkeypatch.setattr(lm, "LANES", lanes)
        assert np.abs(lm._score(m, ids, lengths) * np.log(10) - want).max() < 1e-4


def test_lm_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    whole = lm.train
    monkeypatch.setattr(lm, "train", lambda d, v: whole(d, v, docs_per_model=40, lanes=8))
    monkeypatch.setattr(lm, "BLOCK", 5000)
    a, b = ({r["doc_id"]: r["score"] for r in lm.score_documents(d).collect()}
            for d in (docs.coalesce(1), docs.orderBy("text").repartition(7)))
    assert a.keys() == b.keys() and max(abs(a[i] - b[i]) for i in a) < 1e-2


def test_lm_words_are_looked_up_by_leading_bits():
    import numpy as np
    rng = np.random.default_rng(3)
    crowd = np.arange(50, dtype=np.int64) + 5  # one range of leading bits holds them all
    for h in (rng.integers(-2**63, 2**63 - 1, 1000), np.r_[crowd, np.int64(-1), np.int64(2**63 - 1)], np.array([7])):
        h = rng.permutation(np.unique(h))
        c = np.arange(1, len(h) + 1)
        vocab = lm.Vocabulary(h, c, int(c.sum()), len(h), np.full(lm.UNLISTED, 1e9), np.full(lm.UNLISTED, 1e4))
        asked = np.r_[h, rng.integers(-2**63, 2**63 - 1, 300), h + 1, np.int64(0)]
        want = dict(zip(h.tolist(), c.tolist()))
        _, got, here = vocab.look_up(asked)
        assert got.tolist() == [want.get(x, 0) for x in asked.tolist()]
        assert here.tolist() == [x in want for x in asked.tolist()]


def test_lm_blocks_are_whole_texts(monkeypatch):
    import numpy as np
    import pandas as pd
    monkeypatch.setattr(lm, "BLOCK", 10)
    texts = ["a " * k for k in (3, 0, 25, 9, 1, 1, 4)] + [None]
    vocab = lm.Vocabulary(np.empty(0, np.int64), np.empty(0, np.int64), 0, 0, np.zeros(lm.UNLISTED),
                          np.zeros(lm.UNLISTED))
    cuts = [[len(ids) for ids, _ in lm._blocks(iter(f), vocab)] for f in (
        [pd.DataFrame({"text": texts})], [pd.DataFrame({"text": [t]}) for t in texts])]
    assert cuts[0] == cuts[1] == [31, 10, 10]


def test_lm_trains_on_every_document(spark):
    import numpy as np
    rows = [(i, f"only{i} only{i} only{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    h, c = np.unique(lm._tokens([t.encode() for _, t in rows])[0], return_counts=True)
    cls = lm._unlisted(h)
    vocab = lm.Vocabulary(h, c, int(c.sum()), len(h), np.bincount(cls, c, lm.UNLISTED),
                          np.bincount(cls, minlength=lm.UNLISTED).astype(float))
    start = lm.Gru(vocab.class_log, vocab.member_log, lm.HIDDEN)
    for per_model in (1500, 10):  # one trainer, and a first one with three that start from it
        model = lm.train(df, vocab, docs_per_model=per_model)
        moved = np.abs(model.p["inp"] - start.p["inp"]).max(1) > 0
        words_at = vocab.look_up(lm._tokens([f"only{i}".encode() for i in range(40)])[0][::2])[0]
        assert moved[words_at].all()


def test_lm_encoded_texts_teach_what_texts_teach(spark):
    import numpy as np
    rows = [(i, f"word{i % 7} only{i} " * (i % 5)) for i in range(60)] + [(None, ""), (3, "word3 only3 ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    h, c = np.unique(lm._tokens([t.encode() for _, t in rows])[0], return_counts=True)
    cls = lm._unlisted(h)
    vocab = lm.Vocabulary(h[:30], c[:30], int(c.sum()), len(h), np.bincount(cls, c, lm.UNLISTED),
                          np.bincount(cls, minlength=lm.UNLISTED).astype(float))
    encoded = lm.encode(df, vocab)
    texts = encoded.filter("is_doc")
    got = sorted((r["doc_id"] is None, r["doc_id"], np.frombuffer(r["ids"], lm.ID).tolist()) for r in texts.collect())
    want = sorted((i is None, i, vocab.look_up(lm._tokens([t.encode()])[0])[0].tolist()) for i, t in rows)
    assert got == want
    beyond = Counter(x for _, t in rows for x in lm._tokens([t.encode()])[0].tolist() if x not in h[:30])
    found = Counter()
    for r in encoded.filter("not is_doc").collect():
        found[r["h"]] += r["k"]
    assert found == beyond
    for per_model in (1500, 15):
        a, b = (lm.train(d, vocab, docs_per_model=per_model).flat() for d in (df, texts))
        assert np.abs(a - b).max() < 1e-5


def test_lm_large_logits_and_gates():
    import warnings

    import numpy as np

    from churnlens.llm.gru import PLACES, Gru
    rng = np.random.default_rng(4)
    m = Gru(rng.normal(0, 80, 5), rng.normal(0, 80, (3, 4)), 6)  # beyond what exp holds without a shift
    m.p["inp"] *= np.float32(3000)  # gates and states at their limits
    ids, first = rng.integers(0, 14, (8, PLACES // 4)), np.zeros((8, PLACES // 4), np.float32)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        outs, _, _ = m.run(ids, first, np.zeros((PLACES // 4, 6)))
        lp = m.log_probs(outs, ids)
        grads, _ = m._window(ids, first, np.zeros((PLACES // 4, 6)))
    out, p, flat = outs.reshape(-1, 6).astype(float), m.p, ids.ravel()

    def log_softmax(x):
        x = x - x.max(1, keepdims=True)
        return x - np.log(np.exp(x).sum(1, keepdims=True))
    at = np.arange(len(flat))
    want = log_softmax(out @ p["cls"] + p["cls_b"])[at, m.classes(flat)]
    for c in range(3):
        own = np.flatnonzero(flat // 4 == c)
        want[own] += log_softmax(out[own] @ p["mem"][c] + p["mem_b"][c])[np.arange(len(own)), flat[own] % 4]
    assert np.abs(lp - want).max() < 1e-3
    assert all(np.isfinite(g).all() for g in grads.values())


def test_lm_windows_hold_every_token():
    import numpy as np

    from churnlens.llm.gru import Gru, in_stream
    for n, lanes in ((1, 64), (100, 64), (64 * 16 + 7, 64), (999, 10)):
        ids, lengths = np.arange(n) % 14, np.array([n // 2, n - n // 2])
        grid, first, live = in_stream(ids, lengths, lanes, 16)
        assert (grid.T.ravel()[live.T.ravel() > 0] == ids).all()
        m = Gru(np.zeros(5), np.zeros((3, 4)), 6)
        old = m.flat()
        m.train(grid, first, live, 16, 0.01)
        assert (m.flat() != old).any()
    # Padding teaches nothing, whatever token stands there.
    ids, first, live = np.ones((5, 2), int), np.zeros((5, 2), np.float32), np.ones((5, 2), np.float32)
    live[3:, 1] = 0
    made = []
    for pad in (2, 9):
        ids[3:, 1] = pad
        m = Gru(np.zeros(5), np.zeros((3, 4)), 6)
        m.train(ids, first, live, 16, 0.01)
        made.append(m.flat())
    assert (made[0] == made[1]).all()


def test_pipeline(spark):
    import corpus_pipeline
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[:2] == ["doc_id", "size"] and got.count() > 50
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "mixing",
                                                      "sharding"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    from oracle_compare import compare
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res["cols"] and res["types"] and res["rows"] and res["values"], res


def test_digest_of_the_planted_conversation(spark):
    row = queries.op1_chat_format(spark, SF).filter("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest() and row["n_turns"] == 2
