"""LM scoring with a gated recurrent language model (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.checkpoint import materialize
from .gru import Gru, in_stream, laid_out
from .shingles import U, chunks, mix, word_hashes

END = np.int64(0x0E9D0E9D0E9D0E9D)  # the name of the end token
LISTED, WIDTH, UNLISTED = 24, 64, 40  # classes of listed words, words in each, classes of the others
HIDDEN, LANES, WINDOW = 24, 512, 32
BLOCK = 1 << 21  # tokens that a trainer holds at a time
SLICE, LOT = 8192, 256  # parameters in a row of a model; trainers whose rows one task adds up
TABLE_WORDS = 1 << 19  # words whose counts are broadcast; the counts of the others are joined
SMOOTH = 0.1
ID = np.int16  # of a token's id in an encoded text
KEPT_BYTES = 31 << 20


def _keep_freed_memory() -> None:
    """Let a task's process reuse the memory of freed arrays.

    After an array of this size is freed, the C library keeps that much for smaller ones; before, it
    returns each to the system, and touching new pages takes longer than hashing the words in them.
    """
    np.empty(KEPT_BYTES, np.uint8)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with an end token after each, and tokens per text."""
    words, n = word_hashes(texts)
    out = np.full(len(words) + len(texts), END, np.int64)
    out[np.arange(len(words)) + np.repeat(np.arange(len(texts)), n)] = words.view(np.int64)
    return out, n + 1


def _unlisted(h: np.ndarray) -> np.ndarray:
    """The class, from 0, of a word that is not listed: a part of its hash."""
    return (mix(h.view(U)) % U(UNLISTED)).astype(np.int64)


def _encoded(column: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in column]


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    _keep_freed_memory()
    for f in frames:
        texts, found, times = _encoded(f["text"]), [], []
        for lo, hi in chunks(texts):
            h, c = np.unique(_tokens(texts[lo:hi])[0], return_counts=True)
            found.append(h)
            times.append(c)
        if found:
            h, at = np.unique(np.concatenate(found), return_inverse=True)
            yield pd.DataFrame({"h": h, "c": np.bincount(at, np.concatenate(times)).astype(np.int64)})


class Vocabulary:
    """Counts of the most frequent words, their ids, and the totals of the classes of the others."""

    def __init__(self, h, c, total, distinct, class_n, class_v):
        order = np.argsort(h.view(U))
        self.h, self.c = h[order], c[order]
        # The first word of each range of leading bits: about one word a range, as hashes spread evenly.
        self.shift = U(64 - max(1, len(h).bit_length()))
        self.range = np.searchsorted(self.h.view(U) >> self.shift, np.arange(1 << (64 - int(self.shift)), dtype=U))
        self.total, self.distinct = total, distinct
        listed = LISTED * WIDTH
        best = np.lexsort((self.h, -self.c))[:listed]
        self.ids = np.full(len(h), -1, np.int32)
        self.ids[best] = np.arange(len(best))
        counts = np.zeros(listed)
        counts[:len(best)] = self.c[best]
        # Listed words leave the classes of the unlisted.
        gone = _unlisted(self.h[best])
        self.class_n = class_n - np.bincount(gone, self.c[best], UNLISTED)
        self.class_v = class_v - np.bincount(gone, minlength=UNLISTED)
        members = counts.reshape(LISTED, WIDTH) + 0.01
        classes = np.concatenate([members.sum(1), self.class_n + SMOOTH * (self.class_v + 1)])
        self.class_log = np.log(classes / classes.sum())
        self.member_log = np.log(members / members.sum(1, keepdims=True))

    def look_up(self, h: np.ndarray):
        """(id, count, known here); the count of a word that is not in the table is 0 for now."""
        if not len(self.h):
            return LISTED * WIDTH + _unlisted(h), np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        u, words = h.view(U), self.h.view(U)
        at = self.range.take((u >> self.shift).astype(np.int64))
        at = np.minimum(at, len(words) - 1)
        # Go on from the range's first word while the word there is smaller: a step or two for nearly all.
        on = np.flatnonzero(words.take(at) < u)
        while len(on):
            at[on] += 1
            on = on[at[on] < len(words)]
            on = on[words.take(at[on]) < u[on]]
        at = np.minimum(at, len(words) - 1)
        here = words.take(at) == u
        ids = np.where(here, self.ids[at], -1)
        return (np.where(ids >= 0, ids, LISTED * WIDTH + _unlisted(h)),
                np.where(here, self.c[at], 0), here)

    def base_log10(self, c):
        return np.log10((c + SMOOTH) / (self.total + SMOOTH * (self.distinct + 1)))

    def unlisted_log10(self, c, cls):
        return np.log10((c + SMOOTH) / (self.class_n[cls] + SMOOTH * (self.class_v[cls] + 1)))


def fit_vocabulary(counts: DataFrame, table_words: int = TABLE_WORDS) -> Vocabulary:
    """The most frequent words, at most ``table_words`` of them, and totals over all words of ``counts``."""
    m = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    levels = counts.groupBy("c").agg(F.count(F.lit(1)).alias("v")).orderBy(F.desc("c"))
    # Level by level from the top while the table holds them: the levels above the cut are few.
    running = levels.limit(table_words).toArrow().to_pandas()
    fits = running[running["v"].cumsum() <= table_words]
    floor = int(fits["c"].min()) if len(fits) else np.iinfo(np.int64).max
    top = counts.filter(F.col("c") >= floor).toArrow().to_pandas()
    totals = counts.mapInPandas(_class_totals, "k long, n long, v long").groupBy("k").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")).toArrow().to_pandas()
    n, v = np.zeros(UNLISTED), np.zeros(UNLISTED)
    n[totals["k"]], v[totals["k"]] = totals["n"], totals["v"]
    return Vocabulary(top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64), int(m["n"] or 0), int(m["v"]), n, v)


def _class_totals(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        k = _unlisted(f["h"].to_numpy(np.int64))
        yield pd.DataFrame({"k": np.arange(UNLISTED), "n": np.bincount(k, f["c"], UNLISTED).astype(np.int64),
                            "v": np.bincount(k, minlength=UNLISTED)})


def _key() -> Column:
    return F.xxhash64(F.lit("lm"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").alias("key")


def train(docs: DataFrame, vocabulary: Vocabulary, one_in: int = 1, docs_per_model: int = 6000,
          lanes: int = 512, window: int = 16, rate: float = 0.01) -> Gru:
    """A model trained on all training documents, in one pass over every token.

    The documents are dealt by a hash of id and text to trainers of about
    ``docs_per_model`` documents; each runs truncated backpropagation. The first
    trainer's model is what the others start from, as models trained apart from
    random weights do not average well; theirs are averaged by tokens. The
    trainers grow with the corpus; what comes back is one model's size. A trainer
    reads its documents in the order of their hashes, so the layout of the input
    does not matter; rows that share both id and text share a trainer.
    ``one_in`` above 1 keeps only every so-many-th document. ``docs`` are ``doc_id, text``, or the
    documents of ``encode``, whose texts need not be looked up again.
    """
    model = Gru(vocabulary.class_log, vocabulary.member_log, HIDDEN)
    docs = docs.select("key", "ids") if "ids" in docs.columns else docs.select(_key(), "text")
    if one_in > 1:
        docs = docs.filter(F.pmod("key", F.lit(one_in)) == 0)
    n = max(1, round(docs.count() / docs_per_model))
    if n == 1:
        return _trained(docs, vocabulary, model, 1, lanes, window, rate)
    deal = F.pmod(F.xxhash64(F.lit("deal"), "key"), F.lit(n))
    model = _trained(docs.filter(deal == 0), vocabulary, model, 1, lanes, window, rate)
    return _trained(docs.filter(deal != 0), vocabulary, model, n - 1, lanes, window, rate)


def _ids(f: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and lengths of encoded texts."""
    return np.frombuffer(b"".join(f["ids"]), ID), np.array([len(x) // ID().nbytes for x in f["ids"]], np.int64)


def _looked_up(f: pd.DataFrame, vocab: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    texts = _encoded(f["text"])
    for lo, hi in chunks(texts):
        h, lengths = _tokens(texts[lo:hi])
        yield vocab.look_up(h)[0].astype(ID), lengths


def _blocks(frames: Iterator[pd.DataFrame], vocab: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and lengths of consecutive whole texts, cut at the first text that brings BLOCK tokens or more."""
    held, size = [], 0
    for f in frames:
        for ids, lengths in [_ids(f)] if "ids" in f else _looked_up(f, vocab):
            while size + len(ids) >= BLOCK:
                upto = np.cumsum(lengths)
                k = int(np.searchsorted(upto, BLOCK - size)) + 1
                held.append((ids[:upto[k - 1]], lengths[:k]))
                yield tuple(np.concatenate(x) for x in zip(*held))
                ids, lengths, held, size = ids[upto[k - 1]:], lengths[k:], [], 0
            held.append((ids, lengths))
            size += len(ids)
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _trained(docs: DataFrame, vocabulary: Vocabulary, start: Gru, trainers: int, lanes: int, window: int,
             rate: float) -> Gru:
    """The average, by tokens, of the models that ``trainers`` tasks make of ``start``."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, start.flat()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _keep_freed_memory()
        vocab, flat = shared.value
        model, seen = Gru(vocab.class_log, vocab.member_log, HIDDEN).load(flat), 0
        for ids, lengths in _blocks(frames, vocab):
            model.train(*in_stream(ids, lengths, lanes, window), window, rate)
            seen += len(ids)
        if seen:
            w, me = model.flat(), TaskContext.get().partitionId()
            lo = np.arange(0, len(w), SLICE)
            yield pd.DataFrame({"lo": lo, "lot": me // LOT, "trainer": me, "n": seen,
                                "w": [w[a:a + SLICE].tobytes() for a in lo]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("trainer")  # one order of summation, whatever the shuffle brings first
        w = sum(np.frombuffer(x, np.float32).astype(float) * n for x, n in zip(rows["w"], rows["n"]))
        return pd.DataFrame({"at": rows["lo"].iloc[0] + np.arange(len(w)), "w": w, "n": rows["n"].sum()})
    content = docs.columns[1]
    dealt = docs.repartition(trainers, "key").sortWithinPartitions("key", content).select(content)
    models = dealt.mapInPandas(run, "lo long, lot long, trainer long, n long, w binary")
    learned = (models.groupBy("lo", "lot").applyInPandas(add, "at long, w double, n long").groupBy("at")
               .agg((F.sum("w") / F.sum("n")).alias("w"))).toArrow().to_pandas().sort_values("at")
    return start.load(learned["w"].to_numpy()) if len(learned) else start


def _encoder(shared):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _keep_freed_memory()
        vocab = shared.value
        row = np.int64(TaskContext.get().partitionId()) << np.int64(36)
        for f in frames:
            texts = _encoded(f["text"])
            n = len(texts)
            lengths, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
            base, score, listed, far = np.zeros(n), np.zeros(n), [], []
            for lo, hi in chunks(texts):
                h, lengths[lo:hi] = _tokens(texts[lo:hi])
                ids, c, here = vocab.look_up(h)
                doc = np.repeat(np.arange(hi - lo), lengths[lo:hi])
                inner = here & (ids >= LISTED * WIDTH)
                known[lo:hi] = np.bincount(doc[here], minlength=hi - lo)
                base[lo:hi] = np.bincount(doc[here], vocab.base_log10(c[here]), hi - lo)
                score[lo:hi] = np.bincount(doc[inner], vocab.unlisted_log10(c[inner], ids[inner] - LISTED * WIDTH),
                                           hi - lo)
                upto = np.cumsum(lengths[lo:hi])
                ids = ids.astype(ID)
                listed += [ids[a:b].tobytes() for a, b in zip(upto - lengths[lo:hi], upto)]
                far.append((doc[~here] + lo + row, h[~here]))
            del texts
            yield pd.DataFrame({"row": row + np.arange(n), "doc_id": f["doc_id"].astype("Int64"), "key": f["key"],
                                "ids": listed, "h": np.int64(0), "k": lengths, "known": known, "base": base,
                                "score": score, "is_doc": True})
            row += n
            if any(len(h) for _, h in far):  # words beyond the table, once for each text that has them
                rows, h = (np.concatenate(x) for x in zip(*far))
                pair = pd.DataFrame({"row": rows, "h": h}).value_counts().reset_index(name="k")
                yield pair.assign(doc_id=pd.array([None] * len(pair), "Int64"), key=np.int64(0), ids=None,
                                  known=np.int64(0), base=0.0, score=0.0, is_doc=False)[
                    ["row", "doc_id", "key", "ids", "h", "k", "known", "base", "score", "is_doc"]]
    return run


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The texts as ids of tokens, written once for training and scoring.

    A row for each document (``is_doc``) with its key, ids, tokens ``k``, and the sums of what does not
    need the network; and a row for each word ``h`` of a text that is beyond the table, found ``k`` times.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return materialize(docs.select("doc_id", _key(), "text").mapInPandas(
        _encoder(shared), "row long, doc_id long, key long, ids binary, h long, k long, known long, base double, "
                          "score double, is_doc boolean"), "encoded")


def _scorer(shared):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _keep_freed_memory()
        vocab, flat = shared.value
        model = Gru(vocab.class_log, vocab.member_log, HIDDEN).load(flat)
        for f in frames:
            if len(f):
                ids, lengths = _ids(f)
                starts = np.cumsum(lengths) - lengths
                yield pd.DataFrame({"row": f["row"], "doc_id": f["doc_id"].astype("Int64"), "k": f["k"],
                                    "known": f["known"], "base": f["base"], "score": f["score"] + np.add.reduceat(
                                        _score(model, ids, lengths), starts, dtype=float)})
    return run


def _score(model: Gru, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of each id; the state is carried from window to window through whole texts."""
    lanes = min(LANES, len(lengths))
    place, starts, used = laid_out(lengths, lanes)
    seq, first = np.empty_like(ids), np.zeros(len(ids), bool)
    seq[place] = ids
    first[place[np.cumsum(lengths) - lengths]] = True
    state = np.zeros((lanes, model.h), np.float32)
    out = np.empty(len(ids), np.float32)
    for lo in range(0, int(used[0]), WINDOW):
        n = np.searchsorted(-used, -lo)  # lanes that go on
        step = lo + np.arange(min(WINDOW, used[0] - lo))[:, None]
        inside, at = step < used[:n], np.minimum(starts[:n] + step, len(ids) - 1)
        part = seq[at]
        states, state, _ = model.run(part, first[at], state[:n])
        out[at[inside]] = model.log_probs(states[inside], part[inside])
    return out[place] / np.float32(np.log(10))


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for ``doc_id, text``.

    Counts and the network cover all training documents (crc32 of the id modulo
    10 is not 0); held-out ones teach nothing. The model's probability of a listed word is
    P(class) * P(word | class, state); another word is in a class by its hash,
    with its smoothed share of that class's tokens. Null text is empty and is
    scored as its end token. A null id has no crc32 and counts as training data;
    repeated rows count and are scored as often as they come; an empty table
    gives an empty result; other columns are ignored. Words go by 64-bit hashes.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    seen = rows.filter(~held)
    counts = materialize(seen.select("text").mapInPandas(_count, "h long, c long").groupBy("h").agg(
        F.sum("c").alias("c")), "word-counts")
    vocab = fit_vocabulary(counts, TABLE_WORDS)
    encoded = encode(rows, vocab)
    texts = encoded.filter("is_doc")
    model = train(texts.filter(~held), vocab)
    shared = spark.sparkContext.broadcast((vocab, model.flat()))
    scored = materialize(texts.select("row", "doc_id", "k", "known", "base", "score", "ids").mapInPandas(
        _scorer(shared), "row long, doc_id long, k long, known long, base double, score double"), "scored")
    tail = encoded.filter(~F.col("is_doc")).select("row", "h", "k").join(counts, "h", "left").withColumn(
        "c", F.coalesce("c", F.lit(0)))
    tail = tail.mapInPandas(_tail(shared), "row long, known long, base double, score double").groupBy("row").agg(
        F.sum("known").alias("tk"), F.sum("base").alias("tb"), F.sum("score").alias("ts"))
    whole = scored.join(tail, "row", "left")
    return whole.select(
        "doc_id", held.alias("held_out"), F.col("k").alias("n_tokens"),
        (F.col("known") + F.coalesce("tk", F.lit(0))).alias("n_known"), F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tb", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("ts", F.lit(0.0))).alias("score"))


def _tail(shared):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab, _ = shared.value
        for f in frames:
            c, k = f["c"].to_numpy(np.int64), f["k"].to_numpy(np.int64)
            cls = _unlisted(f["h"].to_numpy(np.int64))
            yield pd.DataFrame({"row": f["row"], "known": k * (c > 0), "base": k * vocab.base_log10(c),
                                "score": k * vocab.unlisted_log10(c, cls)})
    return run
