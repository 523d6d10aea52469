"""Language identification with language-bitmask n-gram filters (operator 7)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.checkpoint import materialize
from .shingles import U, chunks, mix

GRAM = 4  # bytes of lower-cased text, runs of other than letters being one blank
HASHES = 2
#: Slots for each n-gram of the largest filter: at most a quarter of a language's bits are set.
ROOM = 8
PIECE_BITS = 16  # slots of one piece of the bit arrays, as they come from a task
_CLASS = np.full(256, 0x20, np.uint8)
for _c in range(256):
    if chr(_c).isalpha() and _c < 128 or _c >= 128:
        _CLASS[_c] = ord(chr(_c).lower()) if _c < 128 else _c


@dataclass
class Filters:
    """``slots`` has one bitmask of languages (a word per 64) for each slot."""
    langs: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    usual: int


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of all texts as integers, and how many each text has."""
    buf = _CLASS[np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)]
    doc = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    blank = buf == 0x20
    keep = np.ones(len(buf), bool)
    keep[1:] = ~(blank[1:] & blank[:-1]) | (doc[1:] != doc[:-1])
    buf, doc = buf[keep].astype(np.uint32), doc[keep]
    n = len(buf) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    g = np.zeros(n, np.uint32)
    for j in range(GRAM):
        g = (g << np.uint32(8)) | buf[j:n + j]
    whole = doc[:n] == doc[GRAM - 1:]
    return g[whole], np.bincount(doc[:n][whole], minlength=len(texts))


def _encoded(column: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in column]


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """n-gram counts of each batch by language."""
    for f in frames:
        for lang, part in f.groupby("lang"):
            texts, found, times = _encoded(part["text"]), [], []
            for lo, hi in chunks(texts):
                g, c = np.unique(grams(texts[lo:hi])[0], return_counts=True)
                found.append(g)
                times.append(c)
            if found:
                g, at = np.unique(np.concatenate(found), return_inverse=True)
                yield pd.DataFrame({"lang": lang, "gram": g.astype(np.int64),
                                    "n": np.bincount(at, np.concatenate(times)).astype(np.int64)})


def _slots(g: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(g.astype(U) + U(0x51ED270B))
    return [((h >> U(32 * i)) & U((1 << bits) - 1)).astype(np.int64) for i in range(HASHES)]


def gram_counts(train: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all texts of ``train`` (``text, lang``); rows without either teach nothing."""
    rows = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def members(counts: DataFrame, min_share: float, min_ratio: float) -> DataFrame:
    """The rows of ``counts`` whose n-gram is in its language's filter.

    Its share of the language's n-grams is at least ``min_share``, and at least
    ``min_ratio`` of its share in the language where it is most frequent: a
    foreign word quoted in a text puts its n-grams in no filter of the quoting
    language. The window meets at most one row a language.
    """
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    top = F.max("share").over(Window.partitionBy("gram"))
    return (counts.join(F.broadcast(totals), "lang")  # one row a language, as the model has
            .withColumn("share", share).withColumn("top", top)
            .filter((F.col("share") >= min_share) & (F.col("share") >= min_ratio * F.col("top")))
            .select("lang", "gram", "n"))


def _bit_arrays(chosen: DataFrame, langs: list[str], bits: int) -> np.ndarray:
    """The slots' bitmasks, set in tasks, combined by an aggregation, gathered as pieces of 2 ** PIECE_BITS slots."""
    def bits_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            i = f["id"].to_numpy()
            mask = (U(1) << (i % 64).astype(U)).view(np.int64)
            for s in _slots(f["gram"].to_numpy(), bits):
                yield pd.DataFrame({"word": i // 64, "slot": s, "mask": mask})

    def piece_of(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        piece = np.zeros(1 << PIECE_BITS, np.int64)
        piece[f["slot"].to_numpy() & ((1 << PIECE_BITS) - 1)] = f["mask"].to_numpy()
        return pd.DataFrame({"word": [key[0]], "piece": [key[1]], "masks": [piece.tobytes()]})

    place = F.array_position(F.lit(langs), F.col("lang")) - 1
    pieces = (chosen.select(place.cast("long").alias("id"), "gram")
              .mapInPandas(bits_of, "word long, slot long, mask long")
              .groupBy("word", "slot").agg(F.bit_or("mask").alias("mask"))
              .groupBy("word", F.shiftright("slot", PIECE_BITS).alias("piece"))
              .applyInPandas(piece_of, "word long, piece long, masks binary"))
    slots = np.zeros((1 << bits, max(1, -(-len(langs) // 64))), U)
    for r in pieces.toLocalIterator():  # a piece at a time: 8 bytes a slot for each 64 languages
        at = r["piece"] << PIECE_BITS
        masks = np.frombuffer(r["masks"], U)[:(1 << bits) - at]
        slots[at:at + len(masks), r["word"]] = masks
    return slots


def fit(train: DataFrame, min_share: float = 1e-6, min_ratio: float = 0.1) -> Filters:
    """Filters of each language's n-grams over all training texts (``text, lang``).

    Counts cover every text, and every n-gram is in a filter but for those rarer
    than one in ``1 / min_share`` of its language, or than ``min_ratio`` of
    its share elsewhere (``members``). So a language has at most
    ``1 / min_share`` n-grams whatever the corpus, which bounds the model: the slots are
    sized from the measured count of the largest filter. Rows without
    text or language teach nothing.
    """
    chosen = materialize(members(materialize(gram_counts(train), "gram-counts"), min_share, min_ratio), "gram-filters")
    sizes = sorted(chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("grams"), F.sum("n").alias("seen")).collect())
    langs = [r["lang"] for r in sizes]  # one row a language
    if not langs:
        return Filters([], np.zeros((1, 1), U), np.zeros(0), -1)
    bits = max(PIECE_BITS, int(ROOM * max(r["grams"] for r in sizes) - 1).bit_length())
    slots = _bit_arrays(chosen, langs, bits)
    fill = np.array([((slots[:, i // 64] >> U(i % 64)) & U(1)).mean() for i in range(len(langs))])
    return Filters(langs, slots, fill ** HASHES, int(np.argmax([r["seen"] for r in sizes])))


def _has_letter(text) -> bool:
    return isinstance(text, str) and (re.search("[A-Za-z]", text) is not None or any(c.isalpha() for c in text))


def _classify(texts: list[bytes], model: Filters) -> tuple[np.ndarray, np.ndarray]:
    """Best language index and its share, from popcounts corrected for false positives."""
    g, n = grams(texts)
    first, second = _slots(g, len(model.slots).bit_length() - 1)
    masks = model.slots[first] & model.slots[second]
    doc = np.repeat(np.arange(len(texts)), n)
    hits = np.stack([np.bincount(doc, ((masks[:, i // 64] >> U(i % 64)) & U(1)).astype(float), len(texts))
                     for i in range(len(model.langs))], 1)
    true = np.maximum((hits - n[:, None] * model.false_rate) / (1 - model.false_rate), 0)
    best = true.argmax(1)
    total = true.sum(1)
    best[total == 0] = model.usual
    return best, np.where(total > 0, true.max(1) / np.maximum(total, 1e-300), 0.0)


def predict(docs: DataFrame, model: Filters) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; only ``text`` is looked at.

    Null text and text without a letter give ``und`` and 0; text whose n-grams
    are in no filter gives the language seen most in training, with score 0;
    with no training rows at all, everything is ``und``. Ties go to the
    language that is first in code point order. Repeated rows are treated
    alike; columns that clash with the two new ones are replaced.
    """
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # slots bounded by min_share, see fit
    at = keep.index("text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for f in frames:
            column = f.iloc[:, at]
            texts = _encoded(column)
            pred = np.array(["und"] * len(f), object)
            score = np.zeros(len(f))
            if m.langs:
                for lo, hi in chunks(texts):
                    best, share = _classify(texts[lo:hi], m)
                    pred[lo:hi] = np.array(m.langs, object)[best]
                    score[lo:hi] = share
                for i, t in enumerate(column):
                    if not _has_letter(t):
                        pred[i], score[i] = "und", 0.0
            yield f.assign(lang_pred=pred, score=score)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return rows.mapInPandas(run, schema)
