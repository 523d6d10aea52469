"""Importance resampling of documents towards a target distribution.

Features are runs of 1 to ``n`` words, hashed into ``buckets``. A first pass
counts the buckets of all documents and of all target texts; a bucket's gain is
the logarithm of how much likelier the target has it. A second pass sums the
gains of each document's features. Both intern the features of a slice of texts
in an open-addressed table (``ngram_table``), which hashes each distinct one to
its bucket once. Gumbel noise from a hash of the id turns "the highest scores"
into a draw without replacement.

A null text has no feature; a null id makes its noise from the empty id and
stands first among ties. Rows that repeat an id are drawn one by one. With
empty tables all gains are 0. Long texts are read whole, one slice each.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checkpoint import materialize_observed
from . import ngram_table as nt
from .common import running_totals, text_of, without

N_WORDS = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10


def bucket_counts(texts: DataFrame, n: int = N_WORDS, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """Rows (bucket, n): features of all texts; a task sends one row a bucket that it has seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in nt.text_slices(batch.column(0)):
                spans = nt.runs_of(nt.words_of(data, offsets), n)
                table = nt.intern(spans)
                bucket = nt.buckets_of(spans, table, buckets)
                used = np.flatnonzero(bucket >= 0)
                np.add.at(total, bucket[used], table.count[used])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": seen, "n": total[seen]})

    return (texts.select(text_of(text).alias("text")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame, n: int = N_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln(share of the target / share of the documents)) of every bucket, both smoothed by one.

    The driver holds ``buckets`` numbers, however many rows there are.
    """
    have, want = np.zeros(buckets), np.zeros(buckets)
    for out, texts in ((have, docs), (want, target)):
        for r in bucket_counts(texts, n, buckets).collect():  # at most one row a bucket
            out[r["bucket"]] = r["n"]
    ratio = (want + 1) * (have.sum() + buckets) / ((have + 1) * (want.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigher(gains: np.ndarray, n: int) -> Callable:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, columns = [], [batch.column(k) for k in range(1, batch.num_columns)]
            for i, j, data, offsets in nt.text_slices(batch.column(0)):
                words = nt.words_of(data, offsets)
                spans = nt.runs_of(words, n)
                table = nt.intern(spans)
                gain = gains[nt.buckets_of(spans, table, len(gains))][table.slot]
                # whole numbers far below 2^53: the sums in doubles are exact
                counts.append([np.bincount(words.doc, minlength=j - i), np.bincount(spans.doc, minlength=j - i),
                               np.bincount(spans.doc, gain, minlength=j - i).astype(np.int64)])
            if counts:
                got = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*counts)]
                yield pa.RecordBatch.from_arrays(columns + got, batch.schema.names[1:] + ["n_words", "n_features",
                                                                                         "weight"])
    return weigh


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the seeded id's sha256."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000) * F.log(-F.log(uniform)))


def score_documents(docs: DataFrame, gains: np.ndarray, n: int = N_WORDS, seed: int = SEED,
                    carry: list[str] | None = None) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score, and the columns of ``carry`` without clashes."""
    own = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    more = without(docs.select(*[F.col(f"`{c}`") for c in carry or []]), own).columns if carry else []
    rows = docs.select(text_of().alias("_text"), "doc_id", *[F.col(f"`{c}`") for c in more])
    schema = T.StructType([*rows.schema.fields[1:], *[T.StructField(c, T.LongType())
                                                      for c in ("n_words", "n_features", "weight")]])
    return (rows.mapInArrow(_weigher(gains, n), schema)
            .withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))
            .select("doc_id", "n_words", "n_features", "weight", "score", *[F.col(f"`{c}`") for c in more]))


def ranked_documents(docs: DataFrame, target: DataFrame, n: int = N_WORDS, buckets: int = BUCKETS, seed: int = SEED,
                     percent: int = PERCENT, least_words: int = LEAST_WORDS, gains: np.ndarray | None = None
                     ) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank among the drawn (null: not drawn).

    Ranks come from a range partitioning of the narrow scored rows and one
    total a range; ties of score and id, which only repeated rows make, are
    ordered by their other columns.
    """
    gains = bucket_gains(docs, target, n, buckets) if gains is None else gains
    able = F.col("n_words") >= least_words
    scored, seen = materialize_observed(score_documents(docs, gains, n, seed), "resample-scored",
                                        able=F.count_if(able))
    draw = (seen["able"] or 0) * percent // 100
    order = scored.select("*", F.when(able, 0).otherwise(1).alias("_late"), (-F.col("score")).alias("_down"),
                          F.lit(1).alias("_one"))
    run = running_totals(order, ["_late", "_down", "doc_id", "n_features", "weight"], "_one")
    return run.select("doc_id", "n_features", "weight", "score",
                      F.when(F.col("rank") < draw, F.col("rank") + 1).alias("rank"), "n_words")


def resample(docs: DataFrame, target: DataFrame, n: int = N_WORDS, buckets: int = BUCKETS, seed: int = SEED,
             percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; texts are not shuffled.

    The rank of the last drawn row gives the lowest score and, there, the
    highest id; rows that repeat the last one come along.
    """
    gains = bucket_gains(docs, target, n, buckets)
    ranked = ranked_documents(docs, target, n, buckets, seed, percent, least_words, gains)
    last = ranked.filter("rank IS NOT NULL").orderBy(F.col("rank").desc()).limit(1).collect()
    if not last:
        return docs.limit(0)
    rows = score_documents(docs.select(F.struct("*").alias("_row"), "doc_id", "text"), gains, n, seed, ["_row"])
    tie = F.col("doc_id").isNull() | (F.col("doc_id") <= F.lit(last[0]["doc_id"]))
    drawn = (F.col("score") > last[0]["score"]) | ((F.col("score") == last[0]["score"]) & tie)
    return rows.filter((F.col("n_words") >= least_words) & drawn).select("_row.*")
