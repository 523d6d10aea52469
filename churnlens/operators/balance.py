"""Class counts, balancing, splitting and folds.

Sampling and splitting use md5 hash buckets of row keys instead of
``sample``/``randomSplit``: the result is the same for any partitioning
(the reference's seeded calls change with the partition count) and the same
in a SQL engine. The per-class fractions are a three-row table joined by
broadcast, so nothing is collected to the driver and the sample is one
map-side pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, FOLD_SALT, SAMPLE_SALT, SPLIT_SALT, Tuning
from ..functions import HASH_RANGE, hash_bucket, hash_fraction_bits
from ..schema import (CLASS_CANCEL, LABEL, NUM_FOLDS, SCRIPT_BALANCE_K, SEED, TRAIN_FRACTION,
                      VALID_FRACTION_OF_REST)

# Integer/string keys that identify a wrangled training row (no doubles).
ROW_KEYS = ["userId", "gender", "itemInSession", "level", LABEL]


def where_class(df: DataFrame, k: int, label: str = LABEL) -> DataFrame:
    """P7."""
    return df.where(F.col(label) == k)


def where_level(df: DataFrame, level: str) -> DataFrame:
    """P8."""
    return df.where(F.col("level") == level)


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """A2: rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def class_size_summary(counts: DataFrame) -> DataFrame:
    """Largest, smallest and middle class size, as one row.

    ``mid_count`` is the size that is neither the largest nor the smallest
    (null with fewer than three classes), matching the reference's ordinary case.
    """
    return counts.agg(
        F.max("count").alias("max_count"), F.min("count").alias("min_count"),
        F.when(F.count(F.lit(1)) == 3, F.sum("count") - F.max("count") - F.min("count"))
         .alias("mid_count"),
        F.count(F.lit(1)).alias("n_classes"))


def balance_fractions(counts: DataFrame, k: float = SCRIPT_BALANCE_K,
                      keep_whole: int = CLASS_CANCEL, label: str = LABEL) -> DataFrame:
    """B1 + B3: per-class keep fraction ``least(1, k * min / count)``.

    The rarest label class (``keep_whole``) is kept whole; a fraction above 1
    is clamped (the scripts fall back to the whole class there). Two classes
    or tied sizes still give defined fractions.
    """
    # ``counts`` has one row per class, so a whole-table window is three rows.
    return (counts.withColumn("min_count", F.min("count").over(Window.partitionBy()))
                  .select(label, "count", "min_count",
                          F.when(F.col(label) == keep_whole, F.lit(1.0))
                           .otherwise(F.least(F.lit(1.0), F.lit(float(k)) * F.col("min_count")
                                              / F.col("count"))).alias("fraction")))


def balanced_sample(df: DataFrame, k: float = SCRIPT_BALANCE_K, keys: Sequence[str] = ROW_KEYS,
                    label: str = LABEL, method: str = "hash") -> DataFrame:
    """P7 + B2 + U1: keep each row with its class fraction.

    ``method="hash"`` keeps a row when 60 bits of its hash are below that share
    of their range -- deterministic, partition-independent, and as exact for a
    fraction of 1e-9 as for one of a half.
    ``method="random"`` reproduces the reference's seeded Bernoulli
    ``sample`` per class, unioned (partition-dependent).

    ``df`` is read twice (class counts, then the rows); pass a materialised
    table when it is expensive to compute.
    """
    fractions = balance_fractions(class_counts(df, label), k, label=label)
    if method == "random":
        rows = fractions.select(label, "fraction").collect()  # one row per class
        parts = [df.where(F.col(label) == r[label]).sample(False, min(1.0, r["fraction"]), SEED)
                 if r["fraction"] < 1.0 else df.where(F.col(label) == r[label]) for r in rows]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    threshold = fractions.select(
        label, F.floor(F.col("fraction") * F.lit(float(HASH_RANGE))).cast("long").alias("__keep_below"))
    return (df.join(F.broadcast(threshold), label)  # <= one row per class
              .where(hash_fraction_bits(list(keys), SAMPLE_SALT) < F.col("__keep_below"))
              .drop("__keep_below"))


def hash_split(df: DataFrame, keys: Sequence[str] = ROW_KEYS, tuning: Tuning = DEFAULT,
               train: float = TRAIN_FRACTION, valid_of_rest: float = VALID_FRACTION_OF_REST,
               split_by: str = "row") -> DataFrame:
    """Add ``split`` in {train, valid, test}: 70 / 15 / 15 by default.

    ``split_by="user"`` buckets on the user id alone, so one user's rows never
    land on both sides (the reference's row split allows that).
    """
    b = tuning.buckets
    train_cut = int(round(train * b))
    valid_cut = train_cut + int(round((1.0 - train) * valid_of_rest * b))
    bucket = hash_bucket(["userId"] if split_by == "user" else list(keys), SPLIT_SALT, b)
    return df.withColumn("split", F.when(bucket < train_cut, F.lit("train"))
                                   .when(bucket < valid_cut, F.lit("valid"))
                                   .otherwise(F.lit("test")))


def random_split(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """B4 as the reference wrote it: seeded ``randomSplit`` (partition-dependent)."""
    train, rest = df.randomSplit([TRAIN_FRACTION, 1 - TRAIN_FRACTION], seed=SEED)
    valid, test = rest.randomSplit([VALID_FRACTION_OF_REST, 1 - VALID_FRACTION_OF_REST], seed=SEED)
    return train, valid, test


def assign_folds(df: DataFrame, keys: Sequence[str] = ROW_KEYS, num_folds: int = NUM_FOLDS,
                 tuning: Tuning = DEFAULT) -> DataFrame:
    """Cross-validation fold column ``fold`` in ``[0, num_folds)`` (own salt)."""
    return df.withColumn("fold", (hash_bucket(list(keys), FOLD_SALT, tuning.buckets)
                                  % F.lit(num_folds)).cast("int"))
