"""Exactly so many rows of each class, without sorting the classes (B1, B2).

A class keeps the rows with the smallest hashes. The last hash that is kept is
found by a search on histograms: a pass counts the rows of each class per
cell of the next ``CELL_BITS`` bits of their hash, and the cell in which the
wanted number is reached is cut finer by the next pass. A pass shuffles
counts, at most ``2 ** CELL_BITS`` a class and task. Rows that share the very last
hash are ordered by all their columns, so the sample is the same for any
partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, SAMPLE_SALT, Tuning
from ..functions import HASH_RANGE, hash_fraction_bits
from ..schema import CLASS_CANCEL, LABEL, SCRIPT_BALANCE_K
from .balance import ROW_KEYS, class_counts
from .checkpoint import materialize
from .sequence import row_number_within

HASH_BITS = HASH_RANGE.bit_length() - 1
CELL_BITS = 15  # divides HASH_BITS


def exact_sizes(counts: DataFrame, k: float = SCRIPT_BALANCE_K, keep_whole: int = CLASS_CANCEL,
                label: str = LABEL) -> DataFrame:
    """``(label, n_keep)`` from class counts: all of ``keep_whole``, of others at most ``k`` times the smallest class."""
    smallest = F.min("count").over(Window.partitionBy())  # one row per class
    wanted = F.when(F.col(label).eqNullSafe(F.lit(keep_whole)), F.col("count")).otherwise(
        F.least(F.col("count"), F.floor(F.lit(float(k)) * smallest).cast("long")))
    return counts.select(label, wanted.alias("n_keep"))


def _table(df: DataFrame, label: str, rows: list[dict]) -> DataFrame:
    """One row per class, as an inline table; values are longs."""
    kind = df.schema[label].dataType
    structs = [F.struct(F.lit(r["label"]).cast(kind).alias("__label"), *[
        F.lit(v).cast("long").alias(k) for k, v in r.items() if k != "label"]) for r in rows]
    return F.broadcast(df.sparkSession.range(1).select(F.inline(F.array(*structs))))


def _cut(hashes: DataFrame, label: str, state: list[dict], left: int) -> list[dict]:
    """For each class of ``state``, the cell of the next bits that reaches ``need``: ``cell, n, before``."""
    open_ = _table(hashes, label, state)
    inside = hashes.join(open_, hashes[label].eqNullSafe(open_["__label"])
                         & (F.shiftright(hashes["__h"], left) == open_["prefix"]))
    cell = F.shiftright("__h", left - CELL_BITS).bitwiseAND(F.lit((1 << CELL_BITS) - 1)).alias("cell")
    cells = inside.groupBy("__label", "need", cell).agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("__label").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return (cells.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
            .where((F.col("before") < F.col("need")) & (F.col("before") + F.col("n") >= F.col("need")))
            .collect())  # one row per class


def thresholds(hashes: DataFrame, sizes: DataFrame, label: str = LABEL) -> list[dict]:
    """Per class: keep hashes below ``below``, and ``ties`` rows of those at ``below``.

    ``hashes`` has the label and ``__h``, ``sizes`` the label and ``n_keep``, one row per class.
    """
    counts = {r[label]: r["count"] for r in class_counts(hashes, label).collect()}
    out, state = [], []
    for r in sizes.collect():
        n, need = counts.get(r[label], 0), r["n_keep"] or 0
        if need >= n or need <= 0:
            out.append({"label": r[label], "below": HASH_RANGE if need > 0 else 0, "ties": 0})
        else:
            state.append({"label": r[label], "prefix": 0, "need": need})
    left = HASH_BITS
    while state:
        prefix = {s["label"]: s["prefix"] for s in state}
        found, state = _cut(hashes, label, state, left), []
        left -= CELL_BITS
        for r in found:
            name = r["__label"]
            p, need = (prefix[name] << CELL_BITS) | r["cell"], r["need"] - r["before"]
            if need == r["n"]:
                out.append({"label": name, "below": (p + 1) << left, "ties": 0})
            elif left == 0:
                out.append({"label": name, "below": p, "ties": need})
            else:
                state.append({"label": name, "prefix": p, "need": need})
    return out


def exact_class_sample(df: DataFrame, sizes: DataFrame, keys: Sequence[str] = ROW_KEYS, label: str = LABEL,
                       tuning: Tuning = DEFAULT) -> DataFrame:
    """The ``n_keep`` rows of each class with the smallest hashes of ``keys``; all of a smaller class.

    A class that ``sizes`` does not name, or names with null or nothing to
    keep, gives no row; a null label is a class like others. Repeated rows
    count as so many rows. ``df`` is read twice: pass a materialised table when
    it is expensive to compute.
    """
    h = hash_fraction_bits(list(keys), SAMPLE_SALT)
    hashes = materialize(df.select(label, h.alias("__h")), "class-hashes")
    found = thresholds(hashes, sizes, label)
    if not found:
        return df.limit(0)
    cut = _table(df, label, found)
    rows = df.withColumn("__h", h)
    rows = rows.join(cut, rows[label].eqNullSafe(cut["__label"])).drop("__label")
    parts = [rows.where(F.col("__h") < F.col("below")).select(*df.columns)]
    if any(r["ties"] for r in found):
        tied = rows.where((F.col("__h") == F.col("below")) & (F.col("ties") > 0)).drop("__h", "below")
        rest = [c for c in df.columns if c != label]
        numbered = row_number_within(tied, [label], rest, "__at", tuning)
        parts.append(numbered.where(F.col("__at") < F.col("ties")).select(*df.columns))
    return reduce(DataFrame.unionByName, parts)


def exact_balanced_sample(df: DataFrame, k: float = SCRIPT_BALANCE_K, keys: Sequence[str] = ROW_KEYS,
                          label: str = LABEL, tuning: Tuning = DEFAULT) -> DataFrame:
    """``balanced_sample`` with its class sizes met exactly."""
    return exact_class_sample(df, exact_sizes(class_counts(df, label), k, label=label), keys, label, tuning)
