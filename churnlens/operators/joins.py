"""Left join of a per-key side table onto a large table, sized and skew-aware.

The reference joins the per-user mean back onto the events (J1). At scale
the side table has one row per user, so whether it may be broadcast depends
on the data. This helper:

1. writes the side table to the shared checkpoint folder (cuts lineage, so a
   lost executor does not rescan the source, and gives an exact row count);
2. broadcasts it when its rows are within ``Tuning.broadcast_max_rows`` and its
   measured bytes within ``Tuning.broadcast_max_bytes`` -- the large side is then
   joined map-side with no shuffle at all;
3. otherwise shuffles both sides on ``(key, salt)``. Keys whose row count
   (``weight_col``) exceeds one shuffle partition's share of all rows --
   including the null key, e.g. logged-out users -- are spread over several
   salts; their side rows are replicated once per salt. The hot-key list is
   broadcast; it has fewer rows than there are shuffle partitions. A row's salt
   is a hash of its columns, so a recomputed task gives it the same one.

Null keys never match (SQL semantics, same as the reference's ``on=`` join).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Tuning
from .checkpoint import materialize_observed

_SALT = "__salt"
_NSALT = "__nsalt"


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _row_bytes(df: DataFrame) -> Column:
    """A row's size in memory: sixteen bytes a column, and the text of strings."""
    wide = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    return sum(wide, F.lit(16 * len(df.columns)))


def attach_by_key(big: DataFrame, side: DataFrame, key: str, weight_col: str,
                  tuning: Tuning = DEFAULT, name: str = "side", path: str | None = None) -> DataFrame:
    """``big LEFT JOIN side USING (key)``; ``weight_col`` = big rows per key (dropped).

    The side table is written to ``path`` if given (the caller's to remove), else to the scratch folder.
    """
    side, seen = materialize_observed(side, name, path, rows=F.count(F.lit(1)),
                                      total=F.sum(weight_col), bytes=F.sum(_row_bytes(side)))
    value_cols = [c for c in side.columns if c not in (key, weight_col)]
    if seen["rows"] <= tuning.broadcast_max_rows and (seen["bytes"] or 0) <= tuning.broadcast_max_bytes:
        return big.join(F.broadcast(side.select(key, *value_cols)), key, "left")

    total = seen["total"] or 0
    per_task = max(1, math.ceil(total / _shuffle_partitions(big)))
    hot = (side.where(F.col(weight_col) > per_task)
               .select(F.col(key).alias("__hot_key"),
                       F.ceil(F.col(weight_col) / F.lit(per_task)).cast("int").alias(_NSALT)))
    hot = F.broadcast(hot)  # fewer than total / per_task rows: at most one per shuffle partition
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])

    tagged = (big.join(hot, big[key].eqNullSafe(hot["__hot_key"]), "left").drop("__hot_key")
                 .withColumn(_SALT, F.when(F.col(_NSALT).isNull(), F.lit(0)).otherwise(
                     F.pmod(row_hash, F.col(_NSALT))).cast("int"))
                 .drop(_NSALT))
    fanned = (side.join(hot, side[key].eqNullSafe(hot["__hot_key"]), "left").drop("__hot_key")
                  .withColumn(_SALT, F.explode(F.sequence(
                      F.lit(0), F.coalesce(F.col(_NSALT), F.lit(1)) - 1)))
                  .select(key, _SALT, *value_cols))
    return tagged.join(fanned, [key, _SALT], "left").drop(_SALT)
