"""Sharding: global byte-size prefix sums cut at equal targets (operator 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_totals, text_of, without

#: Fixed overhead of a stored document, added to its UTF-8 bytes.
ROW_BYTES = 8


def balanced_shards(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id",
                    text_col: str = "text", whole_share: float = 0.02,
                    carry: list[str] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and the ``carry`` columns.

    Documents are ordered by (text digest, id), so equal texts are neighbours;
    sizes are prefix-summed and the order is cut at ``n_shards`` equal byte
    targets into contiguous shards. A cut that falls into a group of equal
    texts moves to the group's nearer end when the group holds at most
    ``whole_share`` of a shard's target; a larger group (it may hold a third of
    all rows) is cut at the nearer end of the row there. So a shard differs
    from the target by at most ``whole_share`` of it or by one row.

    A null text has no bytes and the crc32 of nothing (0); it is ordered and
    placed as the empty text. A null id is a value like others and sorts first;
    repeated rows are rows of their own with slots of their own. An empty table
    gives an empty result. Columns that are not named are ignored; a carried
    column that clashes with an output column is dropped.
    """
    text = text_of(text_col)
    extra = without(docs.select(*(carry or [])), ["doc_id", "size", "text_crc32", "law", "shard", "slot",
                                                  "grown_shard", "_group", "_part", "before", "rank"])
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.md5(text.cast("binary")).alias("_group"), *[F.col(f"`{c}`") for c in extra.columns])
    run = running_totals(rows, ["_group", "doc_id"], "size")
    cuts = _cuts(run, n_shards, whole_share)
    shard = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]),
                            lambda c: c <= F.col("before"))) if cuts else F.lit(0)
    placed = run.withColumn("shard", shard.cast("int"))
    first = placed.groupBy("shard").agg(F.min("rank").alias("_first"))  # at most n_shards rows
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("rank") - F.col("_first")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), *[F.col(f"`{c}`") for c in extra.columns]))


def _cuts(run: DataFrame, n_shards: int, whole_share: float) -> list[int]:
    """Byte positions of the ``n_shards - 1`` cuts; everything collected has at most that many rows."""
    total = run.agg(F.max(F.col("before") + F.col("size"))).first()[0] or 0
    if not total or n_shards < 2:
        return []
    end = F.col("before") + F.col("size")
    # The row in which cut k falls: before < k * total / n <= before + size.
    last = F.floor(end * n_shards / F.lit(total).cast("decimal(20,0)"))
    first = F.floor(F.col("before") * n_shards / F.lit(total).cast("decimal(20,0)")) + 1
    hit = (run.filter(first <= F.least(last, F.lit(n_shards - 1)))
           .select("_group", "before", end.alias("end")).collect())
    extents = {r["_group"]: (r["lo"], r["hi"]) for r in
               run.filter(F.col("_group").isin(sorted({r["_group"] for r in hit})))
               .groupBy("_group").agg(F.min("before").alias("lo"), F.max(end).alias("hi")).collect()}
    cuts = []
    for k in range(1, n_shards):
        at = next(r for r in hit if r["before"] * n_shards < k * total <= r["end"] * n_shards)
        lo, hi = extents[at["_group"]]
        if (hi - lo) * n_shards > whole_share * total:
            lo, hi = at["before"], at["end"]
        nearer = lo if k * total - lo * n_shards < hi * n_shards - k * total else hi
        cuts.append(max([nearer, *cuts[-1:]]))
    return cuts


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, **kw) -> None:
    """Write every document's columns under ``path``, one folder a shard, rows in slot order."""
    placed = balanced_shards(docs, n_shards, carry=docs.columns, **kw)
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
