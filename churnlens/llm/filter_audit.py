"""What filters remove in every order: survivors, removals, redundancies, label losses, Shapley shares.

Each filter has a stored table of the ids that fail it. The documents walk
through the filters once: at each one a left-semi join with its table takes the
documents removed and a left-anti join the survivors, from all prefixes at once,
as every row carries the set of filters that has taken it so far. The sets are
disjoint, so any order's prefix is made of them: its survivors are the rows of
sets that share no filter with it, a step's removals those whose set also holds
the step's filter, its redundancies the other rows whose set holds it. Two more
left-semi joins with the labelled ids count the losses. Five filters need ten
joins of narrow rows for all 120 orders.

A row's identity is its id and the digest of its text, since no filter looks at
more; rows that repeat both are one row with a count, so neither they nor a hot
text meet in one task. Null texts are empty, null languages the part ``''``. A
null id fails no comparison of ids and has no label. Labels that repeat an id
count once. Empty tables give no rows, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.checkpoint import materialize
from ..operators.joins import attach_by_key
from .common import text_of

SPACES = "\t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The filter that looks at other rows: the text of a smaller id.
EARLIER = "E"


def text_filters() -> dict[str, Column]:
    """Failure conditions on ``text``, ``n_words`` and ``n_distinct``."""
    n_chars = F.length("text")
    capitals = n_chars - F.length(F.translate("text", CAPITALS, ""))
    return {"A": F.col("n_words") < 200,
            "B": F.col("n_distinct") * 100 < F.col("n_words") * 50,
            "C": capitals * 100 > n_chars * 3,
            "D": F.col("text").rlike("[#$%&*|]")}


def failing_rows(docs: DataFrame, filters: Mapping[str, Column] | None = None) -> DataFrame:
    """One written row per document: doc_id, part, digest of the text, and a boolean per filter, ``E`` included.

    Equal texts meet as digests, combined before the shuffle; only groups with
    more than one id are joined back, by size or salted.
    """
    words = F.array_remove(F.split(F.translate("text", SPACES, " " * len(SPACES)), " "), "")
    rows = (docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                        text_of().alias("text"))
            .withColumn("words", words)
            .select("doc_id", "part", "text", F.size("words").alias("n_words"),
                    F.size(F.array_distinct("words")).alias("n_distinct")))
    filters = text_filters() if filters is None else filters
    rows = materialize(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                                   *[c.alias(name) for name, c in filters.items()]), "audit-rows")
    groups = (rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
                                         F.count(F.lit(1)).alias("_n"))
              .filter("first_id < last_id").drop("last_id"))
    copied = attach_by_key(rows, groups, "digest", "_n", name="audit-copies")
    earlier = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return materialize(copied.select("doc_id", "part", "digest", *filters, earlier.alias(EARLIER)), "audit-fails")


def store_id_tables(rows: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """A stored table (doc_id, digest) per filter, of the documents that fail it."""
    return {f: materialize(rows.filter(F.col(f)).select("doc_id", "digest").distinct(), f"audit-ids-{f}")
            for f in names}


def walk(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (doc_id, digest, part, n, failed): ``failed`` has bit k if the k-th table holds the document."""
    at = (rows.groupBy("doc_id", "digest", "part").agg(F.count(F.lit(1)).alias("n"))
          .withColumn("failed", F.lit(0)))
    for k, ids in enumerate(tables.values()):
        on = at["doc_id"].eqNullSafe(ids["doc_id"]) & (at["digest"] == ids["digest"])
        removed = at.join(ids, on, "left_semi").withColumn("failed", F.col("failed") + (1 << k))
        survivors = at.join(ids, on, "left_anti")
        at = materialize(removed.unionByName(survivors), f"audit-walk-{k}")
    return at


def cells(walked: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones per (part, failed): at most 2^filters rows a part."""

    def labelled(name: str) -> DataFrame:
        ids = labels.filter(F.col(name) == 1).select("doc_id").distinct()
        return walked.join(ids, "doc_id", "left_semi")

    names = ("n", "good", "toxic")
    found = [walked, labelled("quality"), labelled("toxic")]
    rows = [df.groupBy("part", "failed").agg(F.sum("n").alias("n"))
            .select("part", "failed", *[(F.col("n") if i == k else F.lit(0)).alias(c) for i, c in enumerate(names)])
            for k, df in enumerate(found)]
    return (rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("part", "failed")
            .agg(*[F.sum(c).cast("long").alias(c) for c in names]))


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per (part, order of the filters, step): what the step's filter does after those before it."""
    filters = text_filters() if filters is None else filters
    names = [*filters, EARLIER]
    rows = failing_rows(docs, filters)
    return orders_report(cells(walk(rows, store_id_tables(rows, names)), labels), names)


def orders_report(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """The report of all orders from ``cells``: sums over a part's cells, then one row per order and step."""
    spark, k = found.sparkSession, len(names)
    pairs = [(s, f) for f in range(k) for s in range(1 << k) if not s >> f & 1]
    pair = F.explode(F.array(*[F.struct(F.lit(s).alias("before"), F.lit(f).alias("f"), F.lit(1 << f).alias("bit"))
                            for s, f in pairs]))
    at = found.select("*", pair.alias("pair")).select("part", "failed", "n", "good", "toxic", "pair.*")
    taken = F.col("failed").bitwiseAND(F.col("before")) != 0
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0

    def total(what: str, when: Column, name: str) -> Column:
        return F.sum(F.when(when, F.col(what)).otherwise(0)).alias(name)

    sums = at.groupBy("part", "before", "f").agg(
        total("n", ~taken & ~fails, "kept"), total("n", ~taken & fails, "removed"), total("n", taken & fails, "redundant"),
        total("n", F.col("failed") == F.col("bit"), "unique_fails"), total("good", ~taken & fails, "good_lost"),
        total("toxic", ~taken & fails, "toxic_lost"))
    # Of the orders, those that have the filters of ``before`` ahead of f.
    ways = {s: factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()) for s, _ in pairs}
    steps = [("".join(names[f] for f in order), i + 1, sum(1 << f for f in order[:i]), order[i],
              ways[sum(1 << f for f in order[:i])])
             for order in permutations(range(k)) for i in range(k)]
    rows = ", ".join(f"('{order}', {step}, {before}, {f}, {n}L)" for order, step, before, f, n in steps)
    grid = spark.sql(f"SELECT * FROM VALUES {rows} AS t(filter_order, step, before, f, ways)")
    per_pair = grid.select("before", "f", "ways").distinct()
    shares = (sums.join(F.broadcast(per_pair), ["before", "f"])  # k * 2^(k-1) rows
              .groupBy("part", "f").agg(F.sum(F.col("removed") * F.col("ways")).alias("shapley")))
    out = sums.join(shares, ["part", "f"]).join(F.broadcast(grid.drop("ways")), ["before", "f"])  # k * k! rows
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                      "toxic_lost", "shapley")
