"""Mixing sources to target weights: temperature mixing (operator 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.checkpoint import materialize, materialize_counted
from ..operators.sequence import row_number_within
from .common import running_totals, side, text_of, words_of

#: Exponents are multiples of 1 / GRID, up to MAX_EXPONENT.
GRID, MAX_EXPONENT = 1_000_000, 8


def shuffled(*parts: Column) -> Column:
    """A permutation key: the digest of the parts as text, null as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def find_exponent(totals: DataFrame, budget: int, entropy_share: float, max_epochs: float,
                  sections: int = 64) -> float:
    """The smallest exponent that keeps to both limits, to 1 / GRID.

    ``totals`` has one row per source with its ``total`` tokens. Entropy and the
    largest repetition both fall as the exponent grows, so the interval is
    narrowed as in bisection, six halvings a pass: each pass evaluates
    ``sections - 1`` exponents as grouped sums and returns one row. If no
    exponent keeps to them, the largest is taken.
    """
    m = totals.agg(F.sum("total").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not m["n"]:
        return 1.0
    all_tokens, n = int(m["t"]), int(m["n"])
    target = F.log(F.lit(float(n))) * F.lit(entropy_share)
    p = totals.select((F.col("total") / F.lit(float(all_tokens))).alias("p"))
    lo, hi = -1, MAX_EXPONENT * GRID  # fails at lo (or is under 0); hi is the answer so far
    while hi - lo > 1:
        points = sorted({lo + (hi - lo) * i // sections for i in range(1, sections)} - {lo, hi})
        e = F.col("k") / F.lit(float(GRID))
        sums = (p.select("p", F.explode(F.array(*[F.lit(k) for k in points])).alias("k"))
                .groupBy("k").agg(F.sum(F.pow("p", e)).alias("z"),
                                  F.sum(F.pow("p", e) * F.log("p")).alias("a"), F.min("p").alias("least")))
        entropy = F.log("z") - e * F.col("a") / F.col("z")
        repeats = F.pow("least", e - 1) / F.col("z") * F.lit(budget / all_tokens)
        good = sums.filter((entropy <= target) & (repeats <= F.lit(max_epochs))).agg(F.min("k")).first()[0]
        if good is None:
            lo = points[-1]
        else:
            hi = good
            lo = max([lo, *[k for k in points if k < good]])
    return hi / GRID


def mix_plan(docs: DataFrame, budget_share: float = 1.0, entropy_share: float = 0.95, max_epochs: float = 4.0,
             block_tokens: int = 1 << 18, seed: int = 1, id_col: str = "doc_id",
             source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``doc_id, source, tokens, epoch, block, slot``: one row for each time a document is drawn.

    Sources get weights proportional to (token share) ** exponent; the exponent
    is the smallest at which the weights' entropy is at most ``entropy_share``
    of the largest possible and no source comes more than ``max_epochs`` times.
    A source's quota is its weight of ``budget_share`` times all tokens. It is
    filled epoch by epoch, each a fresh permutation of the whole source, until
    the document at which the quota is reached. The stream is cut into blocks
    of about ``block_tokens``; every source spreads its quota evenly over all
    blocks, so each block has the target weights, and each block is permuted.

    Tokens are the words of the text and one end token; a null text has the end token alone.
    A null source is a source, a null id a value like others. Rows that repeat
    (source, id) are drawn as rows of their own. Prefix sums run over ranges of
    (source, epoch, key), so a source with a third of all rows is spread over
    many tasks. Empty tables give an empty plan; other columns are ignored.
    """
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        (F.size(words_of(text_of(text_col))) + 1).cast("long").alias("tokens")), "sized")
    totals, n_sources = materialize_counted(
        rows.groupBy("source").agg(F.sum("tokens").alias("total")), "sources")
    all_tokens = int(totals.agg(F.sum("total")).first()[0] or 0)
    budget = int(all_tokens * budget_share)
    exponent = find_exponent(totals, budget, entropy_share, max_epochs)
    weight = F.pow(F.col("total") / F.lit(float(max(all_tokens, 1))), F.lit(exponent))
    z = totals.agg(F.sum(weight)).first()[0] or 1.0
    quotas = totals.select(F.col("source").alias("_source"), "total",
                           F.floor(F.lit(float(budget)) * (weight / F.lit(z))).cast("long").alias("quota"))
    drawn = (rows.join(side(quotas, n_sources, 64), F.col("source").eqNullSafe(F.col("_source")))
             .filter(F.col("quota") > 0)
             .withColumn("epoch", F.explode(F.sequence(
                 F.lit(0), F.ceil(F.col("quota") / F.col("total")).cast("int") - 1))))
    drawn = drawn.select("doc_id", "source", "tokens", "epoch", "quota",
                         shuffled(F.lit(seed), F.col("epoch"), F.col("doc_id")).alias("_key"))
    run = running_totals(drawn, ["source", "epoch", "_key", "doc_id"], "tokens")
    start = run.groupBy("source").agg(F.min("before").alias("_start")).withColumnRenamed("source", "_source")
    placed = (run.join(side(start, n_sources, 64), F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("at", F.col("before") - F.col("_start")).filter(F.col("at") < F.col("quota")))
    n_blocks = max(1, -(-budget // block_tokens))
    placed = placed.withColumn("block", F.floor(
        F.col("at").cast("decimal(20,0)") * n_blocks / F.col("quota")).cast("long"))
    order = Window.partitionBy("block").orderBy(
        shuffled(F.lit(seed), F.col("block"), F.col("epoch"), F.col("doc_id")), "source", "epoch", "at")
    return placed.select("doc_id", "source", "tokens", "epoch", "block",
                         (F.row_number().over(order) - 1).cast("long").alias("slot"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **kw) -> DataFrame:
    """``docs``, each row as often as the plan draws it.

    The n draws of a (source, id) that k rows share are divided over these
    rows: each comes n // k times, the first n % k of them (by a hash of the
    row) once more. So the rows returned are as many as the plan has. A shared
    (source, id), null ids among them, may hold any share of the rows.
    """
    plan = mix_plan(docs, id_col=id_col, source_col=source_col, **kw)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(source_col).alias("_source"), F.col(id_col).alias("_id"))
    draws = plan.groupBy(F.col("source").alias("_s"), F.col("doc_id").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    shared = rows.groupBy(F.col("_source").alias("_s2"), F.col("_id").alias("_d2")).agg(
        F.count(F.lit(1)).alias("_k")).filter("_k > 1")
    shared, n_shared = materialize_counted(shared, "shared-ids")
    draws = draws.join(side(shared, n_shared, 128), F.col("_s").eqNullSafe(F.col("_s2")) & F.col("_d").eqNullSafe(
        F.col("_d2")), "left").select("_s", "_d", "_n", F.coalesce("_k", F.lit(1)).alias("_k"))
    draws, n = materialize_counted(draws, "draws")
    met = rows.join(side(draws, n, 128), F.col("_source").eqNullSafe(F.col("_s")) & F.col("_id").eqNullSafe(F.col("_d")))
    own = met.filter("_k = 1").select("_row", F.col("_n").alias("_times"))
    if n_shared:
        repeats = met.filter("_k > 1").select("_row", "_source", "_id", "_n", "_k", F.xxhash64(
            F.to_json("_row")).alias("_hash"))
        numbered = materialize(row_number_within(repeats, ["_source", "_id"], ["_hash"], "_i"), "shared-rows")
        some = numbered.withColumn("_times", F.floor(F.col("_n") / F.col("_k")).cast("long") + F.when(
            F.col("_i") < F.pmod("_n", "_k"), F.lit(1)).otherwise(F.lit(0))).filter("_times > 0")
        own = own.unionByName(some.select("_row", "_times"))
    return own.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select("_row.*")
