"""Benchmark decontamination by template windows (operator 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.checkpoint import materialize_counted
from .common import side, text_of

# Fixed markers, put before a number, a name and a unit; a token is its marker and its own text.
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"
#: Units that count as such right after a number.
UNITS = ["km", "cm", "mm", "m", "miles", "mile", "feet", "ft", "inches", "kg", "g", "mg", "pounds", "lb", "l", "ml",
         "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day", "weeks", "years", "percent",
         "dollars", "euros", "cents", "usd", "eur"]


def slot_tokens(text: Column) -> Column:
    """Lower-case tokens; numbers, names and units keep their text behind a type marker.

    A name is a capitalised word after a lower-case letter, comma or semicolon
    and one blank, so not at the start of a sentence.
    """
    t = F.translate(text, NUMBER + NAME + UNIT, "   ")
    t = F.regexp_replace(t, r"(?<=\p{N})[.,](?=\p{N})", "_")
    t = F.regexp_replace(t, r"(?<=[\p{Ll},;] )(?=\p{Lu}\p{Ll})", NAME)
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}_])(\p{N}[\p{N}_]*)", f" {NUMBER}$1 ")
    t = F.regexp_replace(t, f"({NUMBER}[\\p{{N}}_]+ )%", f"$1{UNIT}percent ")
    t = F.regexp_replace(t, f"({NUMBER}[\\p{{N}}_]+ ) ?({'|'.join(UNITS)})(?![\\p{{L}}\\p{{N}}_])", f"$1{UNIT}$2 ")
    return F.array_remove(F.split(F.lower(t), r"[^\p{L}\p{M}\p{N}_\x01-\x03]+"), "")


def _is_slot(token: Column) -> Column:
    return token < F.lit("\x04")


def _template(token: Column) -> Column:
    return F.when(_is_slot(token), F.substring(token, 1, 1)).otherwise(token)


def _inside(text: Column) -> Column:
    """The tokens of ``text`` as they are after a lower-case word and a blank, where its first word can be a name."""
    return F.slice(slot_tokens(F.concat(F.lit("a "), F.regexp_replace(text, r"^\s+", ""))), F.lit(2), F.lit(1 << 30))


def _plain(token: Column) -> Column:
    """The hash of a token's own text, whatever its type."""
    return F.xxhash64(F.lit("="), F.ltrim(token, F.lit(NUMBER + NAME + UNIT)))


def _windows(hashes: str, width: int) -> Column:
    """Hashes of all windows of ``width`` values, hashed pairwise in as few steps as ``width`` has bits."""
    n = F.size(hashes)
    done, have, bit = None, 0, 1
    power = F.col(hashes)
    while bit <= width:
        if width & bit:
            shifted = F.slice(power, F.lit(have + 1), F.greatest(n, F.lit(1)))
            done = shifted if done is None else F.zip_with(done, shifted, lambda x, y: F.xxhash64(x, y))
            have += bit
        if 2 * bit <= width:
            power = F.zip_with(power, F.slice(power, F.lit(bit + 1), F.greatest(n, F.lit(1))),
                               lambda x, y: F.xxhash64(x, y))
        bit *= 2
    return F.slice(F.transform(done, lambda h: F.xxhash64(F.lit(width), h)), F.lit(1),
                   F.greatest(n - width + 1, F.lit(0)))


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 8, min_windows: int = 6,
               min_literals: int = 4, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False
               ) -> DataFrame:
    """``doc_id, item_id, n_windows, n_slots, exact``: documents that hold (a variant of) a benchmark item.

    Texts become templates (numbers, names and units are typed placeholders);
    all ``width``-token windows of all documents are hash-joined with those of
    the items that have ``min_literals`` plain tokens. Windows of a document and
    an item at one offset form an alignment. It is a leak when it has
    ``min_windows`` windows (or all of the item's, if those are fewer) and its
    slots are consistent: each item value stands for one document value and the
    other way round. An item shorter than ``width`` is one window of its own
    length. An item's first window also counts in the form it has inside a
    sentence, where a capitalised first word is a name. Items with at most
    ``min_windows`` template windows, so none to spare, are found by their exact
    tokens too, whatever the tokens' types: all of the item's windows at one
    offset. Null texts are empty and match nothing; an item of under
    ``min_literals`` tokens has no window. A document is an id and a text: rows that
    repeat an id, or lack one, with different texts are judged apart and then told under
    their id, or with ``keyed`` under (``doc_id, text_hash``). Empty tables give an empty
    result; other columns are ignored.
    """
    items = benchmark.select(F.col("item_id"), text_of("text").alias("_text")).select(
        "item_id", slot_tokens(F.col("_text")).alias("itoks"), _inside(F.col("_text")).alias("itoks2"))
    n = F.size("itoks")
    whole = F.size(F.filter(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), lambda i: F.size(F.filter(
        F.slice("itoks", i + 1, F.lit(width)), lambda t: ~_is_slot(t))) >= min_literals))
    items = items.withColumns({
        "ih": F.transform("itoks", lambda t: F.xxhash64(_template(t))),
        "ih2": F.transform("itoks2", lambda t: F.xxhash64(_template(t))),
        "eh": F.transform("itoks", _plain),
        "by_text": (n >= min_literals) & (whole <= min_windows)})
    sizes = items.filter(n > 0).select(F.least(n, F.lit(width)).alias("w"), "by_text").distinct().collect()
    shorts = sorted({r["w"] for r in sizes} - {width})  # under ``width`` values
    exacts = sorted({r["w"] for r in sizes if r["by_text"]})
    wins = None
    for w in [width, *shorts]:
        part = items if w == width else items.filter(n == w)
        for toks, hashes, by_text in [("itoks", "ih", False), ("itoks2", "ih2", False), ("itoks", "eh", True)]:
            if by_text and w not in exacts:
                continue
            one = part.filter("by_text") if by_text else part
            if hashes == "ih2":
                one = one.filter(F.size("itoks2") == n).filter(F.get("itoks", F.lit(0)) != F.get("itoks2", F.lit(0)))
            one = one.select("item_id", F.lit(w).alias("w"), F.lit(by_text).alias("by_text"), F.lit(
                hashes == "ih2").alias("second"), "itoks", toks if toks != "itoks" else F.col(toks).alias("itoks2"),
                F.posexplode(_windows(hashes, w)).alias("ipos", "h"))
            wins = one if wins is None else wins.unionByName(one)
    wins = wins.filter(~F.col("second") | (F.col("ipos") == 0))
    wins = wins.withColumn("islots", F.slice("itoks2", F.col("ipos") + 1, F.col("w")))
    # A whole item of its own is judged by the form that matches; else a first window by its plain form.
    judged = F.when(F.col("w") < width, F.col("islots")).otherwise(F.slice("itoks", F.col("ipos") + 1, F.col("w")))
    literal = F.size(F.filter(judged, lambda t: ~_is_slot(t)))
    wins = wins.filter(F.col("by_text") | (literal >= min_literals)).withColumn(
        "islots", F.when(F.col("by_text"), F.array().cast("array<string>")).otherwise(F.col("islots")))
    wins, n_wins = materialize_counted(wins.drop("itoks", "itoks2", "second"), "benchmark-windows")
    need = wins.groupBy("item_id", "by_text").agg(F.least(F.when(~F.col("by_text"), min_windows), F.countDistinct(
        "ipos")).alias("need"))

    # Inside, a document's name is its id with its text's hash.
    text = text_of(text_col)
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h")).alias("doc_id"), text.alias("_text"))
    found = (rows.withColumn("toks", slot_tokens(F.col("_text")))
             .withColumn("th", F.transform("toks", lambda t: F.xxhash64(_template(t)))))
    if exacts:
        found = found.withColumn("eh", F.transform("toks", _plain))
    wins_of = F.concat(*[F.transform(_windows("th", w), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
                         for w in [width, *shorts]],
                       *[F.transform(_windows("eh", w), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
                         for w in exacts])
    # Nothing but the id goes along with the windows.
    flat = found.select("doc_id", F.explode(wins_of).alias("x")).select(
        "doc_id", F.col("x.h").alias("h"), F.col("x.i").alias("dpos"))
    met = flat.join(side(wins, n_wins, 40 + 16 * width), "h")
    met, n_met = materialize_counted(met.select("doc_id", "item_id", "by_text", "dpos", "ipos", "w", "islots", (
        F.col("dpos") - F.col("ipos")).alias("shift")), "template-matches")
    # Only documents that meet a window with slots are read again, for their values.
    slotted = met.filter(F.exists("islots", _is_slot))
    ids = slotted.select(F.col("doc_id").alias("_id")).distinct()
    values = (rows.join(side(ids, n_met, 32), F.col("doc_id").eqNullSafe(F.col("_id")))
              .groupBy("_id").agg(F.first("_text").alias("_text"))  # rows that repeat both hold one text
              .select("_id", slot_tokens(F.col("_text")).alias("toks")))
    slotted = slotted.join(values, F.col("doc_id").eqNullSafe(F.col("_id"))).withColumn(
        "dslots", F.slice("toks", F.col("dpos") + 1, F.col("w"))).drop("toks", "_id")
    pair = F.filter(F.zip_with("islots", "dslots", lambda a, b: F.when(_is_slot(a), F.struct(
        a.alias("a"), b.alias("b")))), lambda p: p.isNotNull())
    slotted = slotted.withColumn("pairs", pair)
    key = ["doc_id", "item_id", "by_text", "shift"]
    alignments = met.groupBy(*key).agg(F.countDistinct("ipos").alias("n"))
    slots = (slotted.select(*key, F.explode("pairs").alias("p")).select(*key, "p.a", "p.b").distinct()
             .groupBy(*key).agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("a").alias("na"),
                                F.countDistinct("b").alias("nb"),
                                F.min((F.col("a") == F.col("b")).cast("int")).alias("same")))
    slots = slots.withColumnsRenamed({k: f"_{k}" for k in key})
    both = alignments.join(slots, F.col("doc_id").eqNullSafe(F.col("_doc_id"))
                           & F.col("item_id").eqNullSafe(F.col("_item_id"))
                           & (F.col("by_text") == F.col("_by_text")) & (F.col("shift") == F.col("_shift")), "left")
    consistent = F.col("pairs").isNull() | ((F.col("pairs") == F.col("na")) & (F.col("pairs") == F.col("nb")))
    need = need.withColumnsRenamed({"item_id": "_item", "by_text": "_kind"})
    both = both.join(side(need, n_wins, 24), F.col("item_id").eqNullSafe(F.col("_item"))
                     & (F.col("by_text") == F.col("_kind")))
    names = [F.col("doc_id.id").alias("doc_id"), *([F.col("doc_id.h").alias("text_hash")] if keyed else [])]
    return (both.filter((F.col("n") >= F.col("need")) & consistent)
            .select(*names, "item_id", "n", "pairs", "same")
            .groupBy("doc_id", *(["text_hash"] if keyed else []), "item_id").agg(
                F.max("n").cast("long").alias("n_windows"),
                F.max(F.coalesce("pairs", F.lit(0))).cast("long").alias("n_slots"),
                (F.max(F.coalesce("same", F.lit(1))) == 1).alias("exact")))


def drop_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold a benchmark item.

    With ``keyed`` leaks a row goes if its id and text do; else all rows of its id go.
    """
    names = [c for c in ("doc_id", "text_hash") if c in leaks.columns]
    ids, n = materialize_counted(leaks.select(*[F.col(c).alias(f"_{c}") for c in names]).distinct(), "leaks")
    on = docs[id_col].eqNullSafe(F.col("_doc_id"))
    if "text_hash" in names:
        on &= F.xxhash64(text_of(text_col)) == F.col("_text_hash")
    return docs.join(side(ids, n, 32), on, "left_anti")
