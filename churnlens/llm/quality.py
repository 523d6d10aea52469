"""Quality rules: distance of a document's distributions from its language's (operator 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.checkpoint import materialize
from .common import SPACE, text_of, without, words_of

#: Character classes of the histogram.
CLASSES = ["lower", "space", "upper", "digit", "symbol", "letter", "other"]
_REST = [SPACE, "[A-Z]+", "[0-9]+", r"[#*$%&|<>]+", r"\p{L}+"]
#: One code letter per common word.
_CODES = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance",
         "word_distance", "base_failed", "kept"]


def _lang(lang_col: str) -> Column:
    return F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(""))


def reference_languages(docs: DataFrame, min_docs: int, min_share: float, text_col: str = "text",
                        lang_col: str = "lang") -> DataFrame:
    """``lang`` of the languages with enough text to be a reference: ``min_docs`` documents, ``min_share`` of all bytes.

    At most ``1 / min_share`` rows, whatever stands in the language column.
    """
    sizes = materialize(docs.groupBy(_lang(lang_col).alias("lang")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length(text_of(text_col))).alias("bytes")), "languages")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    return sizes.filter((F.col("docs") >= min_docs) & (F.col("bytes") >= min_share * total)).select("lang")


def common_words(docs: DataFrame, n_common: int = 16, text_col: str = "text", lang_col: str = "lang",
                 languages: DataFrame | None = None) -> DataFrame:
    """``lang, common, counts``: each language's most frequent words over all its documents.

    Ties come in code point order. A null language is ``''``. Words are counted
    per task before the shuffle, and only each task's best candidates of a
    language are ranked together. ``languages`` (from ``reference_languages``) limits them.
    """
    texts = docs.select(_lang(lang_col).alias("lang"), text_of(text_col).alias("t"))
    if languages is not None:
        texts = texts.join(F.broadcast(languages), "lang", "left_semi")  # at most 1 / min_share rows
    counted = (texts.select("lang", F.explode(words_of(F.col("t"))).alias("w"))
               .groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "w")
    top = (counted.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= n_common)
           .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("r", "w", "n"))).alias("t")))
    return materialize(top.select("lang", F.col("t.w").alias("common"), F.col("t.n").alias("counts")), "common-words")


def with_distance(df: DataFrame, name: str, p: Column, q: Column, when: Column) -> DataFrame:
    """Add the Jensen-Shannon distance (0..1, base-2 logarithms) of the count arrays ``p`` and ``q``.

    Null where ``when`` is false or an array holds nothing. Totals and shares
    are columns of their own, so they are computed once a row.
    """
    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))
    df = df.withColumns({"_p": p, "_q": q})
    df = df.withColumns({"_tp": total("_p"), "_tq": total("_q")})
    df = df.withColumn("_shares", F.when(when & (F.col("_tp") > 0) & (F.col("_tq") > 0), F.zip_with(
        "_p", "_q", lambda x, y: F.struct((x / F.col("_tp")).alias("a"), (y / F.col("_tq")).alias("b")))))
    js = F.aggregate("_shares", F.lit(0.0), lambda s, t: s
                     + F.when(t["a"] > 0, t["a"] * F.log2(2 * t["a"] / (t["a"] + t["b"]))).otherwise(0.0)
                     + F.when(t["b"] > 0, t["b"] * F.log2(2 * t["b"] / (t["a"] + t["b"]))).otherwise(0.0))
    # greatest() passes over a null
    return df.withColumn(name, F.when(js.isNotNull(), F.sqrt(F.greatest(js / 2, F.lit(0.0))))).drop("_p", "_q", "_tp", "_tq", "_shares")


def _hash_pairs(a: str, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def measure(docs: DataFrame, common: DataFrame, text_col: str = "text", lang_col: str = "lang",
            keep_text: bool = True) -> DataFrame:
    """``docs`` with the base counts and the histograms ``_classes`` and ``_bins``, in one pass over the text."""
    df = without(docs, ADDED)
    keep = [c for c in df.columns if keep_text or c != text_col]
    df = df.withColumn("_text", text_of(text_col)).withColumn("_lang", _lang(lang_col))
    # Lower-case letters and blanks are most of a text and come in long runs; the
    # other classes are counted in the little that is left.
    df = df.withColumns({"_blanks": F.length("_text") - F.length(F.replace("_text", F.lit(" "), F.lit(""))),
                         "_left": F.regexp_replace("_text", "[a-z ]+", "")})
    counts, left = [], "_left"
    for i, step in enumerate(_REST):
        df = df.withColumn(f"_left{i}", F.regexp_replace(left, step, ""))
        counts.append(F.length(left) - F.length(f"_left{i}"))
        left = f"_left{i}"
    space = counts[0] + F.col("_blanks")
    lower = F.length("_text") - F.length("_left") - F.col("_blanks")
    df = df.withColumn("_classes", F.array(*[c.cast("long") for c in [
        lower, space, *counts[1:], F.length(left)]]))
    df = df.withColumn("_words", words_of(F.col("_text"))).withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("_wh", F.transform("_words", lambda w: F.xxhash64(w)))
    # Five-word windows from hashes of two words, of two such pairs, and of those with the fifth word.
    n = F.size("_wh")
    df = df.withColumn("_w2", _hash_pairs("_wh", F.slice("_wh", 2, F.greatest(n, F.lit(1)))))
    df = df.withColumn("_w4", _hash_pairs("_w2", F.slice("_w2", 3, F.greatest(n, F.lit(1)))))
    df = df.withColumn("_win", F.slice(_hash_pairs("_w4", F.slice("_wh", 5, F.greatest(n, F.lit(1)))),
                                       F.lit(1), F.greatest(n - 4, F.lit(0))))
    # Positions are only sorted out where some window comes again.
    again = F.size(F.array_distinct("_win")) < F.size("_win")
    df = df.withColumn("_pairs", F.when(again, F.sort_array(F.transform(
        "_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    # Fields of an array of structs are copied out at each access, so they get columns of their own.
    df = df.withColumns({"_ph": F.transform("_pairs", lambda p: p["h"]),
                         "_pi": F.transform("_pairs", lambda p: p["i"])})
    hit = F.filter(F.transform("_pi", lambda i, k: F.when(
        (F.get("_ph", k - 1) == F.get("_ph", k)) | (F.get("_ph", k + 1) == F.get("_ph", k)), i)),
        lambda i: i.isNotNull())
    df = df.withColumn("_hits", F.sort_array(hit)).withColumn("_next", F.expr("slice(_hits, 2, size(_hits))"))
    covered = F.aggregate(F.zip_with("_hits", "_next", lambda a, b: F.least(F.coalesce(b - a, F.lit(5)), F.lit(5))),
                          F.lit(0).cast("long"), lambda s, x: s + x)
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    cls = F.col("_classes")
    df = df.withColumns({
        "word_chars": (F.length("_text") - cls[1]).cast("long"), "n_symbols": cls[4],
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))})
    lists = common.select(F.col("lang").alias("_rlang"), F.col("common").alias("_rw"), F.col("counts").alias("_rn"))
    df = df.join(F.broadcast(lists), F.col("_lang") == F.col("_rlang"), "left")  # one row per reference language
    df = df.withColumn("_at", F.filter(F.transform("_words", lambda w: F.array_position("_rw", w)), lambda p: p > 0))
    df = df.withColumn("_code", F.array_join(F.transform("_at", lambda p: F.substring(F.lit(_CODES), p.cast("int"),
                                                                                      F.lit(1))), ""))
    other = (F.size("_words") - F.size("_at")).cast("long")
    df = df.withColumn("_bins", F.concat(F.array(other), F.transform("_rn", lambda _, i: (
        F.length("_code") - F.length(F.replace("_code", F.substring(F.lit(_CODES), i + 1, F.lit(1)), F.lit(""))))
        .cast("long"))))
    return df.select(*[F.col(f"`{c}`") for c in keep], "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     "n_repeat_words", "base_failed", "_classes", "_bins", "_rn", "_lang")


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", n_common: int = 16,
                  max_class_distance: float = 0.25, max_word_distance: float = 0.45, min_chars: int = 200,
                  min_words: int = 60, keep_text: bool = True, min_common: float = 0.5,
                  min_ref_docs: int = 20, min_ref_share: float = 0.001) -> DataFrame:
    """``docs`` with counts, the two distances and the verdict ``kept``.

    A language's references are the character-class and common-word histograms
    of all documents with that value in the language column (null counts as
    ``''``). A language is a reference with ``min_ref_docs`` documents and
    ``min_ref_share`` of all bytes; under that its documents would be judged by
    little but themselves, so they are held against the character classes of
    all documents, and their words stay unjudged. A document is compared by Jensen-Shannon distance: its character
    classes when it has ``min_chars`` characters, its common words when it has
    ``min_words`` words; a shorter one passes that guard unjudged. A document of
    ``min_words`` words is rejected too when its share of common words is below
    ``min_common`` times its language's: the distance of a text without any is
    bounded by that share and can lie below every limit. The base rule
    rejects too: under ten words, or over a fifth of the words inside five-word
    windows that come again in the text. Null text is empty and fails the base
    rule; repeated rows are judged alike; an empty table gives an empty result.
    Input columns that clash with the added ones are replaced. Repeated windows
    are found by 64-bit hashes within one text. The measured rows are written
    once, without the text unless ``keep_text``.
    """
    languages = reference_languages(docs, min_ref_docs, min_ref_share, text_col, lang_col)
    common = common_words(docs, n_common, text_col, lang_col, languages)
    rows = materialize(measure(docs, common, text_col, lang_col, keep_text), "measured")
    keep = [c for c in without(docs, ADDED).columns if keep_text or c != text_col]
    sums = [F.array(*[F.sum(F.col("_classes")[i]).cast("double") for i in range(len(CLASSES))]).alias("_rc"),
            F.sum("n_words").alias("_all")]
    refs = rows.join(F.broadcast(languages), rows["_lang"] == languages["lang"], "left_semi").groupBy(
        F.col("_lang").alias("_rlang")).agg(*sums)
    pool = rows.agg(*sums).first()["_rc"]
    df = rows.join(F.broadcast(refs), F.col("_lang") == F.col("_rlang"), "left").withColumn(
        "_rc", F.coalesce("_rc", F.array(*[F.lit(float(x or 0)) for x in pool])))  # one row per reference language
    chars = F.aggregate("_classes", F.lit(0).cast("long"), lambda a, x: a + x)
    df = with_distance(df, "class_distance", F.col("_classes"), F.col("_rc"), chars >= min_chars)
    df = df.withColumn("_top", F.aggregate("_rn", F.lit(0).cast("long"), lambda a, x: a + x))
    df = with_distance(df, "word_distance", F.col("_bins"), F.concat(
        F.array(F.col("_all") - F.col("_top")), "_rn"), F.col("n_words") >= min_words)
    far = ((F.coalesce("class_distance", F.lit(0.0)) > max_class_distance)
           | (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance))
    # Shares of common words, multiplied out.
    n_common_words = (F.col("n_words") - F.col("_bins")[0]).cast("double")
    few = (F.col("n_words") >= min_words) & (n_common_words * F.col("_all") < min_common * F.col("n_words") * F.col("_top"))
    far = far | F.coalesce(few, F.lit(False))
    return df.withColumn("kept", ~F.col("base_failed") & ~far).select(*[F.col(f"`{c}`") for c in keep], *ADDED)
