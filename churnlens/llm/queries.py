"""The queries ``opN_<name>`` over whole tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, extract, filter_audit, jaccard, langid, lm, mixing, quality, resample, sharding,
               tokens, warc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\\### Assistant: </turn> ok"
    extra = spark.sql(f"""SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}')
                          AS t(conv_id, turn, role, text)""")
    log = chat.conversation_log(rows.unionByName(extra))
    return chat.digests(chat.render(chat.fold_messages(log)))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score_documents(docs)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), 24)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.quality_rules(docs, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    model = langid.fit(train)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def op8_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_with_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.ranked_documents(docs, table(spark, sf_dir, "benchmark").select("text"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_chat_format, op2_lm_scores, op3_mix_sources, op4_shards, op5_quality_rules, op6_main_text, op7_language,
    op8_jaccard_groups, op9_leaks, op10_token_counts, op11_resample, op12_filter_audit, op13_warc, pipeline)}

OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
esc AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l') AS body,
         replace(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c'),
                 chr(10), '\n') AS head
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(length(head) + length(body) + 14)::BIGINT AS formatted_chars
FROM esc GROUP BY conv_id
"""

OP3_SQL = r"""
WITH RECURSIVE
sized AS (SELECT doc_id, source,
    (len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) + 1)::BIGINT
      AS tokens FROM documents),
totals AS (SELECT source, sum(tokens)::BIGINT AS total FROM sized GROUP BY source),
params AS (SELECT sum(total)::BIGINT AS t, count(*) AS n, ln(count(*)) * 0.95 AS target FROM totals),
bisect(lo, hi) AS (
  SELECT -1, 8000000
  UNION ALL
  SELECT CASE WHEN good THEN lo ELSE mid END, CASE WHEN good THEN mid ELSE hi END FROM (
    SELECT lo, hi, mid, (SELECT ln(sum(p ** e)) - e * sum(p ** e * ln(p)) / sum(p ** e) <= any_value(target)
                          AND min(p) ** (e - 1) / sum(p ** e) <= 4
                         FROM (SELECT total / t::DOUBLE AS p, target, mid / 1000000.0::DOUBLE AS e
                               FROM totals, params)  GROUP BY e) AS good
    FROM (SELECT lo, hi, (lo + hi) // 2 AS mid FROM bisect WHERE hi - lo > 1))),
answer AS (SELECT hi / 1000000.0::DOUBLE AS e FROM bisect ORDER BY hi - lo LIMIT 1),
weights AS (SELECT source, total, (total / t::DOUBLE) ** e AS w, t FROM totals, params, answer),
quotas AS (SELECT source, total, floor(t * (w / (SELECT sum(w) FROM weights)))::BIGINT AS quota FROM weights),
drawn AS (SELECT s.doc_id, s.source, s.tokens, unnest(range(0, ceil(quota / total)::BIGINT)) AS epoch, quota
          FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source WHERE quota > 0),
run AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY epoch,
            md5('1|' || epoch || '|' || coalesce(doc_id::VARCHAR, '')), doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM drawn),
placed AS (SELECT *, (pos::HUGEINT * (SELECT greatest(1, (t + 262143) // 262144) FROM params) // quota)::BIGINT AS block
           FROM run WHERE pos < quota)
SELECT doc_id, source, tokens, epoch::INTEGER AS epoch, block,
       row_number() OVER (PARTITION BY block ORDER BY
         md5('1|' || block || '|' || epoch || '|' || coalesce(doc_id::VARCHAR, '')), source, epoch, pos) - 1 AS slot
FROM placed
"""

OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
counted AS (
  SELECT doc_id, part, t, len(ws) AS n, len(list_distinct(ws)) AS n_distinct,
         length(t) AS chars, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS capitals
  FROM (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM docs)),
fails AS (
  SELECT doc_id, part, (n < 200)::INT + 2 * (100 * n_distinct < 50 * n)::INT + 4 * (100 * capitals > 3 * chars)::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM counted),
labelled AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM fails LEFT JOIN labelled USING (doc_id) GROUP BY part, mask),
letters AS (SELECT chr(65 + i::INT) AS c, (1 << i)::INT AS b FROM range(5) r(i)),
orders AS (
  SELECT p.c || q.c || r.c || s.c || t.c AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.b | q.b | r.b | s.b | t.b = 31),
steps AS (
  SELECT filter_order, k::INT AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before
  FROM orders, range(1, 6) g(k)),
told AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM told
"""

OP13_SQL = r"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts
"""

ORACLE_SQL: dict[str, str] = {"op1_chat_format": OP1_SQL, "op3_mix_sources": OP3_SQL, "op12_filter_audit": OP12_SQL,
                              "op13_warc": OP13_SQL}
