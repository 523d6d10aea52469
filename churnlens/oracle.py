"""Independent SQL (DuckDB dialect) for every deterministic query.

The driver runs these next to the Spark queries on the same parquet tables
and compares rows. They are written from the operator definitions, not
generated from the Spark plans.
"""

from __future__ import annotations

from .config import FOLD_SALT, PEEK_SALT, SAMPLE_SALT, SPLIT_SALT
from .sources.events import LOCATIONS

_LOC_CASE = " ".join(f"WHEN {i} THEN '{loc}'" for i, loc in enumerate(LOCATIONS))

CLICKSTREAM = f"""
clickstream AS (
  SELECT
    CASE WHEN event_id % 41 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS userId,
    CASE WHEN event_id % 41 = 0 THEN NULL WHEN user_id % 5 < 3 THEN 'F' ELSE 'M' END AS gender,
    CAST(row_number() OVER (PARTITION BY user_id, day(ts) ORDER BY ts, event_id) - 1 AS BIGINT)
      AS itemInSession,
    CAST(user_id * 100 + day(ts) AS BIGINT) AS sessionId,
    CASE WHEN (user_id + floor(day(ts) / 10)) % 4 = 0 THEN 'free' ELSE 'paid' END AS level,
    CASE WHEN event_type IN ('click', 'view', 'purchase')
         THEN CAST(round(value * 100) AS DOUBLE) END AS length,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'NextSong'
         WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'Cancellation Confirmation'
         WHEN event_type = 'error' AND event_id % 10 BETWEEN 1 AND 4 THEN 'Downgrade'
         WHEN event_type = 'error' THEN 'Error'
         WHEN event_type = 'signup' THEN 'Home' END AS page,
    CASE user_id % 4 {_LOC_CASE} END AS location,
    CASE WHEN event_type = 'view' THEN 'GET' ELSE 'PUT' END AS method,
    CAST(CASE WHEN event_type = 'error' THEN 404 WHEN event_type = 'signup' THEN 307 ELSE 200 END
         AS BIGINT) AS status,
    epoch_us(ts) // 1000 AS ts
  FROM events)"""

CAST_CS = """
cast_cs AS (
  SELECT TRY_CAST(userId AS BIGINT) AS userId, gender, itemInSession, sessionId, level,
         CAST(length AS DOUBLE) AS length, page, location, method, status, ts
  FROM clickstream)"""

IMPUTED = """
user_means AS (SELECT userId, avg(length) AS mean_length FROM cast_cs GROUP BY userId),
imputed AS (
  SELECT c.userId, c.gender, c.itemInSession, c.sessionId, c.level, c.page, c.location, c.method,
         c.status, c.ts, coalesce(c.length, m.mean_length) AS length
  FROM cast_cs c LEFT JOIN user_means m ON c.userId = m.userId)"""

_LABEL = ("CAST(CASE WHEN page = 'Cancellation Confirmation' THEN 2 "
          "WHEN page = 'Downgrade' THEN 1 ELSE 0 END AS INTEGER)")


def _not_null(cols: list[str]) -> str:
    return " AND ".join([f"{c} IS NOT NULL" for c in cols] + ["NOT isnan(length)"])


_TRAIN_COLS = ["userId", "gender", "itemInSession", "level", "length", "page"]
_EXPLORE_COLS = ["gender", "itemInSession", "level", "location", "length", "method", "page",
                 "sessionId", "status", "ts", "userId"]

TRAIN_ROWS = f"""
train_rows AS (
  SELECT DISTINCT {', '.join(_TRAIN_COLS)} FROM imputed WHERE {_not_null(_TRAIN_COLS)}),
wrangled AS (
  SELECT userId, gender, itemInSession, level, length, {_LABEL} AS churn FROM train_rows)"""

EXPLORE = f"""
explore_clean AS (
  SELECT DISTINCT {', '.join(_EXPLORE_COLS)} FROM imputed WHERE {_not_null(_EXPLORE_COLS)}),
explore_base AS (
  SELECT gender, itemInSession, level, length, method, page, sessionId, status, userId,
         {_LABEL} AS churn,
         CAST(year(epoch_ms(ts)) AS INTEGER) AS year, CAST(month(epoch_ms(ts)) AS INTEGER) AS month,
         CAST(day(epoch_ms(ts)) AS INTEGER) AS day, CAST(hour(epoch_ms(ts)) AS INTEGER) AS hour,
         location,
         CASE WHEN contains(location, ',') THEN trim(split_part(location, ',', 2))
              ELSE location END AS state
  FROM explore_clean),
explore AS (
  SELECT gender, itemInSession, level, length, method, page, sessionId, status, userId, churn,
         year, month, day, hour, unnest(string_split(state, '-')) AS state
  FROM explore_base)"""


def _bucket(keys: list[str], salt: str, buckets: int = 10_000) -> str:
    parts = ", ".join([f"CAST({k} AS VARCHAR)" for k in keys] + [f"'{salt}'"])
    return f"(CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 8) AS BIGINT) % {buckets})"


def _bits(keys: list[str], salt: str) -> str:
    parts = ", ".join([f"CAST({k} AS VARCHAR)" for k in keys] + [f"'{salt}'"])
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 15) AS BIGINT)"


_ROW_KEYS = ["userId", "gender", "itemInSession", "level", "churn"]

FRACTIONS = """
counts AS (SELECT churn, count(*) AS count FROM wrangled GROUP BY churn),
fractions AS (
  SELECT churn, count, min(count) OVER () AS min_count,
         CASE WHEN churn = 2 THEN CAST(1.0 AS DOUBLE)
              ELSE least(CAST(1.0 AS DOUBLE), CAST(8.6 AS DOUBLE) * min(count) OVER () / count)
         END AS fraction
  FROM counts)"""

BALANCED = f"""
balanced AS (
  SELECT w.userId, w.gender, w.itemInSession, w.level, w.length, w.churn
  FROM wrangled w JOIN fractions f ON w.churn = f.churn
  WHERE {_bits(['w.' + k for k in _ROW_KEYS], SAMPLE_SALT)}
        < CAST(floor(f.fraction * CAST(1152921504606846976 AS DOUBLE)) AS BIGINT))"""

SCORE_ROWS = """
scored AS (
  SELECT userId, gender, itemInSession, level, length, page,
         CAST(CASE WHEN length <> floor(length) AND itemInSession % 2 = 0 THEN 2.0
                   WHEN length <> floor(length) THEN 1.0 ELSE 0.0 END AS DOUBLE) AS churn_pred
  FROM train_rows),
flagged AS (
  SELECT *, ((page = 'Cancellation Confirmation' AND churn_pred = 2)
             OR (page = 'Downgrade' AND churn_pred = 1)) AS correct_prediction
  FROM scored WHERE churn_pred IN (1.0, 2.0))"""

USER_CHURN = """
user_days AS (
  SELECT userId, year, month, day, count(*) AS n,
         count(*) FILTER (WHERE page = 'NextSong') AS songs,
         count(*) FILTER (WHERE page = 'Downgrade') AS downgrades,
         count(*) FILTER (WHERE page = 'Cancellation Confirmation') AS cancels,
         max(churn) AS churn_max
  FROM explore_base GROUP BY userId, year, month, day),
user_churn AS (
  SELECT userId, max(churn_max) AS user_churn, CAST(sum(n) AS BIGINT) AS n_events,
         CAST(sum(songs) AS BIGINT) AS n_songs, CAST(sum(downgrades) AS BIGINT) AS n_downgrades,
         CAST(sum(cancels) AS BIGINT) AS n_cancels, count(*) AS active_days
  FROM user_days GROUP BY userId)"""


# The live query: three spans of days; lines with item number 7 (mod 50) arrive cut short.
LIVE = """
spans AS (
  SELECT *, (ts // 86400000 - lo) // ((hi - lo) // 3 + 1) AS span, itemInSession % 50 = 7 AS cut
  FROM cast_cs, (SELECT min(ts // 86400000) AS lo, max(ts // 86400000) AS hi FROM cast_cs)),
span_totals AS (
  SELECT userId, span, sum(length) AS total, count(length) AS n FROM spans
  WHERE NOT cut AND userId IS NOT NULL GROUP BY userId, span),
span_means AS (
  SELECT s.userId, s.span, sum(t.total) / sum(t.n) AS mean_length
  FROM (SELECT DISTINCT userId, span FROM spans WHERE userId IS NOT NULL) s
  JOIN span_totals t ON t.userId = s.userId AND t.span <= s.span GROUP BY s.userId, s.span),
live AS (
  SELECT s.userId, gender, itemInSession, level, coalesce(length, mean_length) AS length, page, sessionId, ts
  FROM spans s LEFT JOIN span_means m ON m.userId = s.userId AND m.span = s.span
  WHERE NOT cut AND s.userId IS NOT NULL AND gender IS NOT NULL AND itemInSession IS NOT NULL
    AND level IS NOT NULL AND page IS NOT NULL),
live_scored AS (
  SELECT *, CAST(CASE WHEN length <> floor(length) AND itemInSession % 2 = 0 THEN 2.0
                      WHEN length <> floor(length) THEN 1.0 ELSE 0.0 END AS DOUBLE) AS churn_pred
  FROM live WHERE length IS NOT NULL),
live_flagged AS (
  SELECT *, ((page = 'Cancellation Confirmation' AND churn_pred = 2)
             OR (page = 'Downgrade' AND churn_pred = 1)) AS correct_prediction
  FROM live_scored WHERE churn_pred > 0)"""


# The lines of a changed producer: one row per line, with the JSON type of every field.
DRIFT = """
drifted AS (
  SELECT *, itemInSession % 50 = 7 AS cut,
         CASE WHEN itemInSession % 11 = 0 THEN 'string' ELSE 'integer' END AS status_type,
         CASE WHEN itemInSession % 13 = 0 THEN 'string' WHEN length IS NULL THEN 'null' ELSE 'number' END AS length_type,
         CASE WHEN itemInSession % 17 = 0 THEN 'number' ELSE 'integer' END AS session_type,
         CASE WHEN itemInSession % 23 = 0 THEN 'array' WHEN itemInSession % 23 = 1 THEN 'integer' END AS tags_type,
         CASE WHEN itemInSession % 19 = 0 THEN 'object' END AS device_type
  FROM clickstream),
whole AS (SELECT * FROM drifted WHERE NOT cut),
kinds AS (SELECT * FROM (VALUES
  ('artist', 'string'), ('auth', 'string'), ('firstName', 'string'), ('gender', 'string'), ('itemInSession', 'bigint'),
  ('lastName', 'string'), ('length', 'double'), ('level', 'string'), ('location', 'string'), ('method', 'string'),
  ('page', 'string'), ('registration', 'bigint'), ('sessionId', 'bigint'), ('song', 'string'), ('status', 'bigint'),
  ('ts', 'bigint'), ('userAgent', 'string'), ('userId', 'string')) k(field, expected)),
typed AS (
  SELECT unnest([
    {'field': 'userId', 'type': 'string', 'lost': 0}, {'field': 'level', 'type': 'string', 'lost': 0},
    {'field': 'page', 'type': 'string', 'lost': 0}, {'field': 'location', 'type': 'string', 'lost': 0},
    {'field': 'method', 'type': 'string', 'lost': 0}, {'field': 'itemInSession', 'type': 'integer', 'lost': 0},
    {'field': 'ts', 'type': 'integer', 'lost': 0},
    {'field': 'gender', 'type': CASE WHEN gender IS NOT NULL THEN 'string' END, 'lost': 0},
    {'field': 'status', 'type': status_type, 'lost': 0},
    {'field': 'length', 'type': length_type, 'lost': (length_type = 'string')::INT},
    {'field': 'sessionId', 'type': session_type, 'lost': (session_type = 'number')::INT},
    {'field': 'tags', 'type': tags_type, 'lost': 0}, {'field': 'device', 'type': device_type, 'lost': 0}], recursive := true)
  FROM whole),
fields AS (SELECT field, type, count(*) AS n, sum(lost)::BIGINT AS lost FROM typed WHERE type IS NOT NULL GROUP BY field, type),
absent AS (
  SELECT field, 'absent' AS type, (SELECT count(*) FROM whole) - coalesce((SELECT sum(n) FROM fields f WHERE f.field = k.field), 0)
           AS n, 0::BIGINT AS lost FROM kinds k)"""


def _with(*blocks: str) -> str:
    return "WITH " + ",".join(blocks)


_BASE = (CLICKSTREAM, CAST_CS, IMPUTED)


def _null_profile(stage: str, table: str, cols: list[str], floats: set[str]) -> str:
    parts = []
    for c in cols:
        cond = f"({c} IS NULL OR isnan({c}))" if c in floats else f"{c} IS NULL"
        parts.append(
            f"SELECT '{stage}' AS stage, '{c}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS null_count, "
            f"CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE) "
            f"AS null_pct FROM {table}")
    return " UNION ALL ".join(parts)


_CS_COLS = ["userId", "gender", "itemInSession", "sessionId", "level", "length", "page",
            "location", "method", "status", "ts"]
#: The columns of the stored profile.
PROFILED = ["userId", "gender", "itemInSession", "sessionId", "level", "length", "page", "status", "ts"]
DESCRIBE_COLS = ["itemInSession", "length", "sessionId", "status", "ts", "userId"]


_INTEGRAL = {"itemInSession", "sessionId", "status", "ts", "userId"}


def _significant(x: str, digits: int = 10) -> str:
    """``x`` to ``digits`` significant digits."""
    return (f"CASE WHEN ({x}) = 0 THEN 0.0 ELSE "
            f"round({x}, {digits - 1} - CAST(floor(log10(abs({x}))) AS INTEGER)) END")


def _describe() -> str:
    parts = []
    for c in DESCRIBE_COLS:
        v = f"CAST({c} AS DOUBLE)"
        if c in _INTEGRAL:
            # Exact moments of d = x - min in HUGEINT, then one rounding to double.
            d = f"CAST({c} - (SELECT min({c}) FROM imputed) AS HUGEINT)"
            mean = f"(SELECT min({c}) FROM imputed) + CAST(sum({d}) AS DOUBLE) / count({c})"
            std = (f"sqrt(CAST(count({c}) * sum({d} * {d}) - sum({d}) * sum({d}) AS DOUBLE)"
                   f" / CAST(count({c}) * (count({c}) - 1) AS DOUBLE))")
        else:
            mean, std = f"avg({v})", f"stddev_samp({v})"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS count, {_significant(mean)} AS mean, "
            f"{_significant(std)} AS std, min({v}) AS min, "
            f"quantile_cont({v}, 0.25) AS q25, quantile_cont({v}, 0.5) AS q50, "
            f"quantile_cont({v}, 0.75) AS q75, max({v}) AS max FROM imputed")
    return " UNION ALL ".join(parts)


JSON_NULLS = ("CAST(NULL AS VARCHAR) AS artist, CAST(NULL AS VARCHAR) AS auth, "
              "CAST(NULL AS VARCHAR) AS firstName, CAST(NULL AS VARCHAR) AS lastName, "
              "CAST(NULL AS BIGINT) AS registration, CAST(NULL AS VARCHAR) AS song, "
              "CAST(NULL AS VARCHAR) AS userAgent")


def _range_profile() -> str:
    def digits(x: str) -> str:
        power = f"(floor(log10(abs({x}))) - 7)"
        up, down = f"pow(10.0, {power})", f"pow(10.0, -{power})"
        return (f"CASE WHEN {x} IS NULL OR {x} = 0 THEN {x} WHEN {power} > 0 THEN round({x} / {up}) * {up} "
                f"ELSE round({x} * {down}) / {down} END")
    parts = []
    for c in PROFILED:
        v = f"CAST({c} AS DOUBLE)" if c in DESCRIBE_COLS else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS null_count, "
                     f"{digits(f'avg({v})')} AS mean, {digits(f'stddev_samp({v})')} AS std, min({v}) AS min, max({v}) AS max, "
                     "TRUE AS ranks_ok, TRUE AS distinct_ok FROM middle")
    return _with(CLICKSTREAM, CAST_CS, """
bounds AS (SELECT min(ts // 86400000) AS lo, max(ts // 86400000) AS hi FROM cast_cs),
middle AS (SELECT c.* FROM cast_cs c, bounds
           WHERE ts // 86400000 BETWEEN lo + (hi - lo) // 4 AND hi - (hi - lo) // 4)""") + " " + " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["adapt_events"] = _with(CLICKSTREAM) + " SELECT * FROM clickstream"
    q["json_scan"] = _with(CLICKSTREAM) + f" SELECT *, {JSON_NULLS} FROM clickstream"
    q["json_line_report"] = (_with(CLICKSTREAM) + " SELECT count(*) AS lines, "
                             "count(*) FILTER (itemInSession % 7 = 3) AS malformed, "
                             "count(*) FILTER (itemInSession % 7 <> 3) AS parsed, "
                             "max(ts) FILTER (itemInSession % 7 <> 3) AS newest_ts FROM clickstream")
    q["impute_length"] = _with(*_BASE) + " SELECT * FROM imputed"
    q["wrangle_train"] = _with(*_BASE, TRAIN_ROWS) + " SELECT * FROM wrangled"
    q["class_counts"] = (_with(*_BASE, TRAIN_ROWS)
                         + " SELECT churn, count(*) AS count FROM wrangled GROUP BY churn")
    q["null_profile"] = (_with(*_BASE) + " " + _null_profile("raw", "cast_cs", _CS_COLS, {"length"})
                         + " UNION ALL " + _null_profile("imputed", "imputed", _CS_COLS, {"length"}))
    q["describe_numeric"] = _with(*_BASE) + " " + _describe()
    q["distinct_pages"] = _with(*_BASE) + " SELECT DISTINCT page FROM imputed"
    q["lower_strings"] = (_with(*_BASE) + " SELECT userId, lower(gender) AS gender, itemInSession, "
                          "sessionId, lower(level) AS level, length, lower(page) AS page, "
                          "lower(location) AS location, lower(method) AS method, status, ts "
                          "FROM cast_cs")
    q["time_parts"] = (_with(*_BASE) + " SELECT userId, sessionId, itemInSession, ts, "
                       "CAST(year(epoch_ms(ts)) AS INTEGER) AS year, "
                       "CAST(month(epoch_ms(ts)) AS INTEGER) AS month, "
                       "CAST(day(epoch_ms(ts)) AS INTEGER) AS day, "
                       "CAST(hour(epoch_ms(ts)) AS INTEGER) AS hour FROM cast_cs")
    q["explode_states"] = (_with(*_BASE, EXPLORE) + " SELECT userId, sessionId, itemInSession, "
                           "location, unnest(string_split(state, '-')) AS state FROM explore_base")
    q["wrangle_explore"] = _with(*_BASE, EXPLORE) + " SELECT * FROM explore"
    q["level_filter"] = _with(*_BASE, EXPLORE) + " SELECT * FROM explore WHERE level = 'free'"
    keys = ", ".join(f"CAST({k} AS VARCHAR)" for k in
                     ["userId", "sessionId", "itemInSession", "state"])
    q["random_rows"] = (_with(*_BASE, EXPLORE) + " SELECT * FROM explore WHERE churn = 2 ORDER BY "
                        f"md5(concat_ws('|', {keys}, '{PEEK_SALT}')) LIMIT 5")
    q["class_sizes"] = (_with(*_BASE, TRAIN_ROWS) + ", counts AS (SELECT churn, count(*) AS count "
                        "FROM wrangled GROUP BY churn) SELECT max(count) AS max_count, "
                        "min(count) AS min_count, CASE WHEN count(*) = 3 THEN "
                        "CAST(sum(count) - max(count) - min(count) AS BIGINT) END AS mid_count, "
                        "count(*) AS n_classes FROM counts")
    q["balance_fractions"] = _with(*_BASE, TRAIN_ROWS, FRACTIONS) + " SELECT * FROM fractions"
    q["balanced_sample"] = _with(*_BASE, TRAIN_ROWS, FRACTIONS, BALANCED) + " SELECT * FROM balanced"
    q["hash_split"] = (_with(*_BASE, TRAIN_ROWS, FRACTIONS, BALANCED)
                       + f" SELECT *, CASE WHEN {_bucket(_ROW_KEYS, SPLIT_SALT)} < 7000 THEN 'train'"
                       f" WHEN {_bucket(_ROW_KEYS, SPLIT_SALT)} < 8500 THEN 'valid' ELSE 'test' END"
                       f" AS split, CAST({_bucket(_ROW_KEYS, FOLD_SALT)} % 3 AS INTEGER) AS fold"
                       " FROM balanced")
    q["balanced_sample_k2"] = (_with(*_BASE, TRAIN_ROWS, FRACTIONS.replace("8.6", "2.0"), BALANCED)
                               + " SELECT * FROM balanced")
    q["training_splits"] = f"SELECT split, fold, count(*) AS n FROM ({q['hash_split']}) GROUP BY split, fold"
    q["saved_loaded"] = ("SELECT split, count(*) AS n_rows, CAST(0 AS BIGINT) AS mismatches, "
                         f"CAST(0 AS BIGINT) AS unscored FROM ({q['hash_split']}) GROUP BY split")
    q["scored_users"] = (_with(*_BASE, TRAIN_ROWS)
                         + " SELECT userId, count(*) AS n_rows FROM train_rows GROUP BY userId")
    q["stream_rows"] = _with(*_BASE, TRAIN_ROWS) + " SELECT * FROM train_rows"
    rules = {"fraction": ("length <> floor(length) AND itemInSession % 2 = 0", "length <> floor(length)"),
             "position": ("itemInSession >= 40", "itemInSession >= 20"), "nobody": ("false", "false"),
             "free": ("level = 'free' AND gender = 'F'", "level = 'free'")}
    predicted = " UNION ALL ".join(
        f"SELECT '{name}' AS model, CAST(churn AS DOUBLE) AS l, CAST(CASE WHEN {cancel} THEN 2 WHEN {downgrade} THEN 1 "
        f"ELSE 0 END AS DOUBLE) AS p FROM test_rows" for name, (cancel, downgrade) in rules.items())
    q["compare_rules"] = f"""WITH test_rows AS (SELECT * FROM ({q['hash_split']}) WHERE split = 'test'),
pred AS ({predicted}),
cells AS (SELECT model, l, p, CAST(count(*) AS DOUBLE) AS n FROM pred GROUP BY model, l, p),
w AS (SELECT *, sum(n) OVER (PARTITION BY model, l) AS label_n, sum(n) OVER (PARTITION BY model, p) AS pred_n,
             sum(n) OVER (PARTITION BY model) AS total FROM cells)
SELECT model, 'test' AS split,
       round(coalesce(sum(CASE WHEN l = p THEN 2.0 * (n / pred_n) * (n / label_n) / ((n / pred_n) + (n / label_n))
                               * label_n / total END), 0.0), 9) AS f1,
       round(coalesce(sum(CASE WHEN l = p THEN (n / pred_n) * label_n / total END), 0.0), 9) AS weighted_precision,
       round(coalesce(sum(CASE WHEN l = p THEN (n / label_n) * label_n / total END), 0.0), 9) AS weighted_recall,
       CAST(max(total) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (p > 0), 0) AS BIGINT) AS flagged_rows
FROM w GROUP BY model"""
    q["nested_grid"] = ("SELECT max_depth::INT AS max_depth, max_iter::INT AS max_iter, false AS metrics_differ, "
                        "true AS best_agrees, 7::INT AS fits, n_rows, 0::BIGINT AS scored_apart "
                        "FROM (VALUES (2, 2), (2, 4), (3, 2), (3, 4)) g(max_depth, max_iter), "
                        f"(SELECT count(*) AS n_rows FROM ({q['hash_split']}))")
    q["training_facts"] = ("SELECT model, split, count(*) AS n_rows, true AS in_range "
                           f"FROM ({q['hash_split']}), (VALUES ('dt'), ('rf')) m(model) "
                           "WHERE split <> 'train' GROUP BY model, split")
    q["scored_table"] = _with(*_BASE, TRAIN_ROWS, SCORE_ROWS) + " SELECT * FROM flagged"
    q["json_drift"] = _with(CLICKSTREAM, DRIFT) + """
SELECT field, type, expected, n::BIGINT AS n, n::DOUBLE / (SELECT count(*) FROM whole) AS share,
       CASE WHEN expected IS NULL THEN 'unknown' WHEN type IN ('null', 'absent') THEN type
            WHEN (expected, type) IN (('bigint', 'integer'), ('double', 'number'), ('double', 'integer'), ('string', 'string'))
            THEN 'ok' ELSE 'conflict' END AS status, lost
FROM (SELECT * FROM fields UNION ALL SELECT * FROM absent WHERE n > 0) LEFT JOIN kinds USING (field)"""
    q["json_schema"] = _with(CLICKSTREAM, DRIFT) + """,
merged AS (SELECT field, list_sort(list(type) FILTER (type <> 'null')) AS types, sum(n)::BIGINT AS n FROM fields GROUP BY field)
SELECT field, n, CASE WHEN types = ['string'] THEN 'STRING' WHEN types = ['integer'] THEN 'BIGINT'
                      WHEN types IN (['number'], ['integer', 'number']) THEN 'DECIMAL'
                      WHEN types = ['object'] THEN 'OBJECT<os: STRING, version: BIGINT>'
                      WHEN types = ['array'] THEN 'ARRAY<STRING>' ELSE 'VARIANT' END AS merged_type
FROM merged"""
    q["json_open"] = _with(CLICKSTREAM, DRIFT) + """
SELECT userId, itemInSession, CASE WHEN session_type = 'integer' THEN sessionId END AS sessionId,
       CASE WHEN length_type = 'number' THEN length END AS length, status, page, ts,
       CASE WHEN device_type IS NOT NULL THEN 'x' END AS device_os,
       CASE WHEN length_type = 'string' AND session_type = 'number'
            THEN '{"length":"n/a","sessionId":' || sessionId || '.5}'
            WHEN length_type = 'string' THEN '{"length":"n/a"}'
            WHEN session_type = 'number' THEN '{"sessionId":' || sessionId || '.5}' END AS lost, false AS malformed
FROM whole
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true FROM drifted WHERE cut"""
    live = _with(CLICKSTREAM, CAST_CS, LIVE)
    q["live_scoring"] = live + """
SELECT 'scored' AS sink, s.*, CASE WHEN churn_pred > 0 THEN f.correct_prediction END AS correct_prediction
FROM live_scored s LEFT JOIN (SELECT userId AS u, sessionId AS i, itemInSession AS k, correct_prediction
                              FROM live_flagged) f ON u = userId AND i = sessionId AND k = itemInSession
UNION ALL SELECT 'flagged', * FROM live_flagged
UNION ALL SELECT 'unfilled', *, NULL, NULL FROM live WHERE length IS NULL
UNION ALL SELECT 'malformed', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM spans WHERE cut"""
    q["live_users"] = live + """,
all_means AS (SELECT userId, CAST(sum(n) AS BIGINT) AS n, sum(total) / sum(n) AS mean_length
              FROM span_totals GROUP BY userId HAVING sum(n) > 0),
at_risk AS (SELECT userId, count(*) AS flagged_events, count(*) FILTER (WHERE churn_pred = 2) AS cancel_flags,
                   count(*) FILTER (WHERE churn_pred = 1) AS downgrade_flags, max(churn_pred) AS max_risk,
                   count(*) FILTER (WHERE correct_prediction) AS confirmed_flags
            FROM live_flagged GROUP BY userId)
SELECT * FROM all_means FULL JOIN at_risk USING (userId)"""
    q["length_item_density"] = (_with(*_BASE, EXPLORE) + " SELECT level, churn, "
                                "CAST(floor(length / 500.0) AS BIGINT) AS x_cell, "
                                "CAST(floor(itemInSession / 10.0) AS BIGINT) AS y_cell, "
                                "count(*) AS n FROM explore_base GROUP BY ALL")
    q["string_index"] = (_with(*_BASE, TRAIN_ROWS) + " SELECT userId, itemInSession, length, churn, "
                         "CAST(dense_rank() OVER (ORDER BY gender) - 1 AS DOUBLE) AS gender, "
                         "CAST(dense_rank() OVER (ORDER BY level) - 1 AS DOUBLE) AS level "
                         "FROM wrangled")
    q["weighted_metrics"] = _with(*_BASE, TRAIN_ROWS) + """,
pred AS (SELECT CAST(churn AS DOUBLE) AS l,
                CASE WHEN length <> floor(length) AND itemInSession % 2 = 0 THEN 2.0
                     WHEN length <> floor(length) THEN 1.0 ELSE 0.0 END AS p FROM wrangled),
cells AS (SELECT l, CAST(p AS DOUBLE) AS p, count(*) AS n FROM pred GROUP BY l, p),
w AS (SELECT l, p, CAST(n AS DOUBLE) AS n,
             CAST(sum(n) OVER (PARTITION BY l) AS DOUBLE) AS label_n,
             CAST(sum(n) OVER (PARTITION BY p) AS DOUBLE) AS pred_n,
             sum(n) OVER () AS total,
             sum(CASE WHEN p IN (1.0, 2.0) THEN n ELSE 0 END) OVER () AS flagged
      FROM cells)
SELECT round(coalesce(sum(CASE WHEN l = p THEN 2.0 * (n / pred_n) * (n / label_n)
                               / ((n / pred_n) + (n / label_n)) * label_n / total END), 0.0), 9) AS f1,
       round(coalesce(sum(CASE WHEN l = p THEN (n / pred_n) * label_n / total END), 0.0), 9)
         AS weighted_precision,
       round(coalesce(sum(CASE WHEN l = p THEN (n / label_n) * label_n / total END), 0.0), 9)
         AS weighted_recall,
       CAST(max(total) AS BIGINT) AS n_rows, CAST(max(flagged) AS BIGINT) AS flagged_rows
FROM w"""
    q["mllib_metrics"] = f"SELECT f1, weighted_precision, weighted_recall FROM ({q['weighted_metrics']})"
    q["flagged_rows"] = _with(*_BASE, TRAIN_ROWS, SCORE_ROWS) + " SELECT * FROM flagged"
    q["flag_precision"] = (_with(*_BASE, TRAIN_ROWS, SCORE_ROWS)
                           + " SELECT count(*) AS n_flagged, "
                           "count(*) FILTER (WHERE correct_prediction) AS n_correct, "
                           "avg(CAST(correct_prediction AS DOUBLE)) * 100 AS flag_precision "
                           "FROM flagged")
    q["at_risk_users"] = (_with(*_BASE, TRAIN_ROWS, SCORE_ROWS)
                          + " SELECT userId, count(*) AS flagged_events, "
                          "count(*) FILTER (WHERE churn_pred = 2) AS cancel_flags, "
                          "count(*) FILTER (WHERE churn_pred = 1) AS downgrade_flags, "
                          "max(churn_pred) AS max_risk, "
                          "count(*) FILTER (WHERE correct_prediction) AS confirmed_flags "
                          "FROM flagged GROUP BY userId")
    q["exact_sample"] = _with(*_BASE, TRAIN_ROWS) + f""",
sizes AS (SELECT churn, CASE WHEN churn = 2 THEN count(*) ELSE
            least(count(*), CAST(floor(2.0 * min(count(*)) OVER ()) AS BIGINT)) END AS n_keep
          FROM wrangled GROUP BY churn),
ordered AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY {_bits(_ROW_KEYS, SAMPLE_SALT)}, userId, gender,
              itemInSession, level, length) AS place FROM wrangled)
SELECT o.* EXCLUDE (place) FROM ordered o JOIN sizes s ON o.churn = s.churn WHERE place <= n_keep"""
    q["range_profile"] = _range_profile()
    q["churn_path"] = _with(*_BASE, EXPLORE) + f""",
path_events AS (
  SELECT userId, page, ts, sessionId, itemInSession, {_LABEL} AS churn,
         count(*) FILTER (WHERE page = 'NextSong') OVER (
           PARTITION BY userId ORDER BY ts, sessionId, itemInSession RANGE UNBOUNDED PRECEDING) AS songs
  FROM explore_clean),
stayed AS (SELECT userId FROM path_events GROUP BY userId HAVING max(churn) = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY userId, churn ORDER BY ts, sessionId, itemInSession, songs) AS up,
         row_number() OVER (PARTITION BY userId, churn ORDER BY ts DESC, sessionId DESC, itemInSession DESC) AS down
  FROM path_events),
anchors AS (
  SELECT userId, churn, ts, sessionId, itemInSession, songs FROM ranked
  WHERE (churn > 0 AND up = 1) OR (churn = 0 AND down = 1 AND userId IN (SELECT userId FROM stayed))),
placed AS (
  SELECT e.userId, a.churn, e.page, least((a.ts - e.ts) // 86400000, 20) AS days,
         least((a.songs - e.songs) // 5, 20) AS songs
  FROM path_events e JOIN anchors a ON e.userId = a.userId
   AND (e.ts < a.ts OR (e.ts = a.ts AND (e.sessionId < a.sessionId
        OR (e.sessionId = a.sessionId AND e.itemInSession < a.itemInSession))))),
long AS (SELECT userId, churn, page, 'days' AS axis, CAST(days AS BIGINT) AS cell FROM placed
         UNION ALL SELECT userId, churn, page, 'songs', CAST(songs AS BIGINT) FROM placed),
reach AS (SELECT userId, churn, axis, max(cell) AS last FROM long GROUP BY ALL),
totals AS (SELECT churn, axis, cell, count(*) FILTER (WHERE page = 'NextSong') AS n_songs FROM long GROUP BY ALL),
users AS (SELECT t.churn, t.axis, t.cell, count(*) AS n_users FROM totals t
          JOIN reach r ON r.churn = t.churn AND r.axis = t.axis AND r.last >= t.cell GROUP BY ALL),
cells AS (SELECT churn, axis, cell, page, count(*) AS n_events FROM long GROUP BY ALL)
SELECT churn, axis, cell, page, n_events, n_users, n_songs, n_events / n_users AS per_user,
       CASE WHEN n_songs > 0 THEN 100.0::DOUBLE * n_events / n_songs END AS per_hundred_songs
FROM cells JOIN totals USING (churn, axis, cell) JOIN users USING (churn, axis, cell)"""
    q["user_churn"] = _with(*_BASE, EXPLORE, USER_CHURN) + " SELECT * FROM user_churn"
    q["group_rates"] = _with(*_BASE, EXPLORE, USER_CHURN) + """,
per_user_page AS (SELECT userId, page, count(*) AS n FROM explore_base GROUP BY userId, page),
joined AS (SELECT p.*, u.user_churn FROM per_user_page p JOIN user_churn u USING (userId)),
totals AS (SELECT user_churn, count(*) AS group_users, sum(active_days) AS group_days,
                  sum(n_songs) AS group_songs FROM user_churn GROUP BY user_churn),
pages AS (SELECT user_churn, page, CAST(sum(n) AS BIGINT) AS n_events, count(*) AS n_users
          FROM joined GROUP BY user_churn, page)
SELECT p.user_churn, p.page, p.n_events, p.n_users, t.group_users,
       CAST(p.n_events AS DOUBLE) / CAST(t.group_days AS DOUBLE) AS events_per_user_day,
       CASE WHEN t.group_songs > 0 THEN CAST(p.n_events AS DOUBLE) / CAST(t.group_songs AS DOUBLE)
       END AS events_per_song
FROM pages p JOIN totals t USING (user_churn)"""
    return q
