"""The catalogue's queries as plain SQL over the same tables, written from the definitions."""

from __future__ import annotations

from tidemark.plans.bindings import HEADER_NAMES, MIDPOINT

# Written out, not imported: a wrong constant of the operators must show.
COLUMN_ALIASES = {
    "time": "timestamp", "ticker": "symbol", "usd_price": "price_usd", "tx_volume": "volume_24h",
    "created_at": "timestamp", "price_timestamp": "timestamp",
}
UNIFIED_FIELDS = [
    "symbol", "name", "price_usd", "volume_24h", "market_cap", "percent_change_24h", "timestamp", "source",
]
NUMERIC_FIELDS = ["price_usd", "volume_24h", "market_cap", "percent_change_24h"]
RUN_LATENCY_BOUNDS_S = [0.1, 0.5, 1, 2, 5, 10, 30, 60, 120, 300]
REQUEST_BOUNDS_MS = [50, 100, 200, 500, 1000, 2000, 5000]
ROW_STEPS = [(0, "red"), (100, "yellow"), (1000, "green")]
ERROR_STEPS = [(0, "green"), (1, "yellow"), (10, "red")]
OUTLIER_STEPS = [(0, "green"), (5, "yellow"), (20, "red")]

ORACLES: dict[str, str] = {}

# --- the bindings ---------------------------------------------------------------------------------

EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

TICKS = EV + """, ticks AS (
  SELECT event_id AS seq, 'U' || CAST(user_id AS VARCHAR) AS symbol, 'User ' || CAST(user_id AS VARCHAR) AS name,
         value AS price_usd, CAST(k AS DOUBLE) AS volume_24h, value * k AS market_cap,
         value - k AS percent_change_24h, ts AS "timestamp", event_type AS source
  FROM ev)"""

MAPPED_SOURCE = """CASE event_type WHEN 'view' THEN 'coinpaprika' WHEN 'click' THEN 'coingecko'
         WHEN 'purchase' THEN 'csv' ELSE event_type END"""

DIRTY = EV + f""", dirty AS (
  SELECT event_id AS seq,
         CASE k WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'SYMBOL-TOO-LONG-TO-STORE-' || CAST(user_id AS VARCHAR)
                ELSE 'U' || CAST(user_id AS VARCHAR) END AS symbol,
         CASE k WHEN 3 THEN NULL WHEN 4 THEN '' ELSE 'User ' || CAST(user_id AS VARCHAR) END AS name,
         CASE k WHEN 5 THEN 0.0 WHEN 6 THEN -value WHEN 7 THEN NULL WHEN 8 THEN CAST('Infinity' AS DOUBLE)
                WHEN 9 THEN CAST(1e17 AS DOUBLE) ELSE value + CAST(0.01 AS DOUBLE) END AS price_usd,
         CASE k WHEN 10 THEN CAST(-1 AS DOUBLE) WHEN 11 THEN NULL ELSE CAST(k AS DOUBLE) END AS volume_24h,
         CASE k WHEN 12 THEN CAST(-5 AS DOUBLE) WHEN 13 THEN NULL ELSE value * k END AS market_cap,
         CASE k WHEN 14 THEN NULL ELSE value - k END AS percent_change_24h,
         CASE WHEN k <> 15 THEN ts END AS "timestamp",
         CASE WHEN k = 16 THEN NULL ELSE {MAPPED_SOURCE} END AS source,
         CASE k WHEN 17 THEN NULL WHEN 18 THEN '[1]' ELSE props END AS raw_data
  FROM ev)
, judged_rule AS (
  SELECT *, CASE
    WHEN symbol IS NULL THEN '"symbol" is required'
    WHEN symbol = '' THEN '"symbol" is not allowed to be empty'
    WHEN name IS NULL THEN '"name" is required'
    WHEN name = '' THEN '"name" is not allowed to be empty'
    WHEN price_usd IS NULL THEN '"price_usd" is required'
    WHEN isinf(price_usd) THEN '"price_usd" cannot be infinity'
    WHEN abs(price_usd) > 9007199254740991 THEN '"price_usd" must be a safe number'
    WHEN price_usd <= 0 THEN '"price_usd" must be a positive number'
    WHEN volume_24h IS NULL THEN '"volume_24h" is required'
    WHEN volume_24h < 0 THEN '"volume_24h" must be greater than or equal to 0'
    WHEN market_cap < 0 THEN '"market_cap" must be greater than or equal to 0'
    WHEN "timestamp" IS NULL THEN '"timestamp" must be a valid date'
    WHEN source IS NULL THEN '"source" is required'
    WHEN source NOT IN ('coinpaprika', 'coingecko', 'csv')
      THEN '"source" must be one of [coinpaprika, coingecko, csv]'
    WHEN raw_data IS NULL THEN '"raw_data" is required'
    WHEN json_type(raw_data) <> 'OBJECT' THEN '"raw_data" must be of type object'
    END AS error,
    coalesce(length(symbol) BETWEEN 1 AND 20 AND length(name) BETWEEN 1 AND 100 AND price_usd >= 0
      AND volume_24h >= 0 AND (market_cap IS NULL OR market_cap >= 0) AND "timestamp" IS NOT NULL
      AND source IN ('coinpaprika', 'coingecko', 'csv') AND json_type(raw_data) = 'OBJECT', FALSE) AS storage_ok
  FROM dirty)"""

NAMES = ", ".join(f"'{n}'" for n in HEADER_NAMES)


def _header(name: str, where: str) -> str:
    return f"""{name} AS (
  SELECT feed, "column", arg_min(type, event_id) AS type,
         row_number() OVER (PARTITION BY feed ORDER BY min(event_id)) - 1 AS pos
  FROM cells WHERE {where} GROUP BY feed, "column")"""


CELLS = EV + f""", cells AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS feed,
         CASE WHEN k < 60 THEN ([{NAMES}])[1 + k % {len(HEADER_NAMES)}]
              ELSE ([{NAMES}])[1 + k % {len(HEADER_NAMES)}] || '_' || event_type END AS "column",
         CASE WHEN event_type IN ('view', 'click') THEN 'number' ELSE 'string' END AS type, event_id, ts
  FROM ev)"""
HEADERS = CELLS + ", " + _header("headers", "TRUE")
OLD_NEW = (CELLS + ", " + _header("old_h", f"ts < TIMESTAMP '{MIDPOINT}'") + ", "
           + _header("new_h", f"ts >= TIMESTAMP '{MIDPOINT}'"))

TARGETS = "targets AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{t}')" for i, t in enumerate(UNIFIED_FIELDS)) + ") t(target_pos, target))"

SCORES = HEADERS + ", " + TARGETS + r""", scores AS (
  SELECT feed, "column", target, target_pos,
    1.0::DOUBLE - levenshtein(regexp_replace(lower("column"), '[\s_]', '', 'g'),
                              regexp_replace(lower(target), '[\s_]', '', 'g'))::DOUBLE
      / greatest(length("column"), length(target)) AS score
  FROM headers CROSS JOIN targets)
, best AS (
  SELECT feed, "column", CASE WHEN score > 0 THEN target END AS target, score
  FROM (SELECT *, row_number() OVER (PARTITION BY feed, "column" ORDER BY score DESC, target_pos) AS rn FROM scores)
  WHERE rn = 1)"""


def _alias_pair(a: str, b: str) -> str:
    return " OR ".join(
        f"({a} = '{k}' AND {b} = '{v}') OR ({b} = '{k}' AND {a} = '{v}')" for k, v in COLUMN_ALIASES.items())


def _similarity(a: str, b: str) -> str:
    x, y = (f"regexp_replace(lower({c}), '[_-]', '', 'g')" for c in (a, b))
    return f"""CASE WHEN {_alias_pair(a, b)} THEN 1.0::DOUBLE
      WHEN contains({x}, {y}) OR contains({y}, {x}) THEN 0.9::DOUBLE
      ELSE 1.0::DOUBLE - levenshtein({x}, {y})::DOUBLE / greatest(length({x}), length({y})) END"""


def _drift(name: str, old: str, new: str) -> str:
    return f"""{name} AS (
  SELECT feed, "from", "to", round(score, 3) AS confidence FROM (
    SELECT r.feed, r."column" AS "from", a."column" AS "to", {_similarity('r."column"', 'a."column"')} AS score,
           row_number() OVER (PARTITION BY r.feed, r."column" ORDER BY score DESC, a.pos) AS rn
    FROM (SELECT * FROM {old} o WHERE NOT EXISTS
            (SELECT 1 FROM {new} n WHERE n.feed = o.feed AND n."column" = o."column")) r
    JOIN (SELECT * FROM {new} n WHERE NOT EXISTS
            (SELECT 1 FROM {old} o WHERE n.feed = o.feed AND n."column" = o."column")) a ON a.feed = r.feed)
  WHERE rn = 1 AND score > 0)"""


DRIFT = OLD_NEW + ", " + _drift("drift", "old_h", "new_h")
STATUS = """CASE WHEN confidence >= 0.8 THEN 'applied' WHEN confidence >= 0.5 THEN 'quarantined'
         ELSE 'skipped' END"""
CHANGED = """changed AS (
  SELECT feed, bool_or(ot IS NULL OR nt IS NULL OR ot <> nt) AS changed FROM (
    SELECT coalesce(o.feed, n.feed) AS feed, o.type AS ot, n.type AS nt
    FROM old_h o FULL OUTER JOIN new_h n ON o.feed = n.feed AND o."column" = n."column")
  WHERE feed IN (SELECT feed FROM old_h) AND feed IN (SELECT feed FROM new_h)
  GROUP BY feed)"""

STAGED = TICKS + """, target AS (
  SELECT symbol, name, price_usd, volume_24h, market_cap, percent_change_24h, "timestamp", source,
         'run-1' AS run_id, TIMESTAMP '2024-01-20' AS created_at
  FROM ticks WHERE "timestamp" < TIMESTAMP '2024-01-20')
, staged AS (
  SELECT seq, symbol, name, price_usd + 1 AS price_usd, volume_24h, market_cap, percent_change_24h, "timestamp", source
  FROM ticks WHERE "timestamp" >= TIMESTAMP '2024-01-10'
  UNION ALL
  SELECT seq + 1000000000000, symbol, name, price_usd + 2, volume_24h, market_cap, percent_change_24h,
         "timestamp", source
  FROM ticks WHERE "timestamp" >= TIMESTAMP '2024-01-10')"""

JUDGED = DIRTY + """, marks AS (
  SELECT source, max("timestamp") AS watermark FROM judged_rule
  WHERE error IS NULL AND "timestamp" < TIMESTAMP '2024-01-15' AND source <> 'csv' GROUP BY source)
, judged AS (
  SELECT j.*, CASE WHEN error IS NOT NULL THEN 'invalid'
    WHEN watermark IS NOT NULL AND "timestamp" <= watermark THEN 'skipped'
    WHEN NOT storage_ok THEN 'failed' ELSE 'load' END AS fate
  FROM judged_rule j LEFT JOIN marks USING (source))"""

LONG = TICKS + ", long AS (" + " UNION ALL ".join(
    f"SELECT seq, symbol, '{f}' AS field, {f} AS value FROM ticks WHERE {f} > 0" for f in NUMERIC_FIELDS) + ")"

STATS = LONG + """, stats AS (
  SELECT seq, symbol, field, value, count(value) OVER w AS n, avg(value) OVER w AS mean,
         stddev_pop(value) OVER w AS sigma, min(value) OVER w AS low, max(value) OVER w AS high,
         lag(value) OVER (PARTITION BY symbol, field ORDER BY seq) AS last_value
  FROM long
  WINDOW w AS (PARTITION BY symbol, field ORDER BY seq ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
, found AS (
  SELECT * FROM (
    SELECT seq, symbol, field, value,
      CASE WHEN n >= 3 AND high > low AND abs((value - mean) / sigma) > 2.5 THEN 'z_score'
           WHEN n >= 3 AND abs((value - last_value) / last_value) * 100 > 50 THEN 'percentage_jump' END AS type,
      CASE WHEN n >= 3 AND high > low AND abs((value - mean) / sigma) > 2.5 THEN abs((value - mean) / sigma)
           ELSE abs((value - last_value) / last_value) * 100 END AS actual
    FROM stats) WHERE type IS NOT NULL)"""

RUNS = EV + """, runs AS (
  SELECT event_id AS seq, 'run-' || CAST(event_id AS VARCHAR) AS run_id, 'job-' || CAST(user_id AS VARCHAR) AS job,
    ts - to_seconds(k) AS start_time, ts AS end_time,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'partial_success' ELSE 'success' END AS status,
    CASE WHEN k >= 5 THEN k END AS rows_processed,
    CASE WHEN k >= 10 THEN k - 1 WHEN k >= 5 THEN 0 END AS rows_loaded,
    CASE WHEN k < 90 THEN user_id END AS duplicates_skipped,
    CASE WHEN event_type = 'error' THEN k + 1 END AS errors,
    CASE WHEN k <> 50 THEN CAST(floor(value * 1000) AS BIGINT) END AS total_latency_ms,
    CASE WHEN k > 20 THEN k // 25 + 1 END AS schema_version,
    CASE WHEN event_type = 'error' THEN 'error ' || CAST(k AS VARCHAR) END AS error_message,
    CASE WHEN k < 70 THEN user_id % 7 END AS throttle_events, event_type AS source
  FROM ev)"""

RUN_VIEW = """run_id, status, coalesce(schema_version, 1) AS schema_version, start_time AS started_at,
  end_time AS completed_at, coalesce(total_latency_ms, 0) AS duration_ms,
  coalesce(rows_processed, 0) AS extracted, coalesce(nullif(rows_loaded, 0), rows_processed, 0) AS loaded,
  coalesce(duplicates_skipped, 0) AS duplicates, coalesce(errors, 0) AS errors,
  coalesce(throttle_events, 0) AS throttle_events"""

REPORTS = JUDGED + """, reports AS (
  SELECT coalesce(symbol, 'none') AS run_id, coalesce(source, 'unknown') AS source, count(*) AS fetched,
    count(*) FILTER (fate = 'skipped') AS skipped, count(*) FILTER (fate <> 'skipped') AS processed,
    count(*) FILTER (fate = 'invalid') AS invalid, count(*) FILTER (fate = 'failed') AS failed,
    count(*) FILTER (fate = 'load') AS loaded
  FROM judged GROUP BY ALL)"""

TWO_RUNS = DIRTY + """, ok AS (
  SELECT * FROM judged_rule WHERE error IS NULL AND storage_ok)
, first_run AS (SELECT * FROM ok WHERE "timestamp" < TIMESTAMP '2024-01-15')
, marks AS (SELECT source, max("timestamp") AS watermark FROM first_run GROUP BY source)"""


def add(name: str, ctes: str, body: str) -> None:
    ORACLES[name] = (f"WITH {ctes}\n" if ctes else "") + body.strip()


# --- cleaning and normalising ---------------------------------------------------------------------

add("clean_numbers", r"""base AS (
  SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS m FROM lineitem)
, dressed AS (
  SELECT l_orderkey, l_linenumber, CASE l_linenumber
    WHEN 1 THEN '$' || m WHEN 2 THEN regexp_replace(m, '(\d)(\d{3})\.', '\1,\2.') WHEN 3 THEN m || ' USD'
    WHEN 4 THEN '  +' || m || 'e1 ' WHEN 5 THEN m || '.7abc' WHEN 6 THEN 'n/a' ELSE '' END AS v FROM base)
, cleaned AS (
  SELECT *, try_cast(nullif(regexp_extract(regexp_replace(v, '[,$\s]', '', 'g'),
    '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?'), '') AS DOUBLE) AS number_or_null FROM dressed)""",
    """SELECT l_orderkey, l_linenumber, coalesce(number_or_null, 0) AS number, number_or_null,
  trim(nullif(v, '')) AS text FROM cleaned""")

add("clean_timestamps", EV + """, parsed AS (
  SELECT *, CASE WHEN event_type IN ('view', 'click') THEN ts
                 WHEN event_type IN ('purchase', 'signup') THEN date_trunc('second', ts) END AS p FROM ev)""",
    """SELECT event_id, p AS or_null, coalesce(p, TIMESTAMP '2024-02-01') AS or_now,
  CASE WHEN event_type = 'error' AND k < 50 THEN date_trunc('second', ts) ELSE p END AS with_epoch,
  date_trunc('millisecond', ts) AS from_millis FROM parsed""")

add("normalize_csv", EV, """
SELECT event_id AS seq, CASE WHEN k < 10 THEN 'UNKNOWN' ELSE 'U' || CAST(user_id AS VARCHAR) END AS symbol,
  CASE WHEN k < 10 THEN 'Unknown' ELSE 'u' || CAST(user_id AS VARCHAR) END AS name,
  CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS price_usd,
  CASE WHEN k % 2 = 0 THEN CAST(k * 1000 AS DOUBLE) ELSE 0 END AS volume_24h,
  0::DOUBLE AS market_cap, 0::DOUBLE AS percent_change_24h, ts AS "timestamp", 'csv' AS source FROM ev""")

for key, source, change in (("normalize_nested", "coinpaprika", "0::DOUBLE"), ("normalize_flat", "coingecko", "0::DOUBLE")):
    record = f"""CASE WHEN k < 10 THEN 'UNKNOWN' ELSE 'U' || CAST(user_id AS VARCHAR) END AS symbol,
  CASE WHEN k < 20 THEN 'Unknown' ELSE 'User ' || CAST(user_id AS VARCHAR) END AS name,
  CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS price_usd, CAST(k AS DOUBLE) AS volume_24h,
  CASE WHEN k = 30 THEN 0 ELSE value END AS market_cap, {change} AS percent_change_24h,
  CASE WHEN k = 40 THEN date_trunc('millisecond', ts) ELSE ts END AS "timestamp", '{source}' AS source FROM ev"""
    add(key, EV, f"SELECT event_id AS seq, {record}")
    add(key.replace("normalize", "read") + "_feed_rows", EV, f"SELECT {record}")

add("read_csv_feed_rows", EV, """
SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, 'u' || CAST(user_id AS VARCHAR) AS name,
  CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS price_usd, CAST(k AS DOUBLE) AS volume_24h,
  0::DOUBLE AS market_cap, 0::DOUBLE AS percent_change_24h, ts AS "timestamp", 'csv' AS source FROM ev""")

add("read_csv_mixed_rows", EV, """
SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol,
  'User "the ' || CAST(user_id AS VARCHAR) || '", esq.' || CASE WHEN k < 50 THEN chr(10) || '(late)' ELSE '' END AS name,
  CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS price_usd, 0::DOUBLE AS volume_24h, 0::DOUBLE AS market_cap,
  0::DOUBLE AS percent_change_24h, date_trunc('second', ts) AS "timestamp", 'csv' AS source FROM ev""")

add("to_normalized", TICKS, "SELECT * FROM ticks")
add("feed_union", TICKS, "SELECT * FROM ticks")
add("feed_head", TICKS, "SELECT * FROM ticks ORDER BY seq LIMIT 10")
add("top_by_market_cap", TICKS, "SELECT * FROM ticks ORDER BY market_cap DESC NULLS LAST, seq LIMIT 20")
add("top_n_per_source", TICKS, """
SELECT * FROM ticks WHERE source IN ('view', 'click', 'purchase')
QUALIFY row_number() OVER (PARTITION BY source ORDER BY seq) <= CASE source WHEN 'purchase' THEN 3 ELSE 5 END""")

# --- column mapping and drift -----------------------------------------------------------------------

add("alias_map", EV, """
SELECT event_id AS seq, user_id AS symbol, value AS price_usd, k AS volume_24h,
  CASE WHEN k > 5 THEN props END AS "timestamp" FROM ev""")
add("column_scores", SCORES, 'SELECT feed, "column", target, round(score, 6) AS score FROM scores')
add("column_best_match", SCORES, 'SELECT feed, "column", target, round(score, 6) AS score FROM best')
add("column_mapping", SCORES, """
SELECT feed, "column", target,
  CASE WHEN score >= 0.8 THEN 'auto' WHEN score >= 0.5 THEN 'quarantine' ELSE 'skip' END AS action FROM best""")
add("mapped_rows", EV, """
SELECT event_id AS seq, 'u' || CAST(user_id AS VARCHAR) AS symbol, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS price_usd,
  CAST(k AS DOUBLE) AS percent_change_24h, event_type AS "timestamp" FROM ev""")
add("unknown_columns", HEADERS, r"""
SELECT feed, "column" FROM headers
WHERE regexp_replace(lower("column"), '[\s_]', '', 'g') NOT IN (""" + ", ".join(
    f"'{f.replace('_', '')}'" for f in UNIFIED_FIELDS) + """)
  AND "column" NOT IN (""" + ", ".join(f"'{a}'" for a in COLUMN_ALIASES) + ")")
add("feed_schema", EV + """, firsts AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS feed, k FROM ev
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)""", """
SELECT feed, c AS "column", t AS type FROM firsts, (VALUES ('k', 'number'), ('kind', 'string'), ('big', 'boolean'),
  ('user', 'object'), ('price', 'number')) v(c, t) WHERE c <> 'price' OR k % 2 = 0""")
add("schema_changed", OLD_NEW + ", " + CHANGED, "SELECT feed, changed FROM changed")
for key, a, b in (("removed_columns", "old_h", "new_h"), ("added_columns", "new_h", "old_h")):
    add(key, OLD_NEW, f'SELECT feed, "column" FROM {a} EXCEPT ALL SELECT feed, "column" FROM {b}')
add("drift_similarity", HEADERS + """, pairs AS (
  SELECT feed, "column", lag("column") OVER (PARTITION BY feed ORDER BY pos) AS previous FROM headers)""",
    f"""SELECT feed, "column", previous, round({_similarity('previous', '"column"')}, 6) AS similarity
FROM pairs WHERE previous IS NOT NULL""")
add("drift_mappings", DRIFT, "SELECT * FROM drift")
add("drift_classes", DRIFT, f"SELECT *, {STATUS} AS status FROM drift")
add("quarantine_table", DRIFT + ", " + _drift("back", "new_h", "old_h") + """, log AS (
  SELECT *, '2024-02-15' AS quarantined_at FROM drift UNION ALL SELECT *, '2024-01-31' FROM back)""", f"""
SELECT * FROM log WHERE {STATUS} = 'quarantined'
QUALIFY row_number() OVER (PARTITION BY feed, "from" ORDER BY quarantined_at DESC) = 1""")
add("schema_versions", OLD_NEW + ", " + CHANGED + """, versions AS (
  SELECT f.feed, CASE WHEN c.changed THEN 2 ELSE 1 END AS schema_version
  FROM (SELECT feed FROM old_h UNION SELECT feed FROM new_h) f LEFT JOIN changed c USING (feed))""", """
SELECT feed, schema_version FROM versions UNION ALL SELECT '*', max(schema_version) FROM versions""")

# --- validation -------------------------------------------------------------------------------------

FIELDS = 'seq, symbol, name, price_usd, volume_24h, market_cap, percent_change_24h, "timestamp", source'
add("valid_rows", DIRTY, f"SELECT {FIELDS} FROM judged_rule WHERE error IS NULL")
add("reject_reasons", DIRTY, "SELECT seq, error FROM judged_rule WHERE error IS NOT NULL")
add("storage_check", DIRTY, "SELECT seq, storage_ok FROM judged_rule")
add("validation_counts", DIRTY, """
SELECT source, count(*) FILTER (error IS NULL) AS valid, count(*) FILTER (error IS NOT NULL) AS invalid,
  count(*) AS total FROM judged_rule GROUP BY source""")
COPIES = """copies AS (
  SELECT o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS o_year, count(*) AS copies
  FROM orders GROUP BY ALL)"""
add("duplicate_keys", COPIES, "SELECT * FROM copies WHERE copies > 1")
add("duplicate_summary", COPIES, """
SELECT CAST(sum(copies) AS BIGINT) AS total_rows, count(*) AS unique_keys,
  CAST(sum(copies - 1) AS BIGINT) AS duplicates FROM copies""")

# --- incremental load -------------------------------------------------------------------------------

add("source_watermarks", TICKS, 'SELECT source, max("timestamp") AS watermark FROM ticks GROUP BY source')
add("incremental_rows", TICKS + """, marks AS (
  SELECT source, max("timestamp") AS watermark FROM ticks
  WHERE "timestamp" < TIMESTAMP '2024-01-15' AND source <> 'signup' GROUP BY source)""", """
SELECT t.* FROM ticks t LEFT JOIN marks m USING (source) WHERE watermark IS NULL OR "timestamp" > watermark""")
SAME_KEY = 't.symbol = s.symbol AND t."timestamp" = s."timestamp" AND t.source = s.source'
add("already_processed", STAGED, f"""
SELECT * FROM staged s WHERE EXISTS (SELECT 1 FROM target t WHERE {SAME_KEY})""")
add("insert_if_absent", STAGED, f"""
SELECT * FROM staged s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {SAME_KEY})
QUALIFY row_number() OVER (PARTITION BY symbol, "timestamp", source ORDER BY seq) = 1""")
add("upsert", STAGED + """, latest AS (
  SELECT * FROM staged QUALIFY row_number() OVER (PARTITION BY symbol, "timestamp", source ORDER BY seq DESC) = 1)""",
    f"""
SELECT s.symbol, s.name, s.price_usd, s.volume_24h, s.market_cap, s.percent_change_24h, s."timestamp", s.source,
  'run-2' AS run_id, coalesce(t.created_at, TIMESTAMP '2024-02-01') AS created_at
FROM latest s LEFT JOIN target t ON {SAME_KEY}
UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM latest s WHERE {SAME_KEY})""")
BATCHES = TICKS + """, batches AS (
  SELECT seq, source, row_number() OVER (PARTITION BY source ORDER BY seq) - 1 AS row_index,
    (row_number() OVER (PARTITION BY source ORDER BY seq) - 1) // 5 AS batch FROM ticks)
, progress AS (
  SELECT source, count(*) AS last_index FROM ticks
  WHERE "timestamp" < TIMESTAMP '2024-01-15' AND source <> 'signup' GROUP BY source)"""
add("batches", BATCHES, "SELECT * FROM batches")
add("batches_cut", DIRTY, """
SELECT seq, source, row_number() OVER (PARTITION BY source ORDER BY seq) - 1 AS row_index,
  (row_number() OVER (PARTITION BY source ORDER BY seq) - 1) // 5 AS batch FROM dirty""")
add("resume_rows", BATCHES, """
SELECT b.* FROM batches b LEFT JOIN progress p USING (source) WHERE row_index >= coalesce(last_index, 0)""")
add("resumed_batches", BATCHES, "SELECT source, last_index // 5 AS resumed_from_batch FROM progress")
PROGRESS_LOG = TICKS + """, log AS (
  SELECT 'snap-' || symbol AS batch_id, source,
    CASE WHEN arg_max(volume_24h, "timestamp") < 50 THEN 'run-a' ELSE 'run-b' END AS run_id,
    count(*) AS last_index, max("timestamp") AS updated_at
  FROM ticks GROUP BY symbol, source, CAST("timestamp" AS DATE))
, latest AS (
  SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY batch_id, source ORDER BY updated_at DESC) = 1)"""
add("latest_progress", PROGRESS_LOG, "SELECT * FROM latest")
add("list_progress", PROGRESS_LOG, "SELECT * FROM latest WHERE run_id = 'run-a'")
add("clear_progress", PROGRESS_LOG, """
SELECT * FROM log WHERE (batch_id, source) NOT IN (SELECT (batch_id, source) FROM latest WHERE run_id = 'run-a')""")
add("load_report", JUDGED, """
SELECT source, count(*) AS fetched, count(*) FILTER (fate = 'skipped') AS skipped_by_watermark,
  count(*) FILTER (fate <> 'skipped') AS processed, count(*) FILTER (fate = 'invalid') AS validation_errors,
  count(*) FILTER (fate = 'failed') AS failed_records, count(*) FILTER (fate = 'load') AS loaded
FROM judged GROUP BY source""")
add("failed_ids", JUDGED, """SELECT source, symbol, "timestamp" FROM judged WHERE fate = 'failed'""")
STORED = """
SELECT symbol, name, CASE WHEN "timestamp" >= TIMESTAMP '2024-01-10' THEN price_usd + 1 ELSE price_usd END AS price_usd,
  volume_24h, market_cap, percent_change_24h, "timestamp", source,
  CASE WHEN "timestamp" >= TIMESTAMP '2024-01-10' THEN 'run-2' ELSE 'run-1' END AS run_id,
  CASE WHEN "timestamp" >= TIMESTAMP '2024-01-20' THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-20' END AS created_at{}
FROM ticks"""
add("stored_tables", TICKS, STORED.format(", CAST(CAST(volume_24h AS BIGINT) AS VARCHAR) AS k"))
BODY = 'symbol, name, price_usd, volume_24h, market_cap, percent_change_24h, "timestamp", source'
add("ingest_runs", TWO_RUNS, f"""
SELECT {BODY}, 'run-1' AS run_id, TIMESTAMP '2024-01-15' AS created_at FROM first_run
UNION ALL
SELECT {BODY}, 'run-2', TIMESTAMP '2024-02-01' FROM ok LEFT JOIN marks USING (source)
WHERE watermark IS NULL OR "timestamp" > watermark""")
add("ingest_stream", TWO_RUNS, f"""
SELECT {BODY}, 'batch-0' AS run_id, TIMESTAMP '2024-02-01' AS created_at FROM ok""")

PARTS = DIRTY + """, parts AS (
  SELECT * FROM (VALUES (0, NULL, TIMESTAMP '2024-01-12'), (1, TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-20'),
    (2, TIMESTAMP '2024-01-16', NULL)) p(part, lo, hi))
, arrived AS (
  SELECT part, j.* FROM judged_rule j JOIN ev ON ev.event_id = j.seq
  JOIN parts ON (lo IS NULL OR ev.ts >= lo) AND (hi IS NULL OR ev.ts < hi OR (ev.ts IS NULL AND lo IS NULL)))
, fates AS (
  SELECT part, source, CASE WHEN error IS NOT NULL THEN 'invalid'
    WHEN "timestamp" <= (SELECT max(b."timestamp") FROM arrived b
      WHERE b.part < a.part AND b.source = a.source AND b.error IS NULL AND b.storage_ok) THEN 'skipped'
    WHEN NOT storage_ok THEN 'failed' ELSE 'load' END AS fate
  FROM arrived a)"""
add("stream_load_reports", PARTS, """
SELECT 'batch-' || part AS load_id, source, count(*) AS fetched,
  count(*) FILTER (fate = 'skipped') AS skipped_by_watermark, count(*) FILTER (fate <> 'skipped') AS processed,
  count(*) FILTER (fate = 'invalid') AS validation_errors, count(*) FILTER (fate = 'failed') AS failed_records,
  count(*) FILTER (fate = 'load') AS loaded
FROM fates GROUP BY part, source""")
# A corrected value is 1 higher, and so are the fields made of it.
add("stream_corrections", PARTS.replace("SELECT part, source, CASE", "SELECT a.*, CASE"), """
SELECT f.symbol, f.name, CASE WHEN e.k >= 50 THEN e.value + 1 + CAST(0.01 AS DOUBLE) ELSE f.price_usd END AS price_usd, f.volume_24h,
  CASE WHEN e.k >= 50 THEN (e.value + 1) * e.k ELSE f.market_cap END AS market_cap,
  CASE WHEN e.k >= 50 THEN e.value + 1 - e.k ELSE f.percent_change_24h END AS percent_change_24h,
  f."timestamp", f.source, 'batch-' || f.part AS run_id, TIMESTAMP '2024-02-01' AS created_at
FROM fates f JOIN ev e ON e.event_id = f.seq WHERE fate = 'load'""")

# --- outliers ---------------------------------------------------------------------------------------

add("explode_fields", LONG, "SELECT * FROM long")
add("trailing_stats", STATS, """
SELECT seq, symbol, field, value, n, round(mean, 6) AS mean, round(sigma, 6) AS sigma, last_value FROM stats""")
FOUND = """SELECT seq, symbol, field, value, type, CASE type WHEN 'z_score' THEN 2.5 ELSE 50 END::DOUBLE AS threshold,
  round(actual, 6) AS actual FROM found"""
add("detect_outliers", STATS, FOUND)
add("outlier_stream", STATS, FOUND)
add("detect_outliers_cut", STATS, FOUND)
add("outlier_counts", STATS, "SELECT field, type, symbol, count(*) AS outliers FROM found GROUP BY ALL")
add("outliers_per_source", STATS, """
SELECT source, count(*) AS outliers FROM found JOIN ticks USING (seq) GROUP BY source""")
for _name in ("history_stats", "stored_history"):
    add(_name, LONG, """
SELECT symbol, field, count(*) AS count, arg_max(value, seq) AS latest, round(avg(value), 6) AS mean
FROM (SELECT * FROM long QUALIFY row_number() OVER (PARTITION BY symbol, field ORDER BY seq DESC) <= 20)
GROUP BY symbol, field""")

# --- serving ----------------------------------------------------------------------------------------

add("data_filter", TICKS, """
SELECT * FROM ticks WHERE symbol = 'U7' AND "timestamp" BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25 12:00:00'""")
add("data_by_source", TICKS, """
SELECT * FROM ticks WHERE source = 'purchase' AND "timestamp" >= TIMESTAMP '2024-01-10'""")
add("data_sorted", TICKS, """
SELECT * FROM ticks ORDER BY volume_24h ASC NULLS FIRST, symbol, "timestamp", source""")
PAGE = 'SELECT * FROM ticks ORDER BY volume_24h DESC NULLS LAST, symbol, "timestamp", source LIMIT 400'
add("data_page1", TICKS, PAGE)
add("data_page2", TICKS, PAGE + " OFFSET 400")
add("stored_page2", TICKS, STORED.format(', CAST("timestamp" AS DATE) AS day') + PAGE.partition("ticks")[2] + " OFFSET 400")
NEWEST = RUNS + ", newest AS (SELECT * FROM runs ORDER BY end_time DESC NULLS LAST, run_id DESC LIMIT {})"
add("latest_run", NEWEST.format(1), """
SELECT run_id, status, end_time, coalesce(errors, 0) AS errors, coalesce(rows_processed, 0) AS rows_processed,
  coalesce(total_latency_ms, 0) AS total_latency_ms FROM newest""")
add("run_history", NEWEST.format(50), f"SELECT {RUN_VIEW} FROM newest")
add("run_detail", RUNS, f"SELECT {RUN_VIEW}, error_message FROM runs WHERE run_id = 'run-42'")
add("table_counts", DIRTY, """
SELECT 'raw' AS "table", count(*) AS rows FROM ev
UNION ALL SELECT 'normalized', count(*) FROM judged_rule WHERE error IS NULL""")
add("run_stats", NEWEST.format(20), """
SELECT coalesce(CAST(round(avg(coalesce(total_latency_ms, 0))) AS BIGINT), 0) AS latency_avg_ms,
  coalesce(round(sum(coalesce(errors, 0))::DOUBLE / (sum(coalesce(rows_processed, 0)) + 1), 4), 0) AS error_rate
FROM newest""")
add("incremental_stats", NEWEST.format(20), """
SELECT CAST(coalesce(first(coalesce(rows_processed, 0) ORDER BY end_time DESC), 0) AS BIGINT) AS last_run_new_records,
  CAST(coalesce(first(coalesce(duplicates_skipped, 0) ORDER BY end_time DESC), 0) AS BIGINT) AS last_run_skipped,
  CAST(coalesce(sum(coalesce(duplicates_skipped, 0)), 0) AS BIGINT) AS total_duplicate_prevention
FROM newest""")

# --- ledger -----------------------------------------------------------------------------------------

add("run_summary", REPORTS + """, totals AS (
  SELECT run_id, CAST(sum(fetched) AS BIGINT) AS total_fetched, CAST(sum(processed) AS BIGINT) AS valid_records,
    CAST(sum(invalid + failed) AS BIGINT) AS invalid_records, CAST(sum(invalid) AS BIGINT) AS validation_errors,
    CAST(sum(failed) AS BIGINT) AS failed_records,
    CAST(count(*) FILTER (source = 'error') AS INTEGER) AS failed_batches,
    max(fetched) FILTER (source = 'csv') AS csv_resumed
  FROM reports GROUP BY run_id)""", "SELECT t.*, r.source, r.fetched FROM totals t JOIN reports r USING (run_id)")
add("run_status", REPORTS, """
SELECT run_id, CASE WHEN bool_or(source = 'error') THEN 'partial_success' ELSE 'success' END AS status
FROM reports GROUP BY run_id""")
add("run_record", REPORTS, """
SELECT run_id, CASE WHEN bool_or(source = 'error') THEN 'partial_success' ELSE 'success' END AS status,
  CAST(sum(processed) AS BIGINT) AS rows_processed, CAST(sum(loaded) AS BIGINT) AS rows_loaded,
  CAST(sum(skipped) AS BIGINT) AS duplicates_skipped, CAST(sum(invalid + failed) AS BIGINT) AS errors,
  CAST(60000 AS BIGINT) AS total_latency_ms, max(CASE source WHEN 'csv' THEN 2 ELSE 1 END) AS schema_version,
  CAST(count(*) AS INTEGER) AS applied, CAST(count(*) AS INTEGER) AS warnings,
  CAST(count(*) FILTER (source = 'error') AS INTEGER) AS failed_batches, CAST(count(*) AS INTEGER) AS batches,
  string_agg(source, ',' ORDER BY source) AS sources, 'rank' AS skipped_fields
FROM reports GROUP BY run_id""")
LEDGER = TWO_RUNS + """, seen AS (
  SELECT j.*, 'run-1' AS run_id, NULL::TIMESTAMP AS watermark FROM judged_rule j
  WHERE "timestamp" IS NULL OR "timestamp" < TIMESTAMP '2024-01-15'
  UNION ALL SELECT j.*, 'run-2', watermark FROM judged_rule j LEFT JOIN marks USING (source))
, fates AS (
  SELECT run_id, CASE WHEN source IN ('coinpaprika', 'coingecko') THEN source ELSE 'csv' END AS feed,
    CASE WHEN error IS NOT NULL THEN 'invalid'
    WHEN watermark IS NOT NULL AND "timestamp" <= watermark THEN 'skipped'
    WHEN NOT storage_ok THEN 'failed' ELSE 'load' END AS fate
  FROM seen)"""
add("ingest_ledger", LEDGER, """
SELECT run_id, 'success' AS status, count(*) FILTER (fate <> 'skipped') AS rows_processed,
  count(*) FILTER (fate = 'load') AS rows_loaded, count(*) FILTER (fate = 'skipped') AS duplicates_skipped,
  count(*) FILTER (fate IN ('invalid', 'failed')) AS errors, 3 AS batches, 1 AS schema_version
FROM fates GROUP BY run_id""")
add("stored_summaries", LEDGER + """, by_feed AS (
  SELECT run_id, feed, count(*) AS n, count(*) FILTER (fate <> 'skipped') AS processed,
    count(*) FILTER (fate = 'invalid') AS invalid, count(*) FILTER (fate = 'failed') AS failed FROM fates GROUP BY run_id, feed)""", """
SELECT run_id, CAST(sum(n) AS BIGINT) AS total_fetched, CAST(sum(processed) AS BIGINT) AS valid_records,
  CAST(sum(invalid) + sum(failed) AS BIGINT) AS invalid_records, CAST(sum(invalid) AS BIGINT) AS validation_errors,
  CAST(sum(failed) AS BIGINT) AS failed_records, string_agg(feed || '=' || n, ',' ORDER BY feed) AS sources
FROM by_feed GROUP BY run_id""")

# --- monitoring -------------------------------------------------------------------------------------

add("counters", RUNS, """
SELECT source, status, CAST(coalesce(sum(rows_processed), 0) AS BIGINT) AS total FROM runs GROUP BY source, status""")
add("request_errors", EV + """, requests AS (
  SELECT '/' || event_type AS route, CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END AS method,
    CASE WHEN k < 70 THEN 200 WHEN k < 80 THEN 400 WHEN k < 90 THEN 404 ELSE 500 END AS status FROM ev)""", """
SELECT route, method, status, count(*) AS total FROM requests WHERE status >= 400 GROUP BY ALL""")


def _histogram(value: str, bounds: list) -> str:
    edges = ", ".join(f"({float(x)}::DOUBLE, '{float(x):.1f}')" for x in bounds)
    return EV + f""", bounds AS (
  SELECT * FROM (VALUES {edges}, ('Infinity'::DOUBLE, '+Inf')) b(edge, le))
, hist AS (
  SELECT event_type, edge, le, count(*) FILTER ({value} <= edge) AS cumulative, round(sum({value}), 4) AS sum,
    count(*) AS count
  FROM ev CROSS JOIN bounds GROUP BY event_type, edge, le)"""


HIST = "SELECT event_type, le, cumulative, sum, count FROM hist"
add("latency_histogram", _histogram("value", RUN_LATENCY_BOUNDS_S), HIST)
add("request_histogram", _histogram("(value * 10)", REQUEST_BOUNDS_MS), HIST)
add("retry_histogram", EV + """, bounds AS (
  SELECT * FROM (VALUES (0.1::DOUBLE, '0.1'), (0.5::DOUBLE, '0.5'), (1::DOUBLE, '1.0'), (2::DOUBLE, '2.0'), (5::DOUBLE, '5.0'),
    (10::DOUBLE, '10.0'), ('Infinity'::DOUBLE, '+Inf')) b(edge, le))""", """
SELECT event_type, le, count(*) FILTER (value / 20 <= edge) AS cumulative, round(sum(value / 20), 4) AS sum, count(*) AS count
FROM ev CROSS JOIN bounds WHERE value IS NOT NULL GROUP BY event_type, edge, le""")
add("errors_by_type", RUNS, """
SELECT CASE WHEN throttle_events <> 3 THEN source END AS source,
  CASE WHEN errors > 50 THEN 'timeout' WHEN errors > 20 THEN 'rate_limit' ELSE 'parse' END AS type,
  CAST(coalesce(sum(errors), 0) AS BIGINT) AS total
FROM runs WHERE status = 'failed' GROUP BY ALL""")
add("throttles_by_source", RUNS, """
SELECT source, CAST(coalesce(sum(throttle_events), 0) AS BIGINT) AS total FROM runs GROUP BY source""")
add("latency_quantile", _histogram("value", RUN_LATENCY_BOUNDS_S) + """, steps AS (
  SELECT *, lag(edge, 1, 0.0::DOUBLE) OVER w AS low, lag(cumulative, 1, 0) OVER w AS below
  FROM hist WINDOW w AS (PARTITION BY event_type ORDER BY edge))""", """
SELECT event_type, label AS q, round(CASE WHEN isinf(edge) THEN low
    ELSE low + (edge - low) * ((q * count - below) / (cumulative - below)) END, 6) AS quantile
FROM steps CROSS JOIN (VALUES (0.95::DOUBLE, '0.95'), (0.5::DOUBLE, '0.50')) v(q, label)
WHERE cumulative >= q * count
QUALIFY row_number() OVER (PARTITION BY event_type, q ORDER BY edge) = 1""")
RATE = """
SELECT time_bucket(INTERVAL '5 minutes', "timestamp") AS window_start, source, round(count(*) / 300.0::DOUBLE, 9) AS rate
FROM ticks GROUP BY ALL"""
add("rate_5m", TICKS, RATE)
add("rate_stream", TICKS, RATE)
add("rate_5m_sliding", TICKS, """
SELECT date_trunc('minute', "timestamp") - to_minutes(CAST(back AS INTEGER)) AS window_start, source,
  round(count(*) / 300.0::DOUBLE, 9) AS rate
FROM ticks CROSS JOIN range(5) r(back) GROUP BY ALL""")


def _colour(value: str, steps: list) -> str:
    cases = " ".join(f"WHEN {value} >= {limit} THEN '{label}'" for limit, label in sorted(steps, reverse=True))
    return f"CASE {cases} END AS {value}_status"


add("threshold_status", RUNS + """, totals AS (
  SELECT job, CAST(sum(rows_processed) AS BIGINT) AS rows, CAST(sum(coalesce(errors, 0)) AS BIGINT) AS errors,
    count(*) FILTER (status = 'failed') AS outliers FROM runs GROUP BY job)""",
    f"""SELECT *, {_colour('rows', ROW_STEPS)}, {_colour('errors', ERROR_STEPS)}, {_colour('outliers', OUTLIER_STEPS)}
FROM totals""")
add("quota_usage", EV + f""", requests AS (
  SELECT {MAPPED_SOURCE} AS source, date_trunc('minute', ts) AS minute FROM ev)
, per_minute AS (
  SELECT source, minute, count(*) AS requests, CASE source WHEN 'coinpaprika' THEN 10 ELSE 3 END AS quota,
    CASE source WHEN 'coinpaprika' THEN 15 ELSE 5 END AS burst
  FROM requests WHERE source IN ('coinpaprika', 'coingecko') GROUP BY source, minute)""", """
SELECT *, requests > quota AS over_quota, requests > burst AS over_burst FROM per_minute""")
add("failure_streaks", RUNS + """, islands AS (
  SELECT seq, job, status,
    count(*) FILTER (status <> 'failed') OVER (PARTITION BY job ORDER BY seq) AS island FROM runs)""", """
SELECT seq, job, status, streak, streak % 3 = 0 AS alert FROM (
  SELECT *, row_number() OVER (PARTITION BY job, island ORDER BY seq) AS streak
  FROM islands WHERE status = 'failed')""")
add("failure_streaks_cut", EV + """, keyed AS (
  SELECT event_id AS seq, CASE WHEN k <> 16 THEN event_type END AS source,
    CASE WHEN event_id % 4 > 0 OR event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'partial_success'
         ELSE 'success' END AS status FROM ev)
, islands AS (
  SELECT *, count(*) FILTER (status <> 'failed') OVER (PARTITION BY source ORDER BY seq) AS island FROM keyed)""", """
SELECT seq, source, status, streak, streak % 3 = 0 AS alert FROM (
  SELECT *, row_number() OVER (PARTITION BY source, island ORDER BY seq) AS streak
  FROM islands WHERE status = 'failed')""")
add("latest_gauge", TICKS, "SELECT source, arg_max(price_usd, seq) AS value FROM ticks GROUP BY source")
