"""Independent SQL (DuckDB dialect) for every registered query.

Written from the operator semantics, not generated from the Spark code: the
shared scenario (two event batches, their SCD2 history, replay key sets,
the page manifest) is spelled out once as CTEs below.
"""

from __future__ import annotations

BRONZE = """bronze AS (
  SELECT event_id, ts, user_id, event_type, value,
    CAST(CASE WHEN ts <= TIMESTAMP '2024-01-15 00:00:00' THEN 1 ELSE 2 END AS BIGINT) AS pipeline_batch_id,
    CASE WHEN ts <= TIMESTAMP '2024-01-15 00:00:00' THEN TIMESTAMP '2024-01-15 01:00:00'
         ELSE TIMESTAMP '2200-01-01 00:00:00' END AS bronze_load_ts
  FROM events WHERE ts <= TIMESTAMP '2200-01-01 00:00:00')"""

# Bronze as landed by two pipeline runs: the load timestamp is each run's instant.
RUN_BRONZE = BRONZE.replace("THEN TIMESTAMP '2024-01-15 01:00:00'", "THEN TIMESTAMP '2024-01-15 00:00:00'")

# Bronze as landed by four weekly runs (load timestamp = run instant).
WEEKLY_BRONZE = """bronze AS (
  SELECT event_id, ts, user_id, event_type, value,
    CAST(CASE WHEN ts <= TIMESTAMP '2024-01-08 00:00:00' THEN 1 WHEN ts <= TIMESTAMP '2024-01-15 00:00:00' THEN 2
              WHEN ts <= TIMESTAMP '2024-01-22 00:00:00' THEN 3 ELSE 4 END AS BIGINT) AS pipeline_batch_id,
    CASE WHEN ts <= TIMESTAMP '2024-01-08 00:00:00' THEN TIMESTAMP '2024-01-08 00:00:00'
         WHEN ts <= TIMESTAMP '2024-01-15 00:00:00' THEN TIMESTAMP '2024-01-15 00:00:00'
         WHEN ts <= TIMESTAMP '2024-01-22 00:00:00' THEN TIMESTAMP '2024-01-22 00:00:00'
         ELSE TIMESTAMP '2200-01-01 00:00:00' END AS bronze_load_ts
  FROM events WHERE ts <= TIMESTAMP '2200-01-01 00:00:00')"""

HIST = """hist AS (
  SELECT event_id, ts, user_id, event_type, value, ts AS effective_from,
    LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, bronze_load_ts ASC NULLS LAST) AS effective_to,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, bronze_load_ts DESC NULLS LAST) = 1 AS is_current,
    pipeline_batch_id, bronze_load_ts
  FROM bronze)"""

# Run 2 failed its gate after landing; run 7 landed everything after run 1's mark again.
RELANDED_BRONZE = """bronze AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(1 AS BIGINT) AS pipeline_batch_id, TIMESTAMP '2024-01-15 00:00:00' AS bronze_load_ts
  FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'
  UNION ALL SELECT event_id, ts, user_id, event_type, value, 2, TIMESTAMP '2024-01-22 00:00:00'
  FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00' AND ts <= TIMESTAMP '2024-01-22 00:00:00'
  UNION ALL SELECT event_id, ts, user_id, event_type, value, 7, TIMESTAMP '2200-01-01 00:00:00'
  FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00')"""

KEYS = """keys AS (
  SELECT DISTINCT user_id FROM bronze
  WHERE ts >= TIMESTAMP '2024-01-29 00:00:00' AND ts < TIMESTAMP '2024-01-29 06:00:00')"""

EKEYS = """ekeys AS (SELECT DISTINCT user_id FROM bronze WHERE user_id IN (3, 7, 11) OR value > 200)"""

HIST_COLS = "event_id, ts, user_id, event_type, value, effective_from, effective_to, is_current, pipeline_batch_id, bronze_load_ts"

def _spoiled(keys: str) -> str:
    """History after a partial replay of spoiled tables: keys outside the scope
    keep the marked current rows only."""
    return (f"SELECT event_id, ts, user_id, CASE WHEN inside THEN event_type ELSE 'damaged' END AS event_type, value, effective_from, "
            f"effective_to, is_current, pipeline_batch_id, bronze_load_ts "
            f"FROM (SELECT *, user_id IN (SELECT user_id FROM {keys}) AS inside FROM hist) WHERE inside OR is_current")


PBRONZE = """pbronze AS (
  SELECT p_partkey, p_name, p_retailprice, TIMESTAMP '2024-01-01 00:00:00' AS chg_ts,
         CAST(1 AS BIGINT) AS pipeline_batch_id, TIMESTAMP '2024-01-01 01:00:00' AS bronze_load_ts FROM part
  UNION ALL
  SELECT p_partkey, p_name,
         CASE WHEN p_partkey % 10 = 0 THEN p_retailprice * 2 ELSE p_retailprice END,
         CASE WHEN p_partkey % 10 = 0 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END,
         CAST(2 AS BIGINT), TIMESTAMP '2024-01-02 01:00:00' FROM part)"""

MANIFEST = """manifest AS (
  SELECT page_id AS slug,
    ['#2563eb', '#059669', '#dc2626', '#7c3aed', '#d97706', '#0d9488'][CAST(page_id % 6 AS INTEGER) + 1] AS accent,
    ['#3b82f6', '#10b981', '#ef4444', '#8b5cf6', '#f59e0b', '#14b8a6'][CAST(page_id % 6 AS INTEGER) + 1] AS accent2
  FROM pages
  UNION ALL SELECT MAX(page_id) + 1, '#000000', '#111111' FROM pages)"""

TITLE_RE = "(?i)<title>(.*?)</title>"
BODY_RE = "(?is)<body[^>]*>(.*)</body>"

RENDERED = f"""rendered AS (
  SELECT m.slug, m.accent, m.accent2, p.page_id,
    CASE WHEN regexp_matches(p.html, '{TITLE_RE}') THEN regexp_extract(p.html, '{TITLE_RE}', 1)
         ELSE CAST(m.slug AS VARCHAR) END AS title,
    regexp_extract(p.html, '{BODY_RE}', 1) AS body,
    CASE WHEN p.page_id IS NULL THEN 'SOURCE_NOT_FOUND'
         WHEN NOT coalesce(regexp_matches(p.html, '{BODY_RE}'), false) THEN 'NO_BODY'
         ELSE 'CREATED' END AS status
  FROM manifest m LEFT JOIN pages p ON p.page_id = m.slug)"""

TEMPLATE = "<title>%%TITLE%%</title><i fill=\"%%ACCENT_ENC%%\"/><style>a{color:%%ACCENT%%;border:%%ACCENT2%%}</style><a href=\"%%SLUG%%.html\">"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {
    "src_table": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "src_sql": (
        "SELECT o.o_orderkey, o.o_totalprice, c.c_mktsegment FROM orders o "
        "JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'F'"
    ),
    "src_union_all": "SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region",
    "extract_full": "SELECT event_id, ts, user_id FROM events",
    "extract_first_run": "SELECT event_id, ts, user_id FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'",
    "extract_incremental": (
        "SELECT event_id, ts, user_id FROM events "
        "WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'"
    ),
    "extract_sequence": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey > 7000",
    "high_water_mark": "SELECT MAX(ts) AS max_value FROM events",
    "watermark_text": (
        "SELECT event_id, CAST(ts AS VARCHAR) AS mark_ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS mark_date, "
        "CAST(event_id AS VARCHAR) AS mark_seq FROM events"
    ),
    "watermark_cast": (
        "SELECT event_id FROM events WHERE event_id > CAST('500' AS BIGINT) "
        "AND ts > CAST('2024-01-10 00:00:00' AS TIMESTAMP) AND ts > CAST('2024-01-05' AS DATE)"
    ),
    "next_batch_id": "SELECT CAST(COALESCE(MAX(o_orderkey), 0) + 1 AS BIGINT) AS next_batch_id FROM orders",
    "record_hash": (
        "SELECT c_custkey, sha256(CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, "
        "'c_nationkey': c_nationkey}) AS VARCHAR)) AS record_hash FROM customer"
    ),
    "bronze_enrich": (
        "SELECT c_custkey, c_name, c_nationkey, CAST(1001 AS BIGINT) AS pipeline_batch_id, "
        "TIMESTAMP '2024-02-01 00:00:00' AS bronze_load_ts, 'customer' AS source_name, 'FULL' AS load_mode, "
        "sha256(CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey}) AS VARCHAR)) "
        "AS record_hash FROM customer"
    ),
    "latest_per_key": _with(BRONZE, HIST) + "SELECT user_id, event_id, ts FROM hist WHERE is_current",
    "effective_ranges": _with(BRONZE, HIST) + "SELECT user_id, effective_from, effective_to FROM hist",
    "scd2_history": _with(BRONZE, HIST) + f"SELECT {HIST_COLS} FROM hist",
    "scd2_current": _with(BRONZE, HIST) + f"SELECT {HIST_COLS} FROM hist WHERE is_current",
    "scd2_current_cdc": _with(
        BRONZE, HIST,
        "flagged AS (SELECT *, CASE WHEN event_type = 'error' THEN 'y' WHEN event_type = 'view' THEN NULL "
        "ELSE 'n' END AS del_flag FROM hist)",
    ) + (
        f"SELECT {HIST_COLS}, del_flag FROM flagged WHERE is_current "
        "AND NOT (UPPER(CAST(del_flag AS VARCHAR)) IN ('Y', 'YES', 'TRUE', '1', 'D'))"
    ),
    "scd2_current_null_live": _with(
        BRONZE, HIST,
        "flagged AS (SELECT *, CASE WHEN event_type = 'error' THEN 'YES' WHEN event_type = 'view' THEN NULL "
        "ELSE 'no' END AS del_flag FROM hist)",
    ) + (
        f"SELECT {HIST_COLS}, del_flag FROM flagged WHERE is_current "
        "AND (del_flag IS NULL OR NOT (UPPER(CAST(del_flag AS VARCHAR)) IN ('Y', 'YES', 'TRUE', '1', 'D')))"
    ),
    "scd2_hot_split": _with(BRONZE, HIST) + f"SELECT {HIST_COLS} FROM hist",
    "scd2_sequence": (
        "SELECT o_custkey, o_orderkey, o_orderstatus, o_orderkey AS effective_from, "
        "LEAD(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS effective_to, "
        "ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1 AS is_current FROM orders"
    ),
    "scd2_composite_key": (
        "SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice, o_orderkey AS effective_from, "
        "LEAD(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS effective_to, "
        "ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) = 1 AS is_current "
        "FROM orders"
    ),
    "scd2_full_snapshots": _with(PBRONZE) + (
        "SELECT p_partkey, p_name, p_retailprice, chg_ts AS effective_from, "
        "LEAD(chg_ts) OVER (PARTITION BY p_partkey ORDER BY chg_ts, bronze_load_ts) AS effective_to, "
        "ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY chg_ts DESC, bronze_load_ts DESC) = 1 AS is_current, "
        "pipeline_batch_id, bronze_load_ts FROM pbronze"
    ),
    "gold_snapshot": _with(BRONZE, HIST) + f"SELECT {HIST_COLS} FROM hist WHERE is_current",
    "impacted_keys": _with(BRONZE, KEYS) + "SELECT user_id FROM keys",
    "anti_remaining": _with(BRONZE, HIST, KEYS) + (
        f"SELECT {HIST_COLS} FROM hist h WHERE NOT EXISTS (SELECT 1 FROM keys k WHERE k.user_id = h.user_id)"
    ),
    "replay_date_range_scope": _with(BRONZE, KEYS) + (
        "SELECT b.* FROM bronze b WHERE EXISTS (SELECT 1 FROM keys k WHERE k.user_id = b.user_id)"
    ),
    "replay_entity_scope": _with(BRONZE, EKEYS) + (
        "SELECT b.* FROM bronze b WHERE EXISTS (SELECT 1 FROM ekeys k WHERE k.user_id = b.user_id)"
    ),
    "rewrite_impacted": _with(
        BRONZE, HIST,
        "old AS (SELECT event_id, user_id, ts AS effective_from, "
        "LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) AS effective_to FROM bronze WHERE pipeline_batch_id = 1)",
        "k2 AS (SELECT DISTINCT user_id FROM bronze WHERE pipeline_batch_id = 2 AND value > 190)",
    ) + (
        "SELECT * FROM old WHERE user_id NOT IN (SELECT user_id FROM k2) "
        "UNION ALL SELECT event_id, user_id, effective_from, effective_to FROM hist "
        "WHERE user_id IN (SELECT user_id FROM k2)"
    ),
    "union_by_name_evolve": (
        "SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS extra FROM customer "
        "WHERE c_mktsegment = 'BUILDING' "
        "UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment IS DISTINCT FROM 'BUILDING'"
    ),
    "replay_date_range_rebuild": _with(RUN_BRONZE, HIST, KEYS) + _spoiled("keys"),
    "replay_entity_rebuild": _with(RUN_BRONZE, HIST, EKEYS) + _spoiled("ekeys"),
    "replay_after_failed_run": _with(RELANDED_BRONZE, HIST) + f"SELECT {HIST_COLS} FROM hist",
    "replay_empty_scope": _with(BRONZE) + (
        "SELECT 'COMPLETED' AS request_status, 'REPLAY_ENTITY' AS run_mode, 'SUCCESS' AS run_status, 'NO_DATA' AS quality_status, "
        "CAST(0 AS BIGINT) AS rows_read, COUNT(*) AS history_rows FROM bronze"),
    "run_log_rows": _with(BRONZE) + (
        "SELECT b.batch_id, 'events' AS source_name, 'PIPELINE_INCREMENTAL_TS' AS run_mode, 'SUCCESS' AS run_status, "
        "COUNT(*) FILTER (pipeline_batch_id = b.batch_id) AS rows_read, COUNT(*) FILTER (pipeline_batch_id = b.batch_id) AS bronze_rows_written, "
        "COUNT(*) + COUNT(DISTINCT user_id) AS silver_rows_written, COUNT(DISTINCT user_id) AS gold_rows_written, 'PASSED' AS quality_status, "
        "strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(MAX(ts)) % 1000000 = 0 THEN '' "
        "ELSE rtrim('.' || lpad(CAST(microsecond(MAX(ts)) % 1000000 AS VARCHAR), 6, '0'), '0') END AS watermark_value "
        "FROM bronze JOIN (SELECT CAST(unnest([1, 2]) AS BIGINT) AS batch_id) b ON pipeline_batch_id <= b.batch_id GROUP BY b.batch_id"),
    "quality_rows": _with(BRONZE) + (
        "SELECT pipeline_batch_id AS batch_id, 'bronze_row_count' AS rule_name, 'PASSED' AS rule_status, CAST(COUNT(*) AS VARCHAR) AS observed_value, "
        "'>= 0' AS expected_value FROM bronze GROUP BY 1 UNION ALL "
        "SELECT CAST(b AS BIGINT), 'required_columns_present', CASE b WHEN 1 THEN 'PASSED' ELSE 'FAILED' END, "
        "'event_id, ts, user_id, event_type, value, pipeline_batch_id, bronze_load_ts, source_name, load_mode, record_hash', "
        "CASE b WHEN 1 THEN 'event_id, ts, user_id' ELSE 'event_id, missing_column' END FROM (SELECT unnest([1, 2]) AS b)"),
    "registry_rows": (
        "SELECT n_name AS source_name, 'src_' || n_nationkey AS source_object, 'CDC' AS load_mode, n_nationkey % 5 <> 0 AS enabled, "
        "'demo.bronze.n' || n_nationkey AS bronze_table, CASE WHEN rn <= 3 THEN 'mark-' || n_nationkey END AS last_successful_watermark, "
        "CASE WHEN rn <= 3 THEN CAST(7 AS BIGINT) END AS last_batch_id FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY n_nationkey) AS rn FROM nation)"),
    "active_sources": (
        "SELECT CAST(ROW_NUMBER() OVER (ORDER BY n_name) - 1 AS INTEGER) AS position, n_name AS source_name FROM nation WHERE n_nationkey % 5 <> 0"),
    "requested_replays": (
        "SELECT CAST(ROW_NUMBER() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS position, CAST(n_nationkey AS BIGINT) AS replay_request_id "
        "FROM nation WHERE n_nationkey % 4 <> 0"),
    "replay_full_rebuild": _with(RUN_BRONZE, HIST) + f"SELECT {HIST_COLS} FROM hist",
    "run_all_sources": (
        "WITH n AS (SELECT 'customer' AS source_name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders "
        "UNION ALL SELECT 'product', count(*) FROM part UNION ALL SELECT 'invoice', count(*) FROM orders WHERE o_orderstatus <> 'P' "
        "UNION ALL SELECT 'shipment', count(DISTINCT l_orderkey) FROM lineitem) "
        "SELECT row_number() OVER (ORDER BY source_name) AS batch_id, source_name, 'PIPELINE_FULL' AS run_mode, 'SUCCESS' AS run_status, "
        "'PASSED' AS quality_status, n AS rows_read, 2 * n AS silver_rows_written, n AS gold_rows_written FROM n"),
    "serving_table": (
        "WITH s AS (SELECT l_orderkey, min(l_partkey) AS l_partkey, max(l_linestatus) AS l_linestatus, max(l_returnflag) AS l_returnflag, "
        "max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_orderkey) "
        "SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_location, l_partkey AS product_id, "
        "p_name AS product_name, p_brand AS category, o_orderstatus AS order_status, "
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderkey + 1000000 END AS invoice_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS invoice_status, "
        "l_orderkey * 10 AS shipment_id, l_linestatus AS shipment_status, l_returnflag AS warehouse_code, o_totalprice AS order_amount, "
        "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS invoice_amount, p_retailprice AS unit_price, CAST(o_orderdate AS DATE) AS order_date, "
        "greatest(CAST(o_orderdate AS TIMESTAMP), CAST(l_shipdate AS TIMESTAMP), CASE WHEN p_partkey IS NOT NULL THEN TIMESTAMP '1992-01-02 00:00:00' END, "
        "CASE WHEN c_custkey IS NOT NULL THEN TIMESTAMP '1992-01-01 00:00:00' END) AS serving_effective_from "
        "FROM orders LEFT JOIN s ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN part ON p_partkey = l_partkey"),
    "list_tables": (
        "WITH e AS (SELECT count(*) AS n, count(DISTINCT user_id) AS k FROM events WHERE ts <= TIMESTAMP '2200-01-01 00:00:00') "
        "SELECT 'demo.bronze.events' AS table_name, n AS n_rows FROM e UNION ALL SELECT 'demo.silver.events_history', n FROM e "
        "UNION ALL SELECT 'demo.silver.events_current', k FROM e UNION ALL SELECT 'demo.gold.events', k FROM e"),
    "two_batch_run": _with(BRONZE, HIST) + (
        "SELECT user_id, event_id, effective_from, pipeline_batch_id FROM hist WHERE is_current"
    ),
    "fold_incremental": _with(WEEKLY_BRONZE, HIST) + f"SELECT {HIST_COLS} FROM hist",
    "fold_full": _with(WEEKLY_BRONZE, HIST) + f"SELECT {HIST_COLS} FROM hist",
    "snapshot_restore": _with(BRONZE) + (
        "SELECT user_id, MAX(ts) AS effective_from FROM bronze WHERE pipeline_batch_id = 1 GROUP BY user_id"
    ),
    "run_metrics": _with(BRONZE, HIST) + (
        "SELECT (SELECT COUNT(*) FROM bronze) AS rows_read, "
        "(SELECT COUNT(*) FROM hist) + (SELECT COUNT(*) FROM hist WHERE is_current) AS silver_rows_written, "
        "(SELECT COUNT(*) FROM hist WHERE is_current) AS gold_rows_written"
    ),
    "merge_upsert": _with(
        "src AS (SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_mktsegment = 'AUTOMOBILE' "
        "UNION ALL SELECT c_custkey + 1000000, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'AUTOMOBILE')"
    ) + (
        "SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey, "
        "CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name, "
        "CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal, "
        "CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment END AS preserved "
        "FROM customer t FULL OUTER JOIN src s ON t.c_custkey = s.c_custkey"
    ),
    "keyed_update": (
        "SELECT o_orderkey, CASE WHEN o_orderkey = 7 AND o_custkey >= 0 THEN 'SUCCESS' ELSE o_orderstatus END "
        "AS run_status FROM orders"
    ),
    "status_transition": (
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'RUNNING' WHEN o_orderstatus = 'F' THEN 'COMPLETED' "
        "ELSE o_orderstatus END AS request_status, "
        "CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE o_orderdate END AS started_ts, "
        "CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE o_orderdate END AS completed_ts "
        "FROM orders"
    ),
    "dq_row_count": (
        "SELECT 'bronze_row_count' AS rule_name, CASE WHEN COUNT(*) > 0 THEN 'PASSED' ELSE 'NO_DATA' END AS rule_status, "
        "CAST(COUNT(*) AS VARCHAR) AS observed_value, '>= 0' AS expected_value, "
        "'Basic completeness check for the bronze landing set.' AS details FROM events"
    ),
    "dq_required_columns": (
        "SELECT 'required_columns_present' AS rule_name, 'FAILED' AS rule_status, "
        "(SELECT string_agg(column_name, ', ' ORDER BY column_index) FROM duckdb_columns() "
        " WHERE table_name = 'events' AND schema_name = 'main') AS observed_value, "
        "'event_id, ts, missing_col' AS expected_value, 'Missing columns: missing_col' AS details"
    ),
    "parse_registration": (
        "SELECT n_nationkey, 'FULL' AS load_mode, CONCAT(n_name, '|', CAST(n_nationkey AS VARCHAR)) AS primary_keys "
        "FROM nation"
    ),
    "options_parse": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "serving_order_fulfilment": (
        "SELECT o.o_orderkey, o.o_custkey, c.c_name AS customer_name, c.c_mktsegment AS customer_segment, "
        "l.l_partkey, p.p_name, p.p_brand, o.o_orderstatus, l.l_linenumber, l.l_linestatus, s.s_name, "
        "o.o_totalprice, l.l_extendedprice, p.p_retailprice, o.o_orderdate, "
        "GREATEST(o.o_orderdate, l.l_shipdate) AS serving_effective_from "
        "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
        "LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey LEFT JOIN part p ON l.l_partkey = p.p_partkey "
        "LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey"
    ),
    "skew_join_salted": (
        "SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_partkey "
        "FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey"
    ),
    "serving_sparse": (
        "SELECT o.o_orderkey, c.c_name, p.p_name, GREATEST(o.o_orderdate, p.d) AS serving_effective_from "
        "FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING') c "
        "ON o.o_custkey = c.c_custkey LEFT JOIN (SELECT p_partkey, p_name, TIMESTAMP '1999-01-01 00:00:00' AS d "
        "FROM part WHERE p_size > 25) p ON o.o_orderkey = p.p_partkey"
    ),
    "page_title": _with(MANIFEST, RENDERED) + "SELECT page_id, title FROM rendered WHERE page_id IS NOT NULL",
    "page_body": _with(MANIFEST, RENDERED) + "SELECT page_id, body FROM rendered WHERE status = 'CREATED'",
    "page_status": _with(MANIFEST, RENDERED) + "SELECT slug, status FROM rendered",
    "page_render": _with(MANIFEST, RENDERED) + (
        "SELECT slug, CONCAT(REPLACE(REPLACE(REPLACE(REPLACE(REPLACE("
        f"'{TEMPLATE}', '%%TITLE%%', title), '%%ACCENT%%', accent), '%%ACCENT2%%', accent2), "
        "'%%ACCENT_ENC%%', REPLACE(accent, '#', '%23')), '%%SLUG%%', CAST(slug AS VARCHAR)), "
        "body, chr(10), '</body>', chr(10), '</html>') AS page FROM rendered WHERE status = 'CREATED'"
    ),
}
