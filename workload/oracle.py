"""The same results in plain SQL over the given tables, for DuckDB."""

from __future__ import annotations

_STAMPS = (
    "TIMESTAMP '2025-01-01 00:00:00' AS retention_added_at, "
    "TIMESTAMP '2025-01-01 00:00:00' + INTERVAL 180 DAY AS retention_expires_at"
)

# Every nation's connection, warehouse and retention, as its config states them.
_NATIONS = """
nations AS (
  SELECT n_nationkey, n_name, n_name || '_dev' AS connection, 'db.' || lower(n_name) AS connection_value,
         's3://' || lower(r_name) || '.archive' AS warehouse, (n_nationkey + 1) || 'm' AS retention
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_KEPT = """
candidates AS (
  SELECT n.*, c_mktsegment AS table_schema, c_name AS table_name,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS source_pos,
         n_name || CASE WHEN c_mktsegment = 'FURNITURE' THEN '-whole' ELSE '-picked' END AS source_name,
         c_mktsegment = 'FURNITURE' OR (
           (regexp_matches(c_name, '^(?:Customer#0+1)') OR regexp_matches(c_name, '^(?:.*5$)'))
           AND NOT regexp_matches(c_name, '^(?:.*7)')) AS kept
  FROM customer JOIN nations n ON c_nationkey = n_nationkey
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')
),
discovered AS (SELECT * FROM candidates WHERE kept)"""

_MANIFEST = """
jobs AS (
  SELECT source_name, source_pos, table_schema AS source_schema, table_name AS source_table,
         connection_value AS glue_connection_name,
         warehouse || '/' || connection || '/' || table_schema || '/' || table_name || '/' AS target_s3_path,
         'archive_' || connection AS target_glue_db, table_schema || '_' || table_name AS target_glue_table,
         retention AS retention_policy_value
  FROM discovered
)"""

_DATED_ORDERS = """
dated AS (
  SELECT *, o_orderdate + CASE WHEN o_orderpriority = '1-URGENT' THEN INTERVAL 365 DAY ELSE INTERVAL 180 DAY END
         AS retention_expires_at
  FROM orders
)"""

_ARCHIVED_ORDERS = """
stamped AS (
  SELECT *,
    CASE WHEN o_orderdate < DATE '1997-01-01' THEN 'orders_old' WHEN o_orderdate < DATE '2000-01-01' THEN 'orders_middle'
         ELSE 'orders_new' END AS table_name
  FROM orders
), archived AS (
  SELECT *,
    CASE table_name WHEN 'orders_old' THEN TIMESTAMP '1997-01-01' WHEN 'orders_middle' THEN TIMESTAMP '2000-01-01'
         ELSE TIMESTAMP '2001-08-02 12:00:00' END AS retention_added_at,
    CASE table_name WHEN 'orders_old' THEN TIMESTAMP '1997-01-01' + INTERVAL 365 DAY
         WHEN 'orders_middle' THEN TIMESTAMP '2000-01-01' + INTERVAL 180 DAY
         ELSE TIMESTAMP '2001-08-02 12:00:00' + INTERVAL 10 DAY END AS retention_expires_at
  FROM stamped
)"""


def _counts(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS row_count FROM {n}" for n in names)


ORACLE = {
    "jdbc_scan_orders": "SELECT * FROM orders",
    "jdbc_scan_hot_key": "SELECT * FROM lineitem",
    "jdbc_archive_run": f"""
        SELECT 'tpch' AS source_name, 'main' AS source_schema, name AS source_table, 'main_' || name AS target_table,
               row_count, 'archived' AS status
        FROM ({_counts(["customer", "orders", "supplier"])})""",
    "inventory_scan": """
        SELECT c_mktsegment AS table_schema, c_name AS table_name FROM customer
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "config_lookup": """
        SELECT event_id, json_extract_string(props, '$.k') AS k,
               CASE WHEN event_type = 'error' THEN json_extract_string(props, '$.k') ELSE 'none' END AS by_column,
               '{"name":"' || event_type || '","value":"' || json_extract_string(props, '$.k') || '"}' AS document
        FROM events""",
    "retention_stamp_orders": f"SELECT *, {_STAMPS} FROM orders",
    "retention_days": """
        WITH units AS (
          SELECT event_id, user_id, event_id % 3 AS u,
                 CASE WHEN event_type = 'error' THEN 'w' WHEN event_id % 3 = 0 THEN 'd'
                      WHEN event_id % 3 = 1 THEN 'M' ELSE 'y' END AS unit
          FROM events)
        SELECT event_id, user_id || unit AS literal, unit <> 'w' AS well_formed,
               CASE unit WHEN 'd' THEN user_id WHEN 'M' THEN user_id * 30 WHEN 'y' THEN user_id * 365 END AS days
        FROM units""",
    "address_parts": """
        WITH hosts AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM pages)
        SELECT page_id, host AS bucket, lower(host) AS host, page_id % 1000 + 5000 AS port,
               'db_' || page_id AS "database"
        FROM hosts""",
    "archive_roundtrip_lineitem": f"SELECT *, {_STAMPS} FROM lineitem",
    "archive_roundtrip_arrays": """
        SELECT vec_id, label, unnest(range(len(embedding))) AS position,
               CAST(unnest(embedding) AS DOUBLE) AS value,
               TIMESTAMP '2025-01-01 00:00:00' AS retention_added_at
        FROM embeddings""",
    "archive_replace": """
        SELECT o_orderkey, upper(o_orderstatus) AS status, TIMESTAMP '2025-01-01 00:00:00' AS first_added_at,
               TIMESTAMP '2025-01-02 00:00:00' AS retention_added_at,
               TIMESTAMP '2025-01-02 00:00:00' + INTERVAL 365 DAY AS retention_expires_at
        FROM orders""",
    "archive_many_status": f"""
        SELECT name AS source_table, 'main_' || name AS target_table, row_count, 'archived' AS status
        FROM ({_counts(["customer", "orders", "lineitem", "embeddings"])})
        UNION ALL SELECT 'no_such_table', 'main_no_such_table', NULL, 'failed'
        UNION ALL SELECT name, 'main_places', NULL, 'refused' FROM ({_counts(["nation", "region"])})""",
    "archive_default_time": """
        SELECT o_orderstatus, count(*) AS row_count, true AS stamped_now, 1 AS times, 180 AS days
        FROM orders GROUP BY o_orderstatus""",
    "archive_read_while_replaced": """
        SELECT 'held' AS version, o_orderstatus, count(*) AS row_count, max(o_orderkey) AS newest
        FROM orders GROUP BY o_orderstatus
        UNION ALL SELECT 'current', o_orderstatus, count(*), max(o_orderkey)
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderstatus""",
    "archive_resume": f"""
        SELECT name AS source_table, row_count, 'archived' AS status,
               CASE WHEN name IN ('customer', 'orders') THEN TIMESTAMP '2025-01-02' ELSE TIMESTAMP '2025-01-03' END AS added_at
        FROM ({_counts(["customer", "orders", "part", "supplier"])})""",
    "archive_listing": f"""
        SELECT 'main_' || name AS table_name, row_count,
               TIMESTAMP '2025-01-01 00:00:00' + INTERVAL 180 DAY AS expires_at
        FROM ({_counts(["nation", "part", "supplier", "documents"])})""",
    "archive_run_log": f"""
        SELECT 'main' AS source_schema, name AS source_table, '6m' AS retention_policy,
               TIMESTAMP '2025-01-01 00:00:00' AS added_at,
               TIMESTAMP '2025-01-01 00:00:00' + INTERVAL 180 DAY AS expires_at, row_count, 'archived' AS status
        FROM ({_counts(["orders", "events"])} UNION ALL {_counts(["events"])})""",
    "purge_report": f"""
        SELECT 'main_' || name AS table_name, false AS dropped_by_listing, true AS dropped, row_count,
               false AS database_left
        FROM ({_counts(["customer", "orders", "pages"])})""",
    "inventory_filter": """
        SELECT c_mktsegment AS table_schema, c_name AS table_name FROM customer
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
          AND (regexp_matches(c_name, '^(?:Customer#0+1)') OR regexp_matches(c_name, '^(?:(Cust).*5)'))
          AND NOT (regexp_matches(c_name, '^(?:.*7)') OR regexp_matches(c_name, '^(?:x|.*9)'))""",
    "discovery_result": f"WITH {_NATIONS}, {_KEPT} SELECT source_name, table_schema, table_name FROM discovered",
    "discovery_counts": f"""
        WITH {_NATIONS}, {_KEPT},
        sources AS (
          SELECT n_name AS config_id, 0 AS source_pos, n_name || '-picked' AS source_name FROM nations
          UNION ALL SELECT n_name, 1, n_name || '-whole' FROM nations)
        SELECT s.config_id, s.source_pos, s.source_name, count(c.table_name) AS inventory_tables,
               count(CASE WHEN c.kept THEN 1 END) AS discovered_tables
        FROM sources s LEFT JOIN candidates c ON c.source_name = s.source_name
        GROUP BY ALL""",
    "discovery_document": f"""
        WITH {_NATIONS}, {_KEPT},
        dealt AS (
          SELECT *, ('0x' || substr(md5(table_schema || '.' || table_name), 1, 7))::BIGINT % 4 AS document
          FROM discovered)
        SELECT n_name AS config_id, source_pos, document,
               '{{"source_name":"' || source_name || '","discovered_tables":[' ||
               string_agg('{{"schema":"' || table_schema || '","table":"' || table_name || '"}}', ','
                          ORDER BY table_schema, table_name) || ']}}' AS result
        FROM dealt GROUP BY n_name, source_pos, source_name, document""",
    "manifest": f"WITH {_NATIONS}, {_KEPT}, {_MANIFEST} SELECT * EXCLUDE (source_pos) FROM jobs",
    "manifest_arguments": f"""
        WITH {_NATIONS}, {_KEPT}, {_MANIFEST}
        SELECT '{{"script_args":{{"--source_schema":"' || source_schema || '","--source_table":"' || source_table ||
               '","--glue_connection_name":"' || glue_connection_name || '","--target_s3_path":"' || target_s3_path ||
               '","--target_glue_db":"' || target_glue_db || '","--target_glue_table":"' || target_glue_table ||
               '","--retention_policy_value":"' || retention_policy_value || '"}}}}' AS job
        FROM jobs""",
    "manifest_conflicts": """
        WITH names AS (
          SELECT 'archive_' || p_type AS db, p_brand || '_' || p_name || '_' || p_size AS name FROM part),
        stored AS (
          SELECT lower(regexp_replace(db, '[^A-Za-z0-9_]', '_', 'g') || '.' || regexp_replace(name, '[^A-Za-z0-9_]', '_', 'g'))
                   AS subject,
                 count(*) AS tables
          FROM names GROUP BY 1)
        SELECT 'target_collision' AS rule, subject, tables || ' tables share this target' AS detail
        FROM stored WHERE tables > 1
        UNION ALL
        SELECT 'unsafe_name',
               lower(regexp_replace(db, '[^A-Za-z0-9_]', '_', 'g') || '.' || regexp_replace(name, '[^A-Za-z0-9_]', '_', 'g')),
               'stored in place of ' || db || '.' || name
        FROM names WHERE regexp_matches(db || name, '[^A-Za-z0-9_]')""",
    "config_violations": """
        WITH given AS (
          SELECT *, c_name || CASE WHEN c_mktsegment = 'BUILDING' THEN '_prod' ELSE '_dev' END AS key,
                 CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'dev' END AS env,
                 c_acctbal >= 0 AS has_warehouses,
                 CASE WHEN c_mktsegment = 'FURNITURE' THEN 'swamp' WHEN c_mktsegment <> 'MACHINERY' THEN 'lake' ELSE ''
                 END AS warehouse
          FROM customer WHERE c_acctbal < 9500)
        SELECT c_custkey AS config_id, 'unreadable' AS rule, 'config' AS subject, 'no config document' AS detail
        FROM customer WHERE c_acctbal >= 9500
        UNION ALL
        SELECT c_custkey, 'missing_key', 'env', 'key ''env'' is not given' FROM given WHERE env IS NULL
        UNION ALL
        SELECT c_custkey, 'missing_key', 'warehouses', 'key ''warehouses'' is not given'
        FROM given WHERE NOT has_warehouses
        UNION ALL
        SELECT c_custkey, 'connection_suffix', key, 'name does not end in ''_dev'''
        FROM given WHERE c_mktsegment = 'BUILDING'
        UNION ALL
        SELECT c_custkey, 'unknown_warehouse', 'sources[0]', 'warehouse ''' || warehouse || ''' is not among the warehouses'
        FROM given WHERE warehouse <> 'lake' OR NOT has_warehouses
        UNION ALL
        SELECT c_custkey, 'unknown_connection', 'sources[0]',
               'connection ''' || CASE WHEN c_nationkey = 3 THEN 'nobody' ELSE '' END || ''' is not among the connections'
        FROM given WHERE c_nationkey IN (3, 4)
        UNION ALL
        SELECT c_custkey, 'unknown_retention_policy', 'sources[0]',
               'retention_policy ''lost'' is not among the retention_policies'
        FROM given WHERE c_nationkey = 5
        UNION ALL
        SELECT c_custkey, 'malformed_retention', 'sources[0]', 'retention literal ''' || c_nationkey || 'w'' is not a length'
        FROM given WHERE c_nationkey >= 20
        UNION ALL
        SELECT c_custkey, 'incomplete_source', 'sources[0]', 'no connection' FROM given WHERE c_nationkey = 4
        UNION ALL
        SELECT c_custkey, 'incomplete_source', 'sources[0]', 'no schema to include' FROM given WHERE c_nationkey IN (7, 8)""",
    "config_scan": """
        SELECT DISTINCT lower(c_mktsegment) || '_' || c_nationkey AS request, 'wrong_type' AS rule, 'config' AS subject
        FROM customer WHERE c_nationkey < 5""",
    "request_stream": """
        SELECT lower(c_mktsegment) || '_' || c_nationkey AS source_name,
               lower(c_mktsegment) || '_' || c_nationkey || '_dev' AS connection, 's3://cold-lake/' AS warehouse_path,
               count(*) || 'd' AS retention, '.*' || max(c_custkey) || '$' AS pattern
        FROM customer GROUP BY c_mktsegment, c_nationkey
        UNION ALL
        SELECT lower(c_mktsegment) || '_' || c_nationkey, lower(c_mktsegment) || '_' || c_nationkey || '_dev',
               's3://colder-lake/', count(*) || 'd', '.*' || max(c_custkey) || '$'
        FROM customer WHERE c_nationkey <= 2 GROUP BY c_mktsegment, c_nationkey""",
    "expired_rows": f"WITH {_DATED_ORDERS} SELECT * FROM dated WHERE retention_expires_at <= TIMESTAMP '1998-01-01'",
    "expiry_overview": f"""
        WITH {_DATED_ORDERS},
        stamped AS (
          SELECT 'orders' AS table_name, retention_expires_at AS e FROM dated
          UNION ALL SELECT 'lineitem', l_shipdate + INTERVAL 365 DAY FROM lineitem)
        SELECT table_name, count(*) AS row_count, count(CASE WHEN e <= TIMESTAMP '1998-01-01' THEN 1 END) AS expired_count,
               min(e) AS first_expiry, max(e) AS last_expiry
        FROM stamped GROUP BY table_name""",
    "expired_in_archives": f"""
        WITH {_ARCHIVED_ORDERS}
        SELECT * EXCLUDE (table_name) FROM archived WHERE retention_expires_at <= TIMESTAMP '2000-06-29'""",
    "archive_expiry_overview": f"""
        WITH {_ARCHIVED_ORDERS}
        SELECT table_name, count(*) AS row_count,
               count(CASE WHEN retention_expires_at <= TIMESTAMP '2000-06-29' THEN 1 END) AS expired_count,
               min(retention_expires_at) AS first_expiry, max(retention_expires_at) AS last_expiry
        FROM archived GROUP BY table_name""",
    "table_age": """
        WITH ages AS (
          SELECT 'orders' AS table_name, max(o_orderdate) AS newest FROM orders
          UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
          UNION ALL SELECT 'events', max(ts) FROM events)
        SELECT table_name, newest, newest <= TIMESTAMP '2022-01-01' - INTERVAL 7300 DAY AS eligible FROM ages""",
}
