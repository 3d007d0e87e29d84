"""The queries again as SQL for DuckDB, over the same tables."""

from __future__ import annotations

_RUN_TS = "TIMESTAMP '2001-01-01 00:00:00'"
_EVENTS_NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def _age(ts: str, now: str) -> str:
    return f"((epoch_us({now}) - epoch_us({ts})) / 1e6 / 3600.0)"


def _spark_type(timestamp: str) -> str:
    """Spark's name for a type that DESCRIBE tells; times have a zone or not, as the reader gives them."""
    return f"""CASE column_type WHEN 'BIGINT' THEN 'LongType()' WHEN 'INTEGER' THEN 'IntegerType()'
             WHEN 'DOUBLE' THEN 'DoubleType()' WHEN 'VARCHAR' THEN 'StringType()'
             WHEN 'TIMESTAMP' THEN '{timestamp}' END"""


_CUSTOMER_WORKSPACES = """
  SELECT c_custkey AS workspace_id,
         CASE WHEN c_acctbal < 0 THEN c_name
              ELSE 'WS_' || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2))
                   || '_N' || c_nationkey END AS workspace_name
  FROM customer"""

_CHOSEN_WORKSPACES = f"""
  SELECT * FROM ({_CUSTOMER_WORKSPACES})
  WHERE upper(workspace_name) IN ('WS_BUILDING_N7', 'WS_FURNITURE_N7', 'WS_HOUSEHOLD_N7')"""

_TARGETS = f"""
  SELECT w.workspace_id, w.workspace_name, o_orderkey AS item_id,
         {{prefix}} || '_' || o_orderpriority || '_' || o_orderkey AS item_name
  FROM orders JOIN ({_CHOSEN_WORKSPACES}) w ON o_custkey = w.workspace_id
  WHERE o_orderstatus = {{status}} AND o_orderpriority <> '4-NOT SPECIFIED'"""

_WAREHOUSES = """
  SELECT item_id, item_name, 'WS_' || upper(left(r_name, 1)) || lower(substr(r_name, 2)) || '_DEV'
           AS workspace_name
  FROM (SELECT c_nationkey AS nation, c_custkey AS item_id,
               'WH_' || c_mktsegment || '_' || c_custkey AS item_name
        FROM customer WHERE c_acctbal >= 0
        UNION ALL
        SELECT s_nationkey, -1 - s_suppkey, 'WH_SUPPLIER_' || s_suppkey FROM supplier)
  JOIN nation ON nation = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name IN ('AFRICA', 'ASIA', 'EUROPE')"""

_NEWEST_LINE = """
  SELECT l_orderkey, l_shipdate AS ts, lpad(l_partkey::VARCHAR, 20, '0') || '.json' AS file
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey) = 1"""

_TABLE_AGES = f"""
  SELECT o_custkey AS item_id, 'Tables/' || o_orderstatus || '/' || o_orderkey AS path, ts, file,
         {_age('ts', _RUN_TS)} AS age,
         CAST(printf('%.2f', CASE WHEN {_age('ts', _RUN_TS)} <> 0
              THEN {_age('ts', _RUN_TS)} END) AS DOUBLE) AS age_hours,
         coalesce({_age('ts', _RUN_TS)} > 24, false) AS stale
  FROM orders LEFT JOIN ({_NEWEST_LINE}) ON o_orderkey = l_orderkey"""

_DETAIL = f"""
  SELECT {_RUN_TS} AS "RunTs", workspace_name AS "WorkspaceName", item_name AS "WarehouseName",
         path AS "TablePath", file AS "LatestLogFile", ts AS "LatestLogTs",
         age_hours AS "AgeHours", CAST(24 AS DOUBLE) AS "ThresholdHours", stale AS "IsStale",
         CAST(NULL AS VARCHAR) AS "ErrorMessage"
  FROM ({_TABLE_AGES}) JOIN ({_WAREHOUSES}) USING (item_id)"""

_SUMMARY = f"""
  SELECT {_RUN_TS} AS "RunTs", workspace_name AS "WorkspaceName", item_name AS "WarehouseName",
         count(path)::INTEGER AS "TotalTables", count(ts)::INTEGER AS "TablesWithDeltaLog",
         count(CASE WHEN stale THEN 1 END)::INTEGER AS "StaleTables",
         max(ts) AS "LatestDeltaLogTs", min(ts) AS "OldestDeltaLogTs",
         nullif(max(age_hours), 0) AS "MaxAgeHours", nullif(min(age_hours), 0) AS "MinAgeHours",
         CAST(24 AS DOUBLE) AS "ThresholdHours",
         CASE WHEN count(ts) > 0 THEN count(CASE WHEN stale THEN 1 END) = count(ts) END
           AS "IsPublishingBroken"
  FROM ({_WAREHOUSES}) LEFT JOIN ({_TABLE_AGES}) USING (item_id)
  GROUP BY item_id, workspace_name, item_name"""

_EVENT_AGES = f"""
  SELECT user_id, event_type, {_age('max(ts)', _EVENTS_NOW)} AS age FROM events GROUP BY ALL"""

_HEALTH = f"""
  SELECT user_id || '/Tables/events/' || event_type AS subject,
         CASE WHEN age > 48 THEN '🔴' ELSE '🟢' END || '  '
         || rpad('Tables/events/' || event_type, 60, ' ') || '  ' || printf('%.1fh', age) AS line
  FROM ({_EVENT_AGES})
  UNION ALL
  SELECT c_name, CASE WHEN count(age) > 0 AND count(age) = count(CASE WHEN age > 48 THEN 1 END)
                      THEN '🔴 PUBLISHING BROKEN' ELSE '🟢 healthy' END
         || ' — ' || count(CASE WHEN age > 48 THEN 1 END) || '/' || count(age) || ' stale  max age '
         || coalesce(CAST(CAST(printf('%.2f', max(age)) AS DOUBLE) AS VARCHAR), 'None') || 'h'
  FROM customer LEFT JOIN ({_EVENT_AGES}) ON c_custkey = user_id
  GROUP BY c_custkey, c_name"""

_RESTATED = """
  SELECT l_orderkey + CASE WHEN l_returnflag = 'R' THEN 1000000000 ELSE 0 END AS o_orderkey,
         min(l_suppkey) AS o_custkey, max(l_linestatus) AS o_orderstatus,
         max(l_extendedprice) AS o_totalprice, max(l_shipdate) AS o_orderdate,
         'RESTATED' AS o_orderpriority
  FROM lineitem GROUP BY 1"""

_MERGED = f"""
  SELECT * FROM ({_RESTATED})
  UNION ALL
  SELECT * FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM ({_RESTATED}) r WHERE r.o_orderkey = o.o_orderkey)"""

_FINAL_LINE_STATE = """
  SELECT l_orderkey, state FROM (
    SELECT l_orderkey, l_shipdate, l_linenumber,
           CASE WHEN l_returnflag = 'R' THEN 'ERROR_FETCHING_STATUS'
                WHEN l_returnflag = 'A' THEN 'success' ELSE 'failure' END AS state
    FROM lineitem WHERE l_returnflag = 'R' OR l_linestatus <> 'O')
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, state) = 1"""

_OUTCOMES = f"""
  SELECT endpoint_id, coalesce(settled, CASE WHEN batch_id <> 'NO_ID' THEN state END) AS status,
         batch_id,
         settled IS NOT NULL OR (batch_id <> 'NO_ID' AND l_orderkey IS NOT NULL) AS finished
  FROM (
    SELECT o_orderkey AS endpoint_id, settled,
           CASE WHEN settled IS NOT NULL THEN 'N/A'
                WHEN o_orderpriority = '2-HIGH' THEN 'NO_ID'
                ELSE 'b' || o_orderkey END AS batch_id
    FROM (
      SELECT *, CASE
        WHEN o_totalprice > 450000 THEN 'ERROR: ' || left(
          'connection reset by the remote host while the reply was being read: ' || o_orderkey, 50)
        WHEN o_orderstatus = 'P' THEN 'FAILED_ALREADY_RUNNING'
        WHEN o_orderpriority = '3-MEDIUM' THEN 'ERROR: ' || left(
          'not a JSON object: <html>' || o_orderkey || '</html>', 50)
        END AS settled
      FROM orders))
  LEFT JOIN ({_FINAL_LINE_STATE}) ON endpoint_id = l_orderkey"""

_LOG_COLUMNS = f"""{_RUN_TS} AS "ExecutionTime", workspace_name AS "WorkspaceName",
         item_name AS "EndpointName" """

_ENDPOINTS = _TARGETS.format(prefix="'LH'", status="'O'")

_ORDERS_TEXT = """
  SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
         o_totalprice::VARCHAR AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, o_orderpriority
  FROM orders"""

_ADDRESS = "regexp_replace(url, '^https?://', '')"

_PAGES_NOW = "TIMESTAMP '2024-01-02 00:00:18'"

_PAGE_LOGS = f"""
  SELECT split_part(address, '/', 1) AS item_id,
         'Tables/' || split_part(address, '/', 2) || '/' || split_part(url, ':', 1) AS table_path,
         lpad(page_id::VARCHAR, 20, '0') || '.json' AS file_name,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id) AS modified
  FROM (SELECT page_id, url, {_ADDRESS} AS address FROM pages)"""

_PAGE_AGES = f"""
  SELECT item_id, table_path, max(file_name) AS file, max(modified) AS ts,
         {_age('max(modified)', _PAGES_NOW)} AS age
  FROM ({_PAGE_LOGS}) GROUP BY item_id, table_path
  UNION ALL
  SELECT item_id, 'Tables/bare/t' || file_name[:20]::BIGINT, NULL, NULL, NULL FROM ({_PAGE_LOGS})
  WHERE file_name[:20]::BIGINT % 10 = 0
  UNION ALL
  SELECT DISTINCT 'gone.' || item_id, NULL, NULL, NULL, NULL FROM ({_PAGE_LOGS})"""

_MOUNT_SUMMARY = f"""
  SELECT {_PAGES_NOW} AS "RunTs", 'WS_PAGES' AS "WorkspaceName", item_id AS "WarehouseName",
         count(*)::INTEGER AS "TotalTables", count(*)::INTEGER AS "TablesWithDeltaLog",
         count(CASE WHEN age > 22 THEN 1 END)::INTEGER AS "StaleTables",
         max(ts) AS "LatestDeltaLogTs", min(ts) AS "OldestDeltaLogTs",
         CAST(printf('%.2f', max(age)) AS DOUBLE) AS "MaxAgeHours",
         CAST(printf('%.2f', min(age)) AS DOUBLE) AS "MinAgeHours",
         CAST(22 AS DOUBLE) AS "ThresholdHours", min(age) > 22 AS "IsPublishingBroken"
  FROM (SELECT item_id, table_path, max(modified) AS ts, {_age('max(modified)', _PAGES_NOW)} AS age
        FROM ({_PAGE_LOGS}) GROUP BY ALL)
  GROUP BY item_id"""

_RUN_LOG = f"""
  SELECT {_LOG_COLUMNS}, 'Starting' AS "Status", 'N/A' AS "BatchId", false AS "IsDryRun"
  FROM ({_ENDPOINTS})
  UNION ALL
  SELECT {_LOG_COLUMNS}, status, batch_id, false
  FROM ({_ENDPOINTS}) JOIN ({_OUTCOMES}) ON item_id = endpoint_id WHERE finished"""

ORACLES: dict[str, str] = {
    "freshness_detail": _DETAIL,
    "freshness_summary": _SUMMARY,
    "freshness_log_append": _DETAIL,
    "latest_log_file": """
  SELECT user_id AS item_id, event_type, lpad(event_id::VARCHAR, 20, '0') || '.json' AS latest_file,
         ts AS latest_ts
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
    "health_label": _HEALTH,
    "env_suffix": f"""
  SELECT workspace_id, workspace_name,
         CASE WHEN contains(workspace_name, '_') THEN '_' || split_part(workspace_name, '_', -1)
              ELSE '' END AS suffix
  FROM ({_CUSTOMER_WORKSPACES})""",
    "current_suffix": f"""
  SELECT workspace_id, workspace_name,
         CASE WHEN contains(workspace_name, '_') THEN '_' || split_part(workspace_name, '_', -1)
              ELSE '' END AS suffix
  FROM ({_CUSTOMER_WORKSPACES}) WHERE workspace_id = 7""",
    "service_targets": _TARGETS.format(prefix="'wh'", status="'F'"),
    "select_workspaces": _CHOSEN_WORKSPACES,
    "select_targets": _TARGETS.format(prefix="'wh'", status="'F'"),
    "table_inventory": f"""
  SELECT DISTINCT split_part(address, '/', 1) AS item_id,
         'Tables/' || split_part(address, '/', 2) || '/' || split_part(address, '/', 3)
           AS table_path
  FROM (SELECT {_ADDRESS} AS address FROM pages)
  WHERE len(string_split(address, '/')) > 3
     OR (len(string_split(address, '/')) = 3
         AND NOT regexp_matches(substr(address, strpos(address, '/')), '[.?#]'))""",
    "pick_monitor_db": """
  SELECT p_partkey AS workspace_id, db AS display_name,
         CASE WHEN from_second THEN p_brand || ':1433' WHEN db IS NOT NULL THEN '' END AS server,
         db AS database_name
  FROM (SELECT *, p_type IN ('ECONOMY', 'PROMO') AS from_second,
               CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'ProcessDB' || p_partkey
                    WHEN p_size <= 40 THEN 'ProcessDB' || p_size END AS db
        FROM part)""",
    "pick_monitor_db_nulls": """
  SELECT p_partkey AS workspace_id, CASE WHEN kind NOT IN (5, 6) THEN 'ProcessDB' || p_partkey END AS display_name,
         CASE WHEN kind IN (1, 3) THEN '' WHEN kind = 4 THEN '{"a":1}' WHEN kind = 7 THEN 'a:1' END AS server,
         CASE WHEN kind IN (1, 7) THEN 'db' END AS database_name
  FROM (SELECT p_partkey, p_size % 8 AS kind FROM part)""",
    "log_file_listing": _PAGE_LOGS,
    "log_file_store": _PAGE_LOGS,
    "log_files_since": f"SELECT * FROM ({_PAGE_LOGS}) WHERE modified >= TIMESTAMP '2024-01-01 00:10:00'",
    "freshness_on_store": _MOUNT_SUMMARY,
    "freshness_in_runs": _DETAIL,
    "freshness_on_mount": _MOUNT_SUMMARY,
    "freshness_on_mount_detail": f"""
  SELECT {_PAGES_NOW} AS "RunTs", 'WS_PAGES' AS "WorkspaceName", item_id AS "WarehouseName",
         table_path AS "TablePath", file AS "LatestLogFile", ts AS "LatestLogTs",
         CAST(printf('%.2f', CASE WHEN age <> 0 THEN age END) AS DOUBLE) AS "AgeHours",
         CAST(22 AS DOUBLE) AS "ThresholdHours", coalesce(age > 22, false) AS "IsStale",
         table_path IS NULL AS "Failed"
  FROM ({_PAGE_AGES})""",
    "target_counts": f"""
  SELECT (SELECT count(*) FROM ({_CHOSEN_WORKSPACES})) AS matching_workspaces,
         (SELECT count(*) FROM ({_TARGETS.format(prefix="'wh'", status="'F'")})) AS targets""",
    "target_scan_counts": """
  SELECT (SELECT count(*) FROM lineitem) AS source_rows,
         (SELECT count(*) FROM orders) AS target_rows""",
    "row_loss_guard": """
  SELECT source_rows, target_rows, loss_pct, loss_pct > 5 AS abort
  FROM (SELECT *, (target_rows - source_rows) / greatest(target_rows, 1) * 100 AS loss_pct
        FROM (SELECT (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS source_rows,
                     (SELECT count(*) FROM orders) AS target_rows))""",
    "post_load_check": f"""
  SELECT required_rows, rows_after, rows_after >= required_rows AS passed
  FROM (SELECT (SELECT count(*) FROM ({_RESTATED})) AS required_rows,
               (SELECT count(*) FROM (SELECT o_orderkey FROM orders
                                      UNION SELECT o_orderkey FROM ({_RESTATED}))) AS rows_after)""",
    "load_report": f"""
  SELECT 'fullload' AS strategy, n AS source_rows, m AS target_rows_before,
         (m - n) / m * 100 AS loss_pct, n AS target_rows_after, n AS required_rows
  FROM (SELECT (SELECT count(*) FROM ({_RESTATED})) AS n, (SELECT count(*) FROM orders) AS m)""",
    "load_append": f"SELECT * FROM orders UNION ALL {_RESTATED}",
    "load_full": _RESTATED,
    "load_merge": _MERGED,
    "load_merge_buckets": _MERGED,
    "load_merge_first": _RESTATED,
    "load_merge_partitions": """
  SELECT * REPLACE (
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice)
  FROM orders""",
    "load_merge_table": """
  SELECT * REPLACE (
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice)
  FROM orders""",
    "load_full_proved": _RESTATED,
    "load_merge_text_partitions": """
  SELECT * REPLACE (
      CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice),
    lpad((o_custkey % 20)::VARCHAR, 2, '0') AS bucket
  FROM orders""",
    "csv_typed_scan": "SELECT * FROM orders",
    "csv_raw_scan": _ORDERS_TEXT,
    "csv_multi_line_scan": """
  SELECT * REPLACE ('a "note",' || chr(10) || chr(10) || 'for ' || o_orderpriority AS o_orderpriority)
  FROM orders""",
    "schema_fields": f"""
  SELECT (row_number() OVER () - 1)::INTEGER AS position, column_name,
         {_spark_type('TimestampType()')} AS type_text, true AS nullable
  FROM (DESCRIBE orders)""",
    "schema_drift": f"""
  SELECT CASE WHEN renamed AND seen THEN 'o_priority' ELSE column_name END AS column_name,
         CASE WHEN NOT renamed THEN 'type' WHEN seen THEN 'unexpected' ELSE 'missing' END AS kind,
         CASE WHEN NOT (renamed AND seen) THEN {_spark_type('TimestampNTZType()')} END AS expected,
         CASE WHEN seen OR NOT renamed THEN {_spark_type('TimestampType()')} END AS actual
  FROM (SELECT *, column_name = 'o_orderpriority' AS renamed, unnest([true, false]) AS seen FROM (DESCRIBE orders))
  WHERE renamed OR (column_type = 'TIMESTAMP' AND seen)""",
    "schema_path_drift": f"""
  SELECT place || replace(column_name, 'l_tax', CASE WHEN kind = 'unexpected' THEN 'l_vat' ELSE 'l_tax' END) AS column_name,
         kind, CASE WHEN kind <> 'unexpected' THEN {_spark_type('TimestampNTZType()')} END AS expected,
         CASE kind WHEN 'type' THEN 'StringType()' WHEN 'unexpected' THEN {_spark_type('TimestampNTZType()')} END AS actual
  FROM (SELECT *, unnest(CASE column_name WHEN 'l_tax' THEN ['missing', 'unexpected'] WHEN 'l_quantity' THEN ['type'] END) AS kind
        FROM (DESCRIBE lineitem))
  CROSS JOIN (VALUES ('lines[].'), ('by_number{{value}}.')) AS places(place)
  UNION ALL
  SELECT 'extra', 'missing', 'struct', NULL""",
    "schema_approval_state": """
  SELECT 'crm' AS schema_name, 't' || c_custkey AS table_name,
         CASE WHEN bool_or(o_totalprice > 480000) THEN 'approved'
              WHEN bool_or(o_orderpriority = '1-URGENT') THEN 'review'
              ELSE 'missing' END AS state
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey""",
    "schema_cast": "SELECT * FROM lineitem",
    "schema_rejects": """
  SELECT l_orderkey::VARCHAR AS l_orderkey,
         CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
              ELSE l_quantity::VARCHAR END AS l_quantity,
         CASE WHEN l_linestatus = 'F' THEN 'n/a' ELSE '0.5' END AS l_tax,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'l_quantity,l_tax'
              WHEN l_returnflag = 'R' THEN 'l_quantity' ELSE 'l_tax' END AS bad_columns
  FROM lineitem WHERE l_returnflag = 'R' OR l_linestatus = 'F'""",
    "gated_etl": "SELECT * FROM orders",
    "gated_etl_strict": """
  SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, o_orderpriority FROM orders""",
    "sync_final_state": """
  SELECT endpoint_id, batch_id, state AS final_state FROM (
    SELECT user_id AS endpoint_id, strftime(ts, '%Y-%m-%d') AS batch_id, ts, event_id,
           CASE event_type WHEN 'error' THEN 'ERROR_FETCHING_STATUS'
             WHEN 'click' THEN 'unknown'
             WHEN 'signup' THEN 'ERROR: ' || left('not a JSON object: <p>' || props || '</p>', 50)
             WHEN 'purchase' THEN CASE WHEN value > 100 THEN NULL ELSE 'success' END
           END AS state
    FROM events WHERE event_type <> 'view')
  QUALIFY row_number() OVER (PARTITION BY endpoint_id, batch_id ORDER BY ts, event_id) = 1""",
    "sync_outcomes": _OUTCOMES,
    "run_log_rows": _RUN_LOG,
    "run_log_append": _RUN_LOG,
    "run_log_once": _RUN_LOG,
    "run_log_dry_run": f"""
  SELECT {_LOG_COLUMNS}, unnest(['Starting', 'DRY_RUN_SUCCESS']) AS "Status",
         'N/A' AS "BatchId", true AS "IsDryRun"
  FROM ({_ENDPOINTS})""",
    "sync_latest_status": """
  SELECT date_trunc('day', ts)::TIMESTAMP AS "ExecutionTime", 'WS_EVENTS' AS "WorkspaceName",
         'LH_' || user_id AS "EndpointName",
         CASE event_type WHEN 'view' THEN 'Starting' ELSE event_type END AS "Status",
         event_id::VARCHAR AS "BatchId", value < 1 AS "IsDryRun"
  FROM events
  QUALIFY row_number() OVER (
    PARTITION BY user_id
    ORDER BY date_trunc('day', ts) DESC, event_type <> 'view' DESC, "Status" DESC,
             "BatchId" DESC) = 1""",
}
