"""DuckDB SQL over the same tables, one text for each query, over whole tables."""

from __future__ import annotations

from workload.queries import TABLES

_PATHS = """
WITH wanted AS (
    SELECT c_custkey AS target_id FROM customer
    WHERE c_mktsegment = 'BUILDING'
), windows AS (
    SELECT o_orderkey AS extraction_id,
           o_custkey AS target_id,
           o_custkey AS project,
           CASE WHEN o_orderkey % 2 = 0 THEN 'click' ELSE 'error' END AS theme,
           o_orderkey % 3 AS extraction_name,
           TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 25 AS INTEGER)) AS delta_start,
           TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 25 + 15 AS INTEGER)) AS delta_end
    FROM orders WHERE o_custkey IN (SELECT target_id FROM wanted)
), entries AS (
    SELECT user_id AS project,
           event_type AS theme,
           event_id % 3 AS extraction_name,
           event_type || '/' || user_id || '/' || strftime(ts, '%Y-%m-%d') AS directory,
           date_trunc('hour', ts) AS partition_time,
           event_id % 2 AS delta_flag
    FROM events
)
SELECT DISTINCT extraction_id, directory, extraction_name, target_id, delta_start, delta_end
FROM entries JOIN windows USING (project, theme, extraction_name)
"""

_COLUMNS = """
FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
JOIN part ON p_partkey = l_partkey
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
"""

_RULES = """
SELECT n_nationkey AS id,
       n_name AS criterion,
       CASE WHEN n_nationkey % 8 = 2 THEN 'no_such_column > 1'
            WHEN n_nationkey % 8 = 3 THEN 'l_quantity / (l_linenumber - 1) > 0'
            WHEN n_nationkey % 8 < 4
            THEN 'l_quantity BETWEEN 1 AND ' || ((n_nationkey % 8 + 1) * 10)
            WHEN n_nationkey % 8 < 6 THEN 'l_discount <= 0.0' || (n_nationkey % 8)
            WHEN n_nationkey % 8 = 6 THEN 'l_returnflag IS NOT NULL'
            ELSE 'nullif(l_linestatus, ''F'') = ''O''' END AS formula
FROM nation
WHERE n_nationkey <= 14 AND (n_nationkey % 5 = 0 OR n_nationkey + 10 >= 14)
"""

_ADVANCE = """
SELECT l_orderkey * 10 + l_linenumber AS extraction_id,
       l_orderkey AS target_id,
       CASE WHEN {moved} THEN l_shipdate + INTERVAL 30 DAY ELSE l_shipdate END AS delta_start,
       CASE WHEN {moved} THEN l_shipdate + INTERVAL 60 DAY
            ELSE l_shipdate + INTERVAL 30 DAY END AS delta_end
FROM lineitem
"""

_READ = """
SELECT CAST(n_nationkey AS INTEGER) AS extraction_id,
       event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day,
       CASE WHEN event_type = 'purchase' THEN event_id * 10 END AS amount
FROM events
JOIN nation
  ON event_type = ['click', 'error', 'purchase', 'signup', 'view'][n_nationkey % 5 + 1]
 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-01' + CAST(n_nationkey AS INTEGER)
                          AND DATE '2024-01-01' + CAST(n_nationkey + 2 AS INTEGER)
JOIN region ON r_regionkey = n_regionkey
"""

ORACLES = {
    "resolve_paths_window": _PATHS + "WHERE partition_time BETWEEN delta_start AND delta_end",
    "resolve_paths_flag": _PATHS + "WHERE delta_flag = 1",
    "extractions_for_target": """
SELECT l_orderkey * 10 + l_linenumber AS extraction_id,
       l_shipdate AS delta_start,
       l_shipdate + INTERVAL 30 DAY AS delta_end
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderstatus = 'F'
""",
    "comparison_info": """
SELECT o_orderkey AS target_id,
       o_orderpriority AS theme,
       o_orderstatus AS target_name,
       'select * from t' || o_orderkey AS select_template,
       o_orderkey % 7 AS delta_value_start,
       o_orderkey % 11 AS delta_value_end,
       c_mktsegment AS period,
       o_orderkey % 5 AS period_interval,
       a.n_name AS dest_name,
       o_orderkey % 2 AS mandatory_data,
       b.n_name AS version_name
FROM orders
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation a ON a.n_nationkey = o_orderkey % 30
LEFT JOIN nation b ON b.n_nationkey = o_orderkey % 40
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
""",
    "target_duration": """
SELECT 'P' || n_nationkey || 'D' AS iso_code
FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
""",
    "column_mapping": "SELECT l_returnflag || l_linestatus AS source_name,"
    " p_name AS dest_name, p_type AS data_type" + _COLUMNS,
    "destination_columns": "SELECT DISTINCT p_name AS dest_name" + _COLUMNS,
    "value_targets": """
SELECT n_name AS dest_name, c_mktsegment AS target_value
FROM customer JOIN nation ON n_nationkey = c_nationkey
""",
    "token_map": """
SELECT n_name AS dest_name,
       '<<Columna_' || l_linenumber || '_' || o_orderpriority || '>>' AS token
FROM lineitem
LEFT JOIN nation ON n_nationkey = l_suppkey % 30
LEFT JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderpriority = '1-URGENT'
""",
    "regulatory_calendar": """
SELECT o_orderkey AS target_id,
       1 AS regulatory_flag,
       CAST(day(l_shipdate) AS INTEGER) AS day,
       CAST(month(l_shipdate) AS INTEGER) AS month,
       CAST(isodow(l_shipdate) - 1 AS INTEGER) AS weekday,
       isodow(l_shipdate) < 6 AS business_day_flag,
       c_custkey AS classification_id,
       c_name, c_nationkey, c_acctbal, c_mktsegment
FROM orders
JOIN lineitem ON l_orderkey = o_orderkey
JOIN customer ON c_custkey = o_custkey
WHERE o_orderstatus = 'F'
""",
    "quality_criteria": """
SELECT CAST(o_orderkey % 9 AS VARCHAR) AS criterion,
       'o_custkey <> ' || o_custkey AS formula,
       'fix ' || o_orderkey AS fix_text,
       o_orderdate AS valid_from,
       o_orderdate + INTERVAL 365 DAY AS valid_to,
       'o_custkey' AS columns,
       CAST(o_orderkey % 100 AS VARCHAR) AS error_code,
       'error ' || (o_orderkey % 100) AS error_text,
       CAST(o_orderkey % 4 AS VARCHAR) AS granularity,
       CAST(o_orderkey AS VARCHAR) AS rule_number
FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
""",
    "evaluate_quality": f"""
WITH rules AS ({_RULES}), failures AS (
    SELECT kind,
           count(*) AS rows_checked,
           count(*) FILTER (
               WHERE CASE WHEN kind < 4 THEN l_quantity NOT BETWEEN 1 AND (kind + 1) * 10
                          WHEN kind < 6 THEN l_discount > kind / 100.0
                          WHEN kind = 6 THEN l_returnflag IS NULL
                          ELSE l_linestatus IS DISTINCT FROM 'O' END
           ) AS rows_failed
    FROM lineitem CROSS JOIN (SELECT unnest(range(8)) AS kind)
    GROUP BY kind
)
SELECT CAST(id AS VARCHAR) AS rule_number, criterion, formula,
       CASE WHEN kind NOT IN (2, 3) THEN rows_checked END AS rows_checked,
       CASE WHEN kind NOT IN (2, 3) THEN rows_failed END AS rows_failed,
       CASE kind WHEN 2 THEN 'UNRESOLVED_COLUMN.WITH_SUGGESTION'
                 WHEN 3 THEN 'DIVIDE_BY_ZERO' END AS error
FROM rules JOIN failures ON kind = id % 8
""",
    "apply_column_mapping": """
SELECT o_orderkey AS order_id,
       TRY_CAST(o_totalprice AS DECIMAL(18, 2)) AS price,
       TRY_CAST(o_orderpriority AS INTEGER) AS priority,
       o_orderstatus AS status
FROM orders
""",
    "apply_resolved_mapping": """
SELECT o_orderkey AS order_id,
       TRY_CAST(o_totalprice AS DECIMAL(18, 2)) AS price,
       coalesce(o_orderstatus, o_orderpriority) AS status
FROM orders
""",
    "count_bad_casts": """
SELECT 'order_id' AS dest_name, count(*) FILTER (
    WHERE o_orderkey IS NOT NULL AND TRY_CAST(o_orderkey AS BIGINT) IS NULL) AS bad_casts
FROM orders
UNION ALL
SELECT 'price', count(*) FILTER (
    WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(18, 2)) IS NULL)
FROM orders
UNION ALL
SELECT 'priority', count(*) FILTER (
    WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL)
FROM orders
UNION ALL
SELECT 'status', count(*) FILTER (
    WHERE o_orderstatus IS NOT NULL AND TRY_CAST(o_orderstatus AS VARCHAR) IS NULL)
FROM orders
""",
    "standardize_values": """
SELECT o_orderkey,
       coalesce(p.value, ' ' || lower(o_orderpriority)) AS priority,
       coalesce(s.value, lower(c_mktsegment) || ' ') AS segment
FROM orders
JOIN customer ON c_custkey = o_custkey
LEFT JOIN (
    SELECT lower(trim(o_orderpriority)) AS spelling, min(o_orderpriority) AS value
    FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1
) p ON p.spelling = lower(trim(' ' || lower(o_orderpriority)))
LEFT JOIN (
    SELECT lower(trim(c_mktsegment)) AS spelling, min(c_mktsegment) AS value
    FROM customer GROUP BY 1
) s ON s.spelling = lower(trim(lower(c_mktsegment) || ' '))
""",
    "render_templates": """
WITH tokens AS (
    SELECT min(n_name) AS dest_name,
           '<<Columna_' || n_nationkey || '_r' || n_regionkey || '>>' AS token
    FROM nation GROUP BY 2
), templates AS (
    SELECT o_orderkey AS target_id,
           '<<Columna_' || (o_orderkey % 30) || '_r' || (o_custkey % 5) || '>>' AS token_1,
           '<<Columna_' || (o_custkey % 5) || '_r' || (o_custkey % 5) || '>>' AS token_2
    FROM orders
)
SELECT target_id,
       'select ' || coalesce(a.dest_name, token_1) || ', ' || coalesce(b.dest_name, token_2)
           || ' from t' AS rendered,
       CASE WHEN a.token IS NULL AND b.token IS NULL AND token_1 <> token_2
            THEN least(token_1, token_2) || ',' || greatest(token_1, token_2)
            WHEN a.token IS NULL THEN token_1
            WHEN b.token IS NULL THEN token_2
            ELSE '' END AS unresolved_tokens
FROM templates
LEFT JOIN tokens a ON a.token = token_1
LEFT JOIN tokens b ON b.token = token_2
""",
    "advance_deltas": _ADVANCE.format(
        moved="l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"
    ),
    "advance_published": _ADVANCE.format(
        moved="l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"
    ),
    "advance_deltas_by_extraction": _ADVANCE.format(
        moved="l_orderkey * 10 + l_linenumber IN"
        " (SELECT l_orderkey * 10 + l_linenumber FROM lineitem WHERE l_returnflag = 'R')"
    ),
    "advance_target_deltas": """
SELECT o_orderkey AS target_id, o_orderpriority AS theme,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey % 11
            ELSE o_orderkey % 7 END AS delta_value_start,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 2 * (o_orderkey % 11) - o_orderkey % 7
            ELSE o_orderkey % 11 END AS delta_value_end
FROM orders
""",
    "catalog_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES
    ),
    "stored_catalog_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES
    ),
    "table_round_trip": """
SELECT *, lpad(CAST(o_custkey % 12 AS VARCHAR), 2, '0') AS part FROM orders
""",
    "read_resolved": _READ,
    "read_resolved_by_key": _READ,
}
