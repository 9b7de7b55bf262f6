"""Stand-in tables for sources, replicas, diff stores, ledgers and logs, as SQL over the given tables.

Each text runs in Spark and in ANSI SQL engines alike. {name} stands for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Column names that are reserved words in one of the dialects, as the fixtures spell them and as they are read.
RENAMED = {"tbl": "table", "n_rows": "rows", "sql_txt": "sql"}

FIXTURES: dict[str, str] = {
    "src_orders": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_orderkey % 3 AS o_flag
FROM {orders}""",
    "tgt_orders": """
SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS custId,
       CASE WHEN o_orderkey % 53 = 0 THEN 'X' ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE o_totalprice END AS totalPrice,
       CAST(CAST(o_orderdate AS DATE) AS STRING)
         || CASE WHEN o_orderkey % 2 = 0 THEN 'T00:00:00.000' ELSE ' 00:00:00' END AS orderDate,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 3 END AS flag
FROM {orders} WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT 'T' || CAST(o_orderkey AS STRING), CAST(o_custkey AS STRING), o_orderstatus, o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T00:00:00.000', 0
FROM {orders} WHERE o_orderkey % 1009 = 0""",
    "src_twice": """
SELECT * FROM {src_orders} UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000, o_orderdate, o_orderpriority, o_flag FROM {src_orders} WHERE o_orderkey % 23 = 0""",
    "tgt_twice": """
SELECT * FROM {tgt_orders} UNION ALL
SELECT ' ' || id || ' ', custId, 'ZZ', totalPrice + 5, orderDate, flag FROM {tgt_orders} WHERE custId LIKE '%7' AND id NOT LIKE 'T%'""",
    "log_queries": """
SELECT event_id AS query_id, 'run_' || CAST(user_id % 20 AS STRING) AS run_id,
       '/logs/connector_' || CASE WHEN event_id % 3 = 0 THEN 'pg' ELSE 'wh' END || '/logging/queries.csv' AS filename,
       CASE WHEN event_id % 43 = 0 THEN '' ELSE 'h' || CAST(event_id % 37 AS STRING) END AS sql_hash, 'tbl_' || event_type AS tbl,
       CASE WHEN event_id % 101 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END AS seconds,
       CAST(user_id * 10 AS STRING) AS n_rows, CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(event_id % 500 AS STRING) END AS rows_per_sec,
       'own_' || CAST(user_id % 3 AS STRING) AS owner, CAST(event_id % 12 AS STRING) AS batch,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, ts AS start_ts,
       CASE WHEN event_type = 'error' THEN 'ValueError: bad row ' || CAST(event_id AS STRING) END AS error,
       'SELECT * FROM tbl_' || event_type AS sql_txt
FROM {events}""",
    "log_events": """
SELECT event_id, 'run_' || CAST(user_id % 20 AS STRING) AS run_id, ts,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
       CASE event_id % 5 WHEN 0 THEN 'run_start' WHEN 1 THEN 'run_end' WHEN 2 THEN 'wh_connect_failed'
            WHEN 3 THEN 'pg_write' ELSE 'step' END AS event,
       'tbl_' || event_type AS tbl,
       CASE WHEN event_type = 'error' THEN 'ValueError: bad row ' || CAST(event_id AS STRING) END AS error,
       '/logs/connector_' || CASE WHEN event_id % 3 = 0 THEN 'pg' ELSE 'wh' END || '/logging/events.csv' AS filename,
       CAST(event_id % 12 AS STRING) AS batch, CASE WHEN event_id % 4 = 0 THEN CAST(event_id AS STRING) END AS query_id
FROM {events}""",
    "log_connections": """
SELECT event_id AS conn_id, 'run_' || CAST(user_id % 20 AS STRING) AS run_id, ts AS start_ts,
       '/logs/connector_' || CASE WHEN event_id % 4 = 0 THEN 'pg' ELSE 'wh' END || '/logging/connections.csv' AS filename,
       'host_' || CAST(user_id % 9 AS STRING) AS hostname, 'land_' || CAST(user_id % 4 AS STRING) AS country, event_type AS city
FROM {events}""",
    "parts_a": """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM {customer}""",
    "parts_b": """
SELECT s_suppkey + 1000003 AS id, s_name AS name, s_nationkey AS nation FROM {supplier}""",
    "tag_lists": """
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ',1,a,22,' WHEN 1 THEN ',-1,' WHEN 2 THEN ''
       WHEN 3 THEN NULL WHEN 4 THEN '3,-1,999,' || CAST(p_size % 25 AS STRING) ELSE CAST(p_size % 25 AS STRING) END AS tags
FROM {part}""",
    "tag_rows": """
SELECT p_brand, CASE p_partkey % 6 WHEN 0 THEN ',1,a,22,' WHEN 1 THEN ',-1,' WHEN 2 THEN ' '
       WHEN 3 THEN NULL WHEN 4 THEN '3,-1,999,' || CAST(p_size % 25 AS STRING) ELSE CAST(p_size % 25 AS STRING) || ', ' || CAST(p_size % 25 AS STRING) END AS tags
FROM {part}""",
    "lookup_names": """
SELECT n_nationkey AS k, n_name AS v FROM {nation}""",
    "codes": """
SELECT p_partkey,
       CASE p_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' 7 ' WHEN 3 THEN '12.7' WHEN 4 THEN '1d'
            WHEN 5 THEN 'nan' WHEN 6 THEN 'abc' ELSE CAST(p_partkey AS STRING) END AS txt,
       CASE p_partkey % 7 WHEN 0 THEN '991332' WHEN 1 THEN '700101' WHEN 2 THEN '691231' WHEN 3 THEN NULL
            WHEN 4 THEN '240229' WHEN 5 THEN '230229' ELSE '12345' END AS ymd,
       CASE p_partkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN ' TRUE ' WHEN 2 THEN '0' WHEN 3 THEN NULL ELSE '2' END AS flag_txt,
       p_partkey % 5 AS code, p_size % 14 AS mm, p_size % 100 AS yy, p_partkey % 3 - 1 AS tri, p_retailprice, p_size
FROM {part}""",
    "changes": """
SELECT 'ev_' || CAST(o_custkey % 5 AS STRING) AS event, CASE WHEN o_orderkey % 2 = 0 THEN 'prod' ELSE 'test' END AS env,
       CAST(o_orderkey % 24 AS STRING) AS win, CASE WHEN o_orderkey % 71 = 0 THEN ' nan ' ELSE CAST(CAST((o_orderkey - o_orderkey % 8) / 8 AS BIGINT) AS STRING) END AS pk,
       CASE o_orderkey % 4 WHEN 0 THEN 'status' WHEN 1 THEN 'total' WHEN 2 THEN 'flag' ELSE '*' END AS field,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS source_value,
       CASE WHEN o_orderkey % 10 = 0 THEN ' ' ELSE o_orderpriority END AS target_value,
       CASE WHEN o_orderkey % 4 = 3 THEN 'missing_in_source' WHEN o_orderkey % 89 = 0 THEN NULL ELSE 'diff' END AS status,
       'f' || CAST(CAST((o_orderkey - o_orderkey % 50) / 50 AS BIGINT) AS STRING) || '.parquet' AS source_file,
       CASE WHEN o_orderkey % 9 = 0 THEN o_orderdate END AS applied_ts
FROM {orders}""",
    "missing": """
SELECT 'ev_' || CAST(o_custkey % 5 AS STRING) AS event, CASE WHEN o_orderkey % 2 = 0 THEN 'prod' ELSE 'test' END AS env,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS orderId, CAST(o_orderkey AS STRING) || 'i' AS id,
       CASE WHEN o_orderkey % 4 = 0 THEN 'nan' ELSE o_orderstatus END AS status, o_orderpriority AS priority,
       'f' || CAST(CAST((o_orderkey - o_orderkey % 50) / 50 AS BIGINT) AS STRING) || '.parquet' AS source_file, 'missing_in_target' AS error
FROM {orders}""",
    "ledger": """
SELECT 'ev_' || CAST(o_custkey % 5 AS STRING) AS event, CASE WHEN o_orderkey % 2 = 0 THEN 'prod' ELSE 'test' END AS env,
       CASE WHEN o_orderkey % 3 = 0 THEN 'missing' ELSE 'changes' END AS mode,
       'f' || CAST(CAST((o_orderkey - o_orderkey % 50) / 50 AS BIGINT) AS STRING) || '.parquet' AS source_file,
       o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND AS applied_ts, o_orderkey % 100 AS n_updated, o_orderkey % 10 AS n_created,
       o_orderkey % 4 AS n_conflicts, CASE WHEN o_orderkey % 13 = 0 THEN 2 ELSE 0 END AS n_failures
FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    "run_summary": """
SELECT event_id AS id, 'run_' || CAST(user_id % 20 AS STRING) AS run_id, CASE WHEN event_id % 2 = 0 THEN 'prod' ELSE 'test' END AS env,
       'tbl_' || event_type AS target_name, CASE WHEN event_id % 3 = 0 THEN 'apply' ELSE 'compare' END AS operation, user_id AS rows_count,
       ts AS started_at, ts + (event_id % 900 - 3) * INTERVAL '1' SECOND + (event_id % 8) * INTERVAL '0.125' SECOND AS ended_at,
       CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'skipped' WHEN event_id % 19 = 0 THEN 'success' WHEN event_id % 29 = 0 THEN 'OK' ELSE 'ok' END AS status,
       CASE WHEN event_type = 'error' THEN 'ValueError: bad row ' || CAST(event_id AS STRING) END AS error
FROM {events}""",
    "batches": """
SELECT 'ev_' || CAST(user_id % 6 AS STRING) AS event, 'run_' || CAST(user_id % 20 AS STRING) AS run_id, event_id % 1000 AS rows_source,
       event_id % 990 AS rows_target, CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 7 END AS rows_changed, event_id % 3 AS rows_missing,
       event_id % 5 AS inserted, event_id % 4 AS updated, event_id % 2 AS deleted,
       CASE WHEN user_id % 20 = 3 THEN 'failed' WHEN event_type = 'error' AND user_id % 20 < 9 THEN 'failed' ELSE 'ok' END AS status
FROM {events}""",
    "summary_files": """
SELECT 'ev_' || CAST(o_custkey % 5 AS STRING) AS event, CASE WHEN o_orderkey % 2 = 0 THEN 'prod' ELSE 'test' END AS env,
       'field_' || CAST(o_orderkey % 30 AS STRING) AS field, CAST(o_orderkey % 90 AS STRING) AS total_issues, CAST(o_orderkey % 40 AS STRING) AS diff,
       CASE WHEN o_orderkey % 77 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 9 AS STRING) END AS missing_in_target, '1' AS missing_in_source,
       CAST(o_orderkey % 5 AS STRING) AS target_blank, '' AS source_blank
FROM {orders}""",
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a fixture over the given tables."""
    if name not in FIXTURES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tables = {t: frame(spark, sf_dir, t) for t in re.findall(r"\{(\w+)\}", FIXTURES[name])}
    return spark.sql(FIXTURES[name], **tables)


def log_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture of a log, with the columns' own names."""
    df = frame(spark, sf_dir, name)
    return df.withColumnsRenamed({k: v for k, v in RENAMED.items() if k in df.columns})


def with_tables(sql: str) -> str:
    """SQL whose {name} fixtures are put before it as common table expressions."""
    names: dict[str, None] = {}

    def need(text: str) -> None:
        for name in re.findall(r"\{(\w+)\}", text):
            if name in FIXTURES and name not in names:
                need(FIXTURES[name])
                names[name] = None

    need(sql)
    parts = [f"{n} AS ({re.sub(r'\{(\w+)\}', r'\1', FIXTURES[n])})" for n in names]
    body = re.sub(r"\{(\w+)\}", r"\1", sql).strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
