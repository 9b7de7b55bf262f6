"""Run logs: text-tier rows to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.functions.values import parse_iso_utc, rows_per_sec, source_from_path

TEXT_CUT, ERROR_CUT = 8000, 4000
#: Columns of the six typed logs, as Spark spells schemas (fixed names and types).
LOG_SCHEMAS: dict[str, str] = {
    "connections": "run_id string, system string, target string, host string, port int, user string, started_at timestamp, ended_at timestamp,"
        " duration_ms int, status string, error string, pid int, thread string",
    "queries": "query_id string, run_id string, system string, target string, operation string, batch_id string, sql_hash string, sql_text string,"
        " params string, started_at timestamp, ended_at timestamp, duration_ms int, `rows` bigint, rows_per_sec double, status string, error string,"
        " owner string, thread string, pid int",
    "batches": "batch_id string, run_id string, target string, operation string, window_from timestamp, window_to timestamp, id_from bigint,"
        " id_to bigint, started_at timestamp, ended_at timestamp, duration_ms int, rows_source bigint, rows_target bigint, rows_changed bigint,"
        " rows_missing bigint, source_query_id string, target_query_id string, status string, error string, worker_pid int",
    "events": "run_id string, ts timestamp, level string, event string, target string, batch_id string, query_id string, message string,"
        " fields string, thread string, pid int",
    "errors": "run_id string, ts timestamp, `where` string, target string, batch_id string, query_id string, error_type string, error_msg string,"
        " traceback string, retried boolean, retry_count int, recovered boolean",
    "phases": "run_id string, target string, phase string, batch_id string, started_at timestamp, ended_at timestamp, duration_ms int,"
        " rows_in bigint, rows_out bigint, status string, error string, worker_pid int",
}


def _extras(df: DataFrame, known: set[str]) -> Column:
    rest = [c for c in df.columns if c not in known]
    if not rest:
        return F.lit(None).cast("string")
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest]))


def normalise_query_log(df: DataFrame) -> DataFrame:
    """Text rows of the query log as typed rows: seconds to milliseconds, counts, other columns as JSON, text cut."""
    known = {"query_id", "run_id", "operation", "sql_hash", "start_ts", "end_ts", "seconds", "rows", "rows_per_sec", "status", "error", "owner", "table", "sql", "filename", "batch", "thread", "_pid"}

    def col(name: str):
        return F.col(f"`{name}`").cast("string") if name in df.columns else F.lit(None).cast("string")

    seconds, rows = col("seconds").try_cast("double"), col("rows").try_cast("bigint")
    return df.select(
        col("query_id").alias("query_id"), col("run_id").alias("run_id"), source_from_path(col("filename")).alias("system"),
        col("table").alias("target"), col("operation").alias("operation"), col("sql_hash").alias("sql_hash"),
        F.substring(col("sql"), 1, TEXT_CUT).alias("sql_text"), parse_iso_utc(col("start_ts")).alias("started_at"),
        parse_iso_utc(col("end_ts")).alias("ended_at"), F.round(seconds * 1000).cast("int").alias("duration_ms"),
        rows.alias("rows"), F.coalesce(col("rows_per_sec").try_cast("double"), rows_per_sec(rows, seconds)).alias("rows_per_sec"),
        F.coalesce(F.nullif(F.lower(F.trim(col("status"))), F.lit("")), F.lit("ok")).alias("status"),
        F.substring(col("error"), 1, TEXT_CUT).alias("error"), col("owner").alias("owner"), _extras(df, known).alias("params"),
        col("batch").alias("batch_id"), col("thread").alias("thread"), col("_pid").try_cast("int").alias("pid"),
    )


def normalise_event_log(df: DataFrame) -> DataFrame:
    """Text rows of the event log as typed rows: level in capitals, other columns as JSON."""
    known = {"run_id", "ts", "level", "event", "table", "message", "error", "filename", "batch", "query_id", "thread", "_pid"}

    def col(name: str):
        return F.col(f"`{name}`").cast("string") if name in df.columns else F.lit(None).cast("string")

    return df.select(
        col("run_id").alias("run_id"), parse_iso_utc(col("ts")).alias("ts"),
        F.upper(F.coalesce(F.nullif(F.trim(col("level")), F.lit("")), F.lit("INFO"))).alias("level"),
        col("event").alias("event"), col("table").alias("target"),
        F.substring(F.coalesce(col("message"), col("error")), 1, TEXT_CUT).alias("message"), _extras(df, known).alias("fields"),
        col("batch").alias("batch_id"), col("query_id").alias("query_id"), col("thread").alias("thread"), col("_pid").try_cast("int").alias("pid"),
    )


def errors_from_queries(queries: DataFrame) -> DataFrame:
    """Failed query rows as error rows: where, error_type (before the first colon), error_msg (after it, cut)."""
    kind = F.regexp_extract("error", r"^([A-Za-z_][A-Za-z0-9_.]*):", 1)
    message = F.when(kind != "", F.regexp_replace("error", r"^[A-Za-z_][A-Za-z0-9_.]*:\s*", "")).otherwise(F.col("error"))
    return queries.filter(F.col("status") == "error").select(
        "run_id", F.coalesce("ended_at", "started_at").alias("ts"), F.concat(F.lit("query."), F.col("system")).alias("where"), "target", "batch_id", "query_id",
        F.when(kind != "", kind).otherwise("Error").alias("error_type"), F.substring(message, 1, ERROR_CUT).alias("error_msg"),
    )
