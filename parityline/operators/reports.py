"""Answers over diff stores, ledgers, run summaries and run logs. Text logs are cast leniently, never with an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityline.functions.keys import is_blank
from parityline.functions.values import source_from_path

SLOW_SECONDS = 5.0


def number(col: str) -> Column:
    return F.col(f"`{col}`").try_cast("double")


def rounded(x: Column, digits: int) -> Column:
    """x rounded half up in decimals, so that the order of a sum does not decide a tie."""
    return F.round(x.cast("decimal(28,8)"), digits).cast("double")


def failed_connect() -> Column:
    """A failed connection in the event log; the underscore is a wildcard in the second pattern."""
    return F.col("event").like("%connect_failed%") | ((F.col("level") == "ERROR") & F.col("event").like("pg_%"))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """Result ids 1, 2, ... of rows that a limit has already made few."""
    return df.withColumn("id", F.row_number().over(Window.orderBy(*order)))


# -- data quality -----------------------------------------------------------------------------------------------------


def quality_summary(diffs: DataFrame, missing: DataFrame) -> DataFrame:
    """Per event, env and field: total_issues, diff, missing_in_target, missing_in_source, blank values among diffs."""
    cols = ["event", "env", "field", "status", "source_value", "target_value"]
    absent = missing.select("event", "env", F.lit("*").alias("field"), F.lit("missing_in_target").alias("status"), *[F.lit(None).cast("string").alias(c) for c in cols[4:]])
    # Rows without a status are issues too; rows that lack the target are counted from the missing table.
    rows = diffs.select(*cols).filter(~F.col("status").eqNullSafe(F.lit("missing_in_target"))).unionByName(absent)
    is_diff = F.col("status") == "diff"
    return rows.groupBy("event", "env", "field").agg(
        F.count("*").alias("total_issues"),
        F.count_if(is_diff).alias("diff"),
        F.count_if(F.col("status") == "missing_in_target").alias("missing_in_target"),
        F.count_if(F.col("status") == "missing_in_source").alias("missing_in_source"),
        F.count_if(is_diff & is_blank("target_value")).alias("target_blank"),
        F.count_if(is_diff & is_blank("source_value")).alias("source_blank"),
    )


COUNTS = ("total_issues", "diff", "missing_in_target", "missing_in_source", "target_blank", "source_blank")


def data_quality(summary: DataFrame, n: int = 200) -> DataFrame:
    """Sums over summary files, the most issues first."""
    sums = [F.sum(F.col(c).try_cast("bigint")).alias(c) for c in COUNTS]
    return summary.groupBy("event", "env", "field").agg(*sums).orderBy(F.desc_nulls_last("total_issues"), "event", "env", "field").limit(n)


def quality_totals(summary: DataFrame) -> DataFrame:
    sums = [F.sum(F.col(c).try_cast("bigint")).alias(c) for c in COUNTS]
    return summary.agg(*sums, F.count("field").alias("n_fields"), F.count_distinct("event").alias("n_events"))


def changes_browse(changes: DataFrame, pk: str | None = None, event: str | None = None, env: str | None = None, status: str | None = None, n: int = 1000) -> DataFrame:
    for col, value in (("pk", pk), ("event", event), ("env", env), ("status", status)):
        if value is not None:
            changes = changes.filter(F.col(col) == value)
    return changes.orderBy("event", "env", "pk", "field").limit(n)


def missing_browse(missing: DataFrame, pk: str, event: str | None = None, env: str | None = None, n: int = 500) -> DataFrame:
    for col, value in (("event", event), ("env", env)):
        if value is not None:
            missing = missing.filter(F.col(col) == value)
    return missing.orderBy("event", "env", pk).limit(n)


# -- connections and queries ------------------------------------------------------------------------------------------


def connection_overview(connections: DataFrame, events: DataFrame) -> DataFrame:
    """source, successes, failures, total: connections that were made, and failed ones from the event log."""
    good = connections.select(source_from_path("filename").alias("source"), F.lit(True).alias("ok"))
    bad = events.filter(failed_connect()).select(source_from_path("filename").alias("source"), F.lit(False).alias("ok"))
    return good.unionByName(bad).groupBy("source").agg(F.count_if("ok").alias("successes"), F.count_if(~F.col("ok")).alias("failures"), F.count("*").alias("total"))


def connections_recent(connections: DataFrame, events: DataFrame, source: str | None = None, status: str | None = None, n: int = 200) -> DataFrame:
    """source, run_id, started, hostname, country, city, status, error: made and failed connections, the latest first."""
    none = F.lit(None).cast("string")
    where = ["hostname", "country", "city"]
    good = connections.select(source_from_path("filename").alias("source"), "run_id", F.col("start_ts").alias("started"), *where, F.lit("success").alias("status"), none.alias("error"))
    bad = events.filter(failed_connect()).select(
        source_from_path("filename").alias("source"), "run_id", F.col("ts").alias("started"), *[none.alias(c) for c in where], F.lit("failed").alias("status"), "error"
    )
    rows = good.unionByName(bad)
    for col, value in (("source", source), ("status", status)):
        if value is not None:
            rows = rows.filter(F.col(col) == value)
    return rows.orderBy(F.desc_nulls_last("started"), *[F.asc_nulls_last(c) for c in ("source", "run_id", "status", "error", *where)]).limit(n)


def query_rows(queries: DataFrame) -> DataFrame:
    """The query log with source, target and its numbers as numbers; text that is no number is null."""
    return queries.select(
        "query_id", source_from_path("filename").alias("source"), "run_id", F.col("table").alias("target"), "owner", "batch", "start_ts", number("seconds").alias("seconds"),
        F.col("rows").try_cast("bigint").alias("rows"), number("rows_per_sec").alias("rate"), "status", "sql_hash", "error", "sql",
    )


def query_slowest(queries: DataFrame, n: int = 50) -> DataFrame:
    """id (1 for the slowest) and the row of each of the slowest queries; queries without a time do not count."""
    rows = query_rows(queries).filter("seconds IS NOT NULL").drop("sql")
    order = (F.desc("seconds"), F.asc("query_id"))
    return numbered(rows.orderBy(*order).limit(n), *order)


def query_hashes(queries: DataFrame, preview: int = 120, n: int = 200) -> DataFrame:
    """Per fingerprint, the most run first; queries without a time or a fingerprint do not count."""
    rows = query_rows(queries).filter("seconds IS NOT NULL AND sql_hash <> ''")
    per = rows.groupBy("sql_hash").agg(
        F.min("source").alias("source"), F.max("target").alias("target"), F.count("*").alias("runs"), rounded(F.avg("seconds"), 3).alias("avg_seconds"),
        F.round(F.max("seconds"), 3).alias("max_seconds"), F.sum("rows").alias("total_rows"), F.min("start_ts").alias("first_seen"), F.max("start_ts").alias("last_seen"),
        F.left(F.max("sql"), F.lit(preview)).alias("preview"),
    )
    return per.orderBy(F.desc("runs"), F.desc("avg_seconds"), "sql_hash").limit(n)


def query_by_hour(queries: DataFrame, sql_hash: str) -> DataFrame:
    """Per hour of the day, of the runs of one fingerprint that have a time."""
    rows = query_rows(queries).filter((F.col("sql_hash") == sql_hash) & F.col("seconds").isNotNull())
    per = rows.groupBy(F.hour("start_ts").alias("hour")).agg(
        F.count("*").alias("runs"), rounded(F.avg("seconds"), 3).alias("avg_seconds"), F.round(F.min("seconds"), 3).alias("min_seconds"), F.round(F.max("seconds"), 3).alias("max_seconds"),
        F.sum("rows").alias("total_rows"), rounded(F.avg("rate"), 1).alias("avg_rate"),
    )
    return per.orderBy("hour")


def query_perf(queries: DataFrame, only_slow: bool = False, source: str | None = None, n: int = 500) -> DataFrame:
    """id (1 for the latest) and the row of each of the latest queries; slow is null where there is no time."""
    rows = query_rows(queries).drop("sql", "owner", "error").withColumn("slow", F.col("seconds") > SLOW_SECONDS)
    if only_slow:
        rows = rows.filter("slow")
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    order = (F.desc_nulls_last("start_ts"), F.asc("query_id"))
    return numbered(rows.orderBy(*order).limit(n), *order)


def recent_errors(events: DataFrame, n: int = 50) -> DataFrame:
    rows = events.filter(F.col("level") == "ERROR").select(source_from_path("filename").alias("source"), "run_id", "ts", "event", "table", "error")
    return rows.orderBy(F.desc_nulls_last("ts"), "source", "run_id", "event", "error").limit(n)


def run_metrics(connections: DataFrame, events: DataFrame, queries: DataFrame, n: int = 100) -> DataFrame:
    """Per run, the latest starts first. A run starts with its first connection and ends with its last end event.

    run_id, source, started, ended, queries, query_seconds, slowest_seconds, rows (null for a run without queries), errors, status.
    """
    known = F.col("run_id").isNotNull()
    start = connections.filter(known).groupBy("run_id").agg(F.min("start_ts").alias("started"))
    logged = events.filter(known).groupBy("run_id").agg(F.max(F.when(F.col("event") == "run_end", F.col("ts"))).alias("ended"), F.count_if(F.col("level") == "ERROR").alias("errors"))
    stats = query_rows(queries).filter(known).groupBy("run_id").agg(
        F.min("source").alias("source"), F.count("*").alias("queries"), rounded(F.sum("seconds"), 3).alias("query_seconds"),
        F.round(F.max("seconds"), 3).alias("slowest_seconds"), F.sum("rows").alias("rows"),
    )
    errors = F.coalesce("errors", F.lit(0))
    out = start.join(logged, "run_id", "left").join(stats, "run_id", "left").select(
        "run_id", "source", "started", "ended", "queries", "query_seconds", "slowest_seconds", "rows", errors.alias("errors"), F.when(errors > 0, "failed").otherwise("ok").alias("status")
    )
    return out.orderBy(F.desc_nulls_last("started"), "run_id").limit(n)


def recent_log(table: DataFrame, ts: str, tie: str, n: int = 100) -> DataFrame:
    return table.orderBy(F.desc_nulls_last(ts), tie).limit(n)


# -- ledger and run summaries -----------------------------------------------------------------------------------------


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds with their fraction."""
    return F.timestamp_diff("MICROSECOND", a, b) / 1e6


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """batches, success, failed, first_ts, last_ts, elapsed_s, mean_interval_s, rows."""
    failed = F.coalesce("n_failures", F.lit(0)) > 0
    a = ledger.agg(
        F.count("*").alias("batches"), F.count_if(~failed).alias("success"), F.count_if(failed).alias("failed"),
        F.min("applied_ts").alias("first_ts"), F.max("applied_ts").alias("last_ts"),
        F.sum(F.coalesce("n_updated", F.lit(0)) + F.coalesce("n_created", F.lit(0))).alias("rows"),
    )
    elapsed = seconds_between(F.col("first_ts"), F.col("last_ts"))
    gaps = F.round(F.try_divide(elapsed, F.col("batches")), 2)
    return a.select("batches", "success", "failed", "first_ts", "last_ts", elapsed.alias("elapsed_s"), gaps.alias("mean_interval_s"), "rows")


def ledger_breakdown(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("event", "env", "mode").agg(
        F.count("*").alias("batches"), F.sum("n_updated").alias("updated"), F.sum("n_created").alias("created"), F.sum("n_conflicts").alias("conflicts"),
        F.sum("n_failures").alias("failures"), F.min("applied_ts").alias("first_ts"), F.max("applied_ts").alias("last_ts"),
    )


def _ok() -> Column:
    return F.coalesce(F.col("status") == "ok", F.lit(False))


def _failed() -> Column:
    return F.coalesce(F.col("status") == "failed", F.lit(False))


def run_summary_totals(summary: DataFrame) -> DataFrame:
    took = seconds_between(F.col("started_at"), F.col("ended_at"))
    return summary.agg(
        F.count("*").alias("runs"), F.count_if(_ok()).alias("ok"), F.count_if(_failed()).alias("failed"), F.count_if(~_ok() & ~_failed()).alias("other"),
        F.min("started_at").alias("first_ts"), F.max("ended_at").alias("last_ts"), seconds_between(F.min("started_at"), F.max("ended_at")).alias("elapsed_s"),
        F.round(F.avg(took), 2).alias("mean_duration_s"), F.sum("rows_count").alias("rows"),
    )


def run_summary_breakdown(summary: DataFrame) -> DataFrame:
    took = seconds_between(F.col("started_at"), F.col("ended_at"))
    return summary.groupBy("target_name", "operation", "env").agg(
        F.count("*").alias("runs"), F.count_if(_ok()).alias("ok"), F.count_if(_failed()).alias("failed"), F.sum("rows_count").alias("rows"),
        F.round(F.avg(took), 2).alias("avg_s"), F.round(F.max(took), 2).alias("max_s"),
    )


def status_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("status", F.lit("(null)")).alias("status")).agg(F.count("*").alias("n"))


def extreme_run(summary: DataFrame, slowest: bool) -> DataFrame:
    """The run that took longest, or least; durations below zero do not count."""
    took = seconds_between(F.col("started_at"), F.col("ended_at"))
    rows = summary.select("id", "run_id", "target_name", took.alias("seconds")).filter("seconds >= 0")
    return rows.orderBy(F.desc("seconds") if slowest else F.asc("seconds"), "id").limit(1)


def event_totals(batches: DataFrame) -> DataFrame:
    sums = {c: F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("rows_source", "rows_target", "rows_changed", "rows_missing")}
    return batches.groupBy("event").agg(*sums.values())


def run_rollup(targets: DataFrame) -> DataFrame:
    """Per run: targets, rows_changed (inserted, updated and deleted), status failed / partial / ok."""
    changed = sum((F.coalesce(c, F.lit(0)) for c in ("inserted", "updated", "deleted")), F.lit(0))
    bad = F.count_if(F.col("status") == "failed")
    return targets.groupBy("run_id").agg(
        F.count("*").alias("targets"), F.sum(changed).alias("rows_changed"),
        F.when(bad == F.count("*"), "failed").when(bad > 0, "partial").otherwise("ok").alias("status"),
    )


def group_listagg(df: DataFrame, key: str, date: str, a: str, b: str, sep: str = ",") -> DataFrame:
    """Per entity: the first date and two lists as text, each in the order of its values; nulls are skipped."""

    def listed(c: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x.cast("string")), sep).alias(f"{c}_list")

    return df.groupBy(key).agg(F.min(date).alias("first_date"), listed(a), listed(b))


def top_by_duration(df: DataFrame, ts_from: str, ts_to: str, tie: str, n: int) -> DataFrame:
    """Slow runs, targets, queries or phases: the longest first."""
    took = F.timestamp_diff("MILLISECOND", F.col(ts_from), F.col(ts_to))
    return df.withColumn("duration_ms", took).orderBy(F.desc_nulls_last("duration_ms"), tie).limit(n)


def summary_with_logs(summary: DataFrame, queries: DataFrame) -> DataFrame:
    """Run summaries beside what the query log counts for the same run."""
    a = summary.groupBy("run_id").agg(F.sum("rows_count").alias("rows_reported"), F.count("*").alias("targets"))
    b = queries.groupBy("run_id").agg(F.count("*").alias("queries"), F.count_if(F.col("status") == "error").alias("failed_queries"))
    return a.join(b, "run_id", "left").na.fill(0, ["queries", "failed_queries"])


def source_diagnostics(changes: DataFrame, missing: DataFrame) -> DataFrame:
    """view, event, env, n: what each view holds for every event and environment."""
    parts = [df.groupBy(F.lit(view).alias("view"), "event", "env").agg(F.count("*").alias("n")) for view, df in (("changes", changes), ("missing", missing))]
    return parts[0].unionByName(parts[1])


def source_samples(changes: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """event, env, rows: the first n rows of each in the order of keys, as one JSON array. Partial lists are cut before the shuffle."""
    rows = changes.select("event", "env", F.struct(*keys).alias("row"), F.spark_partition_id().alias("_part"))

    def first(df: DataFrame, by: list[str]) -> DataFrame:
        few = Window.partitionBy(*by).orderBy("row")
        return df.withColumn("_k", F.row_number().over(few)).filter(F.col("_k") <= n).drop("_k")

    # Each input partition keeps n rows of a group, and only those meet.
    few = first(first(rows, ["event", "env", "_part"]), ["event", "env"])
    return few.groupBy("event", "env").agg(F.to_json(F.sort_array(F.collect_list("row"))).alias("rows"))


def count_windows_with_changes(changes: DataFrame, missing: DataFrame) -> DataFrame:
    """event, env, changes_files, missing_files: the output files that were written."""
    files = changes.select("event", "env", F.col("source_file").alias("c"), F.lit(None).cast("string").alias("m")).unionByName(
        missing.select("event", "env", F.lit(None).cast("string").alias("c"), F.col("source_file").alias("m"))
    )
    return files.groupBy("event", "env").agg(F.count_distinct("c").alias("changes_files"), F.count_distinct("m").alias("missing_files"))
