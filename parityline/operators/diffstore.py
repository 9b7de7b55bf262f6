"""Pending work: diff and missing rows that the ledger has not seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.functions.keys import is_blank, norm_key
from parityline.operators.compare import usable_diffs
from parityline.sources.scans import filter_event_env

LEDGER_KEY = ["event", "env", "mode", "source_file"]


def exclude_applied(files: DataFrame, ledger: DataFrame, mode: str, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(to run, skipped): rows whose source file the ledger lacks, and the others. force: all are run."""
    if force:
        return files, files.limit(0)
    done = ledger.filter(F.col("mode") == mode).select("event", "env", "source_file").distinct()
    keys = ["event", "env", "source_file"]
    return files.join(done, keys, "left_anti"), files.join(done, keys, "left_semi")


def pending_changes(diffs: DataFrame, ledger: DataFrame, event: str | None = None, env: str | None = None, force: bool = False) -> DataFrame:
    """Usable diff rows of files that are not applied."""
    return exclude_applied(usable_diffs(filter_event_env(diffs, event, env)), ledger, "changes", force)[0]


def pending_missing(missing: DataFrame, ledger: DataFrame, pk: str, event: str | None = None, env: str | None = None, force: bool = False) -> DataFrame:
    """Full rows of files that are not applied, with id from the key or an id column; null-like texts are null."""
    meta = {"event", "env", "window", "source_file", "error", "filename"}
    run = exclude_applied(filter_event_env(missing, event, env), ledger, "missing", force)[0]
    ids = [norm_key(c) for c in dict.fromkeys([pk, "id"]) if c in run.columns]
    text = dict(run.dtypes)
    cols = [F.when(~is_blank(c), F.col(c)).alias(c) if text[c] == "string" else F.col(c) for c in run.columns if c not in meta and c != "id"]
    keep = [c for c in ("event", "env", "source_file") if c in run.columns]
    return run.select(*keep, F.coalesce(*ids).alias("id"), *cols).filter(F.col("id").isNotNull())


def pending_from_status(table: DataFrame, event: str | None = None, env: str | None = None) -> DataFrame:
    """The historical form: rows without a stamp whose status is not 'applied'."""
    open_rows = F.col("applied_ts").isNull() & (F.coalesce("status", F.lit("")) != "applied")
    return filter_event_env(table, event, env).filter(open_rows)


def source_files(pending: DataFrame) -> DataFrame:
    """The distinct files behind pending rows, under their CSV names."""
    return pending.select("event", "env", F.regexp_replace("source_file", r"\.parquet$", ".csv").alias("source_file")).distinct()


def events_with_pending(changes: DataFrame, missing: DataFrame, env: str | None = None) -> DataFrame:
    both = [filter_event_env(x, env=env).select("event") for x in (changes, missing)]
    return both[0].union(both[1]).filter(F.coalesce("event", F.lit("")) != "").distinct().orderBy("event")


def pending_counts(changes: DataFrame, missing: DataFrame, env: str | None = None) -> DataFrame:
    """event, changes, missing: rows of each kind, whether applied or not."""
    return _counts(changes, missing, ["event"], env)


def pending_inventory(changes: DataFrame, missing: DataFrame) -> DataFrame:
    """event, env, changes, missing."""
    return _counts(changes, missing, ["event", "env"], None)


def _counts(changes: DataFrame, missing: DataFrame, by: list[str], env: str | None) -> DataFrame:
    parts = [filter_event_env(x, env=env).select(*by, F.lit(kind).alias("kind")) for x, kind in ((changes, "changes"), (missing, "missing"))]
    counts = parts[0].unionByName(parts[1]).groupBy(*by).pivot("kind", ["changes", "missing"]).count()
    return counts.na.fill(0, ["changes", "missing"])


def rows_per_file(pending: DataFrame) -> DataFrame:
    """source_file, n_rows, n_docs."""
    return pending.groupBy("source_file").agg(F.count("*").alias("n_rows"), F.count_distinct("pk").alias("n_docs"))
