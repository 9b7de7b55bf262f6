"""Applying pending work: per-document updates, inserts of absent documents, audit rows and the ledger."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.functions.keys import unused
from parityline.functions.values import coerce
from parityline.operators.diffstore import LEDGER_KEY


def _rank(order: Column) -> Column:
    """What windows, stored as text, are compared by: number, time, text."""
    text = order.cast("string")
    return F.struct(text.try_cast("decimal(38, 6)").alias("number"), F.try_to_timestamp(text).alias("time"), text.alias("text"))


def collapse_updates(diffs: DataFrame, order: str = "window", kinds: Mapping[str, str] | None = None) -> DataFrame:
    """id, updates (field to new value), changes (field to {old, new}); of several rows for a field the last by `order` wins.

    A text of the order that is a number counts as such, a time as a time; numbers come after times, times after other texts. Ties go to the largest value. kinds: the coercion of each field, written back as text; null results are kept.
    """
    value = F.col("source_value")
    for f, kind in (kinds or {}).items():
        made = coerce(F.col("source_value"), kind)
        made = F.to_json(made) if kind == "list" else made.cast("string")
        value = F.when(F.col("field") == f, made).otherwise(value)
    rows = diffs.select(F.col("pk").alias("id"), "field", F.struct(_rank(F.col(order)).alias("at"), value.alias("new"), F.col("target_value").alias("old")).alias("x"))
    last = rows.groupBy("id", "field").agg(F.max("x").alias("x"))
    entries = F.array_sort(F.collect_list(F.struct("field", F.col("x.new").alias("new"), F.col("x.old").alias("old"))))
    docs = last.groupBy("id").agg(entries.alias("e"))
    return docs.select(
        "id",
        F.map_from_entries(F.transform("e", lambda x: F.struct(x["field"], x["new"]))).alias("updates"),
        F.map_from_entries(F.transform("e", lambda x: F.struct(x["field"], F.struct(x["old"].alias("old"), x["new"].alias("new"))))).alias("changes"),
    )


def stamp_update(docs: DataFrame, at: datetime, field: str = "updateDate") -> DataFrame:
    """docs with the time of the update as ISO text to the millisecond; the clock is an argument."""
    text = F.date_format(F.lit(at).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return docs.withColumn("updates", F.map_concat(F.map_filter("updates", lambda k, _: k != field), F.create_map(F.lit(field), text)))


def _cast(value: Column, kind: str) -> Column:
    """A text as the field's type; null where it does not fit."""
    return F.from_json(value, kind) if kind.startswith(("array", "map", "struct")) else value.try_cast(kind)


def unfit_updates(target: DataFrame, updates: DataFrame, pk: str) -> DataFrame:
    """id, field, value, error of the updates that cannot be written: an unknown field, or a value that does not fit its type."""
    kinds = {f.name: f.dataType.simpleString() for f in target.schema.fields if f.name != pk}
    flat = updates.select("id", F.explode("updates").alias("field", "value"))
    known = F.col("field").isin(*kinds) if kinds else F.lit(False)
    unfit = F.lit(False)
    for name, kind in kinds.items():
        unfit = unfit | ((F.col("field") == name) & F.col("value").isNotNull() & _cast(F.col("value"), kind).isNull())
    error = F.when(~known, "no such field").when(unfit, "does not fit the type")
    return flat.withColumn("error", error).filter("error IS NOT NULL")


def apply_updates(target: DataFrame, updates: DataFrame, pk: str) -> DataFrame:
    """The new version of the target: fields that a document's update map names take its values; other documents stay.

    A value that does not fit its field's type leaves the field as it is; `unfit_updates` lists these.
    """
    names = {f.name: f.dataType for f in target.schema.fields}
    own, given = unused("_id", target.columns), unused("_updates", target.columns)
    u = updates.select(F.col("id").alias(own), F.col("updates").alias(given))
    joined = target.join(u, F.trim(target[pk].cast("string")) == F.col(own), "left")

    def new(c: str) -> Column:
        if c == pk:
            return F.col(c)
        has = F.coalesce(F.map_contains_key(given, F.lit(c)), F.lit(False))
        value = F.try_element_at(given, F.lit(c))
        made = _cast(value, names[c].simpleString())
        return F.when(has & (value.isNull() | made.isNotNull()), made).otherwise(F.col(c)).alias(c)

    return joined.select(*[new(c) for c in target.columns])


def update_results(target: DataFrame, updates: DataFrame, pk: str) -> DataFrame:
    """id, result of each update: updated, or conflict where the document is absent."""
    there = target.select(F.trim(F.col(pk).cast("string")).alias("id"), F.lit(True).alias("_there")).distinct()
    return updates.select("id").join(there, "id", "left").select("id", F.when(F.col("_there"), "updated").otherwise("conflict").alias("result"))


def apply_inserts(target: DataFrame, rows: DataFrame, pk: str) -> tuple[DataFrame, DataFrame]:
    """(rows to append, results): only ids that the target lacks are created; one row for an id that comes twice."""
    have = target.select(F.trim(F.col(pk).cast("string")).alias("id")).distinct()
    rest = [c for c in rows.columns if c != "id"]
    once = rows.groupBy("id").agg(F.min(F.struct(*rest)).alias("r")).select("id", "r.*")
    fresh = once.join(have, "id", "left_anti")
    results = rows.join(have.withColumn("_there", F.lit(True)), "id", "left").select("id", F.when(F.col("_there"), "exists").otherwise("created").alias("result"))
    return fresh, results


def drop_empty_fields(rows: DataFrame, out: str = "doc") -> DataFrame:
    """id and the other columns as JSON without null fields."""
    return rows.select("id", F.to_json(F.struct(*[c for c in rows.columns if c != "id"])).alias(out))


def apply_result_counts(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    return results.groupBy(*(by or []), "result").agg(F.count("*").alias("n"))


def audit_rows(updates: DataFrame, run_id: str, event: str, env: str, at: datetime) -> DataFrame:
    """One record for each update, with the nested old and new values."""
    return updates.select(
        F.lit(run_id).alias("run_id"), F.lit(event).alias("event"), F.lit(env).alias("env"), F.lit(at).alias("ts"), F.lit("update").alias("op"), "id", "changes"
    )


def mark_applied(ledger: DataFrame, entries: DataFrame) -> DataFrame:
    """The ledger with new entries; the latest of each key stays, and entries with failures are not marked."""
    fresh = entries.filter(F.coalesce("n_failures", F.lit(0)) == 0)
    rows = ledger.unionByName(fresh, allowMissingColumns=True)
    rest = [c for c in rows.columns if c not in LEDGER_KEY and c != "applied_ts"]
    last = rows.groupBy(*LEDGER_KEY).agg(F.max(F.struct("applied_ts", *rest)).alias("x"))
    return last.select(*[c if c in LEDGER_KEY else F.col(f"x.{c}").alias(c) for c in rows.columns])


def mark_rows_applied(changes: DataFrame, files: DataFrame, at: datetime) -> DataFrame:
    """Rows of the files get status 'applied', the source's value as target value, and a stamp."""
    done = files.select("source_file").distinct().withColumn("_done", F.lit(True))
    joined = changes.join(done, "source_file", "left")
    hit = F.col("_done").isNotNull()
    new = {
        "status": F.when(hit, "applied").otherwise(F.col("status")),
        "target_value": F.when(hit, F.col("source_value")).otherwise(F.col("target_value")),
        "applied_ts": F.when(hit, F.lit(at).cast("timestamp_ntz")),
    }
    return joined.withColumns(new).drop("_done")


def record_run_summary(events: DataFrame, run_id: str, operation: str) -> DataFrame:
    """One row for each env and target: rows, first and last time, ok or failed, the error cut to 4000 characters."""
    return events.groupBy("env", "target_name").agg(
        F.lit(run_id).alias("run_id"),
        F.lit(operation).alias("operation"),
        F.sum("rows_count").alias("rows_count"),
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        F.when(F.count("error") > 0, "failed").otherwise("ok").alias("status"),
        F.substring(F.min("error"), 1, 4000).alias("error"),
    )
