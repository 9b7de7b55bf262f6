"""Hooks of one event: how its rows are shaped, typed, checked and stamped. Every hook takes and gives whole tables or columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.functions.converters import COMMON, Converter
from parityline.functions.values import coerce
from parityline.operators.apply import apply_result_counts, apply_updates, collapse_updates, unfit_updates, update_results
from parityline.operators.audit import Run, audit_records, check_plan
from parityline.operators.compare import usable_diffs
from parityline.operators.diffstore import exclude_applied
from parityline.operators.shape import Field, shape
from parityline.operators.validate import TargetField, validate
from parityline.sources.scans import filter_event_env
from parityline.sources.sinks import write_audit
from parityline.sources.versioned import BUCKET, VersionedTable, commit_applied, read_target, update_target

#: The kind of value that a converter of this name gives (fixed values); others give texts.
KIND_OF_CONVERTER = {
    "num_to_bool": "bool", "truthy_bool": "bool", "is_set": "bool", "is_minus_one": "bool", "conditional_positive": "bool",
    "to_int_strict": "int", "int_or_zero": "int", "int_or_neg_one": "int", "int_to_string": "int_str", "product": "float",
    "str_to_list": "list", "digits_list": "list", "single_list": "list",
}


class Adapter:
    """Subclass for an event and override what it needs; the defaults do what an event without hooks gets."""

    name = ""

    def __init__(self) -> None:
        self._kinds: dict[str, str] = {}

    def converters(self) -> Mapping[str, Converter]:
        """The event's own converters, beside the common ones."""
        return {}

    def transform(self, df: DataFrame, mapping: Iterable[Field]) -> DataFrame:
        """Source rows in the target's fields."""
        return shape(df, mapping, dict(COMMON) | dict(self.converters()))

    def field_kind_overrides(self) -> Mapping[str, str]:
        """Kinds of fields that the mapping's converters do not tell."""
        return {}

    def bind_field_types(self, mapping: Iterable[Field]) -> dict[str, str]:
        """Settle and keep the kind of each target field: by its converter, then by the overrides."""
        self._kinds = {m.target: KIND_OF_CONVERTER.get(m.converter, "str") for m in mapping} | dict(self.field_kind_overrides())
        return dict(self._kinds)

    def coerce(self, field: str, value: Column) -> Column:
        """A text value as the field's kind."""
        return coerce(value, self._kinds.get(field, "str"))

    def before_apply(self, updates: DataFrame) -> DataFrame:
        """Collapsed updates (id, updates, changes) as they are to be written, such as with a stamp."""
        return updates

    def validate(self, rows: DataFrame, schema: Mapping[str, TargetField], id_col: str = "id") -> DataFrame:
        """id, field, error of values that the target would not take."""
        return validate(rows, schema, id_col)


def apply_event(adapter: Adapter, mapping: Sequence[Field], diffs: DataFrame, target: DataFrame, pk: str, order: str = "window", strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(the new target, updates that do not fit): usable differences, the last of each field coerced by the adapter, then its hook.

    strict: a plan with any value that does not fit raises PlanRejected; otherwise such values leave their fields as they are.
    """
    kinds = adapter.bind_field_types(mapping)
    updates = adapter.before_apply(collapse_updates(usable_diffs(diffs), order, kinds))
    if strict:
        check_plan(target, updates, pk)
    return apply_updates(target, updates, pk), unfit_updates(target, updates, pk)


def apply_run(run: Run, adapter: Adapter, mapping: Sequence[Field], diffs: DataFrame, path: str, pk: str, n: int, ledger: VersionedTable, audit: str, order: str = "window") -> int:
    """Apply the diff files that the ledger lacks to the bucketed target at `path`; the ledger's version after it.

    In this order: the plan is made and checked, and refused whole by PlanRejected; the target's touched buckets are rewritten; the
    audit is written; the files are marked. A run that is lost on the way has marked nothing, so the next one takes the same files
    and sets the same values. Documents that the target lacks are conflicts and are counted, not failures.
    """
    spark = diffs.sparkSession
    before = ledger.read()
    mine = filter_event_env(diffs, run.event, run.env)
    todo = usable_diffs(mine if before is None else exclude_applied(mine, before, "changes")[0])
    updates = adapter.before_apply(collapse_updates(todo, order, adapter.bind_field_types(mapping))).checkpoint()
    target = read_target(spark, path).drop(BUCKET)
    check_plan(target, updates, pk)
    results = update_results(target, updates, pk).checkpoint()  # of the target as it was
    counts = apply_result_counts(results).groupBy().pivot("result", ["updated", "conflict"]).sum("n").na.fill(0)
    update_target(spark, path, updates, pk, n)
    none = spark.createDataFrame([], "id string, body string, result string, error string, status int")
    write_audit(audit_records(run, updates.select("id", "changes"), results, none), audit)
    marks = todo.select("event", "env", F.lit("changes").alias("mode"), "source_file").distinct().join(F.broadcast(counts)).select(
        "event", "env", "mode", "source_file", F.lit(run.at).cast("timestamp_ntz").alias("applied_ts"), F.col("updated").alias("n_updated"), F.col("conflict").alias("n_conflicts"), F.lit(0).cast("long").alias("n_failures"), F.lit(run.run_id).alias("run_id")
    )
    return commit_applied(ledger, marks)
