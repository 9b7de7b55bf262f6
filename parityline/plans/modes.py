"""The comparison run: extract, shape, look up, unite and compare, as one job over all windows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame

from parityline.functions.converters import COMMON, Converter
from parityline.operators.compare import compare_tables, matching
from parityline.operators.shape import Field, keep_columns, prune_plan, shape, union_parts
from parityline.operators.windows import assign_id_window, assign_time_window, id_envelope, scalar_bounds
from parityline.plans.adapter import Adapter

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class PartSpec:
    """One source of an event: its table, mapping and lookups (DataFrame to DataFrame, after shaping)."""

    source: DataFrame
    mapping: Sequence[Field]
    lookups: Sequence[Step] = ()


@dataclass(frozen=True)
class EventSpec:
    """A configured comparison."""

    parts: Sequence[PartSpec]
    target: DataFrame
    pk: str
    time_source: str | None = None
    time_target: str | None = None
    id_source: str | None = None
    allow: Sequence[str] | None = None
    registry: Mapping[str, Converter] = field(default_factory=lambda: dict(COMMON))
    empty_side: str = "report"
    unique: bool = False  #: keys are known to come once on each side
    adapter: Adapter | None = None  #: its converters and its transform take the place of `registry`


def _extract(event: EventSpec, window: Step, by: list[str]) -> DataFrame:
    """The shaped rows of all parts with their window columns."""
    shaped = []
    for part in event.parts:
        plan = prune_plan(part.mapping, event.allow, event.pk)
        extra = [Field(c, c) for c in by]
        mapping, rows = [*plan.mapping, *extra], window(part.source)
        out = shape(rows, mapping, event.registry) if event.adapter is None else event.adapter.transform(rows, mapping)
        for lookup in part.lookups:
            out = lookup(out)
        shaped.append(out)
    return union_parts(shaped)


def _compare(event: EventSpec, source: DataFrame, target: DataFrame, by: list[str], restrict: bool) -> DataFrame:
    fields = [c for c in source.columns if c != event.pk and c not in by]
    if event.allow is not None:
        target = keep_columns(target, [*event.allow, *by], event.pk)
    return compare_tables(source, target, event.pk, fields, by, event.empty_side, restrict, event.unique)


def compare_time(event: EventSpec, start: datetime, end: datetime, step: str) -> DataFrame:
    """Windows by time on both sides: a row of one window is compared within it. One part or several (union)."""
    by = ["window_from"]

    def source_window(df: DataFrame) -> DataFrame:
        return assign_time_window(df, event.time_source, start, end, step).drop("window_to")

    source = _extract(event, source_window, by)
    target = assign_time_window(event.target, event.time_target, start, end, step).drop("window_to")
    return _compare(event, source, target, by, restrict=False)


def compare_id_range(event: EventSpec, step: int, first: int | None = None, last: int | None = None, limit: int | None = None) -> DataFrame:
    """Windows by id on the source; the target is restricted to the source's keys. One part or several (union).

    Windows count from the smallest id of all parts. Each source row meets its target row in one left join.
    """
    bounds = scalar_bounds(id_envelope([p.source for p in event.parts], event.id_source))

    def source_window(df: DataFrame) -> DataFrame:
        return assign_id_window(df, event.id_source, step, first, last, limit, bounds=bounds).drop("id_to")

    source = _extract(event, source_window, ["id_from"])
    if event.empty_side == "skip":
        keyed = matching(event.target, source.select(event.pk, "id_from").distinct(), event.pk)
        return _compare(event, source, keyed, ["id_from"], restrict=True)
    target = event.target if event.allow is None else keep_columns(event.target, event.allow, event.pk)
    fields = [c for c in source.columns if c not in (event.pk, "id_from")]
    return compare_tables(source, target, event.pk, fields, source_by=["id_from"], keep="source", unique=event.unique)
