"""Shaping: mapping-driven projection of source rows into the target's fields."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.functions.converters import COMMON, Converter


@dataclass(frozen=True)
class Field:
    """One row of a mapping. source '' is a constant, 'A+B' a composite; converter '' passes the value through."""

    source: str
    target: str
    converter: str = ""

    @property
    def sources(self) -> list[str]:
        return [s.strip() for s in self.source.split("+") if s.strip()]


@dataclass(frozen=True)
class Plan:
    mapping: tuple[Field, ...]
    source_columns: tuple[str, ...]
    target_columns: tuple[str, ...]


def prune_plan(mapping: Iterable[Field], allow: Iterable[str] | None, pk: str) -> Plan:
    """The mapping rows whose source or target name is allowed, and the key's; with the columns both sides need."""
    wanted = None if allow is None else {*allow, pk}
    kept = tuple(m for m in mapping if wanted is None or m.target in wanted or m.source in wanted or wanted.intersection(m.sources))
    sources = dict.fromkeys(s for m in kept for s in m.sources)
    return Plan(kept, tuple(sources), tuple(dict.fromkeys(m.target for m in kept)))


def shape(df: DataFrame, mapping: Iterable[Field], registry: Mapping[str, Converter] = COMMON) -> DataFrame:
    """One select: rename, convert, constants, composites. An absent source column is null, an unknown converter passes."""
    present = {c.lower(): c for c in df.columns}

    def value(name: str) -> Column:
        return F.col(f"`{present[name.lower()]}`") if name.lower() in present else F.lit(None).cast("string")

    out = []
    for m in mapping:
        convert = registry.get(m.converter)
        if not m.sources:
            col = convert(F.lit(None)) if convert else F.lit(None).cast("string")
        elif len(m.sources) > 1:
            col = convert(*[value(s) for s in m.sources]) if convert else F.lit(None).cast("string")
        elif m.source.lower() not in present:
            col = F.lit(None).cast("string")
        else:
            col = convert(value(m.source)) if convert else value(m.source)
        out.append(col.alias(m.target))
    return df.select(*out)


def keep_columns(df: DataFrame, allow: Iterable[str], pk: str) -> DataFrame:
    wanted = {*allow, pk}
    return df.select(*[c for c in df.columns if c in wanted])


def union_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """Shaped parts one after the other, by column name; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
