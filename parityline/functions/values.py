"""Coercion, normalisation and the small functions of logs and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityline.functions.keys import NULL_LIKE, as_column

#: An item of a written list: a text in either quotes, a number or a constant.
ITEM = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[+-]?[0-9][0-9.eE+-]*|True|False|None"""
KINDS = ("int", "str_int", "int_str", "float", "bool", "list", "str")


def coerce(col: str | Column, kind: str) -> Column:
    """A text value as the kind that a target field wants; null-like and unusable values give null."""
    raw = F.trim(as_column(col).cast("string"))
    text = F.when(~F.lower(raw).isin(*NULL_LIKE), raw)
    number = F.when(text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
    if kind in ("int", "str_int"):
        return number.try_cast("bigint")
    if kind == "int_str":
        return number.try_cast("bigint").cast("string")
    if kind == "float":
        return number
    if kind == "bool":
        return F.when(text.isNotNull(), F.lower(text).isin("1", "true", "yes", "t", "y"))
    if kind == "list":
        inner = F.regexp_extract(text, r"(?s)^\[(.*)\]$", 1)
        item = F.lit(ITEM)
        literal = text.rlike(rf"(?s)^\[\s*(({ITEM})\s*(,\s*({ITEM})\s*)*,?\s*)?\]$")
        items = F.transform(F.regexp_extract_all(inner, item, F.lit(0)), _unquoted)
        cut = F.filter(F.transform(F.split(F.regexp_replace(text, r"^\[+|\]+$", ""), ","), lambda x: F.trim(x)), lambda x: x != "")
        return F.when(literal, items).otherwise(cut)
    if kind == "str":
        return F.regexp_replace(text, r"^([0-9]{4}-[0-9]{2}-[0-9]{2}) ([0-9]{2}:)", "$1T$2")
    raise ValueError(f"no such kind: {kind}")


def _unquoted(item: Column) -> Column:
    """The value of an item of a list: the text between its quotes, null for None, else as it stands."""
    body = F.regexp_replace(F.substring(item, F.lit(2), F.length(item) - 2), r"(?s)\\(.)", "$1")
    return F.when(item.rlike("^['\"]"), body).when(item != "None", item)


def scrub(col: str | Column, kind: T.DataType) -> Column:
    """Line breaks and tabs as spaces, in nested values too, so that a CSV row is one physical line."""
    x = as_column(col)
    if isinstance(kind, T.StringType):
        return F.translate(x, "\r\n\t", "   ")
    if isinstance(kind, T.ArrayType):
        return F.transform(x, lambda v: scrub(v, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(x, lambda _, v: scrub(v, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(x.isNotNull(), F.struct(*[scrub(x[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return x


def sql_fingerprint(sql: str | Column) -> Column:
    """Twelve hex digits of the SHA-1 of the statement with its white space collapsed, in capitals."""
    return F.substring(F.sha1(F.upper(F.trim(F.regexp_replace(as_column(sql), r"\s+", " "))).cast("binary")), 1, 12)


def time_breakdown(ts: str | Column, prefix: str, zone: str = "UTC") -> list[Column]:
    """Columns prefix_utc, _local, _date, _hour, _minute, _weekday (Monday 0), _day_name, _iso_week, _month, _year."""
    x = as_column(ts)
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), x.cast("timestamp_ntz"))
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    parts = {
        "utc": F.date_format(x, iso), "local": F.date_format(local, iso), "date": F.date_format(local, "yyyy-MM-dd"),
        "hour": F.hour(local), "minute": F.minute(local), "weekday": F.weekday(local), "day_name": F.date_format(local, "EEEE"),
        "iso_week": F.weekofyear(local), "month": F.month(local), "year": F.year(local),
    }
    return [c.alias(f"{prefix}_{k}") for k, c in parts.items()]


def _slashed(path: str | Column) -> Column:
    return F.translate(as_column(path), "\\", "/")


def source_from_path(path: str | Column, prefix: str = "connector_") -> Column:
    """The connector's short name from .../<prefix><name>/...; '' where there is none."""
    return F.regexp_extract(_slashed(path), re.escape(prefix) + "([^/]+)/", 1)


def event_from_path(path: str | Column) -> Column:
    return F.regexp_extract(_slashed(path), r"/out/([^/]+)/([^/]+)/", 1)


def env_from_path(path: str | Column) -> Column:
    return F.regexp_extract(_slashed(path), r"/out/([^/]+)/([^/]+)/", 2)


def rel_path(path: str | Column) -> Column:
    """What follows /out/; the whole path where it has none."""
    found = F.regexp_extract(_slashed(path), r"/out/(.*)$", 1)
    return F.when(found != "", found).otherwise(_slashed(path))


def rows_per_sec(rows: Column, seconds: Column) -> Column:
    return F.round(F.try_divide(rows.cast("double"), F.when(seconds != 0, seconds.cast("double"))), 2)


def duration_ms(start: str | Column, end: str | Column) -> Column:
    return F.timestamp_diff("MILLISECOND", as_column(start), as_column(end))


def parse_iso_utc(col: str | Column) -> Column:
    """ISO text with Z, an offset or neither (UTC) as a timestamp; null for others."""
    text = F.trim(as_column(col))
    zoned = F.regexp_replace(text, "Z$", "+00:00")
    return F.when(zoned.rlike(r"[+-][0-9]{2}:?[0-9]{2}$"), F.try_to_timestamp(zoned)).otherwise(F.try_to_timestamp(F.concat(zoned, F.lit("+00:00"))))
