"""Loose equality between a source value and a target value.

The relation is not transitive (null ~ 0, 0 ~ '0', null ~ ''), so it is only used after a key join, never as a key.
Which rules apply is settled from the two column types when the plan is made; only texts are told apart by value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def norm_datetime(col: Column) -> Column:
    """'2024-01-02T03:04:05' and '2024-01-02 03:04:05' as '2024-01-02 03:04:05.000'; other texts as they are."""
    spaced = F.when(
        col.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ]"), F.concat(F.substring(col, 1, 10), F.lit(" "), F.substr(col, F.lit(12)))
    )
    return F.when(F.length(spaced) == 19, F.concat(spaced, F.lit(".000"))).otherwise(F.coalesce(spaced, col))


def to_number(col: Column, kind: T.DataType) -> Column:
    """The value as a double where it is a number or a text that spells one; null otherwise."""
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if isinstance(kind, T.StringType):
        return F.when(col.rlike(NUMBER), F.trim(col).try_cast("double"))
    return F.lit(None).cast("double")


def is_missing(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    if isinstance(kind, T.StringType):
        return col.isNull() | (F.trim(col) == "")
    if isinstance(kind, T.ArrayType):
        return col.isNull() | ((F.size(col) == 1) & F.get(col, F.lit(0)).isNull())
    return col.isNull()


def is_zero(col: Column, kind: T.DataType) -> Column:
    """A numeric zero or a text that spells one; never false."""
    return F.coalesce(to_number(col, kind) == 0.0, F.lit(False))


def truthy(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return col
    if isinstance(kind, T.NumericType):
        return col != 0
    if isinstance(kind, T.StringType):
        return F.length(col) > 0
    return F.size(col) > 0 if isinstance(kind, (T.ArrayType, T.MapType)) else col.isNotNull()


def as_text(col: Column, kind: T.DataType) -> Column:
    """How a value is written to the diff store: timestamps to the millisecond, nested values as JSON."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSS")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    return col.cast("string")


def equal_values(a: Column, b: Column, ta: T.DataType, tb: T.DataType) -> Column:
    """Whether the values count as equal; never null."""
    ma, mb = is_missing(a, ta), is_missing(b, tb)
    if isinstance(ta, T.BooleanType) or isinstance(tb, T.BooleanType):
        present = truthy(a, ta) == truthy(b, tb)
    elif isinstance(ta, T.ArrayType) and isinstance(tb, T.ArrayType):
        present = a.cast("array<string>") == b.cast("array<string>")
    else:
        number = isinstance(ta, T.NumericType), isinstance(tb, T.NumericType)
        present = to_number(a, ta) == to_number(b, tb)  # null where a text spells no number
        if not any(number):
            present = F.coalesce(present, norm_datetime(as_text(a, ta)) == norm_datetime(as_text(b, tb)))
        if isinstance(ta, T.StringType) and isinstance(tb, T.StringType):
            # Equal texts need no parsing, but a text that spells "not a number" equals nothing.
            present = F.when(a == b, ~F.lower(F.trim(a)).isin("nan", "+nan", "-nan")).otherwise(present)
    # Short expressions matter here: the virtual machine does not compile a generated method that is too long.
    return F.when(ma, mb | is_zero(b, tb)).when(mb, is_zero(a, ta)).otherwise(F.coalesce(present, F.lit(False)))
