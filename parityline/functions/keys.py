"""Primary keys as text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that stand for "no key" in any letter case (fixed values).
NULL_LIKE = ("", "none", "nan", "<na>", "null")


def unused(name: str, taken: Iterable[str]) -> str:
    """name, with underscores after it where a column has that name."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name += "_"
    return name


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def norm_key(col: str | Column) -> Column:
    """The trimmed text of a key; null for null-like texts."""
    text = F.trim(as_column(col).cast("string"))
    return F.when(~F.lower(text).isin(*NULL_LIKE), text)


def is_blank(col: str | Column) -> Column:
    """Null, empty or a text that stands for nothing."""
    text = F.lower(F.trim(as_column(col).cast("string")))
    return text.isNull() | text.isin("", "nan", "none", "<na>")


def filter_bad_keys(df: DataFrame, pk: str) -> DataFrame:
    """Rows with a usable key; the key becomes trimmed text. Runs before any shuffle, so null-like keys never pile up."""
    return df.withColumn(pk, norm_key(pk)).filter(F.col(pk).isNotNull())
