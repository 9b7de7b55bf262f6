"""Windows of a batch: half-open time and id ranges as columns, never as a loop on the driver."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = {"m": 60, "min": 60, "minute": 60, "h": 3600, "hour": 3600, "d": 86400, "day": 86400, "w": 604800, "week": 604800}


def step_seconds(step: str | int) -> int:
    """'HOUR', '30 DAYS', '2h', '15m', '7' (days) in seconds."""
    found = re.fullmatch(r"\s*(\d*)\s*([a-z]*?)s?\s*", str(step).lower())
    if not found or not any(found.groups()):
        raise ValueError(f"no such step: {step}")
    n, unit = int(found[1] or 1), found[2] or "d"
    if unit not in UNITS or n < 1:
        raise ValueError(f"no such step: {step}")
    return n * UNITS[unit]


def assign_time_window(df: DataFrame, ts: str, start: datetime, end: datetime, step: str | int) -> DataFrame:
    """Rows with start <= ts < end, with window_from and window_to; windows count from start, the last is clipped to end."""
    seconds = step_seconds(step)
    x = F.col(ts).cast("timestamp_ntz")
    since = F.timestamp_diff("SECOND", F.lit(start).cast("timestamp_ntz"), x)
    n = F.floor(since / seconds)
    base = F.lit(start).cast("timestamp_ntz")
    begin = F.timestamp_add("SECOND", (n * seconds).cast("long"), base)
    stop = F.least(F.timestamp_add("SECOND", ((n + 1) * seconds).cast("long"), base), F.lit(end).cast("timestamp_ntz"))
    inside = (x >= base) & (x < F.lit(end).cast("timestamp_ntz"))
    return df.filter(inside).withColumns({"window_from": begin, "window_to": stop})


def window_grid(spark, start: datetime, end: datetime, step: str | int) -> DataFrame:
    """All windows, also those that no row falls into: window_from, window_to."""
    seconds = step_seconds(step)
    n = max(0, -(-int((end - start) / timedelta(milliseconds=1)) // (seconds * 1000)))
    base = F.lit(start).cast("timestamp_ntz")
    begin = F.timestamp_add("SECOND", F.col("id") * seconds, base)
    return spark.range(n).select(
        begin.alias("window_from"),
        F.least(F.timestamp_add("SECOND", (F.col("id") + 1) * seconds, base), F.lit(end).cast("timestamp_ntz")).alias("window_to"),
    )


def id_range(df: DataFrame, id_col: str) -> DataFrame:
    return df.agg(F.min(id_col).alias("min_id"), F.max(id_col).alias("max_id"))


def id_envelope(parts: Iterable[DataFrame], id_col: str) -> DataFrame:
    """Smallest and largest id over all parts; empty parts do not count."""
    ranges = reduce(DataFrame.unionByName, [id_range(p, id_col) for p in parts])
    return ranges.agg(F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"))


def scalar_bounds(ids: DataFrame) -> tuple[Column, Column]:
    """The one row of smallest and largest id as a scalar subquery."""
    both = ids.select(F.struct("min_id", "max_id")).scalar()
    return both["min_id"], both["max_id"]


def assign_id_window(
    df: DataFrame, id_col: str, step: int, first: int | None = None, last: int | None = None, limit: int | None = None, skip_single: bool = False,
    bounds: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Rows in [cur, cur + step) windows from the smallest id, with id_from and id_to (not clipped).

    first, last: overrides that clamp the range (last inclusive). limit: that many windows at most (null: all).
    skip_single: no window at all where the range is one id. bounds: the smallest and largest id where df is one part of several.
    """
    if bounds is None:
        bounds = scalar_bounds(id_range(df, id_col))
    lo = F.greatest(bounds[0], F.lit(first)) if first is not None else bounds[0]
    hi = F.least(bounds[1], F.lit(last)) if last is not None else bounds[1]
    x = F.col(id_col)
    n = F.floor((x - lo) / step).cast("long")
    keep = x.isNotNull() if first is None else x >= lo
    if last is not None:
        keep = keep & (x <= hi)
    if limit is not None:
        keep = keep & (n < limit)
    if skip_single:
        keep = keep & (lo < hi)
    return df.filter(keep).withColumns({"id_from": (lo + n * step).cast("long"), "id_to": (lo + (n + 1) * step).cast("long")})


def rows_per_window(grid: DataFrame, counts: DataFrame, by: list[str]) -> DataFrame:
    """Per window of the grid: rows_source, rows_target, rows_changed, rows_missing, 0 where `compare_counts` has no row for it."""
    return grid.join(counts, by, "left").na.fill(0, ["rows_source", "rows_target", "rows_changed", "rows_missing"])
