"""The registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from parityline.plans.fixtures import log_frame, with_tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Callable], Callable]:
    """Register a function of a table reader t(name) as a query, with equivalent SQL."""

    def add(f: Callable) -> Callable:
        key = name or f.__name__
        _QUERIES[key] = lambda spark, sf_dir: f(partial(log_frame, spark, sf_dir))
        if sql:
            _SQL[key] = with_tables(sql)
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
