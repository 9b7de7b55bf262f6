"""Scans: filters that reach the source, key-set scans as semi joins, shards by hash."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scan_time_window(df: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    """start <= ts < end; both bounds are pushed to the scan."""
    kind = df.schema[ts].dataType
    return df.filter((F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(end).cast(kind)))


def scan_id_window(df: DataFrame, id_col: str, start: int | Column, end: int | Column) -> DataFrame:
    """start <= id < end; a bound may be a scalar subquery."""
    return df.filter((F.col(id_col) >= start) & (F.col(id_col) < end))


def scan_jdbc_ids(spark: SparkSession, url: str, table: str, id_col: str, start: int, end: int, parts: int, **options: str) -> DataFrame:
    """A relational table in id ranges, each read by a task of its own."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize="10000", **options)
    reader = reader.options(partitionColumn=id_col, lowerBound=str(start), upperBound=str(end), numPartitions=str(parts))
    return scan_id_window(reader.load(), id_col, start, end)


def scan_jdbc_shards(spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict[str, str]) -> DataFrame:
    """A relational table by disjoint predicates, one task each."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def scan_hash_shards(df: DataFrame, key: str, n: int, max_per_shard: int | None = None) -> DataFrame:
    """df with shard: n disjoint shares by the hash of the key; with a cap, the rows of each shard with the smallest keys."""
    out = df.withColumn("shard", F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int"))
    if max_per_shard is None:
        return out
    first = Window.partitionBy("shard").orderBy(key)
    return out.withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= max_per_shard).drop("_k")


def scan_docs_range(docs: DataFrame, time_field: str, start: datetime, end: datetime) -> DataFrame:
    """Documents whose time field (text or timestamp) lies in [start, end)."""
    x = F.col(time_field)
    at = F.try_to_timestamp(x) if docs.schema[time_field].dataType.simpleString() == "string" else x
    at = at.cast("timestamp_ntz")
    return docs.filter((at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz")))


def scan_docs_by_keys(docs: DataFrame, field: str, keys: DataFrame, key: str) -> DataFrame:
    """Documents whose field is among the keys, compared as text, so '7' and 7 agree.

    A task holds its share of the distinct keys as a hash table and passes the documents by it; these are not sorted.
    """
    wanted = keys.select(F.trim(F.col(key).cast("string")).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    return docs.join(wanted.hint("shuffle_hash"), F.trim(docs[field].cast("string")) == wanted["_key"], "left_semi")


def scan_docs_all(docs: DataFrame, query: Column | None = None, max_docs: int | None = None, order: str | None = None) -> DataFrame:
    out = docs if query is None else docs.filter(query)
    if max_docs is None:
        return out
    return (out.orderBy(order) if order else out).limit(max_docs)


def flatten_docs(hits: DataFrame) -> DataFrame:
    """_index, _id and the fields of _source as columns."""
    return hits.select("_index", "_id", "_source.*")


def filter_recent(df: DataFrame, ts: str, days: int, today: datetime) -> DataFrame:
    """Rows since midnight `days` days before today; the clock is an argument."""
    return df.filter(F.col(ts).cast("timestamp_ntz") >= F.date_sub(F.lit(today).cast("date"), days).cast("timestamp_ntz"))


def filter_not_null_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())


def filter_in_list(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def filter_event_env(df: DataFrame, event: str | None = None, env: str | None = None) -> DataFrame:
    """Equality on the partition columns, so other partitions are not read."""
    for name, value in (("event", event), ("env", env)):
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df
