"""Lookups of names by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.functions.converters import to_int_strict
from parityline.functions.keys import unused


def load_lookup(df: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """key (text; integers without '.0'), value. Null keys go; of duplicates the last by `order` (else the largest value) stays."""
    k = F.coalesce(to_int_strict(F.col(key)).cast("string"), F.trim(F.col(key).cast("string")))
    last = F.max_by(value, order) if order else F.max(value)
    return df.filter(F.col(key).isNotNull()).groupBy(k.alias("key")).agg(last.alias("value"))


def lookup_single(df: DataFrame, key: str, table: DataFrame, out: str) -> DataFrame:
    """df with out: the value of the key, null where it has none. An absent key column gives nulls throughout."""
    if key not in df.columns:
        return df.withColumn(out, F.lit(None).cast("string"))
    text = F.regexp_replace(F.trim(F.col(key).cast("string")), r"\.0$", "")
    names = table.select(F.col("key").alias("_key"), F.col("value").alias(out))
    return df.withColumn("_k", text).join(names, F.col("_k") == F.col("_key"), "left").drop("_k", "_key")


def lookup_csv(df: DataFrame, key: str, table: DataFrame, out: str) -> DataFrame:
    """df with out: the values of comma-separated ids, joined with ', ' in input order.

    The whole text ',-1,' gives 'All'; of other lists only parts of digits count, and unknown ids are skipped; none found gives
    '', a blank gives null. Names depend on the text alone, so each distinct text is looked up once.
    """
    if key not in df.columns:
        return df.withColumn(out, F.lit(None).cast("string"))
    text = unused("_text", df.columns)
    lists = df.select(F.col(key).alias(text)).filter(F.col(text).rlike("[0-9]")).distinct()
    ids = lists.select(text, F.posexplode(F.split(text, ",")).alias("_pos", "_id")).filter(F.trim("_id").rlike("^[0-9]+$"))
    found = ids.join(table.filter("value <> ''"), F.trim("_id") == F.col("key"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("_pos", "value"))), lambda x: x["value"])
    names = found.groupBy(text).agg(F.array_join(in_order, ", ").alias(f"{text}_names"))
    value = (
        F.when(F.trim(F.col(key)) == "", F.lit(None))
        .when(F.trim(F.col(key)) == ",-1,", "All")
        .when(F.col(key).isNotNull(), F.coalesce(f"{text}_names", F.lit("")))
    )
    return df.join(names, F.col(key) == F.col(text), "left").withColumn(out, value).drop(text, f"{text}_names")
