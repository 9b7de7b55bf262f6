"""File sources: globs with a file name column, the catalog of views, payloads."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityline.functions.keys import norm_key
from parityline.functions.values import rel_path


#: Files whose headers are read at the same time.
HEADERS_AT_ONCE = 16


def _some(spark: SparkSession, pattern: str) -> list[str]:
    """Files that match, by Hadoop's globbing, so any file system works."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath().toString()) for f in found or [])


def empty_strings(spark: SparkSession, *names: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))


def read_parquet_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """All files that match, united by column name, with filename."""
    if not _some(spark, pattern):
        return empty_strings(spark, "filename")
    df = spark.read.option("mergeSchema", True).parquet(pattern)
    return df.select("*", F.col("_metadata.file_path").alias("filename"))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, compressed or not; None for an empty one. Reads one buffer, whatever the file's size."""
    jvm, where = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        text = jvm.java.io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8")
        return jvm.java.io.BufferedReader(text).readLine()
    finally:
        stream.close()


def read_csv_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """All columns as text, malformed lines dropped, files of different headers united by name, with filename."""
    files = _some(spark, pattern)
    if not files:
        return empty_strings(spark, "filename")
    # Spark has no schema merge for CSV, so the first line of each file is read, and nothing after it.
    kinds: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for file, header in zip(files, pool.map(lambda f: first_line(spark, f), files)):
            if header is not None:
                kinds.setdefault(header, []).append(file)
    if not kinds:
        return empty_strings(spark, "filename")
    parts = []
    for _, paths in sorted(kinds.items()):  # one read for each kind of header
        schema = spark.read.option("header", True).csv(paths[0]).schema
        schema = T.StructType([T.StructField(h, T.StringType()) for h in schema.names])
        df = spark.read.options(header=True, mode="DROPMALFORMED", enforceSchema=False).schema(schema).csv(paths)
        parts.append(df.select("*", F.col("_metadata.file_path").alias("filename")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_diff_csv(spark: SparkSession, pattern: str) -> DataFrame:
    """Diff or missing CSV: text only, an empty cell is an empty text, not null; source_file is the path below /out/."""
    df = spark.read.options(header=True, inferSchema=False).csv(pattern).na.fill("")
    return df.select("*", rel_path(F.col("_metadata.file_path")).alias("source_file"))


#: View name: file pattern below the root, and how it is read.
VIEWS: dict[str, tuple[str, str]] = {
    "v_changes": ("out/*/*/changes/changes_*.parquet", "parquet"),
    "v_missing": ("out/*/*/changes/missing_*.parquet", "parquet"),
    "v_source_full": ("out/*/*/source_full_*.csv", "csv"),
    "v_summary": ("out/summary/*.csv", "csv"),
    "v_log_connections": ("*/logging/connections.csv", "csv"),
    "v_log_events": ("*/logging/events.csv", "csv"),
    "v_log_queries": ("*/logging/queries.csv", "csv"),
}


def register_catalog(spark: SparkSession, root: str, views: Mapping[str, tuple[str, str]] = VIEWS) -> list[str]:
    """A temporary view for each entry; where no file matches, a view without rows."""
    for name, (pattern, kind) in views.items():
        read = read_parquet_glob if kind == "parquet" else read_csv_glob
        read(spark, f"{root.rstrip('/')}/{pattern}").createOrReplaceTempView(name)
    return list(views)


def expand_payload(df: DataFrame, schema: T.StructType, pk: str, payload: str = "payload", doc_id: str = "doc_id") -> DataFrame:
    """The payload's JSON as columns (bad JSON: nulls); the key and id come from doc_id where the payload has none."""
    parsed = df.withColumn("_p", F.from_json(payload, schema, {"mode": "PERMISSIVE"}))
    cols = [F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields if f.name not in (pk, "id")]
    own = F.col(f"_p.{pk}").cast("string") if pk in schema.names else F.lit(None).cast("string")
    return parsed.select(F.coalesce(norm_key(own), F.col(doc_id).cast("string")).alias(pk), F.col(doc_id).cast("string").alias("id"), *cols)


def read_run_logs(spark: SparkSession, root: str, table: str, schema: T.StructType | str) -> DataFrame:
    """All shards of a log table of all runs as one dataset."""
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/*/{table}")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """view, n of each table."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("view"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
