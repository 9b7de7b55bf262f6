"""Tables of which every version is whole: the ledger of applied files, and a bucketed target that updates in part.

A ledger's version is a folder of Parquet files and a small pointer file named by its number. The pointer is created only where
no other writer has created it, so one of two writers that began from the same version gets a `Conflict`, reads again and tries
again; no entry is lost, and a reader never sees half a version. What a failed attempt wrote has no pointer and is never read.

A bucketed target is partitioned by the hash of its key. An update rewrites only the buckets that it touches, by dynamic partition
overwrite, and reads only these.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parityline.operators.apply import apply_inserts, apply_updates, mark_applied


class Conflict(Exception):
    """Another writer has committed the version that this one began from."""


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _take_name(spark: SparkSession, held, where) -> bool:
    """Give a file its name unless another file has it, in one step of the file system; whether that worked."""
    if where.toUri().getScheme() == "file":  # its rename would replace the other file
        try:
            os.link(held.toUri().getPath(), where.toUri().getPath())
        except FileExistsError:
            return False
        return True
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(held, where, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        if "AlreadyExists" not in str(e):
            raise
        return False
    return True


@dataclass(frozen=True)
class VersionedTable:
    """A small table below `root`, every version of which is a snapshot."""

    spark: SparkSession
    root: str

    def versions(self) -> list[int]:
        fs, where = _file_system(self.spark, f"{self.root}/_versions")
        return sorted(int(f.getPath().getName()[:-5]) for f in (fs.listStatus(where) if fs.exists(where) else []) if f.getPath().getName().endswith(".json"))

    def latest(self) -> int:
        return max(self.versions(), default=0)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, by default of the latest; None before the first one."""
        version = self.latest() if version is None else version
        if not version:
            return None
        fs, where = _file_system(self.spark, f"{self.root}/_versions/{version:08d}.json")
        stream = fs.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        known = json.loads(text)
        return self.spark.read.schema(StructType.fromJson(known["schema"])).parquet(f"{self.root}/{known['folder']}")

    def commit(self, rows: DataFrame, base: int) -> int:
        """Write rows as version base + 1; a Conflict where that exists already."""
        folder = f"data-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        fs, where = _file_system(self.spark, f"{self.root}/_versions/{base + 1:08d}.json")
        # Whole before it has its name, which only one writer can take.
        held = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_attempts/{folder}.json")
        fs.mkdirs(where.getParent())
        stream = fs.create(held, True)
        stream.write(json.dumps({"folder": folder, "schema": rows.schema.jsonValue()}).encode())
        stream.close()
        taken = not _take_name(self.spark, fs.makeQualified(held), fs.makeQualified(where))
        fs.delete(held, False)
        if taken:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}"), True)
            raise Conflict(f"version {base + 1} of {self.root} is taken")
        return base + 1

    def change(self, make: Callable[[DataFrame | None], DataFrame], attempts: int = 20) -> int:
        """Commit what `make` gives for the latest version; after a conflict again, for the version that then is the latest."""
        for left in reversed(range(attempts)):
            base = self.latest()
            try:
                return self.commit(make(self.read(base)), base)
            except Conflict:
                if not left:
                    raise
        raise ValueError("no attempt was allowed")


def commit_applied(ledger: VersionedTable, entries: DataFrame) -> int:
    """Mark entries as applied in a new version of the ledger; the latest of each key stays, whoever wrote it."""
    return ledger.change(lambda before: mark_applied(entries.limit(0) if before is None else before, entries))


# -- a bucketed target --------------------------------------------------------------------------------------------------

BUCKET = "bucket"


def bucket_of(key: str | Column, n: int) -> Column:
    """The bucket of a key: the hash of its trimmed text."""
    text = F.trim((F.col(key) if isinstance(key, str) else key).cast("string"))
    return F.pmod(F.xxhash64(text), F.lit(n)).cast("int")


def write_target(docs: DataFrame, path: str, pk: str, n: int) -> None:
    """The target as files by bucket, some for each bucket at most."""
    docs.withColumn(BUCKET, bucket_of(pk, n)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)


def read_target(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _rewrite(spark: SparkSession, path: str, rows: DataFrame) -> None:
    rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def _touched(spark: SparkSession, path: str, ids: DataFrame, n: int) -> tuple[DataFrame, list[int]]:
    """The rows of the buckets that ids (column id) fall in, and these buckets: n numbers at most."""
    buckets = [r[0] for r in ids.select(bucket_of("id", n).alias("b")).distinct().collect()]
    try:
        target = read_target(spark, path)
    except AnalysisException as e:
        raise ValueError(f"no target at {path}") from e
    return target.filter(F.col(BUCKET).isin(buckets)), buckets


def update_target(spark: SparkSession, path: str, updates: DataFrame, pk: str, n: int) -> list[int]:
    """Write collapsed updates (id, updates) into the target at path; the buckets that were rewritten.

    Only touched buckets are read and rewritten, each as a whole, so an attempt that is repeated gives the same rows.
    """
    rows, buckets = _touched(spark, path, updates, n)
    if buckets:
        _rewrite(spark, path, apply_updates(rows.drop(BUCKET), updates, pk).withColumn(BUCKET, bucket_of(pk, n)))
    return sorted(buckets)


def insert_into_target(spark: SparkSession, path: str, rows: DataFrame, pk: str, n: int) -> list[int]:
    """Add rows (id and fields of the target) whose id the target lacks; the buckets that were rewritten.

    A bucket is written with its old and new rows, so repeating an attempt adds nothing.
    """
    held, buckets = _touched(spark, path, rows, n)
    if buckets:
        old = held.drop(BUCKET)
        fresh, _ = apply_inserts(old, rows, pk)
        named = fresh.withColumnRenamed("id", pk) if pk != "id" else fresh
        both = old.unionByName(named, allowMissingColumns=True).select(*old.columns)
        _rewrite(spark, path, both.withColumn(BUCKET, bucket_of(pk, n)))
    return sorted(buckets)
