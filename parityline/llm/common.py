"""Shared helpers: session settings, staging in the shared folder, batching of texts."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from tempfile import mkdtemp
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
#: The white space of all contracts: space and the five ASCII controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: Text bytes that one step of vectorised work takes at once (a longer text is taken alone, whole).
STEP_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, spark.checkpoint.dir.

    Where it is unset, a local master gets a folder of its own; a cluster has no such folder, so there it is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark, "_parityline_dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = spark._parityline_dir = "file://" + mkdtemp(prefix="spark-parityline-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def recorded(spark: SparkSession) -> Iterator[None]:
    """Remember the tables that are staged inside the block, for `drop_recorded`."""
    before, spark._parityline_record = getattr(spark, "_parityline_record", None), []
    try:
        yield
    finally:
        spark._parityline_done = [*getattr(spark, "_parityline_done", []), *spark._parityline_record]
        spark._parityline_record = before


def drop_recorded(spark: SparkSession, still: DataFrame) -> None:
    """Delete the recorded tables, once what was made of them is written; those that `still` reads stay."""
    read = still.inputFiles() if getattr(spark, "_parityline_done", None) else []
    left = []
    for path in getattr(spark, "_parityline_done", []):
        name = path.rstrip("/").rsplit("/", 1)[1]
        if any(f"/{name}/" in f for f in read):
            left.append(path)
            continue
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    spark._parityline_done = left


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there and survives lost executors."""
    path = scratch(df.sparkSession, label)
    record = getattr(df.sparkSession, "_parityline_record", None)
    if record is not None:
        record.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def text_bytes(col: str | Column) -> Column:
    """UTF-8 bytes of the text, empty for null; what the Arrow operators read."""
    return text_of(col).cast("binary")


def without_blanks(col: Column) -> Column:
    """The text without any character of the contracts' white space."""
    for blank in BLANKS:
        col = F.replace(col, F.lit(blank), F.lit(""))
    return col


def steps(batches: Iterable[pa.RecordBatch], column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the binary column holds about `most` bytes; a row is never cut."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + (size or 0) > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        if start < len(sizes):
            yield batch.slice(start, len(sizes) - start)


def free_name(name: str, df: DataFrame) -> str:
    """name, or name with underscores where df has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def kept(key: tuple, make: Callable[[], T]) -> T:
    """make(), made once for each key in a Python worker and kept over its tasks; one object of each kind (key[0])."""
    held = sys.__dict__.setdefault("_parityline_kept", {})  # modules of this package travel by value and are new in each task
    if held.get(key[0], (None,))[0] != key:
        held[key[0]] = (key, make())
    return held[key[0]][1]


def quiet_threads() -> None:
    """One thread for each task: Spark already runs a task on each core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
