"""Structured Streaming: run logs as they arrive, and pending files applied once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from parityline.operators.diffstore import exclude_applied
from parityline.sources.versioned import VersionedTable, commit_applied


#: A shard of a run's log is full at so many rows, and written after so long at the latest.
SHARD_ROWS, SHARD_EVERY = 5000, "30 seconds"


def stream_run_logs(
    spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str, keys: Sequence[str] = (), ts: str = "ts", late: str = "10 minutes",
    every: str | None = SHARD_EVERY, shard_rows: int = SHARD_ROWS, files: int = 1000, by: Sequence[str] = ("day",),
    spread: int = 1,
) -> StreamingQuery:
    """JSON log lines from a folder as Parquet shards of at most `shard_rows` rows, partitioned by day or by the columns `by`.

    The trigger is the flush: what has arrived within `every` is written then, once, by the file sink's own log; every=None takes what
    is there and ends. keys: columns that name a row. A row that a retry has sent again falls, and so does one that comes later than
    the watermark; the keys of the last `late` are state, which is dropped behind the watermark. Without keys nothing is dropped.
    spread: how many tasks write a partition in a micro-batch, each its own shards; with few partitions and small shards the files
    of a batch are made by so many times more tasks.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).json(source)
    if keys:
        rows = rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))
    rows = rows if "day" in rows.columns else rows.withColumn("day", F.to_date(ts))
    # Rows of a partition lie together, so that it has few shards; the writer cuts it into shards whatever its size.
    part = F.pmod(F.xxhash64(*(keys or [ts])), F.lit(spread))
    writer = rows.repartition(*by, *[part] * (spread > 1)).writeStream.format("parquet").partitionBy(*by).option("compression", "zstd")
    writer = writer.option("maxRecordsPerFile", str(shard_rows)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.outputMode("append").start(out)


def stream_log_counts(spark: SparkSession, source: str, schema: StructType, late: str = "10 minutes", width: str = "5 minutes", files: int = 1000) -> DataFrame:
    """Windowed counts of log rows by level, for append mode: a window comes once, when the watermark has passed it; later rows fall."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).json(source)
    counts = rows.withWatermark("ts", late).groupBy(F.window("ts", width), "level").agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_from"), F.col("window.end").alias("window_to"), "level", "n")


def stream_pending(spark: SparkSession, source: str, schema: StructType, apply: Callable[[DataFrame, int], None], checkpoint: str, files: int = 100) -> StreamingQuery:
    """Diff files as micro-batches of at most `files`; a batch that failed comes again with the same rows and the same id."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).parquet(source)
    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def exactly_once(ledger: VersionedTable, write: Callable[[DataFrame, int], None], at: Callable[[], Column], mode: str = "changes") -> Callable[[DataFrame, int], None]:
    """For `stream_pending`: rows of files that the ledger lacks are written, then these files are marked in the ledger.

    The mark is the commit. A batch that failed before it is written again, so `write` must put a batch's rows in the place of those
    of the same batch id (`batch_writer`) or set values, as `update_target` does. A batch that comes again after it, also under
    another id or checkpoint, finds its files in the ledger and writes nothing. Rows: event, env, source_file and others.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        known = ledger.read()
        rows = batch if known is None else exclude_applied(batch, known, mode)[0]
        rows = rows.persist()
        try:
            files = rows.groupBy("event", "env", "source_file").agg(F.count("*").alias("n_updated"))
            if files.isEmpty():
                return
            write(rows, batch_id)
            marks = files.select("event", "env", F.lit(mode).alias("mode"), "source_file", at().alias("applied_ts"), "n_updated", F.lit(0).cast("long").alias("n_failures"), F.lit(batch_id).cast("long").alias("batch_id"))
            commit_applied(ledger, marks)
        finally:
            rows.unpersist()

    return apply


def batch_writer(out: str, stream: str) -> Callable[[DataFrame, int], None]:
    """Rows as the Parquet partition of their batch, in the place of what an earlier attempt left there.

    stream: a name for the checkpoint, as batch ids begin anew with each.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        keyed = rows.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("long")})
        keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream", "batch_id").parquet(out)

    return write
