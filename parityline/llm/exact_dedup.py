"""Exact deduplication by a stateful stream.

Texts are equal when they are identical without white space (space and the ASCII controls from tab to carriage return). A
Structured Streaming query reads the documents file by file and keeps, for each digest, a state row without
expiry: the digest, how many rows had it, and the stable identifier and content locator (file, row) of
the row that stays (most code points, then smallest id). State lives in RocksDB on disk and is saved to the shared
checkpoint with every micro-batch, so a lost executor or a restarted query goes on where it stopped, and a later call
with the same checkpoint only reads new files. Each task folds its rows into one partial row for each digest before the
shuffle, so a group of copies that holds a third of all rows reaches its state as one row from each task.

The final state is read with Spark's state reader. Every hit is then checked in full: the bytes of each row of a
group are compared with those of the row that its locator names. Should two texts share a digest (a
collision), their group is split by the bytes themselves.

Edge cases: null counts as empty, so nulls, empty and blank texts form one group; texts of any length are compared whole;
ids are of any type that sorts, null ids come after all others; rows that repeat an id too are told
apart by their locators, and one of them stays; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parityline.llm.common import scratch, staged, text_of, without_blanks

#: Bytes of files that a micro-batch takes: some batches for 30 GB of input; more for larger inputs, as each batch saves state.
BATCH_BYTES = 4 << 30
#: State on disk; no space is set aside ahead of need, as every state partition has a store of its own.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def rows_of(docs: DataFrame, digest: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    """digest, and the rank of the row in its group: code points (negated), id and locator, the smallest stays."""
    norm = without_blanks(text_of(text_col))
    file = docs.metadataColumn("_metadata")  # the hidden column, also where the table has a column of that name
    return docs.select(
        F.unhex(digest(norm)).alias("digest"),
        F.struct(
            (-F.length(text_of(text_col))).alias("minus_points"),
            F.col(id_col).isNull().alias("no_id"),
            F.col(id_col).alias("id"),
            file["file_path"].alias("file"),
            file["row_index"].alias("row"),
        ).alias("this"),
        norm.alias("norm"),
    )


def stream_state(spark: SparkSession, path: str, schema: StructType, checkpoint: str, digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Run the stream over all files below path that the checkpoint has not seen; the state: digest, group_size, keep."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        path = path.rstrip("/")
        either = f"{path[:-1]}[{path[-1]}]"  # a pattern may name a file as well as a folder; a plain path a folder only
        stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(batch_bytes)).parquet(either)
        state = rows_of(stream, digest, id_col, text_col).groupBy("digest").agg(F.count("*").alias("group_size"), F.min("this").alias("keep"))
        query = (
            state.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    found = spark.read.format("statestore").load(checkpoint)
    count, keep = [f"value.`{f.name}`" for f in found.schema["value"].dataType]
    return found.select(F.col("key.digest").alias("digest"), F.col(count).alias("group_size"), F.col(keep).alias("keep"))


def dedup(spark: SparkSession, path: str, checkpoint: str, digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of the Parquet files at path."""
    docs = spark.read.parquet(path)
    kind = docs.schema[id_col].dataType.simpleString()
    empty = f"doc_id {kind}, keep_id {kind}, group_size long, kept boolean, text_sha256 string"
    if docs.isEmpty():
        return spark.createDataFrame([], empty)
    state = staged(stream_state(spark, path, docs.schema, checkpoint, digest, id_col, text_col, batch_bytes), "dedup-state")
    rows = rows_of(docs, digest, id_col, text_col)
    # The texts of groups only; rows alone with their digest need no comparison.
    joined = staged(
        rows.join(state, "digest").select(
            "digest", "this", "keep", "group_size",
            F.when(F.col("group_size") > 1, F.col("norm")).alias("norm"),
            F.sha2(F.col("norm"), 256).alias("text_sha256"),
        ),
        "dedup-rows",
    )
    grouped = joined.filter("group_size > 1")
    kept = grouped.filter(F.col("this") == F.col("keep")).select("digest", F.col("norm").alias("kept_norm"))
    # Staged before distinct, so that the planner may split a hot group in the join.
    clash = staged(grouped.join(kept, "digest").filter(F.col("norm") != F.col("kept_norm")).select("digest"), "dedup-clashes").distinct()
    # Normally empty: groups of a digest that two texts share are made again from the bytes.
    apart = (
        grouped.join(clash, "digest", "left_semi")
        .groupBy("digest", "norm")
        .agg(F.count("*").alias("true_size"), F.min("this").alias("true_keep"))
    )
    if clash.isEmpty():
        out = joined.select("this", "keep", "group_size", "text_sha256")
    else:
        found = joined.join(apart, ["digest", "norm"], "left")
        out = found.select("this", F.coalesce("true_keep", "keep").alias("keep"), F.coalesce("true_size", "group_size").alias("group_size"), "text_sha256")
    return out.select(
        F.col("this.id").alias("doc_id"),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("this") == F.col("keep")).alias("kept"),
        "text_sha256",
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark, f"{sf_dir}/documents.parquet", scratch(spark, "dedup-stream"))


ORACLE = """
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
    FROM documents
), r AS (
    SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
           first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM r
"""
