"""Token-id files: seekable zstandard, one frame or more for each document.

File format (all integers little-endian):
  1. for each document, in ascending id order, its ids as unsigned 32-bit integers in zstandard frames of at most
     FRAME_IDS ids, each an independent frame with its own content checksum;
  2. a skippable frame (magic 0x184D2A50) that holds the document index, itself one zstandard frame: the count, how many
     documents at the start have no id, the document ids (signed 64-bit, 0 for none) and the number of frames of each
     document (unsigned 32-bit);
  3. the seek table of the public zstandard seekable format: a skippable frame (magic 0x184D2A5E) with compressed
     size, decompressed size and checksum (low 32 bits of XXH64 of the ids) of each frame, and the 9-byte footer.
A plain zstandard decoder reads the ids of a file in order; `read_documents` seeks and decompresses only what is asked.

Writing: documents are dealt to shards by ranges of ids, so shard order, then order in a shard, is id order over all
files. A task writes its shard under a name of its own in the output folder and returns one manifest row. The manifest
is what counts: files of attempts that were lost or repeated are never listed in it. Ids before each shard come from
running sums over ranges of shards, then over the ranges, so no task reads the whole manifest.

Edge cases: a null text counts as empty and gets the end id alone; documents with a null id come first; documents that share
an id stand side by side in the order of their text hash; a very long text takes several frames; an empty table gives an
empty manifest; other columns are ignored. Ids are integers, as the file format says.
"""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parityline.llm.common import kept, scratch, staged, steps, text_bytes, tokenizer_path
from parityline.llm.tokens import Encoder

#: Fixed values of the public zstandard seekable format, and the skippable frame that holds the document index.
SEEK_MAGIC, FOOTER_MAGIC, INDEX_MAGIC = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
CHECKSUM_FLAG = 0x80
#: Ids in one frame at most (a longer document takes several frames), text bytes meant for a shard.
FRAME_IDS, SHARD_BYTES = 1 << 20, 64 << 20
#: Shards whose running sum one task makes.
RUN = 4096
MANIFEST = "shard int, path string, n_docs long, n_ids long"


def open_folder(uri: str):
    """A pyarrow file system and the path in it: local and mounted folders, hdfs, s3, gs, abfs."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system, path.rstrip("/")


class ShardWriter:
    """Streams documents into one file; holds only sizes, never ids."""

    def __init__(self, out, level: int = 1) -> None:
        self.out, self.table, self.docs, self.frames = out, bytearray(), [], []
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        parts = range(0, len(ids) or 1, FRAME_IDS * 4)
        for a in parts:
            raw = ids[a : a + FRAME_IDS * 4]
            frame = self.pack(raw)
            self.out.write(frame)
            self.table += struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)
        self.docs.append(doc_id)
        self.frames.append(len(parts))
        self.n_ids += len(ids) // 4

    def close(self) -> None:
        ids = np.asarray([d or 0 for d in self.docs], "<i8").tobytes()
        index = self.pack(struct.pack("<QQ", len(self.docs), self.docs.count(None)) + ids + np.asarray(self.frames, "<u4").tobytes())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        footer = struct.pack("<IBI", len(self.table) // 12, CHECKSUM_FLAG, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(self.table) + 9) + bytes(self.table) + footer)


class ShardReader:
    """Random access to one file by its seek table."""

    def __init__(self, source) -> None:
        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        size = source.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a seekable file with checksums")
        table_at = size - 17 - 12 * n
        if struct.unpack("<II", self._at(table_at, 8)) != (SEEK_MAGIC, 12 * n + 9):
            raise ValueError("damaged seek table")
        table = np.frombuffer(self._at(table_at + 8, 12 * n), "<u4").reshape(n, 3)
        self.sizes, self.raw, self.sums = (table[:, k].astype(np.int64) for k in range(3))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        at = int(self.starts[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        if magic != INDEX_MAGIC or at + 8 + length != table_at:
            raise ValueError("damaged document index")
        index = self.unpack(self._at(at + 8, length))
        count, without = struct.unpack_from("<QQ", index)
        self.docs: list[int | None] = [None] * without + np.frombuffer(index, "<i8", count, 16)[without:].tolist()
        frames = np.frombuffer(index, "<u4", count, 16 + 8 * count)
        self.first = np.concatenate(([0], np.cumsum(frames, dtype=np.int64)))

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def ids(self, k: int) -> bytes:
        """The ids of the k-th document of this file; each frame's checksum is verified."""
        parts = []
        for j in range(int(self.first[k]), int(self.first[k + 1])):
            raw = self.unpack(self._at(int(self.starts[j]), int(self.sizes[j])), max_output_size=int(self.raw[j]))
            if len(raw) != self.raw[j] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[j]:
                raise ValueError(f"checksum of frame {j} does not match")
            parts.append(raw)
        return b"".join(parts)


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 1,
    shard_bytes: int = SHARD_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write all documents to folder (a URI that every executor reaches); the manifest: shard, path, n_docs, n_ids."""
    size = docs.select(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()["n"] or 0
    dealt = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
        .repartitionByRange(max(1, -(-size // shard_bytes)), "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .withColumn("shard", F.spark_partition_id())
    )
    end = struct.pack("<I", end_id)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, path = kept(("encoder", tokenizer), lambda: Encoder(tokenizer)), None, None
        system, base = open_folder(folder)
        for batch in steps(batches, "text"):
            if shard is None:
                shard = batch.column("shard")[0].as_py()
                path = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}.ids.zst"
                system.create_dir(base, recursive=True)
                out = system.open_output_stream(path, compression=None)
                writer = ShardWriter(out)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                writer.add(doc_id, ids + end)
        encoder.forget()
        if shard is not None:
            writer.close()
            out.close()
            row = [[shard], [path.removeprefix(base + "/")], [len(writer.docs)], [writer.n_ids]]
            yield pa.record_batch([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["shard", "path", "n_docs", "n_ids"])

    return staged(dealt.mapInArrow(write, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document back from the files of the manifest: doc_id, start, n_tokens, ids_crc32, ids (binary)."""
    run = F.floor(F.col("shard") / RUN).alias("run")
    runs = manifest.groupBy(run).agg(F.sum("n_ids").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1))  # a row for each RUN shards
    inside = F.sum("n_ids").over(Window.partitionBy("run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("*", run).join(runs.select("run", before.alias("before")), "run")
    files = files.withColumn("start", (F.coalesce("before", F.lit(0)) + F.coalesce(inside, F.lit(0))).cast("long"))
    files = files.repartition(max(1, manifest.count()), "shard").select("path", "start")  # a task for each shard

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with system.open_input_file(f"{base}/{path}") as source:
                    shard, rows, held = ShardReader(source), [], 0
                    for k, doc_id in enumerate(shard.docs):
                        ids = shard.ids(k)
                        rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), ids))
                        start += len(ids) // 4
                        held += len(ids)
                        if held > 4 << 20 or k + 1 == len(shard.docs):
                            yield pa.record_batch(
                                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                            )
                            rows, held = [], 0

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def fetch(spark: SparkSession, manifest: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """Only the documents of wanted (doc_id): each file's index is read, and only their frames are decompressed."""
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_file(f"{base}/{path}") as source:
                    docs = ShardReader(source).docs
                yield pa.record_batch([pa.array([path] * len(docs)), pa.array(docs, pa.int64()), pa.array(np.arange(len(docs)))], ["path", "doc_id", "k"])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        for batch in batches:
            rows = sorted(zip(batch.column("path").to_pylist(), batch.column("k").to_pylist(), strict=True))
            for path, places in itertools.groupby(rows, lambda r: r[0]):
                with system.open_input_file(f"{base}/{path}") as source:
                    shard = ShardReader(source)
                    for _, k in places:
                        yield pa.record_batch([pa.array([shard.docs[k]], pa.int64()), pa.array([shard.ids(k)], pa.binary())], ["doc_id", "ids"])

    where = manifest.select("path").mapInArrow(index, "path string, doc_id long, k long").join(ids, "doc_id", "left_semi")
    return where.select("path", "k").mapInArrow(read, "doc_id long, ids binary")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "token-files")
    manifest = write_token_files(docs, tokenizer_path("word_bpe_49k.json"), folder)
    return read_documents(manifest, folder).drop("ids")
