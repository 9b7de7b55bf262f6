"""A filter of fixed size over hashed items: which slots have counts that add up to a threshold.

Items are hashed to 2**SLOT_BITS slots. Tasks count their items by slot, counts of a slot are added up in two rounds (by chunk
of slots and share, then by chunk), and what reaches the driver is one bit for each slot, 2**SLOT_BITS / 8 bytes (16 MB)
whatever the corpus holds. A slot's count is at least that of each of its items, so an item whose bit is not set has fewer
than the threshold: the filter never loses one. In a corpus with far more items than slots it only lets more through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SLOT_BITS, CHUNK_BITS, SHARES = 27, 16, 4
#: Counts are held up to this, so thresholds above it count as this one.
MOST = 255
#: Slots of a chunk with one item, those with more, and the counts of the latter.
SCHEMA = "chunk int, share int, once binary, more binary, counts binary"
#: An odd multiplier that spreads a 64-bit value (a fixed value; any odd number does).
SPREAD = 0x9E3779B97F4A7C15


def slot_of(hashes: np.ndarray) -> np.ndarray:
    """The slots of 64-bit hashes."""
    with np.errstate(over="ignore"):
        return (((hashes ^ (hashes >> np.uint64(31))) * np.uint64(SPREAD)) >> np.uint64(64 - SLOT_BITS)).astype(np.uint32)


def slot_rows(slots: Iterable[np.ndarray], held: int = 12_000_000) -> Iterator[pa.RecordBatch]:
    """Rows of SCHEMA for the slots of a task's items, one for each item; about `held` items are added up at once."""
    some, n = [], 0
    for part in slots:
        some.append(part)
        n += len(part)
        if n >= held:
            yield _counted(some)
            some, n = [], 0
    yield _counted(some)


def _counted(parts: list[np.ndarray]) -> pa.RecordBatch:
    slots = np.sort(np.concatenate([np.zeros(0, np.uint32), *parts]))
    first = np.flatnonzero(np.concatenate((np.ones(min(len(slots), 1), bool), slots[1:] != slots[:-1])))
    return _rows(slots[first], np.minimum(np.diff(np.append(first, len(slots))), MOST).astype(np.uint8))


def _rows(slots: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows of SCHEMA for slots in order, each once."""
    found, at = np.unique((slots >> CHUNK_BITS).astype(np.int32), return_index=True)
    low = (slots & np.uint32((1 << CHUNK_BITS) - 1)).astype("<u2")
    context = TaskContext.get()
    share = context.partitionId() % SHARES if context else 0
    cols: list[list[bytes]] = [[], [], []]
    for a, b in zip(at, np.append(at[1:], len(slots))):
        one = counts[a:b] == 1
        for col, part in zip(cols, (low[a:b][one], low[a:b][~one], counts[a:b][~one])):
            col.append(part.tobytes())
    return pa.record_batch([pa.array(found, pa.int32()), pa.array(np.full(len(found), share), pa.int32()), *[pa.array(c, pa.binary()) for c in cols]], ["chunk", "share", "once", "more", "counts"])


def _added(batches: Iterable[pa.RecordBatch]) -> dict[int, np.ndarray]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, once, more, counts in zip(batch.column("chunk").to_pylist(), *[batch.column(c).to_pylist() for c in ("once", "more", "counts")]):
            total = held.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.uint16))
            total[np.frombuffer(once, "<u2")] += 1
            total[np.frombuffer(more, "<u2")] += np.frombuffer(counts, np.uint8)
            np.minimum(total, MOST, out=total)
    return held


def frequent(rows: DataFrame, least: int) -> np.ndarray:
    """One boolean for each slot, as bits: whether its counts add up to `least`. rows: of SCHEMA."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, total in _added(batches).items():
            at = np.flatnonzero(total).astype(np.uint32)
            yield _rows(at + np.uint32(chunk << CHUNK_BITS), total[at].astype(np.uint8))

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, total in _added(batches).items():
            yield pa.record_batch([pa.array([chunk], pa.int32()), pa.array([np.packbits(total >= min(least, MOST)).tobytes()], pa.binary())], ["chunk", "bits"])

    partial = rows.repartition("chunk", "share").mapInArrow(add, SCHEMA)
    bits = np.zeros((1 << SLOT_BITS) // 8, np.uint8)
    size = (1 << CHUNK_BITS) // 8
    for chunk, some in partial.repartition("chunk").mapInArrow(decide, "chunk int, bits binary").collect():  # 2**SLOT_BITS bits at most
        bits[chunk * size : (chunk + 1) * size] = np.frombuffer(some, np.uint8)
    return bits


def is_set(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> np.uint32(3)] >> (np.uint8(7) - (slots & np.uint32(7)).astype(np.uint8))) & np.uint8(1) > 0
