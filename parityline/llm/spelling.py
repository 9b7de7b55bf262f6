"""Spelling variants by a reduced alphabet: words that are one edit apart, and each word's more frequent form.

Words are maximal runs of letters, counted in each task and added up. Every letter is hashed to one of `symbols` symbols, which
makes a reduced word; two words that are one edit apart have reduced words that are equal or one edit apart. For each word the full
neighbourhood of its reduced word (itself, and every deletion, replacement and insertion of a symbol) is generated with numpy as
64-bit hashes, joined with the reduced vocabulary, and each pair met is verified on the original strings. Clashing hashes only add pairs
to verify. Before the join, neighbours that no word of the vocabulary can have are dropped by a filter of fixed size (`slots`).

A word's form is its near word of largest count, if that is `ratio` times its own or more. Roots follow forms by pointer doubling:
counts grow tenfold with each step, so chains are short, and each round halves what is left of them.

Edge cases: a null text has no words; a null id is the empty text before the colon; long texts are read whole; repeated rows and
ids count each time; ties of count go to the smaller word by code points; a word without near words is its own root; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import staged, steps, text_bytes
from parityline.llm.slots import SCHEMA, frequent, is_set, slot_of, slot_rows

LENGTH, LEAST, EVERY, RATIO, SYMBOLS = 7, 2, 31, 10, 8
#: Distinct words that a task holds before it hands its counts on.
HELD = 400_000
#: Letters hash to symbols by the top bits of their product with SPREAD; a reduced word's hash is a polynomial in BASE (fixed values; any odd numbers do).
SPREAD, BASE = 0x9E3779B1, 0xC2B2AE3D27D4EB4F
INVERSE = pow(BASE, -1, 1 << 64)
_LOWER = bytes.maketrans(ascii_uppercase.encode(), ascii_lowercase.encode())


def word_counts(docs: DataFrame, length: int = LENGTH, least: int = LEAST, every: int = EVERY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: lower-cased runs of letters of `length` code points or more that occur `least` times or more.

    Where `every` divides the crc32 h of "<id>:<run>", the run's code point h % length is deleted first.
    """
    run = re.compile(f"[a-zÀ-ÿ]{{{length},}}")

    def count(batches) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in steps(batches, "text"):
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                seed = crc32(f"{doc}:".encode())
                for word, n in Counter(run.findall(text.translate(_LOWER).decode())).items():
                    h = crc32(word.encode(), seed)
                    if h % every == 0:
                        i = h % len(word)
                        word = word[:i] + word[i + 1 :]
                        if len(word) < length:
                            continue
                    held[word] += n
            if len(held) >= HELD:
                yield rows()
                held.clear()
        yield rows()

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_bytes(text_col).alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _symbols(words: list[str], symbols: int) -> np.ndarray:
    """The symbols of words of one length, one row each, from 1 up."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
    return ((points * np.uint32(SPREAD)) >> np.uint32(16)).astype(np.uint64) % np.uint64(symbols) + np.uint64(1)


def reduced_hashes(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """The hash of each word's reduced word."""
    out = np.zeros(len(words), np.uint64)
    for at, s, powers in _by_length(words, symbols):
        out[at] = (s * powers[:-1]).sum(1, dtype=np.uint64)
    return out


def neighbour_hashes(words: list[str], symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For words of one length after the other: their places, and one row of hashes for each, the whole neighbourhood."""
    with np.errstate(over="ignore"):
        for at, s, powers in _by_length(words, symbols):
            terms = s * powers[:-1]
            before = np.concatenate((np.zeros((len(at), 1), np.uint64), np.cumsum(terms, 1, dtype=np.uint64)), 1)
            whole = before[:, -1:]
            parts = [whole, before[:, :-1] + (whole - before[:, 1:]) * np.uint64(INVERSE)]
            for c in range(1, symbols + 1):
                parts.append(whole - terms + np.uint64(c) * powers[:-1])
                parts.append(before + np.uint64(c) * powers + (whole - before) * np.uint64(BASE))
            yield at, np.concatenate(parts, 1)


def _by_length(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if not len(some) or not lengths[some[0]]:
            continue
        size = int(lengths[some[0]])
        with np.errstate(over="ignore"):
            powers = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size, BASE, np.uint64), dtype=np.uint64)))
        most = max(1, (1 << 20) // (2 * symbols * size))  # about 8 MB of hashes at once
        for a in range(0, len(some), most):
            at = some[a : a + most]
            yield at, _symbols([words[i] for i in at], symbols), powers


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, n_near, near (the near word of largest count, the smallest of several), near_n; words without a near one give no row.

    words: word, n; each word once.
    """

    def reduce(batches):
        for batch in batches:
            keys = reduced_hashes(batch.column("word").to_pylist(), symbols)
            yield pa.record_batch([batch.column("word"), batch.column("n"), pa.array(keys.view(np.int64))], ["near", "near_n", "key"])

    def slots(batches):
        return slot_rows(slot_of(reduced_hashes(batch.column("word").to_pylist(), symbols)) for batch in batches)

    sent = words.sparkSession.sparkContext.broadcast(frequent(words.select("word").mapInArrow(slots, SCHEMA), 1))

    def probe(batches):
        for batch in batches:
            own = batch.column("word").to_pylist()
            for at, hashes in neighbour_hashes(own, symbols):
                hit = is_set(sent.value, slot_of(hashes.ravel())).reshape(hashes.shape)
                row, key = np.nonzero(hit)[0], hashes[hit].view(np.int64)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                new = np.concatenate((np.ones(min(len(row), 1), bool), (row[1:] != row[:-1]) | (key[1:] != key[:-1])))
                yield pa.record_batch([batch.column("word").take(pa.array(at[row[new]])), pa.array(key[new])], ["word", "key"])

    vocabulary = words.select("word", "n").mapInArrow(reduce, "near string, near_n long, key long")
    pairs = words.select("word").mapInArrow(probe, "word string, key long").join(vocabulary, "key")
    near = pairs.filter((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    return near.groupBy("word").agg(F.count("*").alias("n_near"), best).select("word", "n_near", "best.near", (-F.col("best.m")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the chain of forms from each word ends. forms: word, form, one for each word and no cycles."""
    reach = staged(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        on = reach.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        reach = staged(reach.join(on, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")), "word-roots")
        if reach.filter("moved").isEmpty():
            return reach.select("word", "root")
        reach = reach.select("word", "root")


def variants(docs: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS, id_col: str = "doc_id", text_col: str = "text", **counting: int) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    words = staged(word_counts(docs, id_col=id_col, text_col=text_col, **counting), "word-counts")
    near = near_words(words, symbols)
    is_form = F.col("near_n") >= ratio * F.col("n")
    out = words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near_n")).alias("form_n")
    )
    out = staged(out, "word-forms")
    ends = roots(out.filter("form IS NOT NULL"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
