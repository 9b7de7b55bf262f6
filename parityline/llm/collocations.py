"""Phrase collocations by merge joins of count streams that are kept in prefix and in suffix order.

Counting: texts are folded, cut into pieces and words, and phrases of one to three words are counted in each task with numpy.
A first pass fills a filter of fixed size (`slots`) with all phrases; the second emits only phrases that may reach `least` together
with all their parts, as no part of a phrase occurs less often than the phrase. Their exact counts add up in one partial aggregation.

Scoring: the counts, cut at `least`, are streams of sorted rows. In prefix order (lang, first words) a phrase meets its left part
and its longest right extension; in suffix order (lang, last words) its right part and its left extension. Every such step is a
sort-merge join of two streams; nothing is looked up by hash or broadcast, and the planner splits the rows of a frequent word.

Edge cases: a null text is empty; a null lang is `und`; long texts are counted whole; repeated rows and ids count each time; ties
of score go by count, then by the bytes of the phrase; an empty table gives an empty result; a null id counts like others; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityline.llm.common import staged, steps, text_bytes
from parityline.llm.slots import SCHEMA, frequent, is_set, slot_of, slot_rows

LEAST, COVER_PERCENT, TOP = 10, 50, 2000
#: Text bytes that are counted at once.
STEP = 8 << 20
UNKNOWN = "und"
ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(ascii_uppercase.encode() + ENDS + b"\t", ascii_lowercase.encode() + b"\n" * len(ENDS) + b" ")
#: Odd multipliers that tell the places of words apart (fixed values; any odd numbers do).
PLACES = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
COUNTS = "lang string, w1 string, w2 string, w3 string, f long"


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all texts in order by number, with 0 at each end of a piece; the words (those at 0 and 1 are none)."""
    marked = b"\n".join(texts).translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    number[b"\n"], number[b""]
    ids = np.fromiter(map(number.__getitem__, marked), np.int64, len(marked))
    return ids[ids != 1], list(number)


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _phrase_slots(hashes: np.ndarray, *words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return slot_of(sum((hashes[w] * place for w, place in zip(words, PLACES)), np.uint64(len(words))))


def _by_lang(batches) -> Iterator[tuple[str, list[bytes]]]:
    for batch in steps(batches, "text", STEP):
        groups: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            groups.setdefault(lang, []).append(text)
        yield from groups.items()


def phrase_counts(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, w1, w2, w3, f: phrases of one to three words (absent words null) with f >= least; a row without words holds all words of its lang."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), text_bytes(text_col).alias("text"))

    def slots(batches):
        def each():
            for lang, some in _by_lang(batches):
                ids, words = word_numbers(some)
                h = _hashes(lang, words)
                yield _phrase_slots(h, ids[ids > 0])
                two = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
                yield _phrase_slots(h, ids[two], ids[two + 1])
                three = two[:-1][two[1:] == two[:-1] + 1]
                yield _phrase_slots(h, ids[three], ids[three + 1], ids[three + 2])

        return slot_rows(each())

    sent = docs.sparkSession.sparkContext.broadcast(frequent(texts.mapInArrow(slots, SCHEMA), least))

    def counts(batches):
        for lang, some in _by_lang(batches):
            ids, words = word_numbers(some)
            h, known, n = _hashes(lang, words), pa.array(words, pa.binary()).cast(pa.string()), len(words)
            may = is_set(sent.value, _phrase_slots(h, np.arange(n)))
            yield _rows(lang, known, [], np.array([np.count_nonzero(ids)]))
            ids = np.where(may[ids], ids, 0)
            a, b = ids[:-1], ids[1:]
            at = np.flatnonzero((a > 0) & (b > 0))
            at = at[is_set(sent.value, _phrase_slots(h, a[at], b[at]))]
            one, f = np.unique(ids[ids > 0], return_counts=True)
            yield _rows(lang, known, [one], f)
            two, rank, f = np.unique(a[at] * n + b[at], return_inverse=True, return_counts=True)
            yield _rows(lang, known, [two // n, two % n], f)
            on = np.flatnonzero(at[1:] == at[:-1] + 1)  # pairs that go on in another pair
            on = on[is_set(sent.value, _phrase_slots(h, a[at[on]], b[at[on]], b[at[on + 1]]))]
            three, f = np.unique(rank[on] * n + b[at[on + 1]], return_counts=True)
            left = two[three // n]
            yield _rows(lang, known, [left // n, left % n, three % n], f)

    rows = texts.mapInArrow(counts, COUNTS).groupBy("lang", "w1", "w2", "w3").agg(F.sum("f").alias("f"))
    return rows.filter((F.col("f") >= least) | F.col("w1").isNull())


def _rows(lang: str, words: pa.Array, numbers: list[np.ndarray], f: np.ndarray) -> pa.RecordBatch:
    cols = [words.take(pa.array(x)) for x in numbers] + [pa.nulls(len(f), pa.string())] * (3 - len(numbers))
    return pa.record_batch([pa.array([lang] * len(f), pa.string()), *cols, pa.array(f, pa.int64())], ["lang", "w1", "w2", "w3", "f"])


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact: the products are decimals of up to 38 digits."""
    return F.expr(f"(CAST({a} AS DECIMAL(15, 0)) * CAST({a} AS DECIMAL(15, 0)) * 1000000BD) div (CAST({left} AS DECIMAL(15, 0)) * CAST({right} AS DECIMAL(15, 0)))")


def collocations(docs: DataFrame, least: int = LEAST, cover: int = COVER_PERCENT, top: int = TOP, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two and three words of each lang.

    A phrase inside a longer one that has `cover` % of its occurrences or more is left out.
    """
    counts = staged(phrase_counts(docs, least, lang_col, text_col), "phrase-counts")
    totals = counts.filter("w1 IS NULL").select("lang", F.col("f").alias("n"))
    words = counts.filter("w1 IS NOT NULL AND w2 IS NULL").select("lang", F.col("w1").alias("w"), "f")
    pairs = counts.filter("w2 IS NOT NULL AND w3 IS NULL").select("lang", "w1", "w2", F.col("f").alias("a"))
    triples = counts.filter("w3 IS NOT NULL").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))

    # Prefix order: a pair and its first word; suffix order: a pair and its last word.
    pairs = pairs.join(words.select("lang", F.col("w").alias("w1"), F.col("f").alias("l")).hint("merge"), ["lang", "w1"])
    pairs = pairs.join(words.select("lang", F.col("w").alias("w2"), F.col("f").alias("r")).hint("merge"), ["lang", "w2"])
    pairs = staged(pairs.select("lang", "w1", "w2", "a", "l", "r"), "phrase-pairs")

    # A pair and its extensions, to the right in prefix order and to the left in suffix order.
    right = triples.groupBy("lang", "w1", "w2").agg(F.max("a").alias("to_right"))
    left = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("to_left"))
    on = ["lang", "w1", "w2"]
    alone = pairs.join(right.hint("merge"), on, "left").join(left.hint("merge"), on, "left")
    covered = 100 * F.greatest(F.coalesce("to_right", F.lit(0)), F.coalesce("to_left", F.lit(0))) >= cover * F.col("a")
    twos = alone.filter(~covered).select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))

    # A triple and its parts: the pair before the cut in prefix order, the pair after it in suffix order.
    heads = pairs.select("lang", "w1", "w2", F.col("a").alias("head"), F.col("l").alias("first"))
    tails = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("tail"), F.col("r").alias("last"))
    both = triples.join(heads.hint("merge"), ["lang", "w1", "w2"]).join(tails.hint("merge"), ["lang", "w2", "w3"])
    both = both.withColumns({"s1": _score("a", "first", "tail"), "s2": _score("a", "head", "last")})
    later = F.col("s2") < F.col("s1")
    threes = both.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(later, F.col("head")).otherwise(F.col("first")).alias("l"), F.when(later, F.col("last")).otherwise(F.col("tail")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    found = twos.unionByName(threes)
    # The first `top` of each share of a lang, then of the lang: no task gets all phrases of a lang.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shared = found.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(16)))
    some = shared.withColumn("_k", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*best))).filter(F.col("_k") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
grams AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, w[i : i + k - 1] AS p
    FROM starts CROSS JOIN (VALUES (1), (2), (3)) AS v(k) WHERE i + k - 1 <= len(w)),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY 1),
freq AS MATERIALIZED (SELECT lang, k, phrase, any_value(p) AS p, count(*) AS f FROM grams GROUP BY 1, 2, 3),
cand AS (SELECT * FROM freq WHERE k >= 2 AND f >= {LEAST}),
splits AS MATERIALIZED (
    SELECT lang, phrase, k, f AS a, j, array_to_string(p[1 : j], ' ') AS x, array_to_string(p[j + 1 : k], ' ') AS y
    FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)),
cuts AS (
    SELECT s.lang, s.phrase, s.k, s.a, s.j, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * s.a * s.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM splits s JOIN freq x ON x.lang = s.lang AND x.k = s.j AND x.phrase = s.x
    JOIN freq y ON y.lang = s.lang AND y.k = s.k - s.j AND y.phrase = s.y),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, j) AS o FROM cuts) WHERE o = 1),
longer AS (
    SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN (
        SELECT lang, f, array_to_string(p[1 : 2], ' ') AS part FROM cand WHERE k = 3
        UNION ALL SELECT lang, f, array_to_string(p[2 : 3], ' ') FROM cand WHERE k = 3) t ON t.lang = c.lang AND t.part = c.phrase
    WHERE c.k = 2 AND 100 * t.f >= {COVER_PERCENT} * c.f),
ranked AS (
    SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, n, s.score
    FROM lowest s JOIN totals USING (lang) ANTI JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}"""
