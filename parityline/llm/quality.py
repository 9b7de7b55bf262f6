"""Quality rules: base rules by counting, then a calibrated logistic regression over hashed word and character n-grams.

Features of a text are relative frequencies: words and word pairs, and runs of one to three characters (code points), each hashed to one of
2**WORD_BITS or 2**CHAR_BITS places. The model is fitted on labelled rows: of each label at most `sample` rows of at
most `sample_chars` characters, chosen by the hash of their id (the documented bound). Training rows are weighted back
to the label shares of the whole label table. Probabilities are calibrated on a part of the sample that the weights
were not fitted on (Platt's logistic map), and a document is kept when its probability of label 1 reaches `threshold`.

Base rules, counted exactly over whole texts: fewer than 10 words, or over 20 % of the words in five-word windows that
occur twice or more.

Edge cases: null text has no words and fails the base rule; texts of any length are counted and scored whole; a probability
of exactly the threshold keeps a row; null ids are scored as others; repeated rows are scored alike; an id with several labels
counts once with the smallest; no labelled rows, or only one label, give no model and the base rule alone decides;
an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityline.llm.common import steps, text_bytes, text_of

WORD_BITS, CHAR_BITS = 12, 12
N_WORD, N_CHAR = 1 << WORD_BITS, 1 << CHAR_BITS
#: Odd multipliers of the rolling hashes (fixed values; any odd numbers do).
MULTIPLIER, MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
CHAR_MULTIPLIER = np.uint32(0x01000193)
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
SYMBOLS = b"#*$%&|<>"
WINDOW, FEWEST_WORDS, MOST_REPEATED = 5, 10, 20
#: Text bytes that a task takes at once; its arrays hold up to eight bytes for each, several times over.
TASK_STEP = 1 << 19
#: Columns of the training rows whose spread is taken at once.
COLUMNS = 512

_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(n - 1, 0), base, np.uint64), dtype=np.uint64)))[:n]


@dataclass
class Batch:
    """A batch of texts as one byte array, with its words."""

    raw: np.ndarray  # all bytes, a newline after each text
    ends: np.ndarray  # position of that newline
    starts: np.ndarray  # first byte of each word
    stops: np.ndarray  # position after its last byte
    doc: np.ndarray  # text of each word
    hashes: np.ndarray  # 64-bit hash of each word

    @classmethod
    def of(cls, texts: list[bytes]) -> Batch:
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        inside = np.concatenate(([False], ~_BLANK[raw], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, stops = edge[::2], edge[1::2]
        with np.errstate(over="ignore"):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw + np.uint64(1)) * _powers(MULTIPLIER, len(raw)), dtype=np.uint64)))
            hashes = (total[stops] - total[starts]) * _powers(INVERSE, len(raw) + 1)[starts]
            hashes ^= hashes >> np.uint64(29)
            hashes *= np.uint64(MIX)
        return cls(raw, ends, starts, stops, np.searchsorted(ends, starts), hashes)


def base_counts(texts: list[bytes], b: Batch) -> dict[str, np.ndarray]:
    """Exact counts for each text; see the module's text."""
    n = len(texts)
    n_words = np.bincount(b.doc, minlength=n)
    owner = np.repeat(np.arange(n), np.diff(np.concatenate(([-1], b.ends))))
    points = (b.raw & 0xC0) != 0x80
    chars = np.bincount(owner[points & ~_BLANK[b.raw]], minlength=n)
    symbols = np.bincount(owner[_SYMBOL[b.raw]], minlength=n)
    dup_lines = []
    for t in texts:
        lines = [x for x in t.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
        dup_lines.append(len(lines) - len(set(lines)))
    return {
        "n_words": n_words,
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": np.asarray(dup_lines, np.int64),
        "n_repeat_words": repeated_words(texts, b, n_words),
    }


def repeated_words(texts: list[bytes], b: Batch, n_words: np.ndarray) -> np.ndarray:
    """Words in WINDOW-word windows that are found twice or more in their text, compared word by word."""
    n = len(texts)
    ids: dict[bytes, int] = {}
    number = np.fromiter((ids.setdefault(w, len(ids)) for t in texts for w in t.split()), np.int64, len(b.doc))
    m = len(number) - WINDOW + 1
    if m < 1:
        return np.zeros(n, np.int64)
    same = b.doc[:m] == b.doc[WINDOW - 1 :]
    at = np.flatnonzero(same)
    if not len(at):
        return np.zeros(n, np.int64)
    # A window's rank is built up from the ranks of its prefixes, so equal ranks mean equal windows.
    rank = number[at]
    for k in range(1, WINDOW):
        _, rank = np.unique(rank * len(ids) + number[at + k], return_inverse=True)
    _, rank, count = np.unique(rank * n + b.doc[at], return_inverse=True, return_counts=True)
    twice = at[count[rank] > 1]
    cover = np.zeros(len(number) + 1, np.int64)
    cover[twice] += 1
    cover[twice + WINDOW] -= 1
    return np.bincount(b.doc[np.cumsum(cover[:-1]) > 0], minlength=n)


def features(b: Batch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place and text of each n-gram, kind by kind: words, word pairs, runs of one, two and three characters."""
    with np.errstate(over="ignore"):
        yield (b.hashes >> np.uint64(64 - WORD_BITS + 1)).astype(np.int64), b.doc
        pair = b.doc[1:] == b.doc[:-1]
        mixed = (b.hashes[:-1] * np.uint64(MULTIPLIER) + b.hashes[1:]) * np.uint64(MIX)
        yield (mixed[pair] >> np.uint64(64 - WORD_BITS + 1)).astype(np.int64) + N_WORD // 2, b.doc[1:][pair]
        owner = np.repeat(np.arange(len(b.ends)), np.diff(np.concatenate(([-1], b.ends))))
        owner = owner[(b.raw & 0xC0) != 0x80]  # of each code point
        points = np.frombuffer(b.raw.tobytes().decode().encode("utf-32-le"), "<u4")
        code = points
        for k in range(1, 4):
            if k > 1:
                code = code[:-1] * CHAR_MULTIPLIER + points[k - 1 :]
            place = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BITS)
            keep = owner[: len(code)] == owner[k - 1 :]
            yield place[keep].astype(np.int64) + N_WORD, owner[: len(code)][keep]


def frequencies(texts: list[bytes]) -> np.ndarray:
    """Dense feature rows for training: relative frequency of each place within its kind."""
    b, n, width = Batch.of(texts), len(texts), N_WORD + N_CHAR
    out = np.zeros((n, width), np.float32)
    for place, doc in features(b):
        counts = np.bincount(doc * width + place, minlength=n * width).reshape(n, width)
        out += counts / np.maximum(counts.sum(1, keepdims=True), 1)
    return out


def dense(texts: list[bytes], step: int = 100) -> np.ndarray:
    """frequencies() of many texts, filled in step by step."""
    out = np.empty((len(texts), N_WORD + N_CHAR), np.float32)
    for i in range(0, len(texts), step):
        out[i : i + step] = frequencies(texts[i : i + step])
    return out


def linear_scores(b: Batch, weights: np.ndarray) -> np.ndarray:
    """frequencies() @ weights without the dense rows."""
    n = len(b.ends)
    out = np.zeros(n)
    for place, doc in features(b):
        out += np.bincount(doc, weights[place], minlength=n) / np.maximum(np.bincount(doc, minlength=n), 1)
    return out


@dataclass
class Model:
    weights: np.ndarray
    intercept: float
    slope: float  # Platt's map from margin to log odds
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin + self.intercept) + self.shift, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float, rounds: int = 300, spend: bool = False) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by accelerated gradient descent on scaled columns. spend: float32 x is overwritten, not copied."""
    variance = [((b - b.mean(0)) ** 2).mean(0) for b in (x[:, i : i + COLUMNS] for i in range(0, x.shape[1], COLUMNS))]
    scale = 1 / (np.sqrt(np.concatenate(variance)) + 1e-3)
    z = np.multiply(x, scale, out=x) if spend else np.ascontiguousarray(x * scale, np.float32)
    mean = z.mean(0)
    z -= mean
    w = w / w.sum()
    vec = np.ones(z.shape[1], np.float32)
    for _ in range(8):  # the largest curvature, for the step
        vec = z.T @ (w.astype(np.float32) * (z @ vec))
        vec /= np.linalg.norm(vec) + 1e-12
    step = 1 / (0.25 * float(np.sum(w * (z @ vec) ** 2)) + 0.25 + ridge)
    beta = look = np.zeros(z.shape[1], np.float32)
    b0 = look0 = 0.0
    for k in range(rounds):
        g = (w * (1 / (1 + np.exp(-np.clip(z @ look + look0, -40, 40))) - y)).astype(np.float32)
        new, new0 = look - step * (z.T @ g + ridge * look), look0 - step * float(g.sum())
        speed = k / (k + 3)
        look, look0 = new + speed * (new - beta), new0 + speed * (new0 - b0)
        beta, b0 = new, new0
    weights = (beta * scale).astype(np.float64)
    return weights, float(b0 - mean @ beta)


def fit(texts: list[bytes], y: np.ndarray, shares: tuple[float, float], ridge: float = 1e-3) -> Model | None:
    """Fit on three quarters of the texts, calibrate on the rest; they stand in hash order, so the cut is arbitrary.

    The driver holds the dense rows of one of the two parts at a time, and no copy of them.
    """
    if len(np.unique(y)) < 2:
        return None
    w = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
    aside = np.arange(len(y)) % 4 == 3
    if min((y[aside] == 1).sum(), (y[aside] == 0).sum(), (y[~aside] == 1).sum(), (y[~aside] == 0).sum()) < 3:
        aside[:] = False
    weights, intercept = logistic(dense([t for t, a in zip(texts, aside) if not a]), y[~aside], w[~aside], ridge, spend=True)
    model = Model(weights, intercept, 1.0, 0.0)
    if aside.any():
        margin = dense([t for t, a in zip(texts, aside) if a]) @ weights + intercept
        # Platt's targets keep the map finite where the two labels are separable.
        n1, n0 = (y[aside] == 1).sum(), (y[aside] == 0).sum()
        target = np.where(y[aside] == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        slope, shift = logistic(margin[:, None], target, w[aside], 1e-6)
        if slope[0] > 0:
            model.slope, model.shift = float(slope[0]), float(shift)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int, sample_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, label, text (binary): of each label at most `sample` rows by hash order, none over sample_chars."""
    named = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label).alias("label"))
    # Twice the bound, as long texts drop out after the join; both bounds hold whatever the size of the tables.
    order = F.xxhash64("doc_id")
    chosen = [named.filter(F.col("label") == k).orderBy(order, "doc_id").limit(2 * sample) for k in (0, 1)]
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).filter(F.length("text") <= sample_chars)
    found = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")  # 4 * sample ids at most
    picked = [found.filter(F.col("label") == k).orderBy(order, "doc_id", F.xxhash64("text")).limit(sample) for k in (0, 1)]
    return picked[0].unionByName(picked[1]).select("doc_id", "label", text_bytes("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 1000, sample_chars: int = 20_000, **names) -> Model | None:
    """The calibrated model of the label; None where the labels do not hold both values."""
    counts = {r["k"]: r["n"] for r in labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("k")).agg(F.count("*").alias("n")).collect()}
    rows = training_rows(docs, labels, label, sample, sample_chars, **names).collect()  # 2 * sample rows at most
    if not rows or len(counts) < 2:
        return None
    rows.sort(key=lambda r: zlib.crc32(f"{r['doc_id']}".encode()))
    total = sum(counts.values())
    return fit([bytes(r["text"]) for r in rows], np.asarray([r["label"] for r in rows], np.float64), (counts[0] / total, counts[1] / total))


RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, quality double"


def score(docs: DataFrame, model: Model | None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """The base counts, base_failed, kept and quality (the calibrated probability; null without a model) of each row.

    carry: return the input columns too, named in_<name>, for a filter over whole rows.
    """
    if carry:  # the text travels once, among the columns
        source = docs.select(*[F.col(c).alias(f"in_{c}") for c in docs.columns])
        sent_id, sent_text = f"in_{id_col}", f"in_{text_col}"
    else:
        source = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
        sent_id, sent_text = "doc_id", "text"
    schema = f"doc_id {source.schema[sent_id].dataType.simpleString()}, {RESULT}"
    carried = [f"in_{c}" for c in docs.columns if carry]
    schema += "".join(f", `in_{c}` {t}" for c, t in docs.dtypes if carry)
    names = ["doc_id", *[x.split()[0] for x in RESULT.split(", ")], *carried]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, sent_text, TASK_STEP):
            texts = [t or b"" for t in batch.column(sent_text).cast(pa.binary()).to_pylist()]
            b = Batch.of(texts)
            c = base_counts(texts, b)
            failed = (c["n_words"] < FEWEST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])
            quality = None if model is None else model.probability(linear_scores(b, model.weights))
            kept = ~failed if quality is None else ~failed & (quality >= threshold)
            columns = [batch.column(sent_id), *[pa.array(v, pa.int64()) for v in c.values()], pa.array(failed), pa.array(kept)]
            columns.append(pa.nulls(len(texts), pa.float64()) if quality is None else pa.array(quality))
            yield pa.record_batch([*columns, *[batch.column(k) for k in carried]], names)

    return source.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that the rules keep, all columns as they were."""
    scored = score(docs, train(docs, labels), threshold, carry=True)
    return scored.filter("kept").select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
