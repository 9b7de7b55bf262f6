"""Toxicity: a linear-chain conditional random field over words, tags 0 (clean) and 1 (toxic).

Labels mark documents, so labelled tokens are derived from them: a greedy cover picks the word features (the word, its
prefixes and suffixes) that explain most toxic training documents while almost no clean one has them, and the words with
a picked feature are the toxic tokens of toxic documents. The field is fitted on those tokens by gradient steps
on its likelihood; chains are sentences. Forward-backward marginals of every word of a document give its largest
and its summed toxicity, which a logistic map fitted on training documents turns into the score. Words whose marginal is at
least 0.5 form the offending spans.

Bounds of the fit (parameters): at most `sample` documents of each label, none over `sample_chars` characters, at most
`chains` sentences. Rows with crc32(id as text) mod 5 = 0 are held out and never learned from.

Edge cases: a null or empty text has no words and gets the score of no evidence; texts of any length are scored whole; a
score of exactly 0.5 is predicted 1; a null id is not held out, and no label is its own; repeated rows get equal scores; an id
with several labels is toxic if one says so; without both labels among the learnable rows every score is 0.0; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import string
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parityline.llm.common import steps, text_bytes, text_of
from parityline.llm.quality import logistic

#: Sentences end at a newline or after a word that ends with one of these (fixed values).
STOPS = (b".", b"!", b"?")
MARKS = string.punctuation + "«»“”‘’„…¡¿–—"
PREFIXES, SUFFIXES = (3, 4, 5, 6, 7), (4, 5)
REMEMBERED = 600_000
#: Marginals below this are no evidence, however many a long text has.
SMALL = 0.25


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def core(word: bytes) -> str:
    """A word without its outer punctuation, in lower case."""
    return word.decode("utf-8", "replace").strip(MARKS).lower()


def word_features(w: str) -> list[str]:
    """Features of a core: the word, its prefixes and suffixes; the first letter names the kind."""
    if not w:
        return ["-"]
    return ["w" + w] + ["p" + w[:k] for k in PREFIXES if len(w) > k] + ["s" + w[-k:] for k in SUFFIXES if len(w) > k]


def sentences(text: bytes) -> list[list[bytes]]:
    out = []
    for line in text.split(b"\n"):
        chain: list[bytes] = []
        for w in line.split():
            chain.append(w)
            if w.endswith(STOPS):
                out.append(chain)
                chain = []
        if chain:
            out.append(chain)
    return out


def marginals(theta: np.ndarray, lengths: np.ndarray, trans: np.ndarray, first: float) -> tuple[np.ndarray, np.ndarray, float]:
    """P(tag 1) of each word, expected tag pairs (2 x 2), log partition; chains lie one after the other in theta.

    theta: score of tag 1 over tag 0 for each word; trans[a, b]: score of tag b after tag a; first: of tag 1 at a start.
    All chains advance together, the longest first, so that the active ones are always a prefix.
    """
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    emit = np.exp(np.clip(theta, -30, 30))
    m = np.exp(trans)
    a0, a1, norm = np.empty(len(theta)), np.empty(len(theta)), np.empty(len(theta))
    active = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")  # chains longer than t
    x0 = np.ones(len(lengths))
    x1 = np.full(len(lengths), np.exp(first))
    for t, n in enumerate(active.tolist()):
        at = starts[:n] + t
        if t:
            x0, x1 = x0[:n], x1[:n]
            x0, x1 = x0 * m[0, 0] + x1 * m[1, 0], x0 * m[0, 1] + x1 * m[1, 1]
        x1 = x1 * emit[at]
        s = x0 + x1
        x0, x1 = x0 / s, x1 / s
        a0[at], a1[at], norm[at] = x0, x1, s
    p = np.empty(len(theta))
    pairs = np.zeros((2, 2))
    b0 = np.ones(len(lengths))
    b1 = np.ones(len(lengths))
    for t in range(len(active) - 1, -1, -1):
        n = int(active[t])
        at = starts[:n] + t
        more = int(active[t + 1]) if t + 1 < len(active) else 0
        if more:
            nxt = at[:more] + 1
            e1 = emit[nxt] * b1[:more] / norm[nxt]
            e0 = b0[:more] / norm[nxt]
            x0, x1 = a0[at[:more]], a1[at[:more]]
            pairs += [[m[0, 0] * (x0 @ e0), m[0, 1] * (x0 @ e1)], [m[1, 0] * (x1 @ e0), m[1, 1] * (x1 @ e1)]]
            b0[:more], b1[:more] = m[0, 0] * e0 + m[0, 1] * e1, m[1, 0] * e0 + m[1, 1] * e1
        x0, x1 = a0[at] * b0[:n], a1[at] * b1[:n]
        p[at] = x1 / (x0 + x1)
    return p, pairs, float(np.log(norm).sum())


@dataclass
class Field:
    """A fitted field and its document map."""

    weights: dict[str, float]
    bias: float
    trans: np.ndarray
    first: float
    map: np.ndarray = field(default_factory=lambda: np.array([-3.0, 1.0, 0.0]))  # intercept, largest, amount

    def __post_init__(self) -> None:
        self.kinds = [{f[1:]: x for f, x in self.weights.items() if f[0] == kind} for kind in "wps"]

    def learn(self, words: Iterable[bytes], known: dict[bytes, float], cores: dict[str, float]) -> None:
        """Scores of words not met yet, by their cores."""
        whole, front, back = (k.get for k in self.kinds)
        none = self.bias + self.weights.get("-", 0.0)
        for word in words:
            w = core(word)
            x = cores.get(w)
            if x is None:
                x = self.bias + whole(w, 0.0) if w else none
                n = len(w)
                for k in PREFIXES:
                    if n > k:
                        x += front(w[:k], 0.0)
                for k in SUFFIXES:
                    if n > k:
                        x += back(w[-k:], 0.0)
                cores[w] = x
            known[word] = x

    def tag(self, texts: list[bytes], known: dict[bytes, float], cores: dict[str, float]) -> tuple[list[list[list[bytes]]], np.ndarray, np.ndarray]:
        """Sentences of each text, marginals of all words, and the text of each word."""
        split = [sentences(t) for t in texts]
        words = [w for s in split for c in s for w in c]
        if len(known) > REMEMBERED:
            known.clear()
            cores.clear()
        self.learn(set(words).difference(known), known, cores)
        theta = np.fromiter(map(known.__getitem__, words), float, len(words))
        lengths = np.array([len(c) for s in split for c in s], np.int64)
        p = marginals(theta, lengths, self.trans, self.first)[0]
        return split, p, np.repeat(np.arange(len(texts)), [sum(map(len, s)) for s in split])

    def evidence(self, p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """For each text: log odds of its most toxic word and the log of the sum of its marginals that are not small."""
        top = np.full(n, 1e-6)
        np.maximum.at(top, doc, np.clip(p, 1e-6, 1 - 1e-6))
        return np.stack([np.log(top / (1 - top)), np.log1p(np.bincount(doc, np.where(p >= SMALL, p, 0), minlength=n))], 1)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.map[0] + evidence @ self.map[1:], -40, 40)))


def cover(toxic: list[set[str]], clean: list[set[str]], least: int, purity: float) -> set[str]:
    """Features that explain toxic documents: greedily the one in most unexplained ones, pure enough, until too few."""
    seen_clean = Counter(f for d in clean for f in d)
    holders: defaultdict[str, list[int]] = defaultdict(list)
    for i, d in enumerate(toxic):
        for f in d:
            holders[f].append(i)
    share = len(toxic) / max(len(clean), 1)
    holders = {f: h for f, h in holders.items() if len(h) >= least and seen_clean[f] * share <= (1 - purity) * len(h)}
    picked: set[str] = set()
    open_docs = set(range(len(toxic)))
    gain = {f: len(h) for f, h in holders.items()}
    while gain:
        best = max(gain, key=lambda f: (gain[f], -len(f), f))
        if gain[best] < least:
            break
        picked.add(best)
        gone = open_docs.intersection(holders[best])
        open_docs -= gone
        for i in gone:
            for f in toxic[i]:
                if f in gain:
                    gain[f] -= 1
        del gain[best]
    # What is pure and common tells toxic words apart too, where the documents with it have other such words.
    common = max(least, len(toxic) // 50)
    return picked | {f for f, h in holders.items() if len(h) >= common}


def fit(toxic: list[bytes], clean: list[bytes], share: float = 0.1, chains: int = 12_000, rounds: int = 80, least: int = 4, purity: float = 0.97) -> Field:
    """Derive token labels, fit the field on sentences, then the map from marginals to document scores.

    share: the part of labelled rows that is toxic; the samples are weighted back to it.
    """
    toxic, clean = list(dict.fromkeys(toxic)), list(dict.fromkeys(clean))
    cache: dict[bytes, list[str]] = {}

    def feats(w: bytes) -> list[str]:
        if w not in cache:
            cache[w] = word_features(core(w))
        return cache[w]

    def of(text: bytes) -> set[str]:
        return {f for w in set(text.split()) for f in feats(w)}

    picked = cover([of(t) for t in toxic], [of(t) for t in clean], least, purity)
    with_tag, without, hard = [], [], []
    for is_toxic, texts in ((True, toxic), (False, clean)):
        for t in texts:
            for s in sentences(t):
                tags = [not picked.isdisjoint(feats(w)) for w in s]
                if any(tags):
                    (with_tag if is_toxic else hard).append((s, [float(is_toxic and x) for x in tags]))
                else:
                    without.append((s, [0.0] * len(s)))
    stride = max(1, len(without) // max(1, chains - min(len(with_tag) + len(hard), chains // 2)))
    data = (with_tag + hard)[: chains // 2] + without[::stride]
    number: dict[str, int] = {}
    rows, cols, gold, lengths = [], [], [], []
    for s, tags in data:
        lengths.append(len(s))
        for w, tag in zip(s, tags, strict=True):
            for f in feats(w):
                rows.append(len(gold))
                cols.append(number.setdefault(f, len(number)))
            gold.append(tag)
    rows, cols, y, lengths = np.array(rows), np.array(cols), np.array(gold), np.array(lengths)
    inner = np.ones(len(y), bool)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    inner[starts] = False
    prev = np.concatenate(([0.0], y[:-1]))
    seen_pairs = np.array([[((1 - prev) * (1 - y))[inner].sum(), ((1 - prev) * y)[inner].sum()], [(prev * (1 - y))[inner].sum(), (prev * y)[inner].sum()]])
    w, bias, trans, first = np.zeros(len(number)), -4.0, np.zeros((2, 2)), 0.0
    squares = [np.full(len(number), 1e-6), 1e-6, np.full((2, 2), 1e-6), 1e-6]
    for _ in range(rounds):  # Adagrad on the mean negative log likelihood with a small ridge
        theta = bias + np.bincount(rows, w[cols], minlength=len(y))
        p, pairs, _ = marginals(theta, lengths, trans, first)
        miss = p - y
        grads = [np.bincount(cols, miss[rows], minlength=len(w)) + 0.02 * w, miss.sum(), pairs - seen_pairs, miss[starts].sum()]
        for k, g in enumerate(grads):
            squares[k] = squares[k] + g * g
        move = [0.7 * g / np.sqrt(q) for g, q in zip(grads, squares, strict=True)]
        w, bias, trans, first = w - move[0], bias - move[1], trans - move[2], first - move[3]
        trans[0, 0] = 0.0
    out = Field({f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-3}, float(bias), trans, float(first))
    known, cores, evidence = {}, {}, []
    texts = toxic + clean
    for i in range(0, len(texts), 200):
        _, p, doc = out.tag(texts[i : i + 200], known, cores)
        evidence.append(out.evidence(p, doc, len(texts[i : i + 200])))
    x, label = np.concatenate(evidence), np.array([1.0] * len(toxic) + [0.0] * len(clean))
    beta, b0 = logistic(x, label, np.where(label == 1, share / len(toxic), (1 - share) / len(clean)), 1e-5)
    out.map = np.array([b0, *beta])
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = 1200, sample_chars: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    named = (
        labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("doc_id"))
        .agg(F.max("toxic").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in named.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    order = F.xxhash64("doc_id")
    chosen = [named.filter(F.col("label") == k).orderBy(order, "doc_id").limit(2 * sample) for k in (0, 1)]
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).filter(F.length("text") <= sample_chars)
    found = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")  # 4 * sample ids at most
    got = [
        [bytes(r["text"]) for r in found.filter(F.col("label") == k).orderBy(order, "doc_id", F.xxhash64("text")).limit(sample).select(text_bytes("text").alias("text")).collect()]
        for k in (1, 0)
    ]
    return fit(*got, share=counts[1] / (counts[0] + counts[1])) if all(got) else None


SPANS = "array<struct<start:int,end:int,p:double>>"


def score(docs: DataFrame, model: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, spans (code point offsets and largest marginal of each run of toxic words)."""
    source = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cores = {}, {}
        for batch in steps(batches, "text"):
            texts = batch.column("text").to_pylist()
            if model is None:
                scores, spans = np.zeros(len(texts)), [[] for _ in texts]
            else:
                _, p, doc = model.tag(texts, known, cores)
                scores = model.score(model.evidence(p, doc, len(texts)))
                spans = [[] for _ in texts]
                hit = np.flatnonzero(p >= 0.5)
                first = np.searchsorted(doc, np.arange(len(texts)))
                some, starts = np.unique(doc[hit], return_index=True)  # words stand in the order of their texts
                for d, own in zip(some.tolist(), np.split(hit, starts[1:]), strict=False):
                    spans[d] = offsets(texts[d], (own - first[d]).tolist(), p[first[d] :])
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(scores), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))],
                ["doc_id", "score", "spans"],
            )

    scored = source.mapInArrow(run, f"doc_id {kind}, score double, spans {SPANS}")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def offsets(text: bytes, hits: list[int], p: np.ndarray) -> list[dict]:
    """Runs of consecutive toxic words as code point offsets into the text."""
    found = re.finditer(rb"[^\x20\x09-\x0D]+", text)
    wanted, out, last = set(hits), [], -2
    at = points = 0
    for k, m in enumerate(found):
        if k not in wanted:
            continue
        points += len(text[at : m.start()].decode("utf-8", "replace"))
        length = len(m.group().decode("utf-8", "replace"))
        if k == last + 1:
            out[-1]["end"], out[-1]["p"] = points + length, max(out[-1]["p"], float(p[k]))
        else:
            out.append({"start": points, "end": points + length, "p": float(p[k])})
        at, points, last = m.end(), points + length, k
    return out


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
