"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

Words are lower-cased and lose ASCII punctuation; shingles are five words in a row (a shorter text is one shingle of all
its words). Documents with equal shingle sets form one node, so copies cost nothing further.

1. One Arrow pass gives each document the digest of its shingle set and 128 MinHash values.
2. Nodes that agree in one of 24 bands of 4 values are candidates: at similarity 0.8 a pair is missed with probability
   (1 - 0.8**4)**24 = 3e-6. Sizes that rule 0.8 out are dropped in the join.
3. MinHash values of a pair are compared 16 at a time. With a uniform prior, the posterior probability that the similarity
   reaches the threshold after m matches of n is P(Binomial(n + 1, t) <= m); once it is below `tolerance`, the pair is dropped.
4. What is left is compared exactly, on the words themselves.
5. Connected links make near-duplicate classes by smallest labels with pointer jumping, each round staged in the shared folder.

Of bands that hold the same nodes only the first is kept, as each pair counts in the first band that it shares.

With count_links=True, as the query has it, all candidate pairs are tested: a band is cut into blocks of about BLOCK_NODES nodes, and
each pair of blocks is one group of rows. Step 3 runs over the MinHash values inside the task and names the nodes that have a
surviving pair; these get their texts, and step 4 runs over the same pairs in the same groups. A group gives one row for each node
with a link: how many it has there, the first of them, and a node of its tree in the group, so neither pairs nor links ever become
rows. Rows grow with a band's size over BLOCK_NODES; what stays quadratic, inside tasks, is the test of each pair itself.

Without, only classes are wanted, and steps 2 to 5 run in three phases, as a class needs no link inside it once it is connected. First
each node of a band meets the band's first document only; then the nodes of bands that still hold several classes meet up to
REPRESENTATIVES nodes of other classes of each band; then, in the bands where even now classes differ, all nodes of different
classes meet in such groups. The classes are those of all candidate pairs either way.

Equal sets are equal digests of 64-bit shingle hashes: two different shingles of a text pair share a hash with a chance of
about n * n / 2**65 for n shingles (5e-14 for 1,000).

Edge cases: null, empty and wordless texts share the empty set and form one class of copies; texts of any length are
taken whole; rows that repeat an id and a text are copies; one id with two texts belongs to two classes and gives a row for each;
a similarity of exactly the threshold is a link; a null id is carried along and never names a class unless all its copies have
none; ids may be of any type that sorts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityline.llm.common import staged, steps, text_bytes
from parityline.llm.quality import MIX, MULTIPLIER, Batch

SHINGLE, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
HASHES, BANDS, BAND_ROWS, BLOCK = 128, 24, 4, 16
#: Nodes of a band that the nodes of its other classes meet in the second phase.
REPRESENTATIVES = 8
#: Nodes of a band that are compared with as many others in one group of rows.
BLOCK_NODES = 1024
#: Nodes of a block whose pairs with the other block are held at once.
STRIP_NODES = 128
PUNCTUATION = string.punctuation.encode()


def plain(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode().translate(None, PUNCTUATION)


def shingle_set(text: bytes, size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """The exact shingles of a text."""
    w = plain(text).split()
    if len(w) < size:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(size)], strict=False))


def seeds() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the hash functions, from a fixed generator."""
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, HASHES, np.uint64)


def shingle_hashes(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of each text, sorted by text and hash, and their texts."""
    b = Batch.of([plain(t) for t in texts])
    n_words = np.bincount(b.doc, minlength=len(texts))
    with np.errstate(over="ignore"):
        m = max(len(b.doc) - size + 1, 0)
        h = np.zeros(m, np.uint64)
        for k in range(size):
            h = (h ^ b.hashes[k : k + m]) * np.uint64(MULTIPLIER)
            h ^= h >> np.uint64(31)
        inside = b.doc[:m] == b.doc[size - 1 :] if m else np.zeros(0, bool)
        h, doc = h[inside], b.doc[:m][inside]
        short = np.flatnonzero((n_words > 0) & (n_words < size))
        first = np.searchsorted(b.doc, short)
        x = n_words[short].astype(np.uint64)
        for k in range(size - 1):  # texts of fewer words than a shingle has: one hash over all of them
            more = n_words[short] > k
            x[more] = (x[more] ^ b.hashes[first[more] + k]) * np.uint64(MIX)
            x[more] ^= x[more] >> np.uint64(29)
        h, doc = np.concatenate((h, x)), np.concatenate((doc, short))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def signatures(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """MinHash values, one row of HASHES for each text; texts without shingles get the largest value everywhere."""
    out = np.full((n, HASHES), 0xFFFFFFFF, np.uint32)
    if len(h):
        starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        a, b = seeds()
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                out[doc[starts], k] = np.minimum.reduceat(((h * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, digest (of the shingle set), n (its size), sig."""
    source = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            texts = batch.column("text").to_pylist()
            h, doc = shingle_hashes(texts)
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            raw = h.tobytes()
            digests = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            sig = [x.tobytes() for x in signatures(h, doc, len(texts))]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(np.diff(cuts), pa.int64()), pa.array(sig, pa.binary())],
                ["doc_id", "digest", "n", "sig"],
            )

    return source.mapInArrow(run, f"doc_id {kind}, digest binary, n long, sig binary")


def fewest_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(n, m): after n values a pair needs m matches for the posterior to reach the tolerance."""
    out = []
    for n in range(BLOCK, HASHES + 1, BLOCK):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def banded(nodes: DataFrame) -> DataFrame:
    """k (number of the band), band (with its values), digest, n, name of the nodes in each band that several nodes share.

    Of bands with the same nodes the first is kept: a pair's first band never falls, as an earlier one with its nodes would be first.
    """
    band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(F.col("sig"), k * (4 * BAND_ROWS) + 1, F.lit(4 * BAND_ROWS)))))
    rows = nodes.filter("n > 0").select(band.alias("k", "band"), "digest", "n", "name")
    held = [F.bit_xor(F.xxhash64(F.lit(k), "digest")).alias(f"held_{k}") for k in range(2)]
    several = rows.groupBy("k", "band").agg(F.count("*").alias("size"), *held).filter("size > 1")
    first = several.groupBy("size", "held_0", "held_1").agg(F.min(F.struct("k", "band")).alias("first"))
    return staged(rows.join(first.select("first.band"), "band"), "ngram-bands")


def candidates(rows: DataFrame, threshold: float, most: int) -> DataFrame:
    """Pairs a < b of nodes of different classes (label) that share a band, with sizes that allow the threshold.

    most: 1 pairs each node with the band's first, k with up to k nodes of the band.
    """
    rank = F.struct(F.col("name").isNull(), "name", "digest") if most == 1 else F.struct(F.xxhash64("band", "digest"), "digest")
    slot = F.lit(0) if most == 1 else F.pmod(F.xxhash64("digest", "band"), F.lit(most))
    others = rows.groupBy("band", slot.alias("slot")).agg(F.min_by(F.struct("digest", "n", "label"), rank).alias("x")).select("band", "x.*")
    x, y = (df.select("band", *[F.col(c).alias(f"{c}_{k}") for c in ("digest", "n", "label")]) for df, k in ((rows, "x"), (others, "y")))
    close = (F.col("n_x") >= threshold * F.col("n_y")) & (F.col("n_y") >= threshold * F.col("n_x"))
    pairs = x.join(y, "band").filter((F.col("digest_x") != F.col("digest_y")) & (F.col("label_x") != F.col("label_y")) & close)
    return pairs.select(F.least("digest_x", "digest_y").alias("a"), F.greatest("digest_x", "digest_y").alias("b")).distinct()


def survivors(x: np.ndarray, y: np.ndarray, fewest: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two tables of MinHash values are pairs whose posterior never falls below the tolerance."""
    alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
    for n, m in fewest:
        part = slice(n - BLOCK, n)
        matches[alive] += (x[alive, part] == y[alive, part]).sum(1)
        alive = alive[matches[alive] >= m]
    return alive


def block_pairs(group: pa.RecordBatch, threshold: float, fewest: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Surviving pairs between the two blocks of a group, as rows x and y: of different classes, in the first band that they share."""
    own, i, j = (group.column(c).to_numpy() for c in ("own", "i", "j"))
    sizes, k = group.column("n").to_numpy(), group.column("k")[0].as_py()
    label = np.unique(np.asarray(group.column("label").to_pylist(), object), return_inverse=True)[1]
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    # Two numbers for each earlier band that hold its four values.
    earlier = sig[:, : k * BAND_ROWS].astype(np.uint64).reshape(len(sig), k, BAND_ROWS // 2, 2)
    earlier = (earlier[..., 0] << np.uint64(32)) | earlier[..., 1]
    first, last = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(0, len(left), STRIP_NODES):
        some = left[start : start + STRIP_NODES]
        ok = (label[some][:, None] != label[right]) & (sizes[some][:, None] >= threshold * sizes[right]) & (sizes[right] >= threshold * sizes[some][:, None])
        if i[0] == j[0]:
            ok &= some[:, None] < right
        for band in range(k):
            ok &= (earlier[some, band][:, None] != earlier[right, band]).any(2)
        x, y = np.nonzero(ok)
        x, y = some[x], right[y]
        for at in range(0, len(x), 1 << 14):
            p, q = x[at : at + (1 << 14)], y[at : at + (1 << 14)]
            alive = survivors(sig[p], sig[q], fewest)
            first.append(p[alive])
            last.append(q[alive])
    return np.concatenate(first), np.concatenate(last)


def shingle_numbers(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as numbers, equal where the words are, and the places where each text's begin.

    A text of fewer words than a shingle has none here: its one shingle is its whole text, which no other node has.
    """
    ids: dict[bytes, int] = {}
    parts = [np.fromiter((ids.setdefault(w, len(ids)) for w in plain(t).split()), np.int64) for t in texts]
    word, doc = np.concatenate(parts), np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    at = np.flatnonzero(doc[: max(len(doc) - size + 1, 0)] == doc[size - 1 :])
    rank = word[at]
    for k in range(1, size):  # built up from the ranks of prefixes, so equal numbers mean equal words
        _, rank = np.unique(rank * len(ids) + word[at + k], return_inverse=True)
    n = int(rank.max(initial=0)) + 1
    numbers = np.unique(doc[at] * n + rank)
    return numbers % n, np.searchsorted(numbers, np.arange(len(texts) + 1) * n)


def block_links(group: pa.RecordBatch, threshold: float, fewest: list[tuple[int, int]]) -> tuple[list[int], list[int], list[int], list[int], list[float]]:
    """Rows of a group that have a link in it: row, number of links, first row linked to it and the similarity, first row of its tree."""
    x, y = block_pairs(group, threshold, fewest)
    numbers, cuts = shingle_numbers(group.column("text").to_pylist())
    cuts = cuts.tolist()
    here = np.zeros(int(numbers.max(initial=0)) + 1, bool)
    tree, count = list(range(len(group))), [0] * len(group)
    best: dict[int, tuple[int, float]] = {}

    def root(a: int) -> int:
        while tree[a] != a:
            tree[a] = a = tree[tree[a]]
        return a

    last = -1
    for a, b in zip(x.tolist(), y.tolist(), strict=True):
        if a != last:
            if last >= 0:
                here[numbers[cuts[last] : cuts[last + 1]]] = False
            here[numbers[cuts[a] : cuts[a + 1]]] = True
            last = a
        common = int(np.count_nonzero(here[numbers[cuts[b] : cuts[b + 1]]]))
        jaccard = common / max(cuts[a + 1] - cuts[a] + cuts[b + 1] - cuts[b] - common, 1)
        if jaccard < threshold:
            continue
        for one, other in ((a, b), (b, a)):
            count[one] += 1
            if one not in best or other < best[one][0]:
                best[one] = other, jaccard
        low, high = sorted((root(a), root(b)))
        tree[high] = low
    found = sorted(best)
    return found, [count[a] for a in found], [best[a][0] for a in found], [root(a) for a in found], [best[a][1] for a in found]


#: What makes a group of rows: a band, and two blocks of its nodes.
GROUP = ["band", "k", "i", "j"]


def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each group; a group that goes on in the next batch is put together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in GROUP], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo == hi:
                continue
            if held and lo == 0 and [held[0].column(c)[0].as_py() for c in GROUP] != keys[0].tolist():
                yield pa.concat_batches(held)
                held = []
            if lo > 0 and held:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.concat_batches(held)


def all_links(rows: DataFrame, nodes: DataFrame, texts: DataFrame, names: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Links of all nodes of different classes that share a band, by node and group: digest, n_links, other, tree, jaccard.

    other: of the nodes linked to it in the group the one of the smallest name. tree: a node of the group that its links lead to.
    """
    blocks = F.ceil(F.col("size") / BLOCK_NODES).cast("int")
    sizes = rows.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1").select("band", blocks.alias("blocks"))
    dealt = rows.join(sizes, "band").withColumn("own", F.pmod(F.xxhash64("digest", "band"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select("k", "band", "digest", "n", "label", "own", other.alias("other"))
    dealt = dealt.select("k", "band", "digest", "n", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    grouped = dealt.join(nodes.select("digest", "sig"), "digest").repartition(*GROUP).sortWithinPartitions(*GROUP)
    fewest = fewest_matches(threshold, tolerance)

    def some(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of each group that have a surviving pair in it."""
        for group in groups(batches):
            x, y = block_pairs(group, threshold, fewest)
            if len(x):
                yield group.take(pa.array(np.unique(np.concatenate((x, y)))))

    paired = staged(grouped.mapInArrow(some, grouped.schema), "ngram-paired")
    ready = paired.join(texts, "digest").join(names, "digest").repartition(*GROUP).sortWithinPartitions(*GROUP, "name").drop("name")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            row, n_links, other, tree, jaccard = block_links(group, threshold, fewest)
            if row:
                digest = group.column("digest")
                yield pa.record_batch(
                    [digest.take(pa.array(row)), pa.array(n_links, pa.int64()), digest.take(pa.array(other)), digest.take(pa.array(tree)), pa.array(jaccard)],
                    ["digest", "n_links", "other", "tree", "jaccard"],
                )

    return ready.mapInArrow(run, "digest binary, n_links long, other binary, tree binary, jaccard double")


def pruned(pairs: DataFrame, nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Pairs whose posterior never falls below the tolerance."""
    sig = nodes.select("digest", "sig")
    both = pairs.join(sig.withColumnsRenamed({"digest": "a", "sig": "sig_a"}), "a").join(sig.withColumnsRenamed({"digest": "b", "sig": "sig_b"}), "b")
    fewest = fewest_matches(threshold, tolerance)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).take(pa.array(survivors(x, y, fewest)))

    return both.mapInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Exact similarities of the pairs that reach the threshold: a, b, jaccard."""
    both = pairs.join(texts.withColumnsRenamed({"digest": "a", "text": "text_a"}), "a").join(texts.withColumnsRenamed({"digest": "b", "text": "text_b"}), "b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, last = [], [(None, set()), (None, set())]
            for a, b, s, t in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                for k, (node, text) in enumerate(((a, s), (b, t))):  # rows stand in the order of b; leaders repeat as a
                    if last[k][0] != node:
                        last[k] = node, shingle_set(text)
                own, other = last[0][1], last[1][1]
                common = len(own & other)
                j = common / max(len(own) + len(other) - common, 1)
                if j >= threshold:
                    rows.append((a, b, j))
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.record_batch([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.float64())], ["a", "b", "jaccard"])

    return both.mapInArrow(run, "a binary, b binary, jaccard double")


def components(links: DataFrame, names: DataFrame) -> DataFrame:
    """digest, label: the smallest name among all nodes that links connect; names: digest, name (a struct that ends with node).

    Each round takes the smallest label of all neighbours and then that label's own label, so long chains shrink by jumps.
    """
    edges = links.select(F.col("a").alias("digest"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("digest"), F.col("a").alias("other")))
    edges = staged(edges, "ngram-edges")
    labels = staged(edges.select("digest").distinct().join(names, "digest").select("digest", F.col("name").alias("label")), "ngram-labels")
    while True:
        near = edges.join(labels.select(F.col("digest").alias("other"), F.col("label").alias("theirs")), "other").groupBy("digest").agg(F.min("theirs").alias("theirs"))
        low = staged(labels.join(near, "digest").select("digest", "label", F.least("label", "theirs").alias("low")), "ngram-low")
        above = low.select(F.col("digest").alias("node"), F.col("low").alias("above"))
        moved = low.join(above, F.col("low.node") == F.col("node")).select("digest", F.least("low", "above").alias("label"), (F.least("low", "above") < F.col("label")).alias("moved"))
        moved = staged(moved, "ngram-labels")
        labels = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text", count_links: bool = False) -> DataFrame:
    """One row for each document: doc_id, class_id, n_copies, linked_id, jaccard, digest, class_node; with count_links n_links.

    class_id: the smallest id of its near-duplicate class. n_copies: rows with its shingle set. linked_id: the smallest id of
    a different shingle set that was found linked to it, with their similarity; null where there is none. n_links: all other
    shingle sets linked to it. class_node is the digest of the node that names the class: classes that one id names
    (it has several texts) differ in it.
    """
    rows = staged(described(docs, id_col, text_col), "ngram-rows")
    nodes = staged(
        rows.groupBy("digest").agg(F.min("doc_id").alias("name"), F.count("*").alias("n_copies"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "ngram-nodes",
    )
    bands = banded(nodes)
    wanted = nodes.join(bands.select("digest").distinct(), "digest", "left_semi").select("digest", F.col("name").alias("doc_id"))
    source = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    texts = same_digest(source.join(wanted, "doc_id"))
    if not nodes.filter("name IS NULL").isEmpty():  # texts that only rows without id hold
        loose = text_digests(source.filter("doc_id IS NULL").select("text")).select(F.col("found").alias("digest"), "text")
        texts = texts.unionByName(loose.join(wanted.filter("doc_id IS NULL"), "digest", "left_semi").dropDuplicates(["digest"]))
    texts = staged(texts, "ngram-texts")
    # Names of nodes that differ where ids do not; nodes without id come last.
    name = F.struct(F.col("name").isNull().alias("no_id"), F.col("name").alias("doc_id"), F.col("digest").alias("node"))
    names = nodes.select("digest", name.alias("name"))
    # Links by node, and the edges that connect them.
    links = nodes.limit(0).select("digest", F.lit(0).cast("long").alias("n_links"), F.col("digest").alias("other"), F.lit(0.0).alias("jaccard"))
    edges = nodes.limit(0).select(F.col("digest").alias("a"), F.col("digest").alias("b"))
    labels = nodes.limit(0).select("digest", name.alias("label"))
    for most in (None,) if count_links else (1, REPRESENTATIVES, None):
        own = bands.join(labels.select("digest", F.col("label.node").alias("label")), "digest", "left")
        own = staged(own.withColumn("label", F.coalesce("label", "digest")), "ngram-open")
        mixed = own.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
        open_ = own.join(mixed.select("band"), "band", "left_semi")
        if most is None:
            found = staged(all_links(open_, nodes, texts, names, threshold, tolerance), "ngram-links")
            more = found.filter("digest <> tree").select(F.col("digest").alias("a"), F.col("tree").alias("b"))
        else:
            pairs = staged(pruned(candidates(open_, threshold, most), nodes, threshold, tolerance), "ngram-pairs")
            more = staged(verified(pairs, texts, threshold), "ngram-links")
            both = [more.select(F.col(a).alias("digest"), F.lit(1).cast("long").alias("n_links"), F.col(b).alias("other"), "jaccard") for a, b in ("ab", "ba")]
            found = both[0].unionByName(both[1])
        if more.isEmpty():
            continue
        links = links.unionByName(found.drop("tree"))
        edges = edges.unionByName(more.select("a", "b"))
        labels = components(edges, names)
    ends = links.withColumnRenamed("other", "b").join(names.select(F.col("digest").alias("b"), F.col("name").alias("other")), "b")
    best = ends.groupBy("digest").agg(F.min(F.struct("other", "jaccard")).alias("best"), F.sum("n_links").alias("n_links"))
    classes = nodes.select("digest", "name", "n_copies").join(labels, "digest", "left").join(best, "digest", "left")
    label = F.coalesce(F.col("label"), name)
    classes = classes.select(
        "digest", label["doc_id"].alias("class_id"), label["node"].alias("class_node"), "n_copies", F.col("best.other.doc_id").alias("linked_id"),
        F.col("best.jaccard").alias("jaccard"), *[F.coalesce("n_links", F.lit(0)).alias("n_links")] * count_links,
    )
    out = ["doc_id", "class_id", "n_copies", "linked_id", "jaccard", *["n_links"] * count_links, "digest", "class_node"]
    return rows.select("doc_id", "digest").join(classes, "digest").select(*out)


def text_digests(rows: DataFrame) -> DataFrame:
    """rows (with text in bytes) and found, the digest of the text's shingle set."""
    schema = rows.withColumn("found", F.lit(b"")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            texts = batch.column("text").to_pylist()
            h, doc = shingle_hashes(texts)
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
            raw = h.tobytes()
            found = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "found"])

    return rows.mapInArrow(run, schema)


def same_digest(found: DataFrame) -> DataFrame:
    """digest, text: one text for each digest, where an id may name several texts."""
    return text_digests(found.select("digest", "text")).filter("digest = found").select("digest", "text").dropDuplicates(["digest"])


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class: of the text whose id names it; rows without id stay. All columns as they were."""
    named = near_duplicates(docs).filter("doc_id = class_id AND digest = class_node").select("doc_id", "digest").distinct()
    named = staged(named, "ngram-kept")
    kept = docs.join(named, "doc_id", "left_semi")
    repeated = named.join(docs.groupBy("doc_id").count().filter("count > 1"), "doc_id", "left_semi").select("doc_id").distinct()
    repeated = staged(repeated, "ngram-repeated")
    if not repeated.isEmpty():
        # Only here is an id not enough: of its rows those stay whose shingle set names a class, one of each set.
        rows = kept.join(repeated, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.sha2(text_bytes("text"), 256).alias("key"))
        texts = text_digests(rows.select("id", "key", text_bytes("row.text").alias("text")).dropDuplicates(["id", "key"])).select("id", "key", "found")
        texts = texts.join(named.select(F.col("doc_id").alias("id"), F.col("digest").alias("found")), ["id", "found"], "left_semi")
        once = rows.join(texts, ["id", "key"]).groupBy("id", "found").agg(F.min_by("row", F.struct("key", F.sha2(F.to_json("row"), 256))).alias("row"))
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(once.select("row.*"))
    return kept.unionByName(docs.filter(F.col("doc_id").isNull())).select(*docs.columns)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), count_links=True).drop("digest", "class_node")
