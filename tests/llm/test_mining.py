"""Top-k search, phrase collocations and spelling variants against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parityline.llm import collocations, slots, spelling, topk_search

# -- top-k search -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(40))
def test_search_block(seed):
    """Small and large impacts, exact and rounded ones, queries in and out of the block, shorter queries."""
    r = np.random.default_rng(seed)
    n, m, d, k = int(r.integers(1, 60)), int(r.integers(1, 8)), int(r.integers(1, 12)), int(r.integers(1, 6))
    big = int(r.choice([2, 5, 40, 300, 100000, topk_search.LARGEST - 1]))
    codes, ids = r.integers(-big, big + 1, (n, d)).astype(np.int32), r.permutation(1000)[:n]
    inside = r.integers(0, n, m)
    queries, own = np.concatenate([codes[inside], r.integers(-big, big + 1, (2, d)).astype(np.int32)]), np.concatenate([ids[inside], [5000, 5001]])
    queries = queries[:, : max(1, d - 2)] if seed % 3 == 0 else queries
    index = topk_search.Index.unpack(topk_search.Index.build(ids, codes, int(r.choice([2, 4, 64]))).pack())
    got = [x.tolist() for x in topk_search.search(index, own, queries, k)]
    wide = np.pad(queries, ((0, 0), (0, d - queries.shape[1]))).astype(object)
    want = []
    for j in range(len(queries)):
        best = sorted((-int(codes[i].astype(object) @ wide[j]), int(ids[i])) for i in range(n) if ids[i] != own[j])[:k]
        want += [(j, i, -s) for s, i in best]
    assert list(zip(*got)) == want


def brute_top_k(rows, k):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) or abs(np.floor(64 * x)) >= topk_search.LARGEST for x in v):
            continue
        v = [int(np.floor(64 * x)) for x in v]
        vectors[i] = min(v, vectors.get(i, v))
    out = []
    for q in vectors:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, vectors[q])), i) for i, v in vectors.items() if i != q)[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_odd_rows(spark):
    r = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in r.normal(0, 0.2, 6)]) for i in range(150)]
    rows += [(0, None), (20, rows[21][1]), (40, [1.0, None, 2.0]), (200, [float("nan")] * 6), (220, [float("inf"), 1.0]), (240, []), (260, [0.5, -0.25]), (280, rows[3][1]), (280, rows[3][1]), (None, [1.0]), (300, [3e9, 1.0]), (-20, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, id int, block string")
    got = sorted(tuple(x) for x in topk_search.top_k(df, k=5).collect())
    assert got == brute_top_k(rows, 5)
    assert topk_search.top_k(df.limit(0)).count() == 0
    assert sorted(tuple(x) for x in topk_search.top_k(df.filter("vec_id in (0, 1, 2)")).collect()) == brute_top_k([x for x in rows if x[0] in (0, 1, 2)], 20)


def test_top_k_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 16)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk_search, "TOGETHER", 3)
    rows = [(i, [float((i * 37 + j * 11) % 17 - 8) / 8 for j in range(5)]) for i in range(300)]  # many ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(x) for x in topk_search.top_k(df).collect()) == brute_top_k(rows, 20)


# -- collocations -----------------------------------------------------------------------------------------------------


def brute_collocations(rows, least, cover, top):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in (1, 2, 3):
                f[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, counts in f.items():
        some = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in some.items():
            if len(p) == 2 and any(100 * b >= cover * a and p in (q[:2], q[1:]) for q, b in some.items() if len(q) == 3):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize(("least", "cover", "top"), [(2, 50, 2000), (3, 90, 7), (1, 100, 50)])
def test_collocations(spark, edge_docs, least, cover, top):
    docs = edge_docs.unionByName(spark.createDataFrame([("It's A-b  c,d e\x0bf. A-B\tc É É É!", "en"), ("a-b c d e", None), ("x " * 50, "und")], "text string, lang string"), allowMissingColumns=True)
    got = collocations.collocations(docs, least, cover, top).collect()
    assert sorted(tuple(x) for x in got) == brute_collocations([(r["lang"], r["text"]) for r in docs.collect()], least, cover, top)


def test_collocation_scores_pass_64_bits(spark):
    big = 9_000_000_000_000
    df = spark.createDataFrame([(big, big, big), (big, big + 1, big), (10, big, 11)], "a long, l long, r long")
    got = [r[0] for r in df.select(collocations._score("a", "l", "r")).collect()]
    assert got == [1000000 * a * a // (left * r) for a, left, r in ((big, big, big), (big, big + 1, big), (10, big, 11))]


def test_no_collocations(no_docs):
    assert collocations.collocations(no_docs).count() == 0


def test_filter_loses_nothing(spark):
    """Counts of slots over many tasks are never below those of their items."""
    rows = spark.range(0, 40000, 1, 8).select((F.col("id") % 9000).alias("x"))

    def each(batches):
        import numpy as np

        return slots.slot_rows((slots.slot_of(b.column("x").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for b in batches), 1000)

    bits = slots.frequent(rows.mapInArrow(each, slots.SCHEMA), 5)
    with np.errstate(over="ignore"):
        hit = slots.is_set(bits, slots.slot_of(np.arange(9000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    often = np.arange(9000) < 4000  # five times each, the others four times
    assert hit[often].all()
    assert hit[~often].sum() < 10


# -- spelling variants ------------------------------------------------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_variants(rows, every=31):
    n = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x), default=None) for w, v in near.items()}
    form = {w: v if v and n[v] >= 10 * n[w] else None for w, v in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def variant_docs(spark):
    """A chain of forms a hundred times as frequent, ties, inserted and replaced letters, letters beyond ASCII."""
    texts = ["flowering " * 1100, "flowerinh " * 105 + "xflowerinh " * 10 + "flowerinhh " * 2, "flowerinq " * 40, "größere Größere GRÖSSERE größere größeree größeree", "naïveté×× naïveté×× naïvete×× naïvete××", "short words here", "mississippi mississippi misissippi misissippi mississipp mississipp", None, ""]
    rows = [(k, t, "x", 1, 2) for k, t in enumerate(texts * 2)] + [(None, "uncommon letterings of uncommon lettering " * 30, "x", 1, 2), (5, "again " + texts[3], "y", 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n int, key int")


@pytest.mark.parametrize(("symbols", "every"), [(8, 31), (2, 2), (1, 5)])
def test_variants(spark, symbols, every):
    docs = variant_docs(spark)
    got = spelling.variants(docs, symbols=symbols, every=every).collect()
    assert {tuple(r) for r in got} == brute_variants([(r["doc_id"], r["text"]) for r in docs.collect()], every)
    assert len(got) == len({r["word"] for r in got})


def test_variants_have_chains(spark):
    got = {r["word"]: r for r in spelling.variants(variant_docs(spark), every=1 << 40).collect()}
    assert (got["xflowerinh"]["form"], got["xflowerinh"]["root"]) == ("flowerinh", "flowering")


def test_variants_edges(spark, edge_docs, no_docs):
    got = spelling.variants(edge_docs).collect()
    assert {tuple(r) for r in got} == brute_variants([(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert spelling.variants(no_docs).count() == 0


def test_roots(spark):
    """Chains of every length up to 20."""
    rows = [(f"{c}-{i}", f"{c}-{i + 1}") for c in range(20) for i in range(c)]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {a: f"{a.split('-')[0]}-{a.split('-')[0]}" for a, _ in rows}


def test_neighbourhood_is_full():
    """Every word one edit away has a hash among the neighbours, whatever the edit."""
    word = "collocate"
    (at, hashes), *_ = spelling.neighbour_hashes([word])
    mine = set(hashes[0].tolist())
    letters = "abcxyzé"
    edits = {word[:i] + c + word[i + d :] for i in range(len(word) + 1) for c in ["", *letters] for d in (0, 1)} - {word}
    assert all(int(h) in mine for h in spelling.reduced_hashes(sorted(w for w in edits if one_edit(w, word))))
