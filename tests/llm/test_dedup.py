"""Exact, line and near deduplication against brute force."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from parityline.llm import exact_dedup, line_dedup, ngram_join
from parityline.llm.common import scratch


def stored(df, tmp_path, name="docs", files=1):
    path = str(tmp_path / name)
    df.repartition(files).write.parquet(path)
    return path


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")].append(r)
    want = []
    for g in groups.values():
        keep = min(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"]))["doc_id"]
        want += [(r["doc_id"], keep, len(g)) for r in g]
    return sorted(want)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.substring(F.sha2(t, 256), 1, 2), lambda _: F.lit("00")])
def test_exact(spark, edge_docs, tmp_path, digest):
    """Also with digests that clash for different texts: full bytes tell them apart."""
    docs = edge_docs.filter("doc_id is not null")
    path = stored(docs, tmp_path)
    got = exact_dedup.dedup(spark, path, scratch(spark, "stream"), digest).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == brute_exact(docs.collect())
    keys = [(r["text_sha256"], r["keep_id"]) for r in got if r["kept"]]
    assert len(keys) == len({r["text_sha256"] for r in got})  # one row of each text stays, repeated rows too


def test_exact_odd_ids_and_names(spark, tmp_path):
    """Text ids, the smallest long, and columns named as the file source's own."""
    rows = [("d2", "a b", 1, 2), ("d10", "ab", 3, 4), ("2", "a  b", 5, 6), (None, "ab  ", 7, 8), ("z", "other", 0, 0)]
    path = stored(spark.createDataFrame(rows, "doc_id string, text string, _metadata int, path int"), tmp_path)
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.dedup(spark, path, scratch(spark, "stream")).collect()}
    assert got == {("d2", "2", 4, False), ("d10", "2", 4, False), ("2", "2", 4, True), (None, "2", 4, False), ("z", "z", 1, True)}
    low = -(1 << 63)
    path = stored(spark.createDataFrame([(low, "x"), (0, " x"), (5, "x ")], "doc_id long, text string"), tmp_path, "low")
    assert {(r["doc_id"], r["keep_id"]) for r in exact_dedup.dedup(spark, path, scratch(spark, "stream")).collect()} == {(low, 0), (0, 0), (5, 0)}


def test_lines_odd_names(spark):
    """An id column of another name beside a column doc_id, repeated ids, and the names of this module's own columns."""
    rows = [("a", 9, "one two three four five six\nkeep", 1, 2), ("a", 9, "another text", 1, 2), ("b", 9, "six five four three two one\nnew here", 3, 4)]
    docs = spark.createDataFrame(rows, "key string, doc_id int, text string, _id int, _text int")
    got = {(r["key"], r["text"], r["_id"], r["doc_id"]) for r in line_dedup.drop_repeated_lines(docs, id_col="key").collect()}
    assert got == {("a", rows[0][2], 1, 9), ("a", "another text", 1, 9), ("b", "new here", 3, 9)}


def test_exact_state_goes_on(spark, edge_docs, tmp_path):
    docs = edge_docs.filter("doc_id is not null")
    path, checkpoint = str(tmp_path / "docs"), scratch(spark, "stream")
    docs.filter("doc_id < 6").coalesce(1).write.parquet(path)
    first = exact_dedup.dedup(spark, path, checkpoint).collect()
    docs.filter("doc_id >= 6").coalesce(1).write.mode("append").parquet(path)
    got = exact_dedup.dedup(spark, path, checkpoint, batch_bytes=1).collect()
    assert len(first) < len(got)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == brute_exact(docs.collect())


def test_exact_empty(spark, no_docs, tmp_path):
    assert exact_dedup.dedup(spark, stored(no_docs, tmp_path), scratch(spark, "stream")).count() == 0


def brute_lines(rows, t=0.8):
    """Ids with one text each."""
    seen, kept = [], defaultdict(list)
    lines = sorted({(r["doc_id"], k, line) for r in rows if r["doc_id"] is not None for k, line in enumerate((r["text"] or "").split("\n"))})
    for doc, k, line in lines:
        s = set(re.findall(r"[^\x20\x09-\x0D]+", line))
        if s:
            if not any(len(s & o) >= t * len(s | o) - 1e-9 for o in seen):
                kept[doc].append(k)
            seen.append(s)
    return dict(kept)


def variants(spark):
    words = [f"w{k}" for k in range(40)]
    texts = []
    for k in range(30):
        line = words[:]
        for j in range(k % 7):
            line[(k * 5 + j * 3) % 40] = f"x{k}_{j}"
        texts.append(" ".join(line) + "\n" + " ".join(words[: 3 + k % 9]) + f" tail{k % 4}")
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_lines(spark, edge_docs, no_docs):
    for docs in (edge_docs, variants(spark)):
        got = {r["doc_id"]: r["kept"] for r in line_dedup.kept_lines(docs).collect()}
        assert got == brute_lines(docs.collect())
    assert line_dedup.kept_lines(no_docs).count() == 0


def test_lines_are_taken_out(spark, edge_docs, no_docs):
    clash = edge_docs.withColumn("line_kept", F.lit("mine"))
    out = line_dedup.drop_repeated_lines(clash)
    assert out.columns == clash.columns
    rows = out.collect()
    assert len(rows) == clash.count()
    kept = brute_lines(clash.collect())
    texts = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    for r in clash.filter("doc_id is not null").collect():
        parts = r["text"].split("\n") if r["text"] is not None else None
        want = None if parts is None else "\n".join(x for k, x in enumerate(parts) if not x.strip(" \t\x0b\x0c\r") or k in kept.get(r["doc_id"], []))
        assert texts[r["doc_id"]] == want
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["no id at all"]
    assert line_dedup.drop_repeated_lines(no_docs).count() == 0


def test_an_id_with_several_texts_is_several_documents(spark):
    texts = [(1, "one two three four five\nsix seven eight nine ten"), (1, "one two three four five\neleven twelve thirteen fourteen"), (2, "one two three four five"), (1, "one two three four five\nsix seven eight nine ten")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    out = sorted((r["doc_id"], r["text"]) for r in line_dedup.drop_repeated_lines(docs).collect())
    left = [t for d, t in out if d == 1]
    assert sum("one two" in t for t in left) in (1, 2) and sum("six seven" in t for t in left) == 2 and sum("eleven" in t for t in left) == 1
    assert [t for d, t in out if d == 2] == [""]
    kept = line_dedup.kept_lines(docs).collect()
    assert len([r for r in kept if r["doc_id"] == 1]) == 2


def test_lines_of_one_group(spark):
    """Many near-equal lines, which meet through leaders and then through the remainder."""
    words = [f"w{k}" for k in range(30)]
    texts = []
    for k in range(120):
        line = words[:]
        for j in range(k % 6):
            line[(k * 7 + j * 5) % 30] = f"x{k % 11}_{j}"
        texts.append(" ".join(line))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["kept"] for r in line_dedup.kept_lines(docs).collect()}
    assert got == brute_lines(docs.collect())


def test_prefix_filter_needs_no_short_sets():
    assert line_dedup.ceil_share is not None
    for n in range(1, 4):  # what candidates() leaves out: different sets of fewer than four words stay below 0.8
        assert n / (n + 1) < 0.8
    assert line_dedup.least_size(0.8) == 4


def test_lines_of_all_sizes(spark):
    """Pairs at and beside the threshold whose sizes lie on both sides of every class of sizes."""
    for t in (0.5, 0.8):
        sizes = spark.range(1, 500).select(F.col("id").alias("n"), line_dedup.size_class(F.col("id"), t).alias("size"))
        sizes = {r["n"]: r["size"] for r in sizes.collect()}
        assert len(set(sizes.values())) > 1
        assert all(0 <= sizes[int(n / t + 1e-9)] - sizes[n] <= 1 for n in range(1, 250) if int(n / t + 1e-9) in sizes)
    texts = []
    for n in range(1, 70):
        words = [f"w{n}_{k}" for k in range(n)]
        longest = n * 5 // 4
        for size in (longest, longest + 1, n):
            texts.append(" ".join(words[:n] + [f"x{n}_{size}_{k}" for k in range(size - n)]))
    for order in (texts, texts[::-1]):
        docs = spark.createDataFrame(list(enumerate(order)), "doc_id long, text string")
        got = {r["doc_id"]: r["kept"] for r in line_dedup.kept_lines(docs).collect()}
        assert got == brute_lines(docs.collect())


def test_leaders_are_hashed_and_not_sorted(spark):
    """Lines meet by their least or largest hash, though no word of their prefixes is the same."""
    rows = [(k, 0, 50, 1, 1, 7, 100 + k, [10 * k + j for j in range(11)]) for k in range(4)]
    classes = spark.createDataFrame(rows, "doc_id long, place long, n int, parity long, odd_parity long, least int, largest int, prefix array<int>")
    pairs = line_dedup.leaders(classes, 0.8).collect()
    assert {r["late"]["doc_id"] for r in pairs} == {1, 2, 3} and all(r["early"] < r["late"] for r in pairs)


def test_coded_words_are_sorted_as_longs(spark):
    levels = bytes(k % 32 for k in range(1 << line_dedup.SKETCH_BITS))
    rows = spark.createDataFrame([("b a  a c",), ("",)], "line string").select(line_dedup.coded_words(F.col("line"), levels).alias("words"))
    assert not rows.schema["words"].dataType.containsNull  # else Spark sorts boxed objects
    got = [r["words"] for r in rows.collect()]
    assert [len(w) for w in got] == [3, 0] and got[0] == sorted(got[0])


def brute_near(rows, t=0.8):
    sets = [(r["doc_id"], frozenset(ngram_join.shingle_set((r["text"] or "").encode()))) for r in rows]
    nodes = list({s for _, s in sets})
    parent = list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a in range(len(nodes)):
        for b in range(a):
            if nodes[a] and nodes[b] and len(nodes[a] & nodes[b]) >= t * len(nodes[a] | nodes[b]):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    names = defaultdict(list)
    for d, s in sets:
        names[find(nodes.index(s))].append(d)
    copies = Counter(s for _, s in sets)
    return sorted(
        (str(d), min((x for x in names[find(nodes.index(s))] if x is not None), default=None), links[nodes.index(s)], copies[s]) for d, s in sets
    )


def test_near(spark, edge_docs, no_docs):
    for docs in (edge_docs, variants(spark)):
        want = brute_near(docs.collect())
        got = ngram_join.near_duplicates(docs, count_links=True).collect()
        assert sorted((str(r["doc_id"]), r["class_id"], r["n_links"], r["n_copies"]) for r in got) == want
        few = ngram_join.near_duplicates(docs).collect()
        assert sorted((str(r["doc_id"]), r["class_id"], r["n_copies"]) for r in few) == sorted((d, c, n) for d, c, _, n in want)
        linked = {d for d, _, n, _ in want if n}
        assert {str(r["doc_id"]) for r in few if r["jaccard"] is not None} == linked
    assert ngram_join.near_duplicates(no_docs).count() == 0


def test_phases_find_what_leaders_miss(spark):
    """A chain of texts, each near the one before, whose first and last share little; and one phase after the other."""
    words = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(24):
        texts.append(" ".join(words))
        words[5 * k % 118] = f"new{k}"
    docs = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "doc_id string, text string")
    rows = ngram_join.near_duplicates(docs).collect()
    assert {r["class_id"] for r in rows} == {"0"}
    sets = {str(k): ngram_join.shingle_set(t.encode()) for k, t in enumerate(texts)}
    for r in rows:
        a, b = sets[r["doc_id"]], sets[r["linked_id"]]
        assert r["jaccard"] == pytest.approx(len(a & b) / len(a | b)) and r["jaccard"] >= 0.8


@pytest.mark.parametrize("nodes", [3, 512])
def test_blocks_of_one_hot_band(spark, monkeypatch, nodes):
    """One group of near copies, some linked and some not, in small blocks and in one."""
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", nodes)
    words = [f"w{k}" for k in range(100)]
    texts = []
    for k in range(40):
        text = words[:]
        for j in range(k % 5):
            text[(k * 13 + j * 17) % 100] = f"x{k}_{j}"
        texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_near(docs.collect())
    got = ngram_join.near_duplicates(docs, count_links=True).collect()
    assert sorted((str(r["doc_id"]), r["class_id"], r["n_links"], r["n_copies"]) for r in got) == want
    assert sorted((str(r["doc_id"]), r["class_id"]) for r in ngram_join.near_duplicates(docs).collect()) == sorted((d, c) for d, c, _, _ in want)


def test_recall_of_the_candidates(spark):
    """Of the pairs between ids divisible by 20 and all rows that reach the threshold, at least 0.9 are in one class."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r["class_id"] for r in ngram_join.near_duplicates(docs).collect()}
    sets = {r["doc_id"]: ngram_join.shingle_set((r["text"] or "").encode()) for r in docs.collect()}
    true = [(a, b) for a in sets if a % 20 == 0 for b in sets if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0]
    assert len(true) > 5
    assert sum(got[a] == got[b] for a, b in true) >= 0.9 * len(true)


def test_the_query_counts_every_link(spark):
    """Each row of the query has all links of its text, also those inside a class that is connected without them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = ngram_join.op10_ngram_join(spark, "/root/testdata/sf0.01").collect()
    want = brute_near(docs)
    assert max(n for _, _, n, _ in want) > 0
    assert sorted((str(r["doc_id"]), r["class_id"], r["n_links"], r["n_copies"]) for r in got) == want


def test_numbers_of_shingles():
    texts = [b"a b c d e f", b"", b"a b c", b"x A b, c d e x", b"a b c d e a b c d e"]
    numbers, cuts = ngram_join.shingle_numbers(texts)
    sets = [set(numbers[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
    assert [len(s) for s in sets] == [2, 0, 0, 3, 6 - 1]
    words = [ngram_join.shingle_set(t) if len(t.split()) > 4 else set() for t in texts]
    assert all(len(sets[a] & sets[b]) == len(words[a] & words[b]) for a in range(5) for b in range(5))


def test_keep_one(spark, edge_docs, no_docs):
    out = ngram_join.keep_one(edge_docs)
    assert out.columns == edge_docs.columns
    want = sorted({c for d, c, _, _ in brute_near(edge_docs.collect()) if c is not None})
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == want
    assert out.filter("doc_id is null").count() == 1
    assert ngram_join.keep_one(no_docs).count() == 0


def test_one_id_with_several_texts_and_texts_without_id(spark):
    def near(text, k):
        w = text.split()
        w[k] = "changed"
        return " ".join(w)

    def prose(seed, n):
        return " ".join(f"w{seed}x{k}" for k in range(n))

    a, b, c = prose(11, 60), prose(12, 60), prose(13, 60)
    rows = [(7, a), (7, b), (7, near(b, 30)), (3, c), (9, near(c, 30)), (9, prose(14, 60)), (None, near(a, 30)), (None, prose(15, 60)), (None, near(prose(15, 60), 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_duplicates(docs, count_links=True).collect()
    want = [(7, 7, 1, 1)] * 3 + [(3, 3, 1, 1), (9, 3, 1, 1), (9, 9, 0, 1), (None, 7, 1, 1), (None, None, 1, 1), (None, None, 1, 1)]
    assert Counter((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in got) == Counter(want)
    for n in (1, 5):
        kept = [(r["doc_id"], r["text"]) for r in ngram_join.keep_one(docs.repartition(n)).collect()]
        assert sorted(t for d, t in kept if d is None) == sorted(t for d, t in rows if d is None)
        assert len([1 for d, t in kept if d == 7 and t == a]) == 1
        assert len([1 for d, t in kept if d == 7 and t in (b, near(b, 30))]) == 1
        assert sorted(x for x in kept if x[0] in (3, 9)) == sorted([(3, c), (9, prose(14, 60))])
        assert len(kept) == 7


def test_posterior_bounds():
    bounds = dict(ngram_join.fewest_matches())
    assert all(0 < m < n for n, m in bounds.items() if n > 16)
    assert bounds[128] / 128 < 0.8
    assert sorted(bounds.values()) == list(bounds.values())
