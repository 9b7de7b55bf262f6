"""Quality rules and toxicity: exact counts against brute force, verdicts against held-out labels."""

import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parityline.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_base_counts(spark, edge_docs, no_docs):
    got = quality.score(edge_docs, None).collect()
    assert len(got) == edge_docs.count()
    texts = {}
    for r in edge_docs.collect():
        texts.setdefault(r["doc_id"], r["text"])
    for r in got:
        assert tuple(r[1:7]) == brute_counts(texts[r["doc_id"]])
        assert r["kept"] == (not r["base_failed"])
        assert r["quality"] is None
    assert quality.score(no_docs, None).count() == 0


def test_filter_keeps_columns(spark, edge_docs):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.keep_good(edge_docs, labels)  # one label only: no model, the base rule decides
    assert out.schema == edge_docs.schema
    assert {r["doc_id"] for r in out.collect()} == {k for k, t in ((r["doc_id"], r["text"]) for r in edge_docs.collect()) if not brute_counts(t)[5]}


def test_a_carried_text_travels_once(spark, edge_docs, monkeypatch):
    sent, send = [], type(edge_docs).mapInArrow
    monkeypatch.setattr(type(edge_docs), "mapInArrow", lambda df, *args: sent.append(df) or send(df, *args))
    quality.score(edge_docs, None, carry=True)
    assert sent[0].columns == [f"in_{c}" for c in edge_docs.columns]


def test_word_hash_does_not_depend_on_position():
    b = quality.Batch.of([b"abc de abc", b"", "é abc".encode()])
    assert b.hashes[0] == b.hashes[2] == b.hashes[4]
    assert len(set(b.hashes.tolist())) == 3
    assert b.doc.tolist() == [0, 0, 0, 2, 2]


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_held_out(spark, labelled):
    docs, labels = labelled
    apart = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = quality.train(docs, labels.filter(~apart))
    rows = quality.score(docs, model).withColumnRenamed("quality", "p").join(labels.filter(apart), "doc_id").filter(~F.col("base_failed")).collect()
    good = [r for r in rows if r["quality"] == 1]
    bad = [r for r in rows if r["quality"] == 0]
    assert np.mean([r["kept"] for r in good]) > 0.99
    assert np.mean([r["kept"] for r in bad]) < 0.1
    assert np.mean([(r["p"] - r["quality"]) ** 2 for r in rows]) < 0.02


def test_fit_holds_its_rows_once(spark, labelled):
    docs, labels = labelled
    tracemalloc.start()
    assert quality.train(docs, labels) is not None
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = 2000 * (quality.N_WORD + quality.N_CHAR) * 4  # the dense rows of all training texts
    assert peak < 1.5 * whole


def test_spent_rows_give_the_same_fit():
    x = np.random.default_rng(5).random((60, 700), np.float32)
    y, w = np.arange(60) % 2.0, np.ones(60)
    kept = quality.logistic(x, y, w, 1e-3, rounds=20)
    spent = quality.logistic(x.copy(), y, w, 1e-3, rounds=20, spend=True)
    assert np.array_equal(kept[0], spent[0]) and kept[1] == spent[1]


def test_toxicity_held_out(spark, labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.95
    clean = [r for r in held if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in clean]) < 0.02
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    words = {texts[r["doc_id"]][s["start"] : s["end"]].strip(".,!").lower() for r in held for s in r["spans"] if r["toxic"]}
    assert {"idiot", "scum", "moron"} & words


def test_toxicity_edges(spark, edge_docs, no_docs):
    none = toxicity.score(edge_docs, None).collect()
    assert {r["score"] for r in none} == {0.0}
    bad = [b"you idiot now. fine words here", b"an idiot again", b"idiot there", b"some idiot. yes", b"idiot idiot"]
    good = [b"fine words here", b"you are here now", b"again there", b"some words. yes", b"all well"]
    model = toxicity.fit(bad, good)
    rows = toxicity.score(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(no_docs, model).count() == 0
    df = spark.createDataFrame([(1, "Ünï ok. an IDIOT, idiot! here"), (2, "all is well")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    assert got[1]["score"] > got[2]["score"]
    span = got[1]["spans"][0]
    assert "Ünï ok. an IDIOT, idiot! here"[span["start"] : span["end"]] == "IDIOT, idiot!"


def test_marginals_against_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 4])
    theta, trans, first = rng.normal(size=8), rng.normal(size=(2, 2)), 0.3
    p, pairs, log_z = toxicity.marginals(theta, lengths, trans, first)
    want, want_pairs, total, at = [], np.zeros((2, 2)), 0.0, 0
    for n in lengths:
        mass, own, own_pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=int(n)):
            s = tags[0] * first + sum(t * x for t, x in zip(tags, theta[at : at + n], strict=True)) + sum(trans[a, b] for a, b in itertools.pairwise(tags))
            mass += np.exp(s)
            own += np.exp(s) * np.array(tags)
            for a, b in itertools.pairwise(tags):
                own_pairs[a, b] += np.exp(s)
        want += list(own / mass)
        want_pairs += own_pairs / mass
        total += np.log(mass)
        at += n
    assert np.allclose(p, want)
    assert np.allclose(pairs, want_pairs)
    assert np.isclose(log_z, total)


def test_scores_are_those_of_the_features():
    texts = ["größere Wörter, größere".encode(), b"", b"abc abd", "漢字 🙂 é".encode(), b"one"]
    weights = np.random.default_rng(3).normal(size=quality.N_WORD + quality.N_CHAR)
    got = quality.linear_scores(quality.Batch.of(texts), weights)
    assert np.allclose(got, quality.frequencies(texts) @ weights, atol=1e-4)


def test_character_runs_are_of_characters():
    """Places of runs do not depend on how many bytes a letter takes: k letters have k - 1 runs of two."""
    kinds = list(quality.features(quality.Batch.of(["éüß".encode(), b"abc"])))
    for k, (_, doc) in enumerate(kinds[2:], 1):
        assert np.bincount(doc).tolist()[0] == np.bincount(doc).tolist()[1], k


def test_registered_models(spark):
    """The registered queries: every row once, base counts by brute force, verdicts and labels that follow from the scores."""
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in quality.op5_quality_rules(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for k, r in got.items():
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute_counts(docs[k])
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)
    got = {r["doc_id"]: r for r in toxicity.op7_toxicity(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for k, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= 0.5)
