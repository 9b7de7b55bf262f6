"""Counts, files and byte-pair encoding against the tokenizers library."""

import struct
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parityline.llm import bpe, token_counts, token_files
from parityline.llm.common import scratch, tokenizer_path
from parityline.llm.tokens import Encoder, drops_blanks

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


ALPHABET = st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from(list("abcdeABC '.,!<|>\t\n\x0b 0123éÉßΣσ")))
TEXT = st.lists(st.one_of(st.text(ALPHABET, max_size=12), st.sampled_from(["<|endoftext|>", "it's", "we'LL", "the", "tion", "'re"])), max_size=12).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_encoders_agree_with_the_library(texts):
    from tokenizers import Tokenizer

    want = [x.ids for x in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)] if texts else []
    raw = [t.encode() for t in texts]
    assert [ids(x) for x in Encoder(PATH).encode(raw)] == want
    assert [ids(x) for x in bpe.PairIndexBpe(PATH).encode(raw)] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0x80, 0x2FFFF).filter(lambda c: not 0xD800 <= c < 0xE000).map(chr), min_size=1, max_size=40))
def test_rare_characters_between_letters(marks):
    """Characters of every kind, unassigned ones too, between letters and beside accents."""
    from tokenizers import Tokenizer

    texts = [f"ab{m}cD é{m}x {m}{m} 1{m}2" for m in marks]
    want = [x.ids for x in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    raw = [t.encode() for t in texts]
    assert [ids(x) for x in Encoder(PATH).encode(raw)] == want
    assert [ids(x) for x in bpe.PairIndexBpe(PATH).encode(raw)] == want


def test_all_texts_of_the_tables(spark):
    """Both encoders against the library over whole texts of the middle table."""
    from tokenizers import Tokenizer

    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    want = [x.ids for x in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    raw = [t.encode() for t in texts]
    assert [ids(x) for x in Encoder(PATH).encode(raw)] == want
    assert [ids(x) for x in bpe.PairIndexBpe(PATH).encode(raw)] == want


def test_vocabularies_that_keep_blanks_are_refused():
    with pytest.raises(ValueError):
        bpe.PairIndexBpe(tokenizer_path("byte_bpe_50k.json"))


def test_one_long_word():
    """The one-at-a-time form agrees with the library and does not grow with the square of a word."""
    import time
    from tokenizers import Tokenizer

    word = "abracadabra" * 4000
    began = time.perf_counter()
    got = bpe.PairIndexBpe(PATH)._one_by_one(word)
    assert time.perf_counter() - began < 30
    assert got == Tokenizer.from_file(PATH).encode(word, add_special_tokens=False).ids


def test_registered_queries(spark, library):
    """op3, op4 and op6 as they are registered, against the library over every document."""
    import hashlib

    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want = {d: library.encode(t, add_special_tokens=False).ids for d, t in docs}
    counts = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.op4_token_counts(spark, sf).collect()}
    assert counts == {d: (len(t.encode()), len(want[d]), len(want[d]) > 2048) for d, t in docs}
    rows, at = {r["doc_id"]: r for r in token_files.op3_token_files(spark, sf).collect()}, 0
    for d, _ in docs:
        full = [*want[d], 1]
        assert (rows[d]["start"], rows[d]["n_tokens"], rows[d]["ids_crc32"]) == (at, len(full), zlib.crc32(struct.pack(f"<{len(full)}I", *full)))
        at += len(full)
    coded = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.op6_bpe(spark, sf).collect()}
    for d, x in want.items():
        text = library.decode(x, skip_special_tokens=False)
        assert coded[d] == (len(x), hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_which_files_drop_blanks():
    assert drops_blanks(PATH)
    assert not drops_blanks(tokenizer_path("byte_bpe_50k.json"))
    assert not drops_blanks(tokenizer_path("piece_bpe_32k.model"))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_whole_text_tokenizers(spark, edge_docs, name):
    path = tokenizer_path(name)
    cache = scratch(spark, "cache")
    got = {(r["doc_id"], r["n_bytes"]): r["n_tokens"] for r in token_counts.count_tokens(edge_docs, path, cache).collect()}
    texts = {(r["doc_id"], len((r["text"] or "").encode())): r["text"] or "" for r in edge_docs.filter("doc_id is not null").collect()}
    encoder = Encoder(path)
    for key, text in texts.items():
        assert got[key] == len(encoder.encode([text.encode()])[0]) // 4


def test_counts_and_cache(spark, edge_docs, no_docs, library):
    cache = scratch(spark, "cache")
    first = token_counts.count_tokens(edge_docs.filter("doc_id < 6"), PATH, cache).collect()
    stored = spark.read.parquet(cache).count()
    rows = token_counts.count_tokens(edge_docs.filter("doc_id is not null"), PATH, cache).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in edge_docs.filter("doc_id is not null").collect()]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == sorted(want)
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in rows)
    assert {tuple(r) for r in first} <= {tuple(r) for r in rows}
    total = spark.read.parquet(cache)
    assert total.count() == total.select("digest").distinct().count()  # only distinct misses were appended
    assert total.count() > stored
    assert token_counts.count_tokens(no_docs, PATH, cache).count() == 0


def test_files(spark, edge_docs, no_docs, library):
    docs = edge_docs.unionByName(edge_docs.filter("doc_id is null"))  # null ids come first
    folder = scratch(spark, "files")
    manifest = token_files.write_token_files(docs, PATH, folder, shard_bytes=50_000)
    assert manifest.count() > 1
    rows = token_files.read_documents(manifest, folder).orderBy("start").collect()
    source = [(r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids + [1]) for r in docs.collect()]
    source.sort(key=lambda x: (x[0] is not None, x))
    assert [d for d, _ in source[:3]] == [None, None, 0]
    assert [r["doc_id"] for r in rows] == [d for d, _ in source]
    at = 0
    for r, (_, want) in zip(rows, source, strict=True):
        assert (r["start"], r["n_tokens"], ids(r["ids"])) == (at, len(want), want)
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(want)}I", *want))
        at += len(want)
    some = token_files.fetch(spark, manifest, folder, spark.createDataFrame([(4,), (11,), (99,)], "doc_id long")).collect()
    assert {r["doc_id"]: ids(r["ids"]) for r in some} == {d: w for d, w in source if d in (4, 11)}
    none = token_files.write_token_files(no_docs, PATH, scratch(spark, "files"))
    assert token_files.read_documents(none, folder).count() == 0


def test_damage_is_found(spark, edge_docs):
    folder = scratch(spark, "files")
    manifest = token_files.write_token_files(edge_docs.filter("doc_id = 5"), PATH, folder)
    path = f"{folder.removeprefix('file://')}/{manifest.first()['path']}"
    data = bytearray(open(path, "rb").read())
    data[20] ^= 0xFF
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="(?i)checksum|corrupt|decompress|error"):
        token_files.read_documents(manifest, folder).collect()


def test_frames_of_a_long_document(tmp_path, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_files, "FRAME_IDS", 10)
    with pa.OSFile(str(tmp_path / "f"), "wb") as out:
        w = token_files.ShardWriter(out)
        w.add(3, np.arange(25, dtype="<u4").tobytes())
        w.add(-4, b"")
        w.close()
    r = token_files.ShardReader(pa.OSFile(str(tmp_path / "f"), "rb"))
    assert (r.docs, len(r.sizes)) == ([3, -4], 4)
    assert (ids(r.ids(0)), r.ids(1)) == (list(range(25)), b"")


def test_bpe_query_form(spark, edge_docs, no_docs, library):
    import hashlib

    rows = bpe.encode_decode(edge_docs, PATH).collect()
    want = {}
    for r in edge_docs.collect():
        x = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(x, skip_special_tokens=False)
        want[(r["doc_id"], hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest())] = (len(x), hashlib.sha256(text.encode()).hexdigest(), x, text)
    assert {(r["doc_id"], r["ids_sha256"]): (r["n_tokens"], r["decoded_sha256"], r["ids"], r["decoded"]) for r in rows} == want
    assert len(rows) == edge_docs.count()
    assert bpe.encode_decode(no_docs, PATH).count() == 0


def test_a_rank_that_arises_late():
    """A vocabulary that spells one token in two ways: 'abc' as ab+c and as a+bc, and abc+d between the two ranks."""
    import json
    import tempfile

    letters = bpe.byte_letters()
    names = [*letters, *[c + "</w>" for c in letters], "ab", "bc", "abc", "abcd</w>", "dd</w>"]
    merges = [["b", "c"], ["abc", "d</w>"], ["a", "bc"], ["d", "d</w>"], ["a", "b"], ["ab", "c"]]
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"] |= {"vocab": {n: i for i, n in enumerate(names)}, "merges": merges}
    spec["added_tokens"] = []
    with tempfile.NamedTemporaryFile("w", suffix=".json") as f:
        json.dump(spec, f)
        f.flush()
        from tokenizers import Tokenizer

        words = ["abcd", "abcdd", "abc", "aabcd", "abcabcd", "ddddd", "bcd"]
        want = [x.ids for x in Tokenizer.from_file(f.name).encode_batch(words, add_special_tokens=False)]
        assert [ids(x) for x in bpe.PairIndexBpe(f.name).encode([w.encode() for w in words])] == want


def test_memory_of_a_task(spark, monkeypatch):
    taken, docs = [], spark.createDataFrame([(1, "a")], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, run, schema: taken.append(run))
    bpe.encode_decode(docs, PATH)
    text = " ".join(f"word{k % 997}" for k in range(125)).encode()
    batch = pa.record_batch([pa.array(range(8000), pa.int64()), pa.array([text] * 8000, pa.binary())], ["doc_id", "text"])
    for _ in taken[0](iter([batch.slice(0, 1)])):  # the vocabulary is loaded
        pass
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in taken[0](iter([batch]))) == 8000
        assert tracemalloc.get_traced_memory()[1] < 50e6  # for 8 MB of text
    finally:
        tracemalloc.stop()


def test_steps_of_a_task_are_small(spark, monkeypatch):
    taken, docs = [], spark.createDataFrame([(1, "a")], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, run, schema: taken.append(run))
    bpe.encode_decode(docs, PATH)
    text = " ".join(f"word{k % 997}" for k in range(125)).encode()
    batch = pa.record_batch([pa.array(range(4000), pa.int64()), pa.array([text] * 4000, pa.binary())], ["doc_id", "text"])
    for _ in taken[0](iter([batch.slice(0, 1)])):  # the vocabulary is loaded
        pass
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in taken[0](iter([batch]))) == 4000
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 20e6, peak  # for 4 MB of text
