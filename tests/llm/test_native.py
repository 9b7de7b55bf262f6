"""Mixing and tool-call linking: edge rows, and the queries with SQL on the smallest tables."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from parityline.llm import chat_tools, mixing, queries
from parityline.llm.common import text_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cur = c.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols

    def canon(rows):
        return sorted(str([round(float(v), 6) if isinstance(v, float) else v for v in r]) for r in rows)

    assert canon(tuple(r) for r in df.select(*cols).collect()) == canon(tuple(r[names.index(k)] for k in cols) for r in cur.fetchall())


def test_rake_meets_targets(spark):
    cells = spark.createDataFrame(
        [(f"s{a}", f"l{b}", f"t{c}", (a + 1) * (b + 2) * (c + 3) * 10) for a in range(4) for b in range(3) for c in range(2)] + [("s0", "l0", "empty", 0)],
        "source string, lang string, topic string, tokens long",
    )
    goal = {"source": [1, 2, 3, 4], "lang": [5, 3, 2], "topic": [1, 1]}
    targets = {d: spark.createDataFrame([(f"{d[0]}{k}", float(w)) for k, w in enumerate(ws)], "value string, weight double") for d, ws in goal.items()}
    fitted = mixing.rake(cells, targets, cycles=8)
    for d, ws in goal.items():
        got = {r[d]: r["s"] for r in fitted.groupBy(d).agg(F.sum("share").alias("s")).collect()}
        assert got == pytest.approx({f"{d[0]}{k}": w / sum(ws) for k, w in enumerate(ws)}, abs=1e-6)


def test_sample_meets_targets_where_cells_are_cut(spark):
    tokens = {("s0", "l0", "t0"): 9000, ("s0", "l0", "t1"): 8000, ("s0", "l1", "t0"): 7000, ("s0", "l1", "t1"): 9000, ("s1", "l0", "t0"): 900,
              ("s1", "l0", "t1"): 50, ("s1", "l1", "t0"): 800, ("s1", "l1", "t1"): 900, ("s2", "l1", "t1"): 100}
    cells = spark.createDataFrame([(*k, n) for k, n in tokens.items()], "source string, lang string, topic string, tokens long")
    goal = {"source": [0.89, 0.108, 0.002], "lang": [0.5, 0.5], "topic": [0.45, 0.55]}
    targets = {d: spark.createDataFrame([(f"{d[0]}{k}", w) for k, w in enumerate(ws)], "value string, weight double") for d, ws in goal.items()}
    rows = mixing.probabilities(cells, targets, 0.6).collect()
    assert max(r["ppm"] for r in rows) == mixing.SCALE
    budget = 0.6 * sum(tokens.values())
    for d, ws in goal.items():
        for k, w in enumerate(ws):
            got = sum(tokens[r["source"], r["lang"], r["topic"]] * r["ppm"] / mixing.SCALE for r in rows if r[d] == f"{d[0]}{k}")
            assert got == pytest.approx(w * budget, rel=1e-3)
    # A source that is asked for more than it holds is taken whole, its lack goes to the others, and it is told.
    more = targets | {"source": spark.createDataFrame([("s0", 0.8), ("s1", 0.1), ("s2", 0.1)], "value string, weight double")}
    fit = mixing.calibrated(cells, more, 0.6)
    assert sum(r["p"] * r["tokens"] for r in fit.collect()) == pytest.approx(budget, rel=1e-3)
    told = {r["value"]: r["met"] for r in mixing.reached(fit).filter("dim = 'source'").collect()}
    assert told["s2"] is False


def test_realised_shares_of_the_query(spark):
    """Expected tokens of every source, language and topic against the targets, and the budget."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cells = mixing.cells_of(docs, mixing.form(text_of("text")))
    targets = {d: mixing.tempered(cells, d, p) for d, p in (("source", 0.7), ("lang", 0.8), ("topic", 0.9))}
    fit = mixing.calibrated(cells, targets)
    total = cells.agg(F.sum("tokens").alias("n")).first()["n"]
    assert sum(r["p"] * r["tokens"] for r in fit.collect()) == pytest.approx(mixing.BUDGET * total, rel=1e-3)
    for d in mixing.DIMS:
        for r in fit.groupBy(d).agg(F.sum(F.col("p") * F.col("tokens")).alias("got"), F.first(f"goal_{d}").alias("goal")).collect():
            assert r["got"] == pytest.approx(r["goal"], rel=1e-3)


def test_mix_edges(spark, edge_docs, no_docs):
    clash = edge_docs.withColumn("mix_p", F.lit(5))
    out = mixing.mix(clash, mixing.form(text_of("text")))
    rows = out.collect()
    assert len(rows) == clash.count()
    assert out.columns == [*clash.columns, "mix_source", "mix_lang", "mix_topic", "mix_p_", "mix_kept"]
    assert all(r["mix_p"] == 5 and 0 <= r["mix_p_"] <= 1 for r in rows)
    assert {r["mix_source"] for r in rows} >= {"(none)", "s0"}
    kept = mixing.sampled(clash, mixing.form(text_of("text")))
    assert kept.columns == clash.columns and kept.count() == sum(r["mix_kept"] for r in rows)
    again = mixing.mix(clash.repartition(5), mixing.form(text_of("text"))).collect()
    assert sorted((str(r["doc_id"]), r["mix_kept"]) for r in again) == sorted((str(r["doc_id"]), r["mix_kept"]) for r in rows)
    assert mixing.mix(no_docs, mixing.form(text_of("text"))).count() == 0


CALL = "conv_id long, call_id string, name string, arguments string, depends_on array<string>"


def test_links_and_order(spark):
    good = '{"b": {"z": 1, "a": 2.50}, "query": "x\\n", "limit": 3}'
    calls = spark.createDataFrame(
        [
            (1, "a", "find", good, None), (1, "b", "find", '{"query": 5, "limit": "3", "odd": 1}', ["a"]), (1, "c", "find", '{"limit": 1}', ["a", "b", "gone"]),
            (1, "d", "find", "{bad", ["e"]), (1, "e", "none", '{"query": "q"}', ["d"]), (1, "f", "find", None, ["f"]), (1, None, "find", "[1]", None), (1, "a", "find", good, None),
        ],
        CALL,
    )
    results = spark.createDataFrame([("a", 'say "hi"'), ("a", "zz"), (None, "lost"), ("x", "orphan")], "call_id string, content string")
    schemas = spark.createDataFrame([("find", "query", "string", True), ("find", "limit", "number", False), ("find", "b", "object", False)], "name string, param string, kind string, required boolean")
    rows = chat_tools.link_calls(calls, results, schemas).collect()
    assert len(rows) == 8
    got = {r["call_id"]: r for r in rows}
    assert {k: r["level"] for k, r in got.items()} == {"a": 0, "b": 1, "c": 2, "d": None, "e": None, "f": None, None: None}
    assert {k: r["errors"] for k, r in got.items()} == {"a": "", "b": "type:limit;type:query;unknown:odd", "c": "missing:query", "d": "json", "e": "tool", "f": "json", None: "json"}
    assert (got["a"]["n_results"], got["c"]["unresolved"], got["b"]["n_results"]) == (2, 1, 0)
    assert got["a"]["message"] == '{"arguments":{"b":{"a":2.5,"z":1},"limit":3,"query":"x\\n"},"call_id":"a","errors":[],"level":0,"name":"find","result":"say \\"hi\\""}'
    assert all(json.loads(r["message"]) for r in rows)
    assert chat_tools.link_calls(calls.limit(0), results, schemas).count() == 0


def brute_levels(deps):
    """The longest chain behind each call; None on and behind cycles."""
    level = {}
    for _ in range(len(deps) + 1):
        for c, ds in deps.items():
            live = [d for d in ds if d in deps]
            if c not in level and all(d in level for d in live):
                level[c] = max((level[d] + 1 for d in live), default=0)
    return {c: level.get(c) for c in deps}


@pytest.mark.parametrize("kind", ["chain", "double chain", "layers", "random", "cycles", "star"])
def test_levels_and_positions_of_graphs(spark, kind):
    import random

    rng = random.Random(kind)
    deps = {
        "chain": {f"c{k}": [f"c{k - 1}"] for k in range(70)},
        "double chain": {f"c{k}": [f"c{k - 1}", f"c{k - 2}", f"c{k - 7}"] for k in range(40)},
        "layers": {f"l{k}_{j}": [f"l{k - 1}_{i}" for i in range(3)] for k in range(6) for j in range(3)},
        "random": {f"r{k}": [f"r{rng.randrange(k + 1)}" for _ in range(rng.randrange(4))] for k in range(60)},
        "cycles": {f"y{k}": [f"y{(k * 7 + 3) % 30}"] for k in range(30)} | {"z": ["y1", "a"], "a": [], "b": ["a"], "c": ["c"]},
        "star": {f"s{k}": ["hub"] for k in range(50)} | {"hub": ["root"], "root": []},
    }[kind]
    calls = spark.createDataFrame([(1 + len(c) % 2, c, "none", "{}", ds) for c, ds in deps.items()], CALL)
    results, schemas = spark.createDataFrame([], "call_id string, content string"), spark.createDataFrame([], "name string, param string, kind string, required boolean")
    rows = chat_tools.link_calls(calls, results, schemas).collect()
    want = brute_levels(deps)
    assert {r["call_id"]: r["level"] for r in rows} == want
    for conv in (1, 2):
        order = sorted((r for r in rows if r["conv_id"] == conv), key=lambda r: (r["level"] is None, r["level"] or 0, len(r["call_id"]), r["call_id"]))
        assert [r["position"] for r in order] == list(range(len(order)))
    assert {r["errors"] for r in rows} == {"tool"}
    assert sum(r["unresolved"] for r in rows) == sum(len({d for d in ds if d not in deps}) for ds in deps.values())


def test_repeated_calls_and_null_conversations(spark):
    calls = spark.createDataFrame([(None, "a", "t", "{}", None), (None, "b", "t", "{}", ["a"]), (1, "x", "t", '{"k": 1, "k": 2}', None), (1, "x", "t", "{}", None), (1, "y", "t", "{}", ["x"])], CALL)
    results, schemas = spark.createDataFrame([("a", None)], "call_id string, content string"), spark.createDataFrame([("t", "k", "integer", False)], "name string, param string, kind string, required boolean")
    rows = chat_tools.link_calls(calls.withColumn("content", F.lit("clash")), results, schemas).collect()
    assert sorted((str(r["conv_id"]), r["call_id"], r["position"]) for r in rows) == [("1", "x", 0), ("1", "x", 0), ("1", "y", 2), ("None", "a", 0), ("None", "b", 1)]
    assert sorted(r["errors"] for r in rows) == ["", "", "", "", "json"]


def test_no_turn_of_user_or_assistant_is_lost(spark, tmp_path):
    turns = [(1, 0, "system", "be brief"), (1, 1, "user", None), (1, 2, "assistant", "yes"), (1, 3, "assistant", "again"), (2, 0, "assistant", "first"), (2, 1, "user", "abc")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r["conv_id"], r["call_id"]): r for r in chat_tools.op8_chat_tools(spark, str(tmp_path)).collect()}
    assert {k: (r["n_results"], "orphan" in r["errors"]) for k, r in got.items()} == {(1, "c1_1"): (1, False), (1, "c1_2"): (1, True), (2, "c2_-1"): (1, True), (2, "c2_1"): (0, False)}
    assert json.loads(got[1, "c1_2"]["message"]) == {"arguments": None, "call_id": "c1_2", "errors": ["orphan"], "level": None, "name": None, "result": "again"}
    assert got[1, "c1_1"]["message"].endswith('"result":"yes"}')


def test_pipeline_runs(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "mixing", "bpe"]
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, SF)
        assert step.columns == docs.columns
        step = spark.createDataFrame(step.collect(), docs.schema)
        assert 0 < step.count() <= docs.count()
    rows = corpus_pipeline.STAGES[-1][1](spark, step, SF).collect()
    assert len(rows) == step.count()
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows)


def test_pipeline_of_odd_rows_and_of_none(spark, edge_docs, no_docs):
    import corpus_pipeline

    for docs in (edge_docs, no_docs):
        step = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, step, SF)
            assert out.columns == docs.columns
            step = spark.createDataFrame(out.collect(), docs.schema)
            assert step.count() <= docs.count()
            if name == "quality_rules":
                assert step.filter("text IS NULL OR length(text) < 10").count() == 0
        assert corpus_pipeline.STAGES[-1][1](spark, step, SF).count() == step.count()


def test_run_against_brute_force(spark):
    """run() against its rules one row at a time: the classifier's and the mixing's own decisions are taken as they are."""
    import corpus_pipeline
    from test_dedup import brute_lines, brute_near
    from tokenizers import Tokenizer

    from parityline.llm.common import tokenizer_path

    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = [r.asDict() for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()]
    kept = brute_lines(good)
    for r in good:
        r["text"] = "\n".join(x for k, x in enumerate(r["text"].split("\n")) if not x.strip(" \t\x0b\x0c\r") or k in kept.get(r["doc_id"], []))
        r["n_chars"] = len(r["text"])
    names = {c for _, c, _, _ in brute_near(good)}
    left = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in good if r["doc_id"] in names], docs.schema)
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in corpus_pipeline.mixing_to_weights(spark, left, SF).collect()}
    assert got == want


def test_numbers_keep_their_value(spark):
    """Whole numbers are integers however written; a number that doubles cannot hold is refused, unless it stands in a text."""
    given = {
        "a": ("1.0", ""), "b": ("12345678901234567890", ""), "c": ("1e3", ""), "d": ("1.5", "type:n"), "e": ("1e400", "json"), "f": ("-" + "9" * 400, "json"), "g": ('"1e400"', "type:n"),
        "h": ("1e-400", ""), "i": ("true", "type:n"), "j": ("null", "type:n"),
    }
    calls = spark.createDataFrame([("v", k, "t", f'{{"n": {x}, "s": "say \\"1e999\\" or {"7" * 400}"}}', []) for k, (x, _) in given.items()], "conv_id string, call_id string, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([], "call_id string, content string")
    schemas = spark.createDataFrame([("t", "n", "integer", True), ("t", "s", "string", True)], "name string, param string, kind string, required boolean")
    got = {r["call_id"]: r for r in chat_tools.link_calls(calls, results, schemas).collect()}
    assert {k: r["errors"] for k, r in got.items()} == {k: e for k, (_, e) in given.items()}
    assert '"n":12345678901234567890' in got["b"]["message"]
    assert "Infinity" not in "".join(r["message"] for r in got.values())
    assert got["e"]["message"].startswith('{"arguments":null,')
