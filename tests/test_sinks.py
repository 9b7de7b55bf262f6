"""What is written and kept: the bucketed target, the ledger's versions, bucketed tables, databases, headers, streams, audits."""

import gzip
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parityline.functions.converters import python_converter
from parityline.operators import apply as A
from parityline.operators import audit as AU
from parityline.operators import compare as K
from parityline.operators import lookup as L
from parityline.operators import shape as S
from parityline.operators import validate as VA
from parityline.plans import connectors, modes
from parityline.plans.adapter import Adapter, apply_event, apply_run
from parityline.plans.fixtures import log_frame
from parityline.sources import files as FI
from parityline.sources import sinks as SI
from parityline.sources import versioned as VE
from parityline.streaming import logs as ST

SF = "/root/testdata/sf0.001"
AT = datetime(2024, 1, 2)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def target(spark, tmp_path):
    docs = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("s"), F.col("id").alias("n"), F.lit("u").alias("_id"), F.lit("v").alias("updates"))
    path = str(tmp_path / "target")
    VE.write_target(docs, path, "id", 8)
    return path


def files(path):
    return {str(f) for f in path.rglob("*.parquet")}


def updates(spark, given):
    return spark.createDataFrame(list(given.items()), "id string, updates map<string,string>")


def test_target_touches_only_its_buckets(spark, target, tmp_path):
    before = files(tmp_path)
    done = VE.update_target(spark, target, updates(spark, {"5": {"s": "Z"}, "7": {"n": "70", "_id": "w"}, "none": {"s": "x"}}), "id", 8)
    after = files(tmp_path)
    buckets = {f"bucket={b}" for b in done}
    assert 0 < len(done) < 8
    assert {f.split("/")[-2] for f in before - after} <= buckets
    assert {f for f in before if f.split("/")[-2] not in buckets} <= after
    got = {r["id"]: r for r in VE.read_target(spark, target).collect()}
    assert len(got) == 200
    assert (got["5"]["s"], got["7"]["n"], got["7"]["_id"], got["6"]["s"]) == ("Z", 70, "w", "a")
    assert VE.update_target(spark, target, updates(spark, {"a": {}}).limit(0), "id", 8) == []
    assert files(tmp_path) == after


def test_target_inserts_once(spark, target):
    new = spark.createDataFrame([("5", "no"), ("x", "yes"), ("x", "yes too")], "id string, s string")
    for _ in range(2):
        VE.insert_into_target(spark, target, new, "id", 8)
    back = VE.read_target(spark, target)
    assert back.count() == 201
    assert rows(back.filter("id in ('5', 'x')").select("id", "s", "n")) == [("5", "a", 5), ("x", "yes", None)]
    with pytest.raises(ValueError, match="no target"):
        VE.update_target(spark, target + "-none", updates(spark, {"5": {"s": "Z"}}), "id", 8)


def entries(spark, *files_, at=1, failures=0):
    return spark.createDataFrame([("e", "p", "changes", f, at, failures) for f in files_], "event string, env string, mode string, source_file string, applied_ts int, n_failures int")


def test_no_writer_loses_an_entry(spark, tmp_path):
    """Six writers at once, all from the same version, each with a file of its own."""
    ledger = VE.VersionedTable(spark, str(tmp_path / "ledger"))
    assert ledger.read() is None
    errors = []

    def write(k):
        try:
            VE.commit_applied(ledger, entries(spark, f"f{k}"))
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(6)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert not errors
    assert ledger.versions() == [1, 2, 3, 4, 5, 6]
    assert {r["source_file"] for r in ledger.read().collect()} == {f"f{k}" for k in range(6)}
    with pytest.raises(VE.Conflict):
        ledger.commit(entries(spark, "late"), 3)
    assert ledger.latest() == 6
    assert ledger.read(2).count() == 2
    VE.commit_applied(ledger, entries(spark, "bad", failures=2))
    VE.commit_applied(ledger, entries(spark, "f1", at=9))
    assert {(r["source_file"], r["applied_ts"]) for r in ledger.read().collect()} == {(f"f{k}", 9 if k == 1 else 1) for k in range(6)}


def test_one_writer_takes_a_name(spark, tmp_path):
    """Eight writers that reach the last step together: one gets the name, and the file is its own."""
    jvm, wins = spark._jvm, []
    (tmp_path / "v").mkdir()
    for k in range(8):
        (tmp_path / f"held-{k}").write_text(str(k))
    ready = threading.Barrier(8)

    def take(k):
        held, where = (jvm.org.apache.hadoop.fs.Path(f"file://{tmp_path}/{x}") for x in (f"held-{k}", "v/1.json"))
        ready.wait()
        if VE._take_name(spark, held, where):
            wins.append(k)

    threads = [threading.Thread(target=take, args=(k,)) for k in range(8)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert [str(k) for k in wins] == [(tmp_path / "v/1.json").read_text()]


def test_exactly_once_with_new_files(spark, tmp_path):
    """A checkpoint that is lost begins its batch ids anew; files that came in between are applied, the others not again."""
    schema = "event string, env string, source_file string, pk string"

    def add(name):
        spark.createDataFrame([("e", "p", name, str(k)) for k in range(3)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    ledger, out = VE.VersionedTable(spark, str(tmp_path / "ledger")), str(tmp_path / "out")

    def run(stream):
        kind = spark.read.parquet(str(tmp_path / "in")).schema
        write = ST.exactly_once(ledger, ST.batch_writer(out, stream), lambda: F.lit(1))
        ST.stream_pending(spark, str(tmp_path / "in"), kind, write, str(tmp_path / stream), files=1).awaitTermination()

    add("f1")
    run("a")
    add("f2")
    run("b")
    run("a")
    assert rows(spark.read.parquet(out).select("source_file", "pk")) == [(f, str(k)) for f in ("f1", "f2") for k in range(3)]
    assert {(r["source_file"], r["n_updated"]) for r in ledger.read().collect()} == {("f1", 3), ("f2", 3)}


def test_bucketed_comparison_has_no_exchange(spark, tmp_path):
    a = spark.createDataFrame([(str(k), k) for k in range(50)] + [(" 7 ", 0), ("nan", 1), (None, 2)], "id string, v int")
    b = spark.createDataFrame([(str(k), k + (k == 9)) for k in range(5, 60)], "id string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = [SI.write_keyed(df, f"keyed_{name}", str(tmp_path / name), "id", 4) for name, df in (("a", a), ("b", b))]
        found = K.compare_tables(*sides, "id", ready=True)
        assert "Exchange" not in plan(found)
        assert "Exchange" in plan(K.compare_tables(a, b, "id"))
        assert rows(found) == rows(K.compare_tables(a, b, "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in "ab":
            spark.sql(f"DROP TABLE IF EXISTS keyed_{name}")


def test_repeated_keys_compare_equal(spark):
    a = spark.createDataFrame([("1", 5, "x"), ("1", 4, "y"), ("2", 1, "z")], "id string, v int, w string")
    assert rows(K.compare_tables(a, a, "id")) == []
    event = modes.EventSpec([modes.PartSpec(a.withColumn("k", F.col("id").cast("int")), (S.Field("id", "id"), S.Field("v", "v"), S.Field("w", "w")))], a, "id", id_source="k")
    found = modes.compare_id_range(event, 10)
    assert rows(found) == []
    assert "BroadcastHashJoin" not in plan(found)


def test_database_is_read_in_parts(spark):
    def t(name):
        return log_frame(spark, SF, name)

    read = connectors.jdbc_parts(t, connectors.orders_database(t), 8).filter("o_totalprice > 200000").select("o_orderkey")
    assert read.rdd.getNumPartitions() == 8
    text = plan(read)
    assert "GreaterThan(o_totalprice,200000.0)" in text.replace("*", "")
    assert "o_custkey" not in text


def test_headers_are_read_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,z\n3,4\n")
    (tmp_path / "empty.csv").write_text("")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write("x,y\n5,6\n")
    with open(tmp_path / "long.csv", "w") as f:
        f.write("x\n" + "7" * (32 << 20))
    began = datetime.now()
    assert FI.first_line(spark, str(tmp_path / "long.csv")) == "x"
    assert (datetime.now() - began).total_seconds() < 2
    assert FI.first_line(spark, str(tmp_path / "empty.csv")) is None
    (tmp_path / "long.csv").unlink()
    assert rows(FI.read_csv_glob(spark, str(tmp_path / "*.csv*")).select("x", "y", "z")) == [("1", "2", None), ("5", "6", None), (None, "3", "4")]


def test_every_row_counts_for_a_schema(spark):
    docs = [('{"a": 1, "t": "x", "n": null, "o": {"k": [1, "x"]}}',)] * 300 + [("no JSON",), ("[1]",), (None,), ('{"a": 2.5, "t": ["x"], "a,b:c<d>": {"`": [[true]]}}',)]
    df = spark.createDataFrame(docs, "doc string")
    assert VA.detect_arrays(df) == ["a,b:c<d>.`", "o.k", "t"]
    assert VA.detect_arrays(df, sample=100) == ["o.k"]
    got = {r["full_path"]: (r["type"], r["is_array"]) for r in VA.infer_document_schema(df).collect()}
    assert got == {
        "a": ("double", "false"), "t": ("keyword", "true"), "n": ("keyword", "false"), "o": ("object", "false"), "o.k": ("keyword", "true"),
        "a,b:c<d>": ("object", "false"), "a,b:c<d>.`": ("boolean", "true"),
    }
    mixed = spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',), ('{"a": true}',)], "doc string")
    assert rows(VA.infer_document_schema(mixed).select("full_path", "type")) == [("a", "boolean|keyword|long")]
    assert rows(VA.infer_document_schema(df.limit(0))) == []


def test_audit_has_all_types(spark, tmp_path):
    target = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, s string")
    plan_ = spark.createDataFrame([("1", {"s": "x"}, {"s": ("a", "x")}), ("9", {"s": "y"}, {"s": (None, "y")})], "id string, updates map<string,string>, changes map<string,struct<old:string,new:string>>")
    new = spark.createDataFrame([("2", "there"), ("3", "new"), ("3", "new too"), ("4", None), ("4", None), ("5", "bad")], "id string, s string")
    inserts = AU.insert_results(target, new, "id", F.when(F.col("s") == "bad", "no"))
    assert rows(inserts.select("id", "result", "status", "error", "body")) == [
        ("2", "exists", 409, None, '{"s":"there"}'), ("3", "created", 201, None, '{"s":"new"}'), ("3", "exists", 409, None, '{"s":"new too"}'),
        ("4", "created", 201, None, "{}"), ("4", "exists", 409, None, "{}"), ("5", "error", 400, "no", '{"s":"bad"}'),
    ]
    run = AU.Run("r", "E", "p", "i", AT, batch_rows=1)
    SI.write_audit(AU.audit_records(run, plan_.select("id", "changes"), A.update_results(target, plan_, "id"), inserts), str(tmp_path / "audit"))
    back = spark.read.json(str(tmp_path / "audit")).collect()
    kinds = [r["type"] for r in back]
    assert {k: kinds.count(k) for k in ("run_start", "update", "insert", "run_end")} == {"run_start": 1, "update": 2, "insert": 6, "run_end": 1}
    batches = [r for r in back if r["type"] == "update_batch_result"]
    assert sum(r["ids_planned"] for r in batches) == 2
    assert {r["batch"] for r in back if r["type"] == "update"} == {r["batch"] for r in batches}
    (end,) = (r for r in back if r["type"] == "run_end")
    assert (end["updated"], end["conflicts"], end["created"], end["existing"], end["errors"]) == (1, 1, 2, 3, 1)


def test_a_bad_plan_writes_nothing(spark, target, tmp_path):
    diffs = spark.createDataFrame([("5", "n", "many", None, "9"), ("5", "s", "ok", "a", "9")], "pk string, field string, source_value string, target_value string, window string")
    docs = VE.read_target(spark, target).drop(VE.BUCKET)
    with pytest.raises(AU.PlanRejected, match="5.n: does not fit the type") as e:
        apply_event(Adapter(), (), diffs, docs, "id")
    assert len(e.value.errors) == 1
    new, unfit = apply_event(Adapter(), (), diffs, docs, "id", strict=False)
    assert rows(new.filter("id = '5'").select("s", "n")) == [("ok", 5)]
    assert unfit.count() == 1
    before = files(tmp_path)
    ledger = VE.VersionedTable(spark, str(tmp_path / "ledger"))
    stamped = diffs.select(F.lit("E").alias("event"), F.lit("p").alias("env"), F.lit("f1").alias("source_file"), "*")
    with pytest.raises(AU.PlanRejected):
        apply_run(AU.Run("r", "E", "p", "i", AT), Adapter(), (), stamped, target, "id", 8, ledger, str(tmp_path / "audit"))
    assert ledger.read() is None
    assert {f for f in files(tmp_path) if "/target/" in f} == {f for f in before if "/target/" in f}
    assert apply_run(AU.Run("r", "E", "p", "i", AT), Adapter(), (), stamped.filter("field = 's'"), target, "id", 8, ledger, str(tmp_path / "audit")) == 1
    assert [(r["source_file"], r["n_updated"], r["run_id"]) for r in ledger.read().collect()] == [("f1", 1, "r")]


def test_last_update_by_number_and_time(spark):
    rows_ = [("1", "n", "old", None, "9000"), ("1", "n", "new", None, "10000"), ("2", "n", "old", None, "2024-01-31 00:00:00"), ("2", "n", "new", None, "2024-02-01 00:00:00"), ("3", "n", "new", None, "b"), ("3", "n", "old", None, "a")]
    diffs = spark.createDataFrame(rows_, "pk string, field string, source_value string, target_value string, window string")
    assert {r["id"]: r["updates"] for r in A.collapse_updates(diffs).collect()} == {k: {"n": "new"} for k in "123"}


def test_lookup_needs_no_row_id(spark):
    table = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "")], "key string, value string")
    df = spark.createDataFrame([(None, "1"), (None, "1,1"), ("x", "1"), ("x", "2, 3,9,1"), ("y", ",-1,"), ("y", " "), ("y", None), ("y", "zz")], "r string, ids string")
    got = [(r["ids"], r["names"]) for r in L.lookup_csv(df, "ids", table, "names").collect()]
    assert sorted(got, key=str) == sorted([("1", "A"), ("1,1", "A, A"), ("1", "A"), ("2, 3,9,1", "B, A"), (",-1,", "All"), (" ", None), (None, None), ("zz", "")], key=str)


def test_python_converter_of_one_event(spark):
    class Shout(Adapter):
        def converters(self):
            return {"loud": python_converter(lambda x: x.str.upper() + "!", "string")}

    df = spark.createDataFrame([("1", "a"), ("2", None)], "k string, v string")
    mapping = (S.Field("k", "id"), S.Field("v", "v", "loud"))
    assert rows(Shout().transform(df, mapping)) == [("1", "A!"), ("2", None)]
    assert rows(Adapter().transform(df, mapping)) == [("1", "a"), ("2", None)]
    target = spark.createDataFrame([("1", "a"), ("2", None)], "id string, v string")
    event = modes.EventSpec([modes.PartSpec(df.withColumn("n", F.col("k").cast("int")), mapping)], target, "id", id_source="n", adapter=Shout())
    assert rows(modes.compare_id_range(event, 10).select("pk", "source_value", "target_value")) == [("1", "A!", "a")]
