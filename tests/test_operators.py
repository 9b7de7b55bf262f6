"""Round trips and properties: comparing, applying, files, catalog, validation, streams."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityline.operators import apply as A
from parityline.operators import compare as K
from parityline.operators import diffstore as D
from parityline.operators import shape as S
from parityline.operators import validate as VA
from parityline.operators import windows as W
from parityline.sources import files as FI
from parityline.sources import scans as X
from parityline.sources import sinks as SI
from parityline.streaming import logs as ST


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def pair(spark):
    source = spark.createDataFrame([(str(k), k % 5, f"n{k % 7}", None if k % 9 == 0 else float(k)) for k in range(1, 60)], "id string, a int, b string, c double")
    target = source.filter("id % 10 <> 0").withColumn("b", F.when(F.col("id") % 6 == 0, "other").otherwise(F.col("b"))).withColumn("c", F.when(F.col("id") % 8 == 0, None).otherwise(F.col("c")))
    return source, target


def test_compare_with_itself_is_empty(spark, pair):
    assert K.compare_tables(pair[0], pair[0], "id").isEmpty()


def test_apply_closes_the_loop(spark, pair):
    source, target = pair
    diffs = K.compare_tables(source, target, "id").withColumn("window", F.lit("w1"))
    assert {r["status"] for r in diffs.collect()} == {"diff", "missing_in_target"}
    updates = A.collapse_updates(K.usable_diffs(diffs))
    fixed = A.apply_updates(target, updates, "id")
    missing = K.missing_rows(source, diffs, "id").drop("error")
    fresh, results = A.apply_inserts(fixed, missing, "id")
    after = fixed.unionByName(fresh.select(*fixed.columns))
    assert K.compare_tables(source, after, "id").isEmpty()
    assert {r["result"] for r in results.collect()} == {"created"}


def test_bad_keys_and_duplicates(spark):
    s = spark.createDataFrame([(" 1 ", "a"), ("1", "b"), (None, "c"), ("NaN", "d"), ("2", "e")], "id string, v string")
    t = spark.createDataFrame([(1, "a"), (3, "x")], "id int, v string")
    got = rows(K.compare_tables(s, t, "id"))
    assert [r[0] for r in got] == ["2", "3"]
    assert rows(K.compare_tables(s, t, "id", restrict_target_to_source=True)) == [r for r in got if r[0] == "2"]


def test_empty_side(spark, pair):
    none = pair[1].limit(0)
    assert K.compare_tables(pair[0], none, "id").count() == pair[0].count()
    assert K.compare_tables(pair[0], none, "id", empty_side="skip").isEmpty()
    assert K.compare_tables(none, none, "id").isEmpty()


def test_columns_that_one_side_lacks(spark):
    s = spark.createDataFrame([("1", 5, 0)], "id string, a int, z int")
    t = spark.createDataFrame([("1",)], "id string")
    assert rows(K.compare_tables(s, t, "id")) == [("1", "a", "5", None, "diff")]


def test_prune_plan():
    plan = S.prune_plan([S.Field("a", "id"), S.Field("b+c", "x", "f"), S.Field("d", "y")], ["x"], "id")
    assert plan.source_columns == ("a", "b", "c")
    assert plan.target_columns == ("id", "x")


def test_steps_and_grid(spark):
    assert [W.step_seconds(x) for x in ("HOUR", "30 DAYS", "2h", "15m", "7")] == [3600, 2592000, 7200, 900, 604800]
    with pytest.raises(ValueError, match="no such step"):
        W.step_seconds("soon")
    grid = W.window_grid(spark, datetime(2024, 1, 1), datetime(2024, 1, 1, 2, 30), "h").collect()
    assert grid[-1]["window_to"] == datetime(2024, 1, 1, 2, 30)
    assert W.window_grid(spark, datetime(2024, 1, 1), datetime(2024, 1, 1), "h").isEmpty()


def test_id_windows(spark):
    df = spark.range(3, 4).withColumnRenamed("id", "k")
    assert W.assign_id_window(df, "k", 10).count() == 1
    assert W.assign_id_window(df, "k", 10, skip_single=True).count() == 0
    assert W.assign_id_window(df, "k", 10, limit=0).count() == 0


def test_shards(spark):
    df = spark.range(1000)
    shards = X.scan_hash_shards(df, "id", 4)
    assert shards.count() == 1000
    assert X.scan_hash_shards(df, "id", 4, max_per_shard=3).count() == 12


def test_documents_of_a_key_scan_are_not_sorted(spark):
    docs = spark.range(1000).select(F.concat(F.lit(" "), F.col("id").cast("string")).alias("id"), F.lit("x").alias("s"))
    keys = spark.createDataFrame([(7,), (7,), (None,), (5000,), (12,)], "k long")
    with_sort = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = X.scan_docs_by_keys(docs, "id", keys, "k")
        assert rows(found) == [(" 12", "x"), (" 7", "x")]
        assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_sort)


def test_diff_store_round_trip(spark, pair, tmp_path):
    source, target = pair
    diffs = K.compare_tables(source, target, "id")
    counts = SI.write_diffs(diffs, source, "id", str(tmp_path), "EV", "prod", "w1")
    kinds = {k: diffs.filter(F.col("status") == s).count() for k, s in (("changes", "diff"), ("missing", "missing_in_target"))}
    assert counts == kinds
    back = X.filter_event_env(spark.read.parquet(f"{tmp_path}/changes"), "EV", "prod")
    assert back.count() == counts["changes"]
    again = A.collapse_updates(K.usable_diffs(back))
    assert again.count() == back.select("pk").distinct().count()


def test_diff_store_has_no_file_for_each_window(spark, pair, tmp_path):
    source, target = pair
    diffs = K.compare_tables(source, target, "id").withColumn("id_from", F.xxhash64("pk", "field"))
    counts = SI.write_diffs(diffs, source, "id", str(tmp_path), "EV", "prod")
    for name, status in (("changes", "diff"), ("missing", "missing_in_target")):
        back = spark.read.parquet(f"{tmp_path}/{name}")
        assert back.count() == counts[name]
        windows = {r[0] for r in back.select(F.col("window").cast("string")).distinct().collect()}
        assert windows == {str(r[0]) for r in diffs.filter(F.col("status") == status).select("id_from").collect()}
    assert len(list(tmp_path.rglob("*.parquet"))) <= 16 < len({r[0] for r in diffs.select("id_from").collect()})


def test_ledger_is_idempotent(spark):
    ledger = spark.createDataFrame([], "event string, env string, mode string, source_file string, applied_ts timestamp, n_updated int, n_failures int")
    entries = spark.createDataFrame(
        [("E", "p", "changes", "f1", datetime(2024, 1, 1), 3, 0), ("E", "p", "changes", "f2", datetime(2024, 1, 1), 1, 2), ("E", "p", "changes", "f1", datetime(2024, 1, 2), 4, 0)], ledger.schema
    )
    once = A.mark_applied(ledger, entries)
    assert [(r["source_file"], r["n_updated"]) for r in once.collect()] == [("f1", 4)]
    assert rows(A.mark_applied(once, entries)) == rows(once)
    files = spark.createDataFrame([("E", "p", "f1"), ("E", "p", "f2")], "event string, env string, source_file string")
    run, skipped = D.exclude_applied(files, once, "changes")
    assert ([r["source_file"] for r in run.collect()], [r["source_file"] for r in skipped.collect()]) == (["f2"], ["f1"])
    assert D.exclude_applied(files, once, "changes", force=True)[0].count() == 2


def test_stamp_and_audit(spark, tmp_path):
    diffs = spark.createDataFrame([("1", "a", "x", "y", "w1"), ("1", "a", "z", "y", "w2")], "pk string, field string, source_value string, target_value string, window string")
    docs = A.collapse_updates(diffs)
    stamped = A.stamp_update(docs, datetime(2024, 1, 2)).first()["updates"]
    assert stamped == {"a": "z", "updateDate": "2024-01-02T00:00:00.000"}
    SI.write_audit(A.audit_rows(docs, "r", "E", "p", datetime(2024, 1, 2)), str(tmp_path / "audit"))
    record = json.loads(spark.read.text(str(tmp_path / "audit")).first()[0])
    assert record["changes"] == {"a": {"old": "y", "new": "z"}}


def test_validate(spark):
    schema = {f.field: f for f in (VA.TargetField("n", "long", "n"), VA.TargetField("t", "keyword", "t"), VA.TargetField("d", "date", "d"), VA.TargetField("l", "long", "l", True), VA.TargetField("u", "geo", "u"))}
    df = spark.createDataFrame([("1", "x", True, "no date", [1], ["a", None], 1, 5)], "id string, n string, t boolean, d string, l array<int>, l2 array<string>, u int, extra int")
    found = {(r["field"], r["error"]) for r in VA.validate(df, schema).collect()}
    assert found == {("n", "wrong type"), ("t", "boolean on keyword"), ("extra", "not in schema"), ("l2", "not in schema")}
    lists = spark.createDataFrame([("1", ["a", None, "b"], [1])], "id string, l array<string>, n array<int>")
    found = {(r["field"], r["error"]) for r in VA.validate(lists, schema).collect()}
    assert found == {("l", "element 0: wrong type"), ("n", "list on a scalar")}
    with pytest.raises(ValueError, match="not in schema"):
        VA.validate_plan(df, schema)
    nulls = df.select("id", *[F.lit(None).cast(t).alias(c) for c, t in df.dtypes if c != "id"])
    VA.validate_plan(nulls, schema)


def test_schemas(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": {"c": [1, 2]}, "d": ["x"]}',), ('{"a": 2}',)], "doc string")
    assert VA.detect_arrays(docs) == ["b.c", "d"]
    typed = spark.createDataFrame([(1, [2.0], {"k": 1})], "a int, b array<double>, m map<string,int>")
    assert rows(VA.infer_target_schema(typed)) == [("a", "long", "", "a", "false"), ("b", "double", "", "b", "true"), ("m", "object", "", "m", "false")]


def test_files_and_catalog(spark, tmp_path):
    (tmp_path / "x/logging").mkdir(parents=True)
    (tmp_path / "y/logging").mkdir(parents=True)
    (tmp_path / "x/logging/queries.csv").write_text("query_id,seconds\n1,2\n2,bad\n")
    (tmp_path / "y/logging/queries.csv").write_text("query_id,rows\n3,9\n")
    FI.register_catalog(spark, str(tmp_path))
    got = spark.table("v_log_queries")
    assert set(got.columns) == {"query_id", "seconds", "rows", "filename"}
    assert got.count() == 3
    assert spark.table("v_changes").columns == ["filename"]
    assert spark.table("v_changes").isEmpty()
    df = spark.createDataFrame([("a\nb", ["c\td"], None)], "t string, l array<string>, n string")
    SI.write_csv_scrubbed(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()[0] == "a b"
    SI.export_table_csv(spark.range(10), str(tmp_path / "few"), 3)
    assert spark.read.option("header", True).csv(str(tmp_path / "few")).count() == 3
    back = FI.read_diff_csv(spark, str(tmp_path / "y/logging/queries.csv"))
    assert back.first()["rows"] == "9"
    df.createOrReplaceTempView("some_table")
    assert SI.backup_tables(spark, ["some_table", "no_such_table"], str(tmp_path / "backup")) == {"some_table": "saved", "no_such_table": "absent"}


def test_payload(spark):
    df = spark.createDataFrame([("7", '{"id": "7", "v": 1}'), ("8", "{bad")], "doc_id string, payload string")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType())])
    assert rows(FI.expand_payload(df, schema, "key")) == [("7", "7", 1), ("8", "8", None)]


def test_run_logs(spark, tmp_path):
    schema = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("n", T.LongType())])
    for run in ("r1", "r2"):
        SI.write_run_log(spark.createDataFrame([(run, "5")], "run_id string, n string"), str(tmp_path), run, "queries", schema)
    assert rows(FI.read_run_logs(spark, str(tmp_path), "queries", schema)) == [("r1", 5), ("r2", 5)]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"ts": "2024-01-01T00:00:00Z", "level": "INFO"}\n')
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("level", T.StringType())])
    for more in (None, '{"ts": "2024-01-02T00:00:00Z", "level": "ERROR"}\n'):
        if more:
            (tmp_path / "in/b.json").write_text(more)
        ST.stream_run_logs(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "cp"), every=None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    q = ST.stream_log_counts(spark, str(tmp_path / "in"), schema).writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counts").count() == 2


def test_shards_of_a_partition_are_written_by_several_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("".join(f'{{"k": {k % 500}, "ts": "2024-01-01T00:00:00Z", "run_id": "r"}}\n' for k in range(600)))
    schema, out = T.StructType.fromDDL("k long, ts timestamp, run_id string"), str(tmp_path / "out")
    ST.stream_run_logs(spark, str(tmp_path / "in"), schema, out, str(tmp_path / "cp"), keys=("k",), every=None, shard_rows=50, by=("run_id",), spread=8).awaitTermination()
    shards = spark.read.parquet(out).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in shards) == 500 and max(r["n"] for r in shards) <= 50
    assert len({r["file"].split("-")[1] for r in shards}) > 1  # the number of the task


def test_stream_pending_applies_each_file_once(spark, tmp_path):
    spark.createDataFrame([("1", "a")], "pk string, field string").write.parquet(str(tmp_path / "in"))
    seen = []
    schema = T.StructType([T.StructField("pk", T.StringType()), T.StructField("field", T.StringType())])
    for _ in range(2):
        ST.stream_pending(spark, str(tmp_path / "in"), schema, lambda df, _: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination()
    assert sum(seen) == 1


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["pk", "field", "source_value", "target_value", "status"]
    assert df.count() > 0
