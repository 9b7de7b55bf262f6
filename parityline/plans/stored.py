"""Queries over what is written and read back: the diff store, logs, exports, schemas, streams and an event's hooks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityline.functions import converters as C
from parityline.functions import values as V
from parityline.operators import apply as A
from parityline.operators import compare as K
from parityline.operators import logs as G
from parityline.operators import lookup as L
from parityline.operators import reports as R
from parityline.operators import shape as S
from parityline.operators import validate as VA
from parityline.plans import modes as M
from parityline.plans.adapter import Adapter, apply_event
from parityline.plans.registry import query
from parityline.sources import files as FI
from parityline.sources import sinks as SI
from parityline.sources.shared import scratch
from parityline.streaming import logs as ST

MAPPING = (
    S.Field("o_orderkey", "id", "int_to_string"),
    S.Field("o_orderstatus", "status"),
    S.Field("o_totalprice", "totalPrice"),
)
START, END = datetime(1996, 1, 1), datetime(1998, 7, 1)


def _spark(df: DataFrame):
    return df.sparkSession


# -- the diff store ---------------------------------------------------------------------------------------------------


def _written(t) -> tuple[DataFrame, str]:
    """A comparison by id windows, written as the diff store of one event; its folder."""
    source, target = t("src_orders"), t("tgt_orders")
    event = M.EventSpec([M.PartSpec(source, MAPPING)], target, "id", id_source="o_orderkey")
    root = scratch(_spark(source), "diff-store")
    SI.write_diffs(M.compare_id_range(event, 1000), S.shape(source, MAPPING), "id", root, "EV", "prod", mode="both")
    return source, root


STORE = """
lo AS (SELECT min(o_orderkey) AS lo FROM {src_orders}),
pairs AS (SELECT o_orderkey - (o_orderkey - lo) % 1000 AS win, s.*, t.* FROM {src_orders} s CROSS JOIN lo LEFT JOIN {tgt_orders} t ON CAST(s.o_orderkey AS VARCHAR) = t.id)"""


@query(f"""WITH {STORE} SELECT 'EV' AS event, 'prod' AS env, CAST(win AS VARCHAR) AS "window", id AS pk, 'status' AS field, o_orderstatus AS source_value, status AS target_value, 'diff' AS status
FROM pairs WHERE o_orderstatus <> status
UNION ALL SELECT 'EV', 'prod', CAST(win AS VARCHAR), id, 'totalPrice', CAST(o_totalprice AS VARCHAR), NULL, 'diff' FROM pairs WHERE id IS NOT NULL AND totalPrice IS NULL AND o_totalprice <> 0""")
def stored_changes(t):
    source, root = _written(t)
    back = FI.read_parquet_glob(_spark(source), f"{root}/changes/event=*/env=*/*.parquet")
    path = F.col("filename")
    part = {name: F.regexp_extract(path, f"/{name}=([^/]+)/", 1).alias(name) for name in ("event", "env")}
    return back.select(*part.values(), "window", "pk", "field", "source_value", "target_value", "status")


@query(f"WITH {STORE} SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CAST(o_totalprice AS VARCHAR) AS \"totalPrice\", 'missing_in_target' AS error, CAST(win AS VARCHAR) AS \"window\" FROM pairs WHERE id IS NULL")
def stored_missing(t):
    source, root = _written(t)
    return _spark(source).read.parquet(f"{root}/missing").select("id", "status", "totalPrice", "error", "window")


@query("""SELECT 'v_changes' AS view, count(*) AS n FROM {changes} UNION ALL SELECT 'v_missing', count(*) FROM {missing} UNION ALL SELECT 'v_log_queries', count(*) FROM {log_queries}
UNION ALL SELECT 'v_log_events', count(*) FROM {log_events} UNION ALL SELECT 'v_log_connections', 0""")
def catalog_views(t):
    """All views of the catalog over files of both kinds; a view without files is empty."""
    spark = _spark(t("changes"))
    root = scratch(spark, "catalog")
    t("changes").write.parquet(f"{root}/out/EV/prod/changes/changes_1.parquet")
    t("missing").write.parquet(f"{root}/out/EV/prod/changes/missing_1.parquet")
    for name in ("queries", "events"):
        SI.write_csv_scrubbed(t(f"log_{name}").drop("filename"), f"{root}/connector_wh/logging/{name}.csv")
    views = {k: (f"{pattern}/part-*", kind) for k, (pattern, kind) in FI.VIEWS.items()}
    names = FI.register_catalog(spark, root, views)
    wanted = [n for n in names if n not in ("v_source_full", "v_summary")]
    return FI.table_counts({n: spark.table(n) for n in wanted})


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus AS status, replace(o_orderpriority, '-', ' ') || ' x' AS note, NULL AS extra FROM {orders} WHERE o_orderstatus = 'F'
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, o_orderpriority FROM {orders} WHERE o_orderstatus <> 'F'""")
def csv_glob(t):
    """Files of two headers, one with line breaks in its texts, united by name."""
    orders = t("orders")
    root = scratch(_spark(orders), "csv")
    note = F.concat(F.translate("o_orderpriority", "-", "\n"), F.lit("\tx"))
    SI.write_csv_scrubbed(orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_orderstatus").alias("status"), note.alias("note")), f"{root}/a")
    SI.write_csv_scrubbed(orders.filter("o_orderstatus <> 'F'").select("o_orderkey", F.col("o_orderpriority").alias("extra")), f"{root}/b")
    return FI.read_csv_glob(_spark(orders), f"{root}/*/*.csv").select("o_orderkey", "status", "note", "extra")


@query("SELECT pk, field, coalesce(source_value, '') AS source_value, 'EV/prod/changes/' AS folder, event, env FROM {changes}")
def read_diff_csv(t):
    """Diff rows as CSV: text only, an empty cell is an empty text, and the path names file, event and environment."""
    changes = t("changes")
    path = f"{scratch(_spark(changes), 'diff-csv')}/out/EV/prod/changes"
    changes.select("event", "env", "pk", "field", "source_value").write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = FI.read_diff_csv(_spark(changes), path)
    named = F.concat(V.event_from_path(F.concat(F.lit("/out/"), F.col("source_file"))), F.lit("/"), V.env_from_path(F.concat(F.lit("/out/"), F.col("source_file"))), F.lit("/changes/"))
    return back.select("pk", "field", "source_value", named.alias("folder"), "event", "env")


@query("SELECT o_orderkey, o_orderdate FROM {orders} ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000")
def ordered_extract(t):
    """The first rows of an extract in a given order, as CSV."""
    orders = t("orders")
    path = scratch(_spark(orders), "extract")
    SI.export_table_csv(orders.select("o_orderkey", "o_orderdate"), path, 1000, order=(F.desc("o_orderdate"), "o_orderkey"))
    back = _spark(orders).read.option("header", True).csv(path)
    return back.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.to_timestamp("o_orderdate").alias("o_orderdate"))


@query("""SELECT event, env, field, CAST(count(*) AS VARCHAR) AS total_issues, CAST(count(*) FILTER (status = 'diff') AS VARCHAR) AS diff, CAST(count(*) FILTER (status = 'missing_in_target') AS VARCHAR) AS missing_in_target
FROM (SELECT event, env, field, status FROM {changes} WHERE status IS DISTINCT FROM 'missing_in_target' UNION ALL SELECT event, env, '*', 'missing_in_target' FROM {missing}) GROUP BY 1, 2, 3""")
def quality_file(t):
    """The quality summary of both views as its CSV holds it."""
    changes = t("changes")
    path = scratch(_spark(changes), "quality")
    SI.write_quality_summary(R.quality_summary(changes, t("missing")), path)
    return _spark(changes).read.option("header", True).csv(path).select("event", "env", "field", "total_issues", "diff", "missing_in_target")


@query("""WITH last AS (SELECT * FROM (SELECT trim(pk) AS id, field, source_value AS new, target_value AS old, row_number() OVER (PARTITION BY trim(pk), field ORDER BY TRY_CAST(win AS BIGINT) DESC NULLS LAST,
    source_value DESC NULLS LAST, target_value DESC NULLS LAST) AS k FROM {changes} WHERE field = 'status' AND lower(trim(pk)) NOT IN ('', 'none', 'nan', '<na>', 'null')) WHERE k = 1)
SELECT 'r1' AS run_id, 'EV' AS event, 'update' AS op, id, old, new, '2024-01-02T00:00:00.000' AS stamp FROM last""")
def audit_of_updates(t):
    """Collapsed updates with their stamp, written as the audit's JSON lines and read back."""
    changes = t("changes")
    docs = A.collapse_updates(K.usable_diffs(changes).filter("field = 'status'"), "win")
    docs = A.stamp_update(docs, datetime(2024, 1, 2))
    path = scratch(_spark(changes), "audit")
    stamps = docs.select("id", F.col("updates")["updateDate"].alias("stamp"))
    SI.write_audit(A.audit_rows(docs, "r1", "EV", "prod", datetime(2024, 1, 2)).join(stamps, "id"), path)
    back = _spark(changes).read.schema("run_id string, event string, op string, id string, changes map<string, struct<old: string, new: string>>, stamp string").json(path)
    return back.select("run_id", "event", "op", "id", F.col("changes")["status"]["old"].alias("old"), F.col("changes")["status"]["new"].alias("new"), "stamp")


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, CAST(p_size AS VARCHAR) AS p_size, 'saved' AS outcome FROM {part}")
def backup_tables(t):
    part = t("part").select("p_partkey", "p_brand", "p_size")
    spark, root = _spark(part), scratch(_spark(part), "backup")
    part.createOrReplaceTempView("parityline_backup_part")
    out = SI.backup_tables(spark, ["parityline_backup_part", "parityline_no_such_table"], root)
    return spark.read.parquet(f"{root}/parityline_backup_part").withColumn("outcome", F.lit(out["parityline_backup_part"]))


# -- logs -------------------------------------------------------------------------------------------------------------


@query("""SELECT run_id, date_trunc('milliseconds', ts) AS ts, level, event, tbl AS target, batch AS batch_id, query_id, error AS message, CAST(event_id % 1000 AS INTEGER) AS pid, 't' || CAST(event_id % 5 AS VARCHAR) AS thread,
       '{"event_id":' || CAST(event_id AS VARCHAR) || '}' AS fields FROM {log_events}""")
def run_log_round_trip(t):
    """Text rows of the event log made typed, written as the shards of their runs and read back with the declared schema."""
    rows = t("log_events").withColumns({"ts": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), "_pid": F.col("event_id") % 1000, "thread": F.concat(F.lit("t"), (F.col("event_id") % 5).cast("string"))})
    typed, schema = G.normalise_event_log(rows), G.LOG_SCHEMAS["events"]
    root = scratch(_spark(typed), "run-logs")
    for part, keep in (("run_early", F.col("pid") < 500), ("run_late", F.col("pid") >= 500)):
        SI.write_run_log(typed.filter(keep), root, part, "events", schema)
    back = FI.read_run_logs(_spark(typed), root, "events", schema)
    return back.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


SECONDS = "TRY_CAST(seconds AS DOUBLE)"


@query(f"""SELECT CAST(query_id AS VARCHAR) AS query_id, run_id, CASE WHEN query_id % 3 = 0 THEN 'pg' ELSE 'wh' END AS system, tbl AS target, NULL AS operation, batch AS batch_id, sql_hash, sql_txt AS sql_text,
       NULL AS params, date_trunc('milliseconds', start_ts) AS started_at, CAST(round({SECONDS} * 1000) AS INTEGER) AS duration_ms, TRY_CAST(n_rows AS BIGINT) AS "rows", status, error, owner,
       coalesce(TRY_CAST(rows_per_sec AS DOUBLE), round(TRY_CAST(n_rows AS DOUBLE) / CASE WHEN {SECONDS} <> 0 THEN {SECONDS} END, 2)) AS rows_per_sec FROM {{log_queries}}""")
def normalise_query_log_full(t):
    q = t("log_queries").withColumn("start_ts", F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    return G.normalise_query_log(q).withColumn("started_at", F.col("started_at").cast("timestamp_ntz")).drop("ended_at", "thread", "pid")


LINE = "event_id long, run_id string, level string, ts timestamp"


def _lines(df: DataFrame) -> DataFrame:
    return df.select("event_id", "run_id", "level", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ts"))


@query("""SELECT run_id, level, count(*) AS n, true AS fits FROM (
    SELECT run_id, level FROM {log_events} UNION ALL SELECT run_id, level FROM {log_events} WHERE event_id % 7 = 0) GROUP BY 1, 2""")
def stream_run_logs(t):
    """The event log streamed into shards over three micro-batches: all rows; new ones among rows sent again; rows too late to count."""
    events = t("log_events")
    spark, root = _spark(events), scratch(_spark(events), "log-stream")
    first = events.agg(F.max("ts").alias("last")).select("last").scalar()
    newer = events.filter("event_id % 7 = 0").withColumns({"event_id": F.col("event_id") + (1 << 40), "ts": first + F.expr("INTERVAL '1' MINUTE")})
    late = events.filter("event_id % 3 = 0").withColumns({"event_id": F.col("event_id") + (1 << 41), "ts": first - F.expr("INTERVAL '2' DAY")})
    for name, part in (("1", events), ("2", newer.unionByName(events.filter("event_id % 5 = 0"))), ("3", late)):
        _lines(part).coalesce(1).write.mode("append").json(f"{root}/in/part={name}")
    done = ST.stream_run_logs(spark, f"{root}/in/part=*", T.StructType.fromDDL(LINE), f"{root}/out", f"{root}/checkpoint", keys=("event_id",), every=None, shard_rows=100, files=1, by=("run_id",), spread=8)
    done.awaitTermination()
    rows = spark.read.parquet(f"{root}/out").withColumn("file", F.col("_metadata.file_path"))
    # One scan of the shards serves both: the exchange of these counts is reused.
    counts = rows.groupBy("file", "run_id", "level").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("file").agg(F.sum("n").alias("n")).agg((F.max("n") <= 100).alias("fits"))
    return counts.groupBy("run_id", "level").agg(F.sum("n").alias("n")).join(F.broadcast(sizes))


@query("SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_from, level, count(*) AS n FROM {log_events} GROUP BY 1, 2")
def stream_log_counts(t):
    """Rows of the event log in five-minute windows; the second micro-batch closes all of them, the third is too late to count."""
    events = t("log_events")
    spark, root = _spark(events), scratch(_spark(events), "log-counts")
    last = events.agg(F.max("ts").alias("last")).select("last").scalar()
    late = events.filter(F.col("ts") < last - F.expr("INTERVAL '1' DAY"))
    closing = events.limit(1).withColumn("ts", last + F.expr("INTERVAL '1' DAY"))
    for name, part in (("1", events), ("2", closing), ("3", late)):
        _lines(part).coalesce(1).write.mode("append").json(f"{root}/in/part={name}")
    counts = ST.stream_log_counts(spark, f"{root}/in/part=*", T.StructType.fromDDL(LINE), files=1)
    write = ST.batch_writer(f"{root}/out", "counts")
    counts.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    back = spark.read.parquet(f"{root}/out")
    return back.select(F.to_timestamp_ntz(F.date_format("window_from", "yyyy-MM-dd HH:mm:ss")).alias("window_from"), "level", "n")


# -- schemas, payloads, hooks ------------------------------------------------------------------------------------------


@query("SELECT CAST(o_orderkey AS VARCHAR) AS \"key\", CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM {orders}")
def expand_payload(t):
    """Payloads as columns; a payload that is no JSON gives nulls, the key comes from its document's id."""
    orders = t("orders")
    good = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("key"), F.col("o_totalprice").alias("price")))
    docs = orders.select(F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderstatus") == "P", F.concat(good, F.lit("}"))).otherwise(good).alias("payload"))
    docs = docs.withColumn("payload", F.when(F.startswith("payload", F.lit("{")) & F.endswith("payload", F.lit("}}")), F.lit("{bad")).otherwise(F.col("payload")))
    return FI.expand_payload(docs, T.StructType.fromDDL("key string, price double"), "key")


def _documents(t) -> DataFrame:
    """Orders as JSON texts whose shape depends on the row: a price that may be a text, a list in the last order only, a field of some."""
    orders = t("orders")
    last = orders.agg(F.max("o_orderkey").alias("last"))
    price = F.when(F.col("o_orderkey") % 97 == 0, F.to_json(F.struct(F.lit("on demand").alias("price")))).otherwise(F.to_json(F.struct(F.col("o_totalprice").alias("price"))))
    rest = F.struct(
        F.col("o_orderkey").alias("key"),
        F.struct(F.col("o_custkey").alias("cust"), F.when(F.col("o_orderstatus") == "P", F.array(F.struct(F.col("o_orderpriority").alias("code")))).alias("marks")).alias("inner"),
        F.when(F.col("o_orderkey") == F.col("last"), F.array("o_orderstatus")).alias("lines"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(True)).alias("even"),
    )
    doc = F.concat(F.substring_index(price, "}", 1), F.lit(","), F.substring(F.to_json(rest), 2, 1 << 20))
    return orders.join(F.broadcast(last)).select(F.when(F.col("o_orderkey") % 89 == 0, "no JSON").otherwise(doc).alias("doc"))


@query("""WITH o AS (SELECT *, (SELECT max(o_orderkey) FROM {orders}) AS last FROM {orders}), d AS (SELECT * FROM o WHERE o_orderkey % 89 <> 0)
SELECT 'key' AS field, 'long' AS type, '' AS format, 'key' AS full_path, 'false' AS is_array FROM d HAVING count(*) > 0
UNION ALL SELECT 'price', string_agg(DISTINCT CASE WHEN o_orderkey % 97 = 0 THEN 'keyword' ELSE 'double' END, '|' ORDER BY CASE WHEN o_orderkey % 97 = 0 THEN 'keyword' ELSE 'double' END), '', 'price', 'false' FROM d HAVING count(*) > 0
UNION ALL SELECT 'inner', 'object', '', 'inner', 'false' FROM d HAVING count(*) > 0
UNION ALL SELECT 'cust', 'long', '', 'inner.cust', 'false' FROM d HAVING count(*) > 0
UNION ALL SELECT 'marks', 'object', '', 'inner.marks', 'true' FROM d WHERE o_orderstatus = 'P' HAVING count(*) > 0
UNION ALL SELECT 'code', 'keyword', '', 'inner.marks.code', 'false' FROM d WHERE o_orderstatus = 'P' HAVING count(*) > 0
UNION ALL SELECT 'lines', 'keyword', '', 'lines', 'true' FROM d WHERE o_orderkey = last HAVING count(*) > 0
UNION ALL SELECT 'even', 'boolean', '', 'even', 'false' FROM d WHERE o_orderkey % 2 = 0 HAVING count(*) > 0""")
def target_schema(t):
    """The schema of JSON documents, settled by all rows."""
    return VA.infer_document_schema(_documents(t))


@query("""WITH o AS (SELECT *, (SELECT max(o_orderkey) FROM {orders}) AS last FROM {orders})
SELECT DISTINCT 'lines' AS path FROM o WHERE o_orderkey = last AND o_orderkey % 89 <> 0 UNION ALL SELECT DISTINCT 'inner.marks' FROM o WHERE o_orderstatus = 'P' AND o_orderkey % 89 <> 0""")
def array_paths(t):
    """Paths that are a list in any document; one of them only in the very last."""
    docs = _documents(t)
    return VA.document_paths(docs).filter("is_array").select(F.col("full_path").alias("path")).distinct()


@query("""SELECT 'o_orderkey' AS field, 'long' AS type, 'o_orderkey' AS full_path, 'false' AS is_array, count(*) AS n FROM {orders}
UNION ALL SELECT 'tags', 'keyword', 'tags', 'true', count(*) FROM {orders} UNION ALL SELECT 'inner', 'object', 'inner', 'false', count(*) FROM {orders} UNION ALL SELECT 'o_custkey', 'long', 'inner.o_custkey', 'false', count(*) FROM {orders}""")
def typed_schema(t):
    """The flattened schema of a typed table, with its number of rows."""
    docs = t("orders").select("o_orderkey", F.array("o_orderpriority").alias("tags"), F.struct("o_custkey").alias("inner"))
    return docs.agg(F.count("*").alias("n")).join(F.broadcast(VA.infer_target_schema(docs))).select("field", "type", "full_path", "is_array", "n")


SCHEMA = {
    f.field: f
    for f in (
        VA.TargetField("custId", "long", "custId"), VA.TargetField("status", "keyword", "status"), VA.TargetField("totalPrice", "double", "totalPrice"),
        VA.TargetField("orderDate", "date", "orderDate"), VA.TargetField("tags", "long", "tags", True), VA.TargetField("mark", "object", "mark"),
    )
}


@query("""SELECT id, 'custId' AS field, 'wrong type' AS error FROM {tgt_orders} WHERE custId IS NOT NULL
UNION ALL SELECT id, 'flag', 'not in schema' FROM {tgt_orders} WHERE flag IS NOT NULL
UNION ALL SELECT id, 'tags', 'element ' || CASE WHEN status = 'X' THEN '1' ELSE '0' END || ': wrong type' FROM {tgt_orders}""")
def validate_rows(t):
    """Texts on a number field, a field that the schema lacks, and the first bad element of a list; any text is a date, any value an object."""
    rows = t("tgt_orders").withColumns({"tags": F.array(F.when(F.col("status") != "X", F.col("status")), F.lit("y"), F.lit("x")), "mark": F.lit("text")})
    return VA.validate(rows.withColumn("status", F.lit("ok")), SCHEMA)


@query("""SELECT id || '.' || field || ': ' || error AS error FROM (SELECT id, 'custId' AS field, 'wrong type' AS error FROM {tgt_orders} WHERE custId IS NOT NULL
UNION ALL SELECT id, 'flag', 'not in schema' FROM {tgt_orders} WHERE flag IS NOT NULL) ORDER BY id, field LIMIT 50""")
def validate_plan(t):
    """A plan that does not fit its schema is refused with its first errors."""
    target = t("tgt_orders")
    try:
        VA.validate_plan(target, SCHEMA)
    except VA.PlanRejected as e:
        return target.limit(1).select(F.explode(F.lit(e.errors)).alias("error"))
    raise AssertionError("a plan that does not fit was taken")


class OrderAdapter(Adapter):
    """An event whose price is a number, and whose documents carry the time of their update."""

    name = "orders"

    def field_kind_overrides(self):
        return {"totalPrice": "float"}

    def before_apply(self, updates: DataFrame) -> DataFrame:
        return A.stamp_update(updates, datetime(2024, 1, 2), "orderDate")


def _adapter_run(t) -> tuple[DataFrame, DataFrame]:
    """Changes of two fields for every order: a price that may be no number, and a status."""
    orders = t("orders")
    key = F.col("o_orderkey").cast("string").alias("pk")
    price = F.when(F.col("o_orderpriority") == "2-HIGH", "none at all").otherwise((F.col("o_orderkey") * 2).cast("string"))
    rows = [("totalPrice", price), ("status", F.lit("Z")), ("flag", F.when(F.col("o_orderstatus") == "F", "no number").otherwise("5"))]
    diffs = [orders.select(key, F.lit(f).alias("field"), v.alias("source_value"), F.lit(None).cast("string").alias("target_value"), F.lit("w1").alias("window")) for f, v in rows]
    return apply_event(OrderAdapter(), MAPPING, diffs[0].unionByName(diffs[1]).unionByName(diffs[2]), t("tgt_orders"), "id", strict=False)


@query("""SELECT t.id, t.custId, CASE WHEN o_orderkey IS NULL THEN t.status ELSE 'Z' END AS status,
       CASE WHEN o_orderkey IS NULL THEN t.totalPrice WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderkey * 2.0 END AS "totalPrice",
       CASE WHEN o_orderkey IS NULL THEN t.orderDate ELSE '2024-01-02T00:00:00.000' END AS "orderDate",
       CASE WHEN o_orderkey IS NULL OR o_orderstatus = 'F' THEN t.flag ELSE 5 END AS flag
FROM {tgt_orders} t LEFT JOIN {orders} ON t.id = CAST(o_orderkey AS VARCHAR)""")
def adapter_apply(t):
    """The target after an event's hooks: coerced, stamped; a value that does not fit leaves its field."""
    return _adapter_run(t)[0]


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, 'flag' AS field, 'no number' AS value, 'does not fit the type' AS error FROM {orders} WHERE o_orderstatus = 'F'")
def adapter_unfit(t):
    return _adapter_run(t)[1]


# -- keys, lookups, converters that other queries do not show ----------------------------------------------------------


@query("""SELECT coalesce(CAST(o_orderkey AS VARCHAR), id) AS pk, o_orderkey IS NOT NULL AS in_source, id IS NOT NULL AS in_target
FROM {src_orders} FULL JOIN {tgt_orders} ON CAST(o_orderkey AS VARCHAR) = id""")
def key_sets(t):
    """Keys of both sides: their intersection and both differences."""
    return K.key_sets(t("src_orders").withColumnRenamed("o_orderkey", "id"), t("tgt_orders"), "id")


@query("SELECT o_orderkey, (SELECT max(l_extendedprice) FROM {lineitem} WHERE l_orderkey = o_orderkey) AS largest FROM {orders}")
def correlated_scalar(t):
    """For every order the largest price of its lines, by a correlated scalar subquery."""
    return _spark(t("orders")).sql("SELECT o_orderkey, (SELECT max(l_extendedprice) FROM {lines} WHERE l_orderkey = o_orderkey) AS largest FROM {orders}", lines=t("lineitem"), orders=t("orders"))


@query("""SELECT event, env, to_json(list({'pk': pk, 'field': field} ORDER BY pk, field)) AS "rows" FROM (
    SELECT *, row_number() OVER (PARTITION BY event, env ORDER BY pk, field) AS k FROM {changes}) WHERE k <= 5 GROUP BY 1, 2""")
def source_samples(t):
    return R.source_samples(t("changes"), ["pk", "field"])


@query("""SELECT c_custkey, CAST(NULL AS VARCHAR) AS none, last AS newest FROM {customer}
LEFT JOIN (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS last FROM {orders} GROUP BY 1) ON c_custkey = o_custkey""")
def lookup_last_wins(t):
    """Of duplicate lookup keys the last by an order counts; a key column that is absent gives nulls."""
    table = L.load_lookup(t("orders"), "o_custkey", "o_orderpriority", order="o_orderkey")
    df = L.lookup_single(t("customer").select("c_custkey"), "no_such_column", table, "none")
    return L.lookup_single(df, "c_custkey", table, "newest").select("c_custkey", "none", "newest")


@query("""SELECT o_orderkey, o_orderkey % 2 <> 0 AS flagged, strftime(o_orderdate, '%Y-%m-%d') AS day_text, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS time_text,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '["' || o_orderstatus || '","' || o_orderpriority || '"]' END AS listed, 'EV/prod/x.csv' AS rel, o_orderdate AS parsed,
       CASE WHEN o_custkey % 4 <> 0 THEN round(o_orderkey / (o_custkey % 4), 2) END AS rate, 'EV' AS event, 'prod' AS env FROM {orders}""")
def small_functions(t):
    """Converters, coercions and path functions beside those of the other queries; a date has no time in its text."""
    c, path = F.col, F.lit("/data/out/EV/prod/x.csv")
    both = F.concat(F.lit('["'), c("o_orderstatus"), F.lit('","'), c("o_orderpriority"), F.lit('"]'))
    return t("orders").select(
        "o_orderkey", C.num_to_bool(c("o_orderkey") % 2).alias("flagged"), C.time_to_string(c("o_orderdate").cast("date")).alias("day_text"), C.time_to_string(c("o_orderdate")).alias("time_text"),
        F.to_json(V.coerce(F.when(c("o_orderkey") % 5 == 0, F.lit(" None ")).otherwise(both), "list")).alias("listed"), V.rel_path(path).alias("rel"),
        V.parse_iso_utc(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).cast("timestamp_ntz").alias("parsed"), V.rows_per_sec(c("o_orderkey"), c("o_custkey") % 4).alias("rate"),
        V.event_from_path(path).alias("event"), V.env_from_path(path).alias("env"),
    )
