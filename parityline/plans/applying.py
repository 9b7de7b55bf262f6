"""Queries over what an apply run writes: the bucketed target, the ledger's versions, streams that apply once, the audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.operators import apply as A
from parityline.operators import audit as AU
from parityline.operators import compare as K
from parityline.plans.registry import query
from parityline.sources import sinks as SI
from parityline.sources import versioned as VE
from parityline.sources.shared import scratch
from parityline.streaming import logs as ST

BUCKETS = 16
AT = datetime(2024, 1, 2, 3, 4, 5)
USABLE = "lower(trim(pk)) NOT IN ('', 'none', 'nan', '<na>', 'null') AND field IS NOT NULL AND field NOT IN ('', '*')"
LAST = f"""
usable AS (SELECT trim(pk) AS id, field, win, source_value AS new, target_value AS old FROM {{changes}} WHERE {USABLE}),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, field ORDER BY TRY_CAST(win AS BIGINT) DESC NULLS LAST, new DESC NULLS LAST, old DESC NULLS LAST) AS k FROM usable) WHERE k = 1),
u AS (SELECT id, max(new) AS new, max(old) AS old FROM last WHERE field = 'status' GROUP BY id)"""


def _status_updates(t) -> DataFrame:
    return A.collapse_updates(K.usable_diffs(t("changes")).filter("field = 'status'"), "win")


def _target(t) -> str:
    """The stand-in target, written by bucket."""
    target = t("tgt_orders")
    path = scratch(target.sparkSession, "target")
    VE.write_target(target, path, "id", BUCKETS)
    return path


# -- the bucketed target ------------------------------------------------------------------------------------------------


@query(f"""WITH {LAST} SELECT t.id, t.custId, CASE WHEN u.id IS NOT NULL THEN u.new ELSE t.status END AS status, t.totalPrice, t.orderDate, t.flag
FROM {{tgt_orders}} t LEFT JOIN u USING (id)""")
def update_target(t):
    """Updates written into the bucketed target, twice as after a lost attempt, and read back."""
    spark, path = t("changes").sparkSession, _target(t)
    for _ in range(2):
        VE.update_target(spark, path, _status_updates(t), "id", BUCKETS)
    return VE.read_target(spark, path).drop(VE.BUCKET)


@query("""SELECT id, custId, status FROM {tgt_orders}
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, min(o_orderstatus) FROM {orders} WHERE o_orderkey % 97 = 0 GROUP BY o_orderkey""")
def insert_into_target(t):
    """Absent documents added to the bucketed target; those that are there stay, and a second attempt adds nothing."""
    spark, path = t("orders").sparkSession, _target(t)
    rows = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"))
    for _ in range(2):
        VE.insert_into_target(spark, path, rows, "id", BUCKETS)
    return VE.read_target(spark, path).select("id", "custId", "status")


# -- the ledger ---------------------------------------------------------------------------------------------------------


@query("""SELECT version, event, env, mode, source_file, applied_ts, n_updated FROM (
    SELECT v AS version, *, row_number() OVER (PARTITION BY v, event, env, mode, source_file ORDER BY applied_ts DESC, n_updated DESC) AS k
    FROM {ledger} CROSS JOIN (VALUES (1), (2), (3)) AS versions(v)
    WHERE n_failures = 0 AND (mode = 'missing' OR v >= 2) AND (env = 'test' OR v >= 3)) WHERE k = 1""")
def ledger_versions(t):
    """Three commits, the second after a conflict with the first; all versions as they were committed."""
    rows = t("ledger")
    spark = rows.sparkSession
    ledger = VE.VersionedTable(spark, scratch(spark, "ledger"))
    first, second, third = rows.filter("mode = 'missing' AND env = 'test'"), rows.filter("mode = 'changes' AND env = 'test'"), rows.filter("env = 'prod'")
    base = ledger.latest()
    VE.commit_applied(ledger, first)
    try:  # a writer that began from the same version as the first
        ledger.commit(A.mark_applied(rows.limit(0), second), base)
        raise AssertionError("two writers committed one version")
    except VE.Conflict:
        VE.commit_applied(ledger, second)
    VE.commit_applied(ledger, third)
    names = ["event", "env", "mode", "source_file", "applied_ts", "n_updated"]
    one, two, three = (ledger.read(v).select(F.lit(v).alias("version"), *names) for v in ledger.versions())
    return one.unionByName(two).unionByName(three)


def _streamed(t) -> tuple[str, VE.VersionedTable]:
    """The diff files applied by a stream that fails once after its first write, goes on, and is then run anew from the start."""
    changes = t("changes").select("event", "env", "pk", "field", "source_value", "source_file")
    spark = changes.sparkSession
    root = scratch(spark, "pending-stream")
    changes.repartition(4, "source_file").write.parquet(f"{root}/in")
    ledger = VE.VersionedTable(spark, f"{root}/ledger")
    write, again = (ST.batch_writer(f"{root}/out", name) for name in ("a", "b"))
    failed: list[int] = []

    def fails_once(rows: DataFrame, batch_id: int) -> None:
        write(rows, batch_id)
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write, before the mark")

    for writer, checkpoint in ((fails_once, "a"), (write, "a"), (again, "b")):
        query = ST.stream_pending(spark, f"{root}/in", changes.schema, ST.exactly_once(ledger, writer, lambda: F.lit(AT)), f"{root}/checkpoint-{checkpoint}", files=2)
        try:
            query.awaitTermination()
        except Exception as e:
            if "lost after the write" not in str(e):
                raise
    return root, ledger


@query("SELECT pk, field, source_value, source_file FROM {changes}")
def stream_pending(t):
    """Rows of diff files applied once each, through a failed attempt and a repeated run."""
    root, ledger = _streamed(t)
    return ledger.spark.read.parquet(f"{root}/out").select("pk", "field", "source_value", "source_file")


@query("SELECT event, env, 'changes' AS mode, source_file, count(*) AS n_updated FROM {changes} GROUP BY 1, 2, 4")
def stream_pending_ledger(t):
    """The ledger after the same runs."""
    return _streamed(t)[1].read().select("event", "env", "mode", "source_file", "n_updated")


# -- the audit ----------------------------------------------------------------------------------------------------------

RUN = AU.Run("r1", "EV", "prod", "orders", AT)
AUDIT = """ts string, type string, run_id string, env string, event string, index string, id string, batch long, changes map<string, struct<old: string, new: string>>, ids_planned long,
updated long, conflicts long, failures long, status int, result string, error string, body string, created long, existing long, errors long"""


def _audit(t) -> DataFrame:
    target, updates = t("tgt_orders"), _status_updates(t)
    rows = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"))
    refused = F.when(F.col("status") == "P", "status P is not taken")
    inserts = AU.insert_results(target, rows, "id", refused)
    path = scratch(target.sparkSession, "audit")
    SI.write_audit(AU.audit_records(RUN, updates.select("id", "changes"), A.update_results(target, updates, "id"), inserts), path)
    return target.sparkSession.read.schema(AUDIT).json(path)


OUTCOME = "CASE WHEN o_orderstatus = 'P' THEN 'error' WHEN o_orderkey % 97 = 0 THEN 'created' ELSE 'exists' END"


@query(f"""WITH {LAST}, r AS (SELECT u.*, CASE WHEN t.id IS NULL THEN 'conflict' ELSE 'updated' END AS result FROM u LEFT JOIN {{tgt_orders}} t USING (id)), i AS (SELECT {OUTCOME} AS outcome FROM {{orders}})
SELECT 'run_start' AS type, 1 AS n, NULL AS planned, NULL AS updated, NULL AS conflicts, NULL AS created, NULL AS existing, NULL AS errors
UNION ALL SELECT 'update', count(*), NULL, NULL, NULL, NULL, NULL, NULL FROM r
UNION ALL SELECT 'update_batch_result', NULL, count(*), count(*) FILTER (result = 'updated'), count(*) FILTER (result = 'conflict'), NULL, NULL, NULL FROM r
UNION ALL SELECT 'insert', (SELECT count(*) FROM i), NULL, NULL, NULL, NULL, NULL, NULL
UNION ALL SELECT 'run_end', 1, NULL, count(*) FILTER (result = 'updated'), count(*) FILTER (result = 'conflict'),
    (SELECT count(*) FROM i WHERE outcome = 'created'), (SELECT count(*) FROM i WHERE outcome = 'exists'), (SELECT count(*) FROM i WHERE outcome = 'error') FROM r""")
def audit_types(t):
    """Counts of all record types as read back; batches have no number in SQL, so only their sums are compared."""
    n = F.when(F.col("type") != "update_batch_result", F.count("*")).alias("n")
    sums = {"ids_planned": "planned", "updated": "updated", "conflicts": "conflicts", "created": "created", "existing": "existing", "errors": "errors"}
    return _audit(t).groupBy("type").agg(n, *[F.sum(c).alias(v) for c, v in sums.items()])


@query(f"""WITH {LAST} SELECT '2024-01-02T03:04:05' AS ts, 'r1' AS run_id, 'prod' AS env, 'EV' AS event, 'orders' AS "index", id, old, new FROM u""")
def audit_update_records(t):
    x = F.col("changes")["status"]
    return _audit(t).filter("type = 'update'").select("ts", "run_id", "env", "event", "index", "id", x["old"].alias("old"), x["new"].alias("new"))


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, {OUTCOME} AS result, CASE {OUTCOME} WHEN 'created' THEN 201 WHEN 'exists' THEN 409 ELSE 400 END AS status,
       CASE WHEN o_orderstatus = 'P' THEN 'status P is not taken' END AS error,
       '{{"status":"' || o_orderstatus || '"' || CASE WHEN o_orderpriority <> '5-LOW' THEN ',"priority":"' || o_orderpriority || '"' ELSE '' END || '}}' AS body FROM {{orders}}""".replace("'{{", "'{").replace("}}'", "}'"))
def audit_insert_records(t):
    return _audit(t).filter("type = 'insert'").select("id", "result", "status", "error", "body")


@query("""SELECT CAST(o_orderkey AS VARCHAR) || '.' || CASE WHEN o_orderstatus = 'F' THEN 'nowhere: no such field' ELSE 'totalPrice: does not fit the type' END AS error, (SELECT count(*) FROM {tgt_orders}) AS n_target
FROM {orders} WHERE o_orderpriority = '1-URGENT' ORDER BY CAST(o_orderkey AS VARCHAR) LIMIT 50""")
def rejected_plan(t):
    """A plan with bad values is refused whole, with its first errors; the target keeps its rows and files."""
    orders, target = t("orders"), t("tgt_orders")
    urgent, key = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey").cast("string")
    bad = F.when(F.col("o_orderstatus") == "F", F.create_map(F.lit("nowhere"), F.lit("1"))).otherwise(F.create_map(F.lit("totalPrice"), F.lit("much")))
    updates = orders.select(key.alias("id"), F.when(urgent, bad).otherwise(F.create_map(F.lit("status"), F.lit("Z"))).alias("updates"))
    try:
        AU.check_plan(target, updates, "id")
    except AU.PlanRejected as e:
        errors = F.explode(F.lit(e.errors))
        return target.agg(F.count("*").alias("n_target")).select(errors.alias("error"), "n_target")
    raise AssertionError("a plan with bad values was taken")
