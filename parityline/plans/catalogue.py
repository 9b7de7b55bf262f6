"""All queries of the library by name, with their SQL."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.functions import converters as C
from parityline.functions import values as V
from parityline.operators import apply as A
from parityline.operators import compare as K
from parityline.operators import diffstore as D
from parityline.operators import lookup as L
from parityline.operators import logs as G
from parityline.operators import reports as R
from parityline.operators import shape as S
from parityline.operators import windows as W
from parityline.plans import modes as M
from parityline.plans import applying, connectors, stored  # noqa: F401  register their queries
from parityline.plans.registry import oracle_sql, queries, query  # noqa: F401
from parityline.sources import files as FI
from parityline.sources import scans as X

# -- comparison -------------------------------------------------------------------------------------------------------

MAPPING = (
    S.Field("o_orderkey", "id", "int_to_string"),
    S.Field("o_custkey", "custId"),
    S.Field("o_orderstatus", "status"),
    S.Field("o_totalprice", "totalPrice"),
    S.Field("o_orderdate", "orderDate", "time_to_string"),
    S.Field("o_flag", "flag"),
)
START, END = datetime(1996, 1, 1), datetime(1998, 7, 1)

#: Both sides hold some keys several times; the smallest row of each counts.
PAIRS = """
s AS (SELECT *, o_orderkey AS k FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey, o_orderstatus, o_totalprice) AS o FROM {src_twice}) WHERE o = 1),
t AS (SELECT * REPLACE (trim(id) AS id) FROM (SELECT *, row_number() OVER (PARTITION BY trim(id) ORDER BY custId, status, totalPrice NULLS FIRST, orderDate) AS o FROM {tgt_twice}) WHERE o = 1),
pairs AS (SELECT s.*, t.id, t.status, t.totalPrice FROM s JOIN t ON CAST(s.o_orderkey AS VARCHAR) = t.id), diffs AS (
    SELECT id AS pk, 'status' AS field, o_orderstatus AS source_value, status AS target_value, 'diff' AS status, o_orderdate, k
    FROM pairs WHERE o_orderstatus <> status
    UNION ALL
    SELECT id, 'totalPrice', CAST(o_totalprice AS VARCHAR), NULL, 'diff', o_orderdate, k FROM pairs
    WHERE totalPrice IS NULL AND o_totalprice <> 0
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), '*', '<row>', NULL, 'missing_in_target', o_orderdate, o_orderkey FROM s
    WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT id FROM t)
    UNION ALL
    SELECT id, '*', NULL, '<row>', 'missing_in_source', CAST(substr(orderDate, 1, 10) AS TIMESTAMP), NULL FROM t
    WHERE id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM s)
)"""
DIFF_COLS = "pk, field, source_value, target_value, status"


def _event(t, **more) -> M.EventSpec:
    return M.EventSpec([M.PartSpec(t("src_twice"), MAPPING)], t("tgt_twice"), "id", **more)


@query(f"WITH {PAIRS} SELECT {DIFF_COLS} FROM diffs")
def compare_orders(t):
    return K.compare_tables(S.shape(t("src_twice"), MAPPING), t("tgt_twice"), "id")


@query("""WITH s AS (SELECT * FROM (SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_quantity) AS k FROM {lineitem}) WHERE k = 1),
t AS (SELECT * FROM (SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_quantity) AS k FROM {lineitem} WHERE l_linenumber > 1) WHERE k = 1)
SELECT CAST(l_orderkey AS VARCHAR) AS pk, 'l_quantity' AS field, CAST(s.l_quantity AS VARCHAR) AS source_value, CAST(t.l_quantity AS VARCHAR) AS target_value, 'diff' AS status
FROM s JOIN t USING (l_orderkey) WHERE s.l_quantity <> t.l_quantity
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'l_partkey', CAST(s.l_partkey AS VARCHAR), CAST(t.l_partkey AS VARCHAR), 'diff' FROM s JOIN t USING (l_orderkey) WHERE s.l_partkey <> t.l_partkey
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), '*', '<row>', NULL, 'missing_in_target' FROM s ANTI JOIN t USING (l_orderkey)""")
def compare_repeated_keys(t):
    """Keys that come several times on both sides: the smallest row of each counts, in the order of its columns."""
    lines = t("lineitem").select(F.col("l_orderkey").alias("id"), "l_partkey", "l_quantity", "l_linenumber")
    return K.compare_tables(lines.drop("l_linenumber"), lines.filter("l_linenumber > 1").drop("l_linenumber"), "id")


@query(f"WITH {PAIRS} SELECT {DIFF_COLS} FROM diffs WHERE status IN ('diff', 'missing_in_target') AND field IN ('status', '*')")
def compare_allowed_fields(t):
    source = S.shape(t("src_twice"), S.prune_plan(MAPPING, ["status"], "id").mapping)
    return K.filter_diff_mode(K.compare_tables(source, S.keep_columns(t("tgt_twice"), ["status"], "id"), "id"), "both")


@query(f"WITH {PAIRS} SELECT {DIFF_COLS} FROM diffs WHERE status <> 'missing_in_source'")
def compare_restricted(t):
    return K.compare_tables(S.shape(t("src_twice"), MAPPING), t("tgt_twice"), "id", restrict_target_to_source=True)


@query(f"""WITH {PAIRS} SELECT {DIFF_COLS}, o_orderdate - ((date_diff('day', TIMESTAMP '1996-01-01', o_orderdate) % 30) * INTERVAL 1 DAY) AS window_from
FROM diffs WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'""")
def compare_time(t):
    event = _event(t, time_source="o_orderdate", time_target="at")
    target = event.target.withColumn("at", F.try_to_timestamp("orderDate"))
    event = M.EventSpec(event.parts, target, "id", "o_orderdate", "at")
    return M.compare_time(event, START, END, "30 DAYS")


@query(f"WITH {PAIRS} SELECT {DIFF_COLS}, k - k % 5000 AS id_from FROM diffs WHERE status <> 'missing_in_source'")
def compare_id_range(t):
    return M.compare_id_range(_event(t, id_source="o_orderkey"), 5000)


PART_A = (S.Field("id", "id", "int_to_string"), S.Field("name", "name"), S.Field("nation", "nation"), S.Field("balance", "balance"))
PART_B = (S.Field("id", "id", "int_to_string"), S.Field("name", "name"), S.Field("nation", "nation"))
UNION_TARGET = """
SELECT CAST(id AS STRING) AS id, CASE WHEN id % 13 = 0 THEN 'other' ELSE name END AS name, nation,
       CASE WHEN id % 17 = 0 THEN balance + 1 ELSE balance END AS balance
FROM (SELECT id, name, nation, balance FROM {parts_a} UNION ALL SELECT id, name, nation, CAST(NULL AS DOUBLE) FROM {parts_b})"""
UNION_SQL = f"""
WITH tgt AS ({UNION_TARGET}), src AS (
    SELECT CAST(id AS VARCHAR) AS id, id AS k, name, nation, balance FROM {{parts_a}}
    UNION ALL SELECT CAST(id AS VARCHAR), id, name, nation, NULL FROM {{parts_b}}
)
SELECT s.id AS pk, 'name' AS field, s.name AS source_value, t.name AS target_value, 'diff' AS status EXTRA
FROM src s JOIN tgt t USING (id) WHERE s.name <> t.name
UNION ALL
SELECT s.id, 'balance', CAST(s.balance AS VARCHAR), CAST(t.balance AS VARCHAR), 'diff' EXTRA
FROM src s JOIN tgt t USING (id) WHERE s.balance <> t.balance"""


def _union_event(t, **more) -> M.EventSpec:
    a, b = t("parts_a"), t("parts_b")
    rows = a.unionByName(b, allowMissingColumns=True)
    target = rows.select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 13 == 0, "other").otherwise(F.col("name")).alias("name"),
        "nation",
        F.when(F.col("id") % 17 == 0, F.col("balance") + 1).otherwise(F.col("balance")).alias("balance"),
    )
    stamp = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.pmod(F.col("id").cast("bigint"), F.lit(28)).cast("int") + 1, F.lit(0), F.lit(0), F.lit(0))
    return M.EventSpec(
        [M.PartSpec(a.withColumn("at", stamp), PART_A), M.PartSpec(b.withColumn("at", stamp), PART_B)], target.withColumn("at", stamp), "id", **more
    )


@query(UNION_SQL.replace("EXTRA", ", CAST(TIMESTAMP '2024-01-01' + (k % 28 - (k % 28) % 7) * INTERVAL 1 DAY AS TIMESTAMP) AS window_from", 1).replace("EXTRA", ", TIMESTAMP '2024-01-01' + (k % 28 - (k % 28) % 7) * INTERVAL 1 DAY"))
def compare_time_union(t):
    return M.compare_time(_union_event(t, time_source="at", time_target="at"), datetime(2024, 1, 1), datetime(2024, 1, 29), "7")


#: The windows of all parts count from the smallest id of any.
LOWEST = "least((SELECT min(id) FROM {parts_a}), (SELECT min(id) FROM {parts_b}))"


@query(UNION_SQL.replace("EXTRA", f", k - (k - {LOWEST}) % 1000 AS id_from", 1).replace("EXTRA", f", k - (k - {LOWEST}) % 1000"))
def compare_id_range_union(t):
    return M.compare_id_range(_union_event(t, id_source="id"), 1000)


@query("""SELECT id AS pk, o_orderstatus AS source_value, status AS target_value
FROM {src_orders} s JOIN {tgt_orders} t ON CAST(s.o_orderkey AS VARCHAR) = t.id WHERE o_orderstatus <> status""")
def compare_field(t):
    return K.compare_field(S.shape(t("src_orders"), MAPPING), t("tgt_orders"), "id", "status")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS BIGINT) AS custId, o_orderstatus AS status, o_totalprice AS totalPrice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS orderDate, o_flag AS flag, 'missing_in_target' AS error
FROM {src_twice} WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT id FROM {tgt_twice})""")
def missing_rows(t):
    shaped = S.shape(t("src_twice"), MAPPING)
    return K.absent_rows(shaped, t("tgt_twice"), "id")


@query("SELECT t.* FROM {tgt_orders} t WHERE id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM {src_orders} WHERE o_orderstatus = 'F')")
def semi_keys(t):
    return K.semi_keys(t("tgt_orders"), t("src_orders").filter("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "id"), "id")


@query("""SELECT CASE WHEN CASE WHEN o_orderkey % 53 = 0 THEN 'X' ELSE o_orderstatus END = o_orderstatus THEN 'matched' ELSE 'mismatched' END AS outcome,
       count(*) AS n FROM {orders} WHERE o_orderkey % 97 <> 0 GROUP BY 1""")
def rule_check(t):
    return K.rule_check(t("src_orders").withColumnRenamed("o_orderkey", "id"), t("tgt_orders"), "id", F.col("o_orderstatus"), "status")


@query("""SELECT o_orderstatus AS grp, count(*) AS n, count(*) FILTER (totalPrice IS NULL AND o_totalprice <> 0) AS differing,
       coalesce(array_to_string(list_sort((list(id ORDER BY id) FILTER (totalPrice IS NULL AND o_totalprice <> 0))[1:3]), ','), '') AS sample
FROM {src_orders} s JOIN {tgt_orders} t ON CAST(s.o_orderkey AS VARCHAR) = t.id GROUP BY 1""")
def diff_rate_by_group(t):
    source = t("src_orders").withColumnsRenamed({"o_orderkey": "id", "o_totalprice": "totalPrice"})
    return K.diff_rate_by_group(source, t("tgt_orders"), "id", "totalPrice", "o_orderstatus")


@query("SELECT code AS grp, count(*) AS n, count(*) FILTER (txt IS NULL OR trim(txt) = '') AS blank FROM {codes} GROUP BY 1")
def null_rate_by_group(t):
    return K.null_rate_by_group(t("codes"), "code", "txt")


@query("SELECT flag AS value, count(*) AS n FROM {tgt_orders} GROUP BY 1")
def distribution(t):
    return K.distribution(t("tgt_orders"), "flag")


@query("SELECT count(*) AS n, count(totalPrice) AS non_null, count(*) FILTER (coalesce(totalPrice, 0) <> 0) AS non_zero FROM {tgt_orders} WHERE status = 'F'")
def non_null_count(t):
    return K.non_null_count(t("tgt_orders"), F.col("status") == "F", "totalPrice")


@query("""SELECT l_orderkey, l_partkey, l_quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_quantity) AS k FROM {lineitem}) WHERE k = 1""")
def first_row_per_key(t):
    return K.first_per_key(t("lineitem").select("l_orderkey", "l_partkey", "l_quantity"), ["l_orderkey"], ["l_partkey"])


@query("""SELECT l_orderkey, o_orderstatus, c_name, p_brand FROM (
    SELECT l_orderkey, o_orderstatus, c_name, p_brand, row_number() OVER (PARTITION BY l_orderkey ORDER BY o_orderstatus NULLS FIRST, c_name NULLS FIRST, p_brand NULLS FIRST) AS k
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
    LEFT JOIN {part} ON l_partkey = p_partkey AND p_size > 25) WHERE k = 1""")
def star_join(t):
    joined = (
        t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("part").filter("p_size > 25"), F.col("l_partkey") == F.col("p_partkey"), "left")
    )
    return K.first_per_key(joined.select("l_orderkey", "o_orderstatus", "c_name", "p_brand"), ["l_orderkey"])


@query("""SELECT o_orderkey, c_name, n_name, r_name FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey AND c_acctbal > 0
LEFT JOIN {nation} ON c_nationkey = n_nationkey LEFT JOIN {region} ON n_regionkey = r_regionkey""")
def left_join_chain(t):
    return (
        t("orders").join(t("customer").filter("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


# -- scans and windows ------------------------------------------------------------------------------------------------


@query("SELECT * FROM {orders} WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'")
def scan_time_window(t):
    return X.scan_time_window(t("orders"), "o_orderdate", START, END)


@query("""SELECT * FROM {orders} WHERE o_orderkey >= (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 4 FROM {orders})
AND o_orderkey < (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 4 * 3 FROM {orders})""")
def scan_id_window(t):
    quarter = F.floor((F.col("max_id") - F.col("min_id")) / 4)
    ids = W.id_range(t("orders"), "o_orderkey").select((F.col("min_id") + quarter).alias("lo"), (F.col("min_id") + 3 * quarter).alias("hi"))
    return X.scan_id_window(t("orders"), "o_orderkey", ids.select("lo").scalar(), ids.select("hi").scalar())


@query("SELECT * FROM {orders} WHERE o_orderkey >= (SELECT min(o_orderkey) FROM {orders}) AND o_orderkey < (SELECT max(o_orderkey) + 1 FROM {orders})")
def scan_id_window_all(t):
    ids = W.id_range(t("orders"), "o_orderkey")
    return X.scan_id_window(t("orders"), "o_orderkey", ids.select("min_id").scalar(), ids.select(F.col("max_id") + 1).scalar())


@query("SELECT o_orderkey, 1 AS shards_of_key, true AS in_range, true AS same_again FROM {orders}")
def scan_hash_shards(t):
    """Each row in one shard of the range, and in the same one when its key comes in other rows (lineitem) and other types."""
    shards = X.scan_hash_shards(t("orders").select("o_orderkey"), "o_orderkey", 8)
    again = X.scan_hash_shards(t("lineitem").select(F.col("l_orderkey").cast(t("orders").schema["o_orderkey"].dataType).alias("o_orderkey")), "o_orderkey", 8).distinct().withColumnRenamed("shard", "other")
    per = shards.join(again, "o_orderkey", "left").groupBy("o_orderkey").agg(
        F.count_distinct("shard").cast("int").alias("shards_of_key"), F.bool_and(F.col("shard").between(0, 7)).alias("in_range"),
        F.bool_and(F.coalesce(F.col("shard") == F.col("other"), F.lit(True))).alias("same_again"),
    )
    return per


@query("SELECT * FROM {tgt_orders} WHERE CAST(replace(orderDate, 'T', ' ') AS TIMESTAMP) >= TIMESTAMP '1996-01-01' AND CAST(replace(orderDate, 'T', ' ') AS TIMESTAMP) < TIMESTAMP '1998-07-01'")
def scan_docs_range(t):
    return X.scan_docs_range(t("tgt_orders"), "orderDate", START, END)


@query("SELECT * FROM {tgt_orders} WHERE id IN (SELECT CAST(l_orderkey AS VARCHAR) FROM {lineitem} WHERE l_quantity > 45)")
def scan_docs_by_keys(t):
    return X.scan_docs_by_keys(t("tgt_orders"), "id", t("lineitem").filter("l_quantity > 45"), "l_orderkey")


@query("SELECT * FROM {tgt_orders} WHERE status = 'F' ORDER BY id LIMIT 100")
def scan_docs_all(t):
    return X.scan_docs_all(t("tgt_orders"), F.col("status") == "F", 100, "id")


@query("SELECT 'orders' AS _index, id AS _id, custId, status FROM {tgt_orders}")
def flatten_docs(t):
    hits = t("tgt_orders").select(F.lit("orders").alias("_index"), F.col("id").alias("_id"), F.struct("custId", "status").alias("_source"))
    return X.flatten_docs(hits)


@query("SELECT * FROM {events} WHERE ts >= TIMESTAMP '2024-01-20'")
def filter_recent(t):
    return X.filter_recent(t("events"), "ts", 10, datetime(2024, 1, 30, 12))


@query("SELECT * FROM {codes} WHERE txt IS NOT NULL AND ymd IS NOT NULL AND code IN (1, 3)")
def filter_pair_and_list(t):
    return X.filter_in_list(X.filter_not_null_pair(t("codes"), "txt", "ymd"), "code", [1, 3])


@query("SELECT p_partkey, trim(txt) AS txt FROM {codes} WHERE lower(trim(txt)) NOT IN ('', 'none', 'nan', '<na>', 'null') AND txt IS NOT NULL")
def filter_bad_keys(t):
    from parityline.functions.keys import filter_bad_keys as run

    return run(t("codes").select("p_partkey", "txt"), "txt")


@query("""SELECT event_id, TIMESTAMP '2024-01-03' + (date_diff('minute', TIMESTAMP '2024-01-03', date_trunc('minute', ts)) // 420) * INTERVAL 420 MINUTE AS window_from,
       least(TIMESTAMP '2024-01-03' + (date_diff('minute', TIMESTAMP '2024-01-03', date_trunc('minute', ts)) // 420 + 1) * INTERVAL 420 MINUTE, TIMESTAMP '2024-01-09 12:00:00') AS window_to
FROM {events} WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-09 12:00:00'""")
def assign_time_window(t):
    return W.assign_time_window(t("events"), "ts", datetime(2024, 1, 3), datetime(2024, 1, 9, 12), "7h").select("event_id", "window_from", "window_to")


@query("""SELECT g AS window_from, least(g + INTERVAL 1 DAY, hi) AS window_to
FROM (SELECT unnest(range(lo, hi, INTERVAL 1 DAY)) AS g, hi FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) + INTERVAL 1 SECOND AS hi FROM {orders} HAVING count(o_orderdate) > 0))""")
def window_grid(t):
    return _grid_of(t("orders"), "o_orderdate", "1 DAY")


def _grid_of(df: DataFrame, ts: str, step: str) -> DataFrame:
    """All windows between a table's first and last time."""
    at = F.col(ts).cast("timestamp_ntz")
    lo, hi = df.agg(F.min(at), F.max(at)).first()
    if lo is None:  # no rows, no windows
        return W.window_grid(df.sparkSession, START, START, step)
    return W.window_grid(df.sparkSession, lo, hi + timedelta(seconds=1), step)


@query("""SELECT g AS window_from, least(g + INTERVAL 7 HOUR, hi) AS window_to
FROM (SELECT unnest(range(lo, hi, INTERVAL 7 HOUR)) AS g, hi FROM (SELECT min(ts) AS lo, max(ts) + INTERVAL 1 SECOND AS hi FROM {events} HAVING count(ts) > 0))""")
def window_grid_all(t):
    return _grid_of(t("events"), "ts", "7h")


@query("""SELECT o_orderkey, 5 + (o_orderkey - 5) // 700 * 700 AS id_from, 5 + (o_orderkey - 5) // 700 * 700 + 700 AS id_to
FROM {orders} WHERE o_orderkey >= 5""")
def assign_id_window(t):
    return W.assign_id_window(t("orders"), "o_orderkey", 700, first=5).select("o_orderkey", "id_from", "id_to")


@query("""SELECT o_orderkey, lo + (o_orderkey - lo) // 700 * 700 AS id_from, lo + (o_orderkey - lo) // 700 * 700 + 700 AS id_to
FROM {orders} CROSS JOIN (SELECT min(o_orderkey) AS lo FROM {orders}) AS ids WHERE o_orderkey IS NOT NULL""")
def assign_id_window_all(t):
    return W.assign_id_window(t("orders"), "o_orderkey", 700).select("o_orderkey", "id_from", "id_to")


@query("""WITH g AS (SELECT unnest(range(TIMESTAMP '1996-01-01', TIMESTAMP '1998-07-01', INTERVAL 30 DAY)) AS window_from),
s AS (SELECT TIMESTAMP '1996-01-01' + (date_diff('day', TIMESTAMP '1996-01-01', o_orderdate) // 30 * 30) * INTERVAL 1 DAY AS window_from, o_orderkey AS k FROM {orders}
      WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-07-01')
SELECT window_from, least(window_from + INTERVAL 30 DAY, TIMESTAMP '1998-07-01') AS window_to, count(k) AS rows_source, count(k) FILTER (k % 97 <> 0) AS rows_target,
       count(k) FILTER (k % 97 <> 0 AND k % 53 = 0) AS rows_changed, count(k) FILTER (k % 97 = 0) AS rows_missing
FROM g LEFT JOIN s USING (window_from) GROUP BY 1""")
def rows_per_window(t):
    grid = W.window_grid(t("orders").sparkSession, START, END, "30 DAYS")
    source = W.assign_time_window(t("orders"), "o_orderdate", START, END, "30 DAYS").select("window_from", F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    target = source.filter("id % 97 <> 0").withColumn("status", F.when(F.col("id") % 53 == 0, "X").otherwise(F.col("status")))
    return W.rows_per_window(grid, K.compare_counts(source, target, "id", ["window_from"]), ["window_from"])


@query("SELECT min(o_orderkey) AS min_id, max(o_orderkey) AS max_id FROM {orders}")
def id_range(t):
    return W.id_range(t("orders"), "o_orderkey")


@query("SELECT min(id) AS min_id, max(id) AS max_id FROM (SELECT id FROM {parts_a} UNION ALL SELECT id FROM {parts_b})")
def id_envelope(t):
    return W.id_envelope([t("parts_a"), t("parts_b"), t("parts_a").limit(0)], "id")


# -- shaping, lookups, converters ---------------------------------------------------------------------------------------


@query("SELECT id, name, nation, balance FROM {parts_a} UNION ALL SELECT id, name, nation, NULL FROM {parts_b}")
def union_parts(t):
    return S.union_parts([t("parts_a"), t("parts_b")])


@query("""SELECT CAST(p_partkey AS VARCHAR) || '_1' AS suffixed, CAST(p_partkey AS VARCHAR) || CASE WHEN code = 4 THEN '_4' ELSE '_1' END AS typed,
       CAST(NULL AS VARCHAR) AS absent, 0 AS zero, CAST(NULL AS VARCHAR) AS nothing, txt AS passed, CAST(NULL AS VARCHAR) AS unresolved FROM {codes}""")
def shape_composites(t):
    fields = [
        S.Field("p_partkey", "suffixed", "suffixed_1"), S.Field("p_partkey+code", "typed", "typed_id"), S.Field("no_such", "absent", "last_4"),
        S.Field("", "zero", "zero"), S.Field("", "nothing"), S.Field("txt", "passed", "no_such_converter"), S.Field("p_partkey+code", "unresolved", "no_such_converter"),
    ]
    return S.shape(t("codes"), fields)


@query("SELECT c_custkey, v AS nation_name FROM {customer} LEFT JOIN {lookup_names} ON c_nationkey + 2 = k")
def lookup_single(t):
    table = L.load_lookup(t("lookup_names"), "k", "v")
    df = t("customer").select("c_custkey", (F.col("c_nationkey") + 2).cast("double").alias("nk"))
    return L.lookup_single(df, "nk", table, "nation_name").select("c_custkey", "nation_name")


@query("""WITH rows AS (SELECT *, row_number() OVER () AS r FROM {tag_rows}),
ids AS (SELECT r, unnest(string_split(tags, ',')) AS x, unnest(range(len(string_split(tags, ',')))) AS i FROM rows),
found AS (SELECT r, array_to_string(list(v ORDER BY i), ', ') AS names FROM ids JOIN {lookup_names} ON CAST(k AS VARCHAR) = trim(x) WHERE regexp_full_match(trim(x), '[0-9]+') GROUP BY 1)
SELECT p_brand, tags, CASE WHEN tags IS NULL OR trim(tags) = '' THEN NULL WHEN trim(tags) = ',-1,' THEN 'All' ELSE coalesce(names, '') END AS tag_names
FROM rows LEFT JOIN found USING (r)""")
def lookup_csv(t):
    """Rows without any id of their own; lists repeat."""
    table = L.load_lookup(t("lookup_names"), "k", "v")
    return L.lookup_csv(t("tag_rows"), "tags", table, "tag_names").select("p_brand", "tags", "tag_names")


TXT_NUM = "CASE WHEN regexp_full_match(trim(txt), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(trim(txt) AS DOUBLE) END"


@query(f"""SELECT p_partkey, CAST(trunc({TXT_NUM}) AS BIGINT) AS as_int, coalesce(CAST(trunc({TXT_NUM}) AS BIGINT), 0) AS or_zero,
       coalesce(CAST(trunc({TXT_NUM}) AS BIGINT), -1) AS or_neg, coalesce(CAST(CAST(trunc({TXT_NUM}) AS BIGINT) AS VARCHAR), txt) AS as_text,
       coalesce(lower(trim(flag_txt)) IN ('1', 'true', 'y', 'yes', 't') OR (trim(flag_txt) IN ('0', '2') AND trim(flag_txt) <> '0'), false) AS truthy,
       CASE code WHEN 0 THEN 'none' WHEN 1 THEN 'gold' WHEN 2 THEN 'silver' ELSE 'other' END AS label,
       'P' || CAST(p_partkey AS VARCHAR) AS prefixed, CASE WHEN code <> 4 THEN p_partkey END AS unless_4, CASE WHEN code = 4 THEN p_partkey ELSE 0 END AS if_4,
       CASE WHEN code = 4 THEN 'yes' ELSE 'no' END AS label_4, tri = -1 AS minus_one, tri NOT IN (0, -1) AS is_set,
       CASE WHEN trim(txt) <> '' THEN right(trim(txt), 4) END AS last4, CASE WHEN trim(txt) <> '' THEN substr(trim(txt), 1, 6) END AS first6,
       coalesce(txt, '-') AS nvl, CAST(mm AS VARCHAR) || '-' || CAST(yy AS VARCHAR) AS range_text,
       code = 4 AND CASE WHEN mm = 1 THEN p_size ELSE tri END > 0 AS positive, round(p_retailprice * 2.0 * trunc(p_retailprice) * p_size, 2) AS product
FROM {{codes}}""")
def convert_codes(t):
    c = F.col
    labels = {0: "none", 1: "gold", 2: "silver"}
    return t("codes").select(
        "p_partkey", C.to_int_strict(c("txt")).alias("as_int"), C.int_or_zero(c("txt")).alias("or_zero"), C.int_or_neg_one(c("txt")).alias("or_neg"),
        C.int_to_string(c("txt")).alias("as_text"), C.truthy_bool(c("flag_txt")).alias("truthy"), C.code_to_label(labels, "other")(c("code")).alias("label"),
        C.prefixed_id("P")(c("p_partkey")).alias("prefixed"), C.value_unless(4)(c("p_partkey"), c("code")).alias("unless_4"), C.value_if(4)(c("p_partkey"), c("code")).alias("if_4"),
        C.label_if(4, "yes", "no")(c("code")).alias("label_4"), C.is_minus_one(c("tri")).alias("minus_one"), C.is_set(c("tri")).alias("is_set"),
        C.last_n(4)(c("txt")).alias("last4"), C.first_n(6)(c("txt")).alias("first6"), C.coalesce_default("-")(c("txt")).alias("nvl"),
        C.range_label(c("mm"), c("yy")).alias("range_text"), C.conditional_positive(c("code"), c("mm"), c("p_size"), c("tri")).alias("positive"),
        F.round(C.product(c("p_retailprice"), F.lit(2.0), c("p_retailprice"), c("p_size")), 2).alias("product"),
    )


@query("""SELECT p_partkey, CASE ymd WHEN '700101' THEN '1970-01-01' WHEN '691231' THEN '2069-12-31' WHEN '240229' THEN '2024-02-29' END AS iso,
       CASE WHEN mm BETWEEN 0 AND 12 THEN strftime(last_day(make_date(CAST(CASE WHEN yy < 70 THEN yy + 2000 ELSE yy + 1900 END AS BIGINT), CAST(greatest(mm, 1) AS BIGINT), 1)), '%Y-%m-%d') END AS month_end,
       CASE WHEN tri >= 0 THEN strftime(TIMESTAMP '2024-02-28 01:02:03' + tri * INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S.%g') END AS plus_days,
       CAST(CAST(TIMESTAMP '2024-02-28' + mm * INTERVAL 1 DAY AS DATE) AS VARCHAR) AS plus_number
FROM {codes}""")
def convert_dates(t):
    c = F.col
    ts = F.lit(datetime(2024, 2, 28, 1, 2, 3)).cast("timestamp_ntz")
    return t("codes").select(
        "p_partkey", C.yymmdd_to_iso(c("ymd")).alias("iso"), C.month_end(c("yy"), c("mm")).alias("month_end"), C.add_days(ts, c("tri")).alias("plus_days"),
        C.add_day_number(ts, c("mm")).cast("string").alias("plus_number"),
    )


@query("""SELECT p_partkey, CASE WHEN tags IS NULL THEN NULL ELSE array_to_string(list_filter(list_transform(string_split(tags, ','), lambda x: trim(x)), lambda x: regexp_full_match(x, '[0-9]+')), '|') END AS digits,
       CASE WHEN tags = '' THEN 0 ELSE len(string_split(tags, ',')) END AS n_parts, CASE WHEN trim(tags) <> '' THEN trim(tags) END AS single
FROM {tag_lists}""")
def convert_lists(t):
    c = F.col("tags")
    return t("tag_lists").select(
        "p_partkey", F.array_join(C.digits_list(c), "|").alias("digits"), F.when(c.isNotNull(), F.size(C.str_to_list(c))).alias("n_parts"), F.array_join(C.single_list(c), "|").alias("single")
    )


NULLED = "lower(trim(txt)) IN ('', 'none', 'nan', '<na>', 'null')"


@query(f"""SELECT p_partkey, CAST(trunc({TXT_NUM}) AS BIGINT) AS c_int, CAST(CAST(trunc({TXT_NUM}) AS BIGINT) AS VARCHAR) AS c_int_str, {TXT_NUM} AS c_float,
       CASE WHEN lower(trim(flag_txt)) IN ('', 'none', 'nan', '<na>', 'null') THEN NULL ELSE lower(trim(flag_txt)) IN ('1', 'true', 'yes', 't', 'y') END AS c_bool,
       CASE WHEN txt IS NULL OR {NULLED} THEN NULL ELSE trim(txt) END AS c_str, txt IS NULL OR lower(trim(txt)) IN ('', 'nan', 'none', '<na>') AS blank
FROM {{codes}}""")
def coerce_values(t):
    from parityline.functions.keys import is_blank

    x = F.col("txt")
    return t("codes").select(
        "p_partkey", V.coerce(x, "int").alias("c_int"), V.coerce(x, "int_str").alias("c_int_str"), V.coerce(x, "float").alias("c_float"),
        V.coerce("flag_txt", "bool").alias("c_bool"), V.coerce(x, "str").alias("c_str"), is_blank("txt").alias("blank"),
    )


@query("""SELECT event_id, substr(sha1(upper(trim(regexp_replace('  select  *' || chr(10) || ' from ' || event_type, '\\s+', ' ', 'g')))), 1, 12) AS fingerprint,
       replace(replace(replace(event_type || chr(9) || 'x' || chr(13) || 'y' || chr(10), chr(9), ' '), chr(13), ' '), chr(10), ' ') AS scrubbed,
       hour(ts) AS at_hour, minute(ts) AS at_minute, isodow(ts) - 1 AS at_weekday, dayname(ts) AS at_day_name, week(ts) AS at_iso_week, month(ts) AS at_month, year(ts) AS at_year,
       strftime(ts, '%Y-%m-%d') AS at_date FROM {events}""")
def log_functions(t):
    from pyspark.sql.types import StringType

    e = t("events")
    sql = F.concat(F.lit("  select  *\n from "), F.col("event_type"))
    dirty = F.concat(F.col("event_type"), F.lit("\tx\ry\n"))
    return e.select("event_id", V.sql_fingerprint(sql).alias("fingerprint"), V.scrub(dirty, StringType()).alias("scrubbed"), *V.time_breakdown("ts", "at")).drop("at_utc", "at_local")


# -- diff store ---------------------------------------------------------------------------------------------------------

USABLE = "(pk IS NOT NULL AND lower(trim(pk)) NOT IN ('', 'none', 'nan', '<na>', 'null') AND field NOT IN ('', '*'))"


@query(f"""SELECT c.event, c.env, trim(pk) AS pk, field, source_value, target_value, status, source_file FROM {{changes}} c
WHERE {USABLE} AND NOT EXISTS (SELECT 1 FROM {{ledger}} l WHERE l.mode = 'changes' AND l.event = c.event AND l.env = c.env AND l.source_file = c.source_file) AND c.env = 'prod'""")
def pending_changes(t):
    return D.pending_changes(t("changes"), t("ledger"), env="prod").drop("win", "applied_ts")


@query("""SELECT event, env, source_file, coalesce(orderId, id) AS id, orderId, CASE WHEN status <> 'nan' THEN status END AS status, priority FROM {missing} c
WHERE NOT EXISTS (SELECT 1 FROM {ledger} l WHERE l.mode = 'missing' AND l.event = c.event AND l.env = c.env AND l.source_file = c.source_file)""")
def pending_missing(t):
    return D.pending_missing(t("missing"), t("ledger"), "orderId")


@query("SELECT event, env, pk, field FROM {changes} WHERE applied_ts IS NULL AND coalesce(status, '') <> 'applied' AND event = 'ev_1'")
def pending_from_status(t):
    return D.pending_from_status(t("changes"), event="ev_1").select("event", "env", "pk", "field")


@query("SELECT DISTINCT event, env, replace(source_file, '.parquet', '.csv') AS source_file FROM {changes}")
def source_files(t):
    return D.source_files(t("changes"))


@query("SELECT DISTINCT event FROM (SELECT event FROM {changes} WHERE env = 'test' UNION ALL SELECT event FROM {missing} WHERE env = 'test')")
def events_with_pending(t):
    return D.events_with_pending(t("changes"), t("missing"), "test")


@query("SELECT event, count(*) FILTER (k = 'c') AS changes, count(*) FILTER (k = 'm') AS missing FROM (SELECT event, 'c' AS k FROM {changes} UNION ALL SELECT event, 'm' FROM {missing}) GROUP BY 1")
def pending_counts(t):
    return D.pending_counts(t("changes"), t("missing"))


@query("SELECT event, env, count(*) FILTER (k = 'c') AS changes, count(*) FILTER (k = 'm') AS missing FROM (SELECT event, env, 'c' AS k FROM {changes} UNION ALL SELECT event, env, 'm' FROM {missing}) GROUP BY 1, 2")
def pending_inventory(t):
    return D.pending_inventory(t("changes"), t("missing"))


@query("SELECT source_file, count(*) AS n_rows, count(DISTINCT pk) AS n_docs FROM {changes} GROUP BY 1")
def rows_per_file(t):
    return D.rows_per_file(t("changes"))


@query("SELECT event, env, source_file, count(*) AS n FROM {changes} c WHERE EXISTS (SELECT 1 FROM {ledger} l WHERE l.mode = 'changes' AND l.event = c.event AND l.env = c.env AND l.source_file = c.source_file) GROUP BY ALL")
def skipped_files(t):
    return D.exclude_applied(t("changes"), t("ledger"), "changes")[1].groupBy("event", "env", "source_file").agg(F.count("*").alias("n"))


@query("""SELECT event, env, field, count(*) AS total_issues, count(*) FILTER (status = 'diff') AS diff, count(*) FILTER (status = 'missing_in_target') AS missing_in_target,
       count(*) FILTER (status = 'missing_in_source') AS missing_in_source, count(*) FILTER (status = 'diff' AND trim(coalesce(target_value, '')) = '') AS target_blank,
       count(*) FILTER (status = 'diff' AND trim(coalesce(source_value, '')) = '') AS source_blank
FROM (SELECT event, env, field, status, source_value, target_value FROM {changes} UNION ALL SELECT event, env, '*', 'missing_in_target', NULL, NULL FROM {missing}) GROUP BY 1, 2, 3""")
def quality_summary(t):
    return R.quality_summary(t("changes"), t("missing"))


SUMS = ", ".join(f"CAST(sum(TRY_CAST({c} AS BIGINT)) AS BIGINT) AS {c}" for c in R.COUNTS)


@query(f"SELECT event, env, field, {SUMS} FROM {{summary_files}} GROUP BY 1, 2, 3 ORDER BY total_issues DESC NULLS LAST, 1, 2, 3 LIMIT 200")
def data_quality(t):
    return R.data_quality(t("summary_files"))


@query(f"SELECT {SUMS}, count(field) AS n_fields, count(DISTINCT event) AS n_events FROM {{summary_files}}")
def quality_totals(t):
    return R.quality_totals(t("summary_files"))


@query("SELECT event, env, pk, field FROM {changes} WHERE event = 'ev_2' AND env = 'prod' ORDER BY event, env, pk, field LIMIT 1000")
def changes_browse(t):
    return R.changes_browse(t("changes"), event="ev_2", env="prod").select("event", "env", "pk", "field")


@query("SELECT event, env, id, priority FROM {missing} WHERE event = 'ev_3' ORDER BY event, env, id LIMIT 500")
def missing_browse(t):
    return R.missing_browse(t("missing"), "id", event="ev_3").select("event", "env", "id", "priority")


# -- applying -----------------------------------------------------------------------------------------------------------

LAST = f"""
usable AS (SELECT trim(pk) AS id, field, win, source_value AS new, target_value AS old FROM {{changes}} WHERE {USABLE}),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, field ORDER BY TRY_CAST(win AS BIGINT) DESC NULLS LAST, new DESC NULLS LAST, old DESC NULLS LAST) AS k FROM usable) WHERE k = 1)"""


@query(f"WITH {LAST} SELECT id, array_to_string(list(field || '=' || coalesce(new, '-') || '<' || coalesce(old, '-') ORDER BY field), ';') AS changed FROM last GROUP BY id")
def collapse_updates(t):
    docs = A.collapse_updates(K.usable_diffs(t("changes")), "win")
    text = F.transform(F.array_sort(F.map_entries("changes")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"]["new"], F.lit("-")), F.lit("<"), F.coalesce(e["value"]["old"], F.lit("-"))))
    return docs.select("id", F.array_join(text, ";").alias("changed"))


@query(f"""WITH {LAST}, u AS (SELECT id, max(new) AS new FROM last WHERE field = 'status' GROUP BY id)
SELECT t.id, t.custId, CASE WHEN u.id IS NOT NULL THEN u.new ELSE t.status END AS status, t.totalPrice, t.orderDate, t.flag AS flag
FROM {{tgt_orders}} t LEFT JOIN u USING (id)""")
def apply_updates(t):
    updates = A.collapse_updates(K.usable_diffs(t("changes")).filter("field = 'status'"), "win")
    return A.apply_updates(t("tgt_orders"), updates, "id")


@query(f"WITH {LAST} SELECT CASE WHEN id IN (SELECT id FROM {{tgt_orders}}) THEN 'updated' ELSE 'conflict' END AS result, count(*) AS n FROM (SELECT DISTINCT id FROM last) GROUP BY 1")
def apply_result_counts(t):
    updates = A.collapse_updates(K.usable_diffs(t("changes")), "win")
    return A.apply_result_counts(A.update_results(t("tgt_orders"), updates, "id"))


@query("SELECT id, min(o_orderstatus) AS status FROM (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus FROM {orders} WHERE o_orderkey % 97 = 0) GROUP BY id")
def apply_inserts(t):
    rows = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"))
    return A.apply_inserts(t("tgt_orders"), rows, "id")[0]


@query("""SELECT event, env, mode, source_file, applied_ts, n_updated FROM (
    SELECT *, row_number() OVER (PARTITION BY event, env, mode, source_file ORDER BY applied_ts DESC, n_updated DESC) AS k FROM {ledger} WHERE n_failures = 0) WHERE k = 1""")
def mark_applied(t):
    ledger = t("ledger")
    return A.mark_applied(ledger.limit(0), ledger).select("event", "env", "mode", "source_file", "applied_ts", "n_updated")


@query("""SELECT event, pk, field, CASE WHEN f THEN 'applied' ELSE status END AS status, CASE WHEN f THEN source_value ELSE target_value END AS target_value FROM (
    SELECT *, source_file IN ('f3.parquet', 'f12.parquet') AS f FROM {changes})""")
def mark_rows_applied(t):
    changes = t("changes")
    files = changes.filter(F.col("source_file").isin("f3.parquet", "f12.parquet")).select("source_file")
    return A.mark_rows_applied(changes, files, datetime(2024, 1, 1)).select("event", "pk", "field", "status", "target_value")


@query("""SELECT env, target_name, 'r1' AS run_id, 'compare' AS operation, CAST(sum(rows_count) AS BIGINT) AS rows_count, min(started_at) AS started_at, max(ended_at) AS ended_at,
       CASE WHEN count(error) > 0 THEN 'failed' ELSE 'ok' END AS status, substr(min(error), 1, 4000) AS error FROM {run_summary} GROUP BY 1, 2""")
def record_run_summary(t):
    return A.record_run_summary(t("run_summary"), "r1", "compare")


@query("""SELECT id, '{' || concat_ws(',', '"orderId":"' || orderId || '"', '"status":"' || status || '"', '"priority":"' || priority || '"') || '}' AS doc FROM {missing}""", name="drop_empty_fields")
def _drop_empty_fields(t):
    return A.drop_empty_fields(t("missing").select("id", "orderId", "status", "priority", F.lit(None).cast("string").alias("gone")))


# -- logs and reports ---------------------------------------------------------------------------------------------------

SRC = "CASE WHEN event_id % 3 = 0 THEN 'pg' ELSE 'wh' END"
FAILED = "(event LIKE '%connect_failed%' OR (level = 'ERROR' AND event LIKE 'pg_%'))"
CONN = f"""
conn AS (SELECT CASE WHEN conn_id % 4 = 0 THEN 'pg' ELSE 'wh' END AS source, 'success' AS status, start_ts AS started, CAST(NULL AS VARCHAR) AS error, run_id, hostname, country, city FROM {{log_connections}}
    UNION ALL SELECT {SRC}, 'failed', ts, error, run_id, NULL, NULL, NULL FROM {{log_events}} WHERE {FAILED})"""
SECONDS = "TRY_CAST(seconds AS DOUBLE)"


@query(f"WITH {CONN} SELECT source, count(*) FILTER (status = 'success') AS successes, count(*) FILTER (status <> 'success') AS failures, count(*) AS total FROM conn GROUP BY 1")
def connection_overview(t):
    return R.connection_overview(t("log_connections"), t("log_events"))


@query(f"WITH {CONN} SELECT * FROM conn WHERE source = 'pg' ORDER BY started DESC NULLS LAST, source, run_id NULLS LAST, status, error NULLS LAST, hostname NULLS LAST, country NULLS LAST, city NULLS LAST LIMIT 200")
def connections_recent(t):
    return R.connections_recent(t("log_connections"), t("log_events"), source="pg")


QUERY_ROWS = f"""
q AS (SELECT query_id, CASE WHEN query_id % 3 = 0 THEN 'pg' ELSE 'wh' END AS source, run_id, tbl AS target, owner, batch, start_ts, {SECONDS} AS seconds,
    TRY_CAST(n_rows AS BIGINT) AS "rows", TRY_CAST(rows_per_sec AS DOUBLE) AS rate, status, sql_hash, error, sql_txt FROM {{log_queries}})"""


@query(f"WITH {QUERY_ROWS} SELECT * EXCLUDE (sql_txt), row_number() OVER (ORDER BY seconds DESC, query_id) AS id FROM q WHERE seconds IS NOT NULL ORDER BY id LIMIT 50")
def query_slowest(t):
    return R.query_slowest(t("log_queries"))


@query(f"""WITH {QUERY_ROWS} SELECT sql_hash, min(source) AS source, max(target) AS target, count(*) AS runs, CAST(round(CAST(avg(seconds) AS DECIMAL(28,8)), 3) AS DOUBLE) AS avg_seconds, round(max(seconds), 3) AS max_seconds,
       CAST(sum("rows") AS BIGINT) AS total_rows, min(start_ts) AS first_seen, max(start_ts) AS last_seen, left(max(sql_txt), 120) AS preview
FROM q WHERE sql_hash <> '' AND seconds IS NOT NULL GROUP BY 1 ORDER BY runs DESC, avg_seconds DESC, sql_hash LIMIT 200""")
def query_hashes(t):
    return R.query_hashes(t("log_queries"))


@query(f"""WITH {QUERY_ROWS} SELECT hour(start_ts) AS hour, count(*) AS runs, CAST(round(CAST(avg(seconds) AS DECIMAL(28,8)), 3) AS DOUBLE) AS avg_seconds, round(min(seconds), 3) AS min_seconds, round(max(seconds), 3) AS max_seconds,
       CAST(sum("rows") AS BIGINT) AS total_rows, CAST(round(CAST(avg(rate) AS DECIMAL(28,8)), 1) AS DOUBLE) AS avg_rate FROM q WHERE sql_hash = 'h3' AND seconds IS NOT NULL GROUP BY 1 ORDER BY 1""")
def query_by_hour(t):
    return R.query_by_hour(t("log_queries"), "h3")


@query(f"""WITH {QUERY_ROWS} SELECT * EXCLUDE (sql_txt, owner, error), seconds > 5 AS slow, row_number() OVER (ORDER BY start_ts DESC NULLS LAST, query_id) AS id
FROM q WHERE seconds > 5 AND source = 'pg' ORDER BY id LIMIT 500""")
def query_perf(t):
    return R.query_perf(t("log_queries"), only_slow=True, source="pg")


@query(f"""WITH {QUERY_ROWS} SELECT * EXCLUDE (sql_txt, owner, error), seconds > 5 AS slow, row_number() OVER (ORDER BY start_ts DESC NULLS LAST, query_id) AS id FROM q ORDER BY id LIMIT 500""")
def query_perf_all(t):
    return R.query_perf(t("log_queries"))


@query(f'SELECT {SRC} AS source, run_id, ts, event, tbl AS "table", error FROM {{log_events}} WHERE level = \'ERROR\' ORDER BY ts DESC, source, run_id, event, error LIMIT 50')
def recent_errors(t):
    return R.recent_errors(t("log_events"))


@query(f"""WITH {QUERY_ROWS}, s AS (SELECT run_id, min(start_ts) AS started FROM {{log_connections}} GROUP BY 1), e AS (SELECT run_id, max(ts) AS ended FROM {{log_events}} WHERE event = 'run_end' GROUP BY 1),
p AS (SELECT run_id, min(source) AS source, count(*) AS queries, CAST(round(CAST(sum(seconds) AS DECIMAL(28,8)), 3) AS DOUBLE) AS query_seconds, round(max(seconds), 3) AS slowest_seconds, CAST(sum("rows") AS BIGINT) AS "rows" FROM q GROUP BY 1),
r AS (SELECT run_id, count(*) AS errors FROM {{log_events}} WHERE level = 'ERROR' GROUP BY 1)
SELECT run_id, source, started, ended, queries, query_seconds, slowest_seconds, "rows", coalesce(errors, 0) AS errors, CASE WHEN errors > 0 THEN 'failed' ELSE 'ok' END AS status
FROM s LEFT JOIN e USING (run_id) LEFT JOIN p USING (run_id) LEFT JOIN r USING (run_id) ORDER BY started DESC, run_id LIMIT 100""")
def run_metrics(t):
    return R.run_metrics(t("log_connections"), t("log_events"), t("log_queries"))


@query("SELECT id, run_id, started_at FROM {run_summary} ORDER BY started_at DESC NULLS LAST, id LIMIT 100")
def recent_log(t):
    return R.recent_log(t("run_summary").select("id", "run_id", "started_at"), "started_at", "id")


@query("""SELECT count(*) AS batches, count(*) FILTER (n_failures = 0) AS success, count(*) FILTER (n_failures > 0) AS failed, min(applied_ts) AS first_ts, max(applied_ts) AS last_ts,
       date_sub('microsecond', min(applied_ts), max(applied_ts)) / 1e6 AS elapsed_s, round(date_sub('microsecond', min(applied_ts), max(applied_ts)) / 1e6 / count(*), 2) AS mean_interval_s,
       CAST(sum(n_updated + n_created) AS BIGINT) AS "rows" FROM {ledger}""")
def ledger_totals(t):
    return R.ledger_totals(t("ledger"))


@query("""SELECT event, env, mode, count(*) AS batches, CAST(sum(n_updated) AS BIGINT) AS updated, CAST(sum(n_created) AS BIGINT) AS created, CAST(sum(n_conflicts) AS BIGINT) AS conflicts,
       CAST(sum(n_failures) AS BIGINT) AS failures, min(applied_ts) AS first_ts, max(applied_ts) AS last_ts FROM {ledger} GROUP BY 1, 2, 3""")
def ledger_breakdown(t):
    return R.ledger_breakdown(t("ledger"))


TOOK = "date_sub('microsecond', started_at, ended_at) / 1e6"


@query(f"""SELECT count(*) AS runs, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (coalesce(status, '') NOT IN ('ok', 'failed')) AS other,
       min(started_at) AS first_ts, max(ended_at) AS last_ts, date_sub('microsecond', min(started_at), max(ended_at)) / 1e6 AS elapsed_s, round(avg({TOOK}), 2) AS mean_duration_s,
       CAST(sum(rows_count) AS BIGINT) AS "rows" FROM {{run_summary}}""")
def run_summary_totals(t):
    return R.run_summary_totals(t("run_summary"))


@query(f"""SELECT target_name, operation, env, count(*) AS runs, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'failed') AS failed, CAST(sum(rows_count) AS BIGINT) AS "rows",
       round(avg({TOOK}), 2) AS avg_s, round(max({TOOK}), 2) AS max_s FROM {{run_summary}} GROUP BY 1, 2, 3""")
def run_summary_breakdown(t):
    return R.run_summary_breakdown(t("run_summary"))


@query("SELECT coalesce(status, '(null)') AS status, count(*) AS n FROM {run_summary} GROUP BY 1")
def status_histogram(t):
    return R.status_histogram(t("run_summary"))


@query(f"SELECT id, run_id, target_name, {TOOK} AS seconds FROM {{run_summary}} WHERE {TOOK} >= 0 ORDER BY seconds, id LIMIT 1")
def fastest_run(t):
    return R.extreme_run(t("run_summary"), slowest=False)


@query(f"SELECT id, run_id, target_name, {TOOK} AS seconds FROM {{run_summary}} WHERE {TOOK} >= 0 ORDER BY seconds DESC, id LIMIT 1")
def slowest_run(t):
    return R.extreme_run(t("run_summary"), slowest=True)


@query("""SELECT event, CAST(sum(rows_source) AS BIGINT) AS rows_source, CAST(sum(rows_target) AS BIGINT) AS rows_target, CAST(sum(coalesce(rows_changed, 0)) AS BIGINT) AS rows_changed,
       CAST(sum(rows_missing) AS BIGINT) AS rows_missing FROM {batches} GROUP BY 1""")
def event_totals(t):
    return R.event_totals(t("batches"))


@query("""SELECT run_id, count(*) AS targets, CAST(sum(inserted + updated + deleted) AS BIGINT) AS rows_changed,
       CASE WHEN count(*) FILTER (status = 'failed') = count(*) THEN 'failed' WHEN count(*) FILTER (status = 'failed') > 0 THEN 'partial' ELSE 'ok' END AS status FROM {batches} GROUP BY 1""")
def run_rollup(t):
    return R.run_rollup(t("batches"))


@query("""SELECT o_custkey, min(o_orderdate) AS first_date, array_to_string(list_transform(list_sort(list(o_orderkey)), lambda x: CAST(x AS VARCHAR)), ',') AS o_orderkey_list,
       array_to_string(list_sort(list(o_orderstatus)), ',') AS o_orderstatus_list FROM {orders} GROUP BY 1""")
def group_listagg(t):
    return R.group_listagg(t("orders"), "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")


@query("SELECT id, date_sub('millisecond', started_at, ended_at) AS duration_ms FROM {run_summary} ORDER BY duration_ms DESC NULLS LAST, id LIMIT 25")
def slowest_phases(t):
    return R.top_by_duration(t("run_summary"), "started_at", "ended_at", "id", 25).select("id", "duration_ms")


@query("""WITH a AS (SELECT run_id, CAST(sum(rows_count) AS BIGINT) AS rows_reported, count(*) AS targets FROM {run_summary} GROUP BY 1),
b AS (SELECT run_id, count(*) AS queries, count(*) FILTER (status = 'error') AS failed_queries FROM {log_queries} GROUP BY 1)
SELECT run_id, rows_reported, targets, coalesce(queries, 0) AS queries, coalesce(failed_queries, 0) AS failed_queries FROM a LEFT JOIN b USING (run_id)""")
def summary_with_logs(t):
    return R.summary_with_logs(t("run_summary"), t("log_queries"))


@query(f"""SELECT CAST(query_id AS VARCHAR) AS query_id, run_id, CASE WHEN query_id % 3 = 0 THEN 'pg' ELSE 'wh' END AS system, tbl AS target, sql_hash, CAST(round({SECONDS} * 1000) AS INTEGER) AS duration_ms,
       TRY_CAST(n_rows AS BIGINT) AS "rows", status FROM {{log_queries}}""")
def normalise_query_log(t):
    q = t("log_queries").withColumn("start_ts", F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    return G.normalise_query_log(q).select("query_id", "run_id", "system", "target", "sql_hash", "duration_ms", "rows", "status")


@query("SELECT run_id, level, event, tbl AS target, error AS message FROM {log_events}")
def normalise_event_log(t):
    e = t("log_events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    return G.normalise_event_log(e).select("run_id", "level", "event", "target", "message")


@query("""SELECT run_id, 'query.' || CASE WHEN query_id % 3 = 0 THEN 'pg' ELSE 'wh' END AS "where", tbl AS target, batch AS batch_id, CAST(query_id AS VARCHAR) AS query_id, 'ValueError' AS error_type,
       'bad row ' || CAST(query_id AS VARCHAR) AS error_msg FROM {log_queries} WHERE status = 'error'""")
def errors_from_queries(t):
    q = t("log_queries").withColumn("start_ts", F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    return G.errors_from_queries(G.normalise_query_log(q)).drop("ts")


@query("SELECT 'changes' AS view, count(*) AS n FROM {changes} UNION ALL SELECT 'missing', count(*) FROM {missing}")
def table_counts(t):
    return FI.table_counts({"changes": t("changes"), "missing": t("missing")})


@query("""SELECT 'changes' AS view, event, env, count(*) AS n FROM {changes} GROUP BY event, env
UNION ALL SELECT 'missing', event, env, count(*) FROM {missing} GROUP BY event, env""")
def source_diagnostics(t):
    return R.source_diagnostics(t("changes"), t("missing"))


@query("""SELECT event, env, count(DISTINCT c) AS changes_files, count(DISTINCT m) AS missing_files FROM (
    SELECT event, env, source_file AS c, NULL AS m FROM {changes} UNION ALL SELECT event, env, NULL, source_file FROM {missing}) GROUP BY event, env""")
def count_windows_with_changes(t):
    return R.count_windows_with_changes(t("changes"), t("missing"))
