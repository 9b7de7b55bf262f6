"""Chat formatting by tool-call linking, with DataFrame functions only.

Calls are joined to their results by identifier (hash join), ordered topologically by what they depend on, checked against
the schemas of their tools, and serialised as canonical JSON: keys in order, no spaces, numbers in shortest form.

A call's level is the length of the longest chain of calls behind it. Dependencies that a chain of two others implies are left
out first; levels stay as they are, and most calls then have one dependency or none. Such calls form trees, in which each
doubling round lets every call point twice as far back, so a chain of n calls takes log2(n) rounds. The dependencies of the other
calls are then moved to the ends of their trees; those that now meet count once, by their longest way, and so on until no
call has several. Every round is staged in the shared folder and reads one table of its predecessor, so plans stay small however
deep the calls are. Calls on or behind a cycle have no level.

`position` orders a conversation: the number of its rows before this one by level (none last), then length and text of the
call_id. It comes from running sums over ranges of the sorted rows, so one huge conversation is spread over many tasks.

Edge cases: a dependency on a call that does not exist is listed as unresolved and does not hold the call back; several
results for one call count (n_results) and the smallest text is used; a call without result has none; repeated calls give
repeated rows with the same level and position; arguments that are null or no JSON object, that repeat a key, or that hold
a number beyond the range of doubles, are the error "json"; whole numbers are integers however they are written; a tool without schema (or an empty table of schemas) is the error "tool"; null identifiers link to nothing and depend on
nothing; texts of any length are taken whole; empty tables give empty results; other columns are ignored.
`link_calls` gives rows for calls only; results that name no call are the rows of `lost_results`, with the error "orphan" and
no position.

Of plain conversations, a user turn with null text is a call with an empty query, and system turns are neither calls nor
results, so they give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parityline.llm.common import scratch, staged

#: Most dependencies of a call that may stand in the middle of a way that makes another edge needless.
SHORTCUT_DEPS = 64

#: JSON kinds as Spark names the types of parsed values (fixed values of the schema language).
KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "object": "OBJECT", "array": "ARRAY", "number": "DECIMAL"}


def quoted(text: Column) -> Column:
    """A string as JSON, null for null."""
    return F.coalesce(F.to_json(text.cast("variant")), F.lit("null"))


def _before(a: Column, b: Column) -> Column:
    """One fixed order of call ids: by length, then text, which puts numbered ids in the order of their numbers."""
    return (F.length(a) < F.length(b)) | ((F.length(a) == F.length(b)) & (a < b))


def without_shortcuts(edges: DataFrame) -> DataFrame:
    """edges (call_id, dep) less those u, w for which u, v and v, w exist with u after v after w in the order of ids.

    The way over v is longer, so no level changes; the strict order keeps one way for each edge that goes, so cycles stay too.
    Calls v with more than SHORTCUT_DEPS dependencies are not tried as the middle, which only leaves more to the rounds.
    """
    sizes = edges.groupBy("call_id").agg(F.count("*").alias("n"))
    first = edges.join(sizes.filter("n > 1").select("call_id"), "call_id", "left_semi").filter(_before(F.col("dep"), F.col("call_id")))
    second = edges.join(sizes.filter(F.col("n") <= SHORTCUT_DEPS).select("call_id"), "call_id", "left_semi").filter(_before(F.col("dep"), F.col("call_id")))
    second = second.select(F.col("call_id").alias("middle"), F.col("dep").alias("far_dep"))
    over = first.join(second, first["dep"] == second["middle"]).select("call_id", F.col("far_dep").alias("dep"))
    return edges.join(over, ["call_id", "dep"], "left_anti")


def ends(steps: DataFrame) -> DataFrame:
    """steps (call_id, dep, far; one row for each call) with every dep moved to the end of its chain and far to its length.

    A null dep is the end of a chain, as is one that is no call of steps. Rows that lead into a cycle are left out.
    """
    rounds = int(steps.count()).bit_length() + 1
    steps = staged(steps.select("call_id", "dep", "far", F.col("dep").isNotNull().alias("moved")), "call-steps")
    for _ in range(rounds):
        if steps.filter("moved").isEmpty():
            break
        there = steps.select(F.col("call_id").alias("dep"), F.col("dep").alias("next"), F.col("far").alias("more"), F.lit(True).alias("hit"))
        moved = F.coalesce("hit", F.lit(False))
        going = steps.filter("moved").join(there, "dep", "left")
        going = going.select("call_id", F.when(moved, F.col("next")).otherwise(F.col("dep")).alias("dep"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"), moved.alias("moved"))
        steps = staged(steps.filter("NOT moved").unionByName(going.select("call_id", "dep", "far", (F.col("moved") & F.col("dep").isNotNull()).alias("moved"))), "call-steps")
    return steps.filter("NOT moved").drop("moved")


def levels(calls: DataFrame) -> DataFrame:
    """call_id, level of all calls that no cycle holds back; calls: call_id, depends_on."""
    named = calls.filter(F.col("call_id").isNotNull())
    ids = named.select("call_id").distinct()
    every = named.select("call_id", F.explode("depends_on").alias("dep")).distinct()
    live = staged(every.join(ids.withColumnRenamed("call_id", "dep"), "dep", "left_semi").select("call_id", "dep"), "call-edges")
    edges = without_shortcuts(live).withColumn("far", F.lit(1).cast("long"))
    # A call that depends on nothing ends at null, at distance 0.
    roots = ids.join(live, "call_id", "left_anti").select("call_id", F.lit(None).cast("string").alias("dep"), F.lit(0).cast("long").alias("far"))
    edges = staged(edges.unionByName(roots), "call-edges")
    folder, rounds = scratch(calls.sparkSession, "call-ends"), 0
    while True:
        sizes = edges.groupBy("call_id").agg(F.count("*").alias("n"), F.min(F.struct("dep", "far")).alias("one"))
        sizes = staged(sizes, "call-sizes")
        single = sizes.filter("n = 1").select("call_id", "one.dep", "one.far")
        if single.isEmpty():
            break
        found = staged(ends(single), "call-found")
        found.write.mode("append").parquet(folder)
        rounds += 1
        left = edges.join(sizes.filter("n > 1").select("call_id"), "call_id", "left_semi")
        there = found.select(F.col("call_id").alias("dep"), F.col("dep").alias("next"), F.col("far").alias("more"), F.lit(True).alias("hit"))
        fixed = left.filter(F.col("dep").isNull())
        moved = left.filter(F.col("dep").isNotNull()).join(there, "dep", "left")
        moved = moved.select("call_id", F.when(F.col("hit"), F.col("next")).otherwise(F.col("dep")).alias("dep"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"))
        edges = staged(fixed.unionByName(moved).groupBy("call_id", "dep").agg(F.max("far").alias("far")), "call-edges")
    if not rounds:
        return ids.limit(0).withColumn("level", F.lit(0))
    found = calls.sparkSession.read.schema("call_id string, dep string, far long").parquet(folder)
    if rounds > 1:  # ends of one round are calls of a later one
        found = ends(found)
    return found.filter("dep IS NULL").select("call_id", F.col("far").cast("int").alias("level"))


def positions(calls: DataFrame, levels: DataFrame) -> DataFrame:
    """conv_id, call_id, level, position: the number of rows of the conversation that stand before the call."""
    keys = calls.groupBy("conv_id", "call_id").agg(F.count("*").alias("n")).join(levels, "call_id", "left")
    order = [F.col("level").isNull(), F.col("level"), F.length("call_id").asc_nulls_last(), F.col("call_id").asc_nulls_last()]
    dealt = keys.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    dealt = staged(dealt.withColumn("part", F.spark_partition_id()), "call-order")  # from here on the ranges are fixed
    before = Window.partitionBy("part", "conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("here", F.coalesce(F.sum("n").over(before), F.lit(0)))
    parts = dealt.groupBy("conv_id", "part").agg(F.sum("n").alias("rows"))
    ranges = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.coalesce(F.sum("rows").over(ranges), F.lit(0)).alias("start"))
    same = (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    return inside.join(starts, same).select("conv_id", "call_id", "level", (F.col("start") + F.col("here")).alias("position"))


def out_of_range(arguments: Column) -> Column:
    """Whether a JSON text holds a number beyond the range of doubles, which no parser would give back as it stands."""
    bare = F.regexp_replace(arguments, r'"(?:[^"\\]++|\\.)*+"', '""')
    numbers = F.regexp_extract_all(bare, F.lit(r"-?[0-9][0-9.]*(?:[eE][+-]?[0-9]+)?"), F.lit(0))
    return F.when(arguments.rlike("[0-9]{300}|[eE][+-]?[0-9]{3}"), F.exists(numbers, lambda x: F.abs(x.try_cast("double")) == float("inf"))).otherwise(False)


def schema_errors(arguments: Column, params: Column) -> Column:
    """Sorted errors of a JSON object against array<struct<param, kind, required>>; null params: an unknown tool."""
    parsed = F.from_json(arguments, "map<string,variant>")

    def has(p: Column) -> Column:
        return F.map_contains_key(parsed, p["param"])

    def fits(p: Column) -> Column:
        value = F.element_at(parsed, p["param"])
        kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
        number = F.try_variant_get(value, "$", "double")
        # A whole number is an integer however it is written: 1.0, 1e3, and more digits than a long holds.
        whole = ((kind == "DECIMAL") & F.try_variant_get(value, "$", "string").rlike(r"^-?[0-9]+(\.0*)?$")) | ((kind == "DOUBLE") & (number == F.rint(number)))
        return (kind == p["kind"]) | ((p["kind"] == "DECIMAL") & kind.isin("BIGINT", "DOUBLE")) | ((p["kind"] == "BIGINT") & whole)

    missing = F.transform(F.filter(params, lambda p: p["required"] & ~has(p)), lambda p: F.concat(F.lit("missing:"), p["param"]))
    wrong = F.transform(F.filter(params, lambda p: has(p) & ~fits(p)), lambda p: F.concat(F.lit("type:"), p["param"]))
    known = F.transform(params, lambda p: p["param"])
    extra = F.transform(F.array_except(F.map_keys(parsed), known), lambda k: F.concat(F.lit("unknown:"), k))
    return (
        F.when(parsed.isNull() | F.try_parse_json(arguments).isNull() | out_of_range(arguments), F.array(F.lit("json")))
        .when(params.isNull(), F.array(F.lit("tool")))
        .otherwise(F.array_sort(F.concat(missing, wrong, extra)))
    )


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call; (conv_id, position) is the order of a conversation.

    calls: conv_id, call_id, name, arguments (JSON), depends_on (array of call ids); results: call_id, content;
    schemas: name, param, kind (a key of KINDS), required.
    Result: conv_id, call_id, name, level, position, n_results, unresolved, errors, valid, message (canonical JSON).
    """
    calls = calls.select("conv_id", "call_id", "name", "arguments", F.array_distinct(F.coalesce("depends_on", F.array().cast("array<string>"))).alias("depends_on"))
    answers = results.filter(F.col("call_id").isNotNull()).groupBy("call_id").agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    tools = schemas.groupBy("name").agg(
        F.collect_list(F.struct("param", F.element_at(kinds, F.col("kind")).alias("kind"), "required")).alias("params")
    )
    # Ids and what follows from them are settled before any text is moved.
    links = staged(calls.select("conv_id", "call_id", "depends_on"), "call-links")
    known = links.select(F.col("call_id").alias("dep")).distinct()
    # Dependencies that name no call; normally few.
    dangling = (
        links.select("call_id", F.explode("depends_on").alias("dep")).join(known, "dep", "left_anti").groupBy("call_id").agg(F.count_distinct("dep").alias("unresolved"))
    )
    order = staged(positions(links, levels(links)).join(dangling, "call_id", "left").withColumnsRenamed({"conv_id": "_conv", "call_id": "_call"}), "call-order")
    own = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("call_id").eqNullSafe(F.col("_call"))
    linked = (
        calls.join(answers.hint("shuffle_hash"), "call_id", "left")
        .join(order, own)
        .join(tools, "name", "left")
        .withColumn("errors", schema_errors(F.col("arguments"), F.col("params")))
        .withColumn("valid", F.size("errors") == 0)
    )
    message = F.concat(
        F.lit('{"arguments":'), F.coalesce(F.when(~out_of_range(F.col("arguments")), F.to_json(F.try_parse_json("arguments"))), F.lit("null")),
        F.lit(',"call_id":'), quoted(F.col("call_id")),
        F.lit(',"errors":'), F.to_json("errors"),
        F.lit(',"level":'), F.coalesce(F.col("level").cast("string"), F.lit("null")),
        F.lit(',"name":'), quoted(F.col("name")),
        F.lit(',"result":'), quoted(F.col("content")),
        F.lit("}"),
    )
    return linked.select(
        "conv_id", "call_id", "name", "level", "position",
        F.coalesce("n_results", F.lit(0)).alias("n_results"), F.coalesce("unresolved", F.lit(0)).alias("unresolved"),
        F.array_join("errors", ";").alias("errors"), "valid", message.alias("message"),
    )


def lost_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """One row, in the columns of link_calls, for each result whose call_id is null or names no call.

    results: conv_id, call_id, content. name, level and position are null, n_results is 1, the error is "orphan".
    """
    known = calls.select("call_id").distinct()
    message = F.concat(
        F.lit('{"arguments":null,"call_id":'), quoted(F.col("call_id")), F.lit(',"errors":["orphan"],"level":null,"name":null,"result":'), quoted(F.col("content")), F.lit("}")
    )
    return results.join(known, "call_id", "left_anti").select(
        "conv_id", "call_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("position"), F.lit(1).cast("long").alias("n_results"),
        F.lit(0).cast("long").alias("unresolved"), F.lit("orphan").alias("errors"), F.lit(False).alias("valid"), message.alias("message"),
    )


def example_tools(spark: SparkSession) -> DataFrame:
    """The four tools of the query: name, param, kind, required."""
    return spark.sql("""
        SELECT name, param, kind, required FROM VALUES ('lookup'), ('search'), ('summarise'), ('translate') AS t(name)
        LATERAL VIEW inline(array(('query', 'string', true), ('limit', 'integer', true), ('filter', 'object', false))) p AS param, kind, required""")


def turns_to_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: each user turn is a call, the assistant turn after it its result.

    The tool and the flaws of its arguments (a limit that is missing or text, an unknown key, cut JSON) follow from the
    length of the turn; a call depends on the call two turns before, and every third one on that four turns before too.
    """
    conversations = conversations.withColumn("query", F.coalesce("text", F.lit("")))
    n = F.length("query")

    def call_id(back: int) -> Column:
        return F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - back).cast("string"))

    limit = (
        F.when(n % 5 == 0, F.lit(""))
        .when(n % 7 == 0, F.concat(F.lit('"limit" : "'), (n % 10).cast("string"), F.lit('", ')))
        .otherwise(F.concat(F.lit('"limit" : '), (n % 10).cast("string"), F.lit(", ")))
    )
    arguments = F.concat(
        F.lit('{"query" : '), quoted(F.col("query")), F.lit(", "), limit,
        F.when(n % 11 == 0, F.lit('"debug" : true, ')).otherwise(F.lit("")),
        F.lit('"filter" : {"turn" : '), F.col("turn").cast("string"),
        F.lit(', "conv" : '), F.col("conv_id").cast("string"), F.when(n % 13 == 0, F.lit("}")).otherwise(F.lit("}}")),
    )
    users = conversations.filter(F.col("role") == "user")
    calls = users.select(
        "conv_id", call_id(0).alias("call_id"),
        F.element_at(F.array(*[F.lit(x) for x in ("search", "lookup", "summarise", "translate")]), n % 4 + 1).alias("name"),
        arguments.alias("arguments"),
        F.concat(
            F.when(F.col("turn") >= 2, F.array(call_id(2))).otherwise(F.array().cast("array<string>")),
            F.when((F.col("turn") >= 4) & (n % 3 == 0), F.array(call_id(4))).otherwise(F.array().cast("array<string>")),
        ).alias("depends_on"),
    )
    results = conversations.filter(F.col("role") == "assistant").select("conv_id", call_id(1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op8_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = turns_to_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return link_calls(calls, results, example_tools(spark)).unionByName(lost_results(calls, results))


ORACLE = """
WITH RECURSIVE u AS (
    SELECT conv_id, turn, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, 'c' || conv_id || '_' || turn AS call_id
    FROM conversations WHERE role = 'user'
), c AS (
    SELECT *, ['search', 'lookup', 'summarise', 'translate'][n % 4 + 1] AS name,
           list_filter([CASE WHEN turn >= 2 THEN 'c' || conv_id || '_' || (turn - 2) END,
                        CASE WHEN turn >= 4 AND n % 3 = 0 THEN 'c' || conv_id || '_' || (turn - 4) END], lambda x: x IS NOT NULL) AS deps,
           CASE WHEN n % 13 = 0 THEN NULL ELSE
               '{' || CASE WHEN n % 11 = 0 THEN '"debug":true,' ELSE '' END
               || '"filter":{"conv":' || conv_id || ',"turn":' || turn || '}'
               || CASE WHEN n % 5 = 0 THEN '' WHEN n % 7 = 0 THEN ',"limit":"' || (n % 10) || '"' ELSE ',"limit":' || (n % 10) END
               || ',"query":' || CAST(to_json(text) AS VARCHAR) || '}' END AS arguments,
           CASE WHEN n % 13 = 0 THEN ['json'] ELSE list_filter([
               CASE WHEN n % 5 = 0 THEN 'missing:limit' END,
               CASE WHEN n % 5 <> 0 AND n % 7 = 0 THEN 'type:limit' END,
               CASE WHEN n % 11 = 0 THEN 'unknown:debug' END], lambda x: x IS NOT NULL) END AS errs
    FROM u
), e AS (
    SELECT call_id, unnest(deps) AS dep FROM c
), live AS (
    SELECT DISTINCT call_id, dep FROM e WHERE dep IN (SELECT call_id FROM c)
), walk(call_id, level) AS (
    SELECT call_id, 0 FROM c WHERE call_id NOT IN (SELECT call_id FROM live)
    UNION
    SELECT live.call_id, walk.level + 1 FROM live JOIN walk ON live.dep = walk.call_id
), lv AS (
    SELECT call_id, max(level) AS level FROM walk GROUP BY call_id
), r AS (
    SELECT 'c' || conv_id || '_' || (turn - 1) AS call_id, min(text) AS content, count(*) AS n_results
    FROM conversations WHERE role = 'assistant' GROUP BY ALL
), gone AS (
    SELECT call_id, count(DISTINCT dep) AS unresolved FROM e WHERE dep NOT IN (SELECT call_id FROM c) GROUP BY call_id
)
SELECT c.conv_id, c.call_id, c.name, lv.level, rank() OVER (PARTITION BY c.conv_id ORDER BY lv.level NULLS LAST, length(c.call_id), c.call_id) - 1 AS position, coalesce(r.n_results, 0) AS n_results, coalesce(gone.unresolved, 0) AS unresolved,
       array_to_string(errs, ';') AS errors, len(errs) = 0 AS valid,
       '{"arguments":' || coalesce(arguments, 'null') || ',"call_id":"' || c.call_id || '","errors":'
       || CAST(to_json(errs) AS VARCHAR) || ',"level":' || lv.level || ',"name":"' || c.name || '","result":'
       || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS message
FROM c LEFT JOIN lv USING (call_id) LEFT JOIN r USING (call_id) LEFT JOIN gone USING (call_id)
UNION ALL
SELECT conv_id, 'c' || conv_id || '_' || (turn - 1), NULL, NULL, NULL, 1, 0, 'orphan', false,
       '{"arguments":null,"call_id":"c' || conv_id || '_' || (turn - 1) || '","errors":["orphan"],"level":null,"name":null,"result":'
       || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || '}'
FROM conversations WHERE role = 'assistant' AND 'c' || conv_id || '_' || (turn - 1) NOT IN (SELECT call_id FROM c)
"""
