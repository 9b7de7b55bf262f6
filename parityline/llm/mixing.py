"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Documents are summed to cells (one for each source, language and topic that occur together). Raking multiplies each cell
by one factor for each of its three values, so that token weights meet the target share of every source, then of every
language, then of every topic, again and again; each factor table is staged before the next is computed. The fitted
share of a cell and its tokens give the probability with which its documents are sampled: p = min(1, budget * share /
tokens), the budget being a fraction of all tokens. Calibration, the default, sets every factor with that cut in view, so that
what cells at p = 1 lack is sampled from other cells and the targets and the budget are met; `reached` tells those that
cannot be. A document is kept when the hash of its id falls below p, so the
choice is the same on every run and in every partitioning.

A value's cells meet as partial sums, so a source that holds a third of all documents is one row from each task. The
cells are joined to documents by a join that Spark broadcasts only while they are below its size limit; beyond it the
join is a shuffle whose hot cells the adaptive planner splits.

Edge cases: a null source, language or topic is the value "(none)"; null, empty and blank texts have no tokens, take part
with the p of their cell, and p = 0 where a whole cell has none; texts of any length are counted whole; values without a
target get none of the weight; repeated rows count each, and rows that share an id share their draw, so equal draws of
different ids are kept or dropped together with their own p; a null id draws as the empty text; tables that are empty give
empty results; other columns are carried along untouched, and where one has the name of a column that `mix` adds, the new
one gets an underscore behind.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parityline.llm.common import free_name, staged, text_of

NONE = "(none)"
DIMS = ("source", "lang", "topic")
#: Share of all tokens to sample, and rounds of raking, of the query and the pipeline.
BUDGET, CYCLES = 0.7, 6
#: Rounds of calibration, and how often as many more follow while a reachable goal is missed by more than a share of it.
ROUNDS, MORE, TOLERANCE = 12, 3, 1e-3
SCALE = 1_000_000


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def form(text: Column) -> Column:
    """The topic that the query derives: the form of a text."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("###")) | F.contains(text, F.lit("$$$")), "symbols")
        .when(F.length(text) >= 4000, "long prose")
        .otherwise("prose")
    )


def _keyed(docs: DataFrame, topic: Column) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(f"mix_{c}") for c in ("source", "lang")] + [
        F.coalesce(topic, F.lit(NONE)).alias("mix_topic")
    ]


def cells_of(docs: DataFrame, topic: Column, text_col: str = "text") -> DataFrame:
    """source, lang, topic, tokens of each cell."""
    keyed = docs.select(*_keyed(docs, topic), words(text_of(text_col)).alias("n"))
    cells = keyed.groupBy(*[F.col(f"mix_{d}").alias(d) for d in DIMS]).agg(F.sum("n").alias("tokens"))
    return staged(cells, "mix-cells")


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Targets in proportion to a power of each value's tokens: value, weight. Below 1 it lifts the small values."""
    return cells.groupBy(F.col(dim).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("weight"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], cycles: int = CYCLES) -> DataFrame:
    """source, lang, topic, tokens, share (fitted shares; they sum to 1 where the targets can be met)."""
    live = cells.filter("tokens > 0")
    goal, factor = {}, {}
    for d in DIMS:
        present = targets[d].join(live.select(F.col(d).alias("value")).distinct(), "value", "left_semi").filter("weight > 0")
        total = present.agg(F.sum("weight").alias("total"))
        goal[d] = staged(present.select(F.col("value").alias(d), (F.col("weight") / total.scalar()).alias("goal")), "mix-goal")
        factor[d] = goal[d].select(d, F.lit(1.0).alias(f"f_{d}"))

    def weighted(dims: list[str]) -> DataFrame:
        out = live
        for d in dims:
            out = out.join(factor[d], d)
        product = F.col("tokens").cast("double")
        for d in dims:
            product = product * F.col(f"f_{d}")
        return out.withColumn("share", product)

    for _ in range(cycles):
        for d in DIMS:
            sums = weighted([o for o in DIMS if o != d]).groupBy(d).agg(F.sum("share").alias("now"))
            factor[d] = staged(sums.join(goal[d], d).select(d, (F.col("goal") / F.col("now")).alias(f"f_{d}")), "mix-factor")
    return weighted(list(DIMS)).select(*DIMS, "tokens", "share")


def _solutions(part: list[str], tokens: Column, pull: Column, goal: Column) -> Column:
    """f: the solution of goal = tokens of larger pulls + f * (sum of tokens * pull of the others); full: where f * pull is 1."""
    order = Window.partitionBy(*part).orderBy(pull.desc(), *[d for d in DIMS if d not in part])
    fixed = F.coalesce(F.sum(tokens).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    free = F.sum(tokens * pull).over(order.rowsBetween(0, Window.unboundedFollowing))
    return F.struct(F.try_divide(goal - fixed, free).alias("f"), F.try_divide(F.lit(1.0), pull).alias("full"))


def _factor(df: DataFrame, name: str, part: list[str], pull: Column, goal: Column) -> DataFrame:
    """df with column `name`: the factor f of the row's part for which the sum of tokens * min(1, f * pull) is goal.

    The sum is the least of the lines that fix the k largest pulls at 1, so f is the largest of their solutions; where the
    goal is out of reach, f is just large enough that all are 1.
    """
    every = Window.partitionBy(*part)
    df = df.withColumn("_at", _solutions(part, F.col("tokens"), pull, goal))
    return df.withColumn(name, F.least(F.max("_at.f").over(every), F.max("_at.full").over(every))).drop("_at")


def calibrated(cells: DataFrame, targets: Mapping[str, DataFrame], budget: float = BUDGET, cycles: int = ROUNDS) -> DataFrame:
    """source, lang, topic, tokens, p, goal_source, goal_lang, goal_topic (tokens to sample of the cell's three values).

    p = min(1, product of the cell's three factors); each factor is set so that what is sampled of its value is the goal,
    with the cells that are cut at 1 counted whole. A goal is the value's share of the budget, at most all its tokens, and
    what it lacks goes to the other values of its kind in proportion to their weights.
    """
    total = cells.agg((F.sum("tokens").cast("double") * F.lit(float(budget))).alias("total")).scalar()
    fit = cells.filter("tokens > 0").select(*DIMS, F.col("tokens").cast("double").alias("tokens"))
    for d in DIMS:
        fit = fit.join(targets[d].filter("weight > 0").select(F.col("value").alias(d), F.col("weight").cast("double").alias(f"w_{d}")), d)
    fit = staged(fit.withColumn("budget", total), "mix-fit")
    for d in DIMS:
        values = fit.groupBy(d).agg(F.sum("tokens").alias("tokens"), F.first(f"w_{d}").alias("w"), F.first("budget").alias("budget"))
        values = values.select(d, *[F.lit("").alias(o) for o in DIMS if o != d], "tokens", "w", "budget", F.lit(0).alias("all"))
        goals = _factor(values, "f", ["all"], F.col("w") / F.col("tokens"), F.col("budget"))
        goals = goals.select(d, F.least("tokens", F.col("f") * F.col("w")).alias(f"goal_{d}"))
        fit = staged(fit.join(goals, d).withColumn(f"f_{d}", F.lit(1.0)), "mix-fit")
    p = F.least(F.lit(1.0), F.col("f_source") * F.col("f_lang") * F.col("f_topic"))
    for _ in range(1 + MORE):
        for _ in range(cycles):
            for d in DIMS:
                a, b = (F.col(f"f_{o}") for o in DIMS if o != d)
                fit = _factor(fit, f"f_{d}", [d], a * b, F.col(f"goal_{d}"))
            fit = staged(fit, "mix-fit")
        sums = [fit.groupBy(d).agg(F.abs(F.sum(p * F.col("tokens")) / F.first(f"goal_{d}") - 1).alias("off")).select("off") for d in DIMS]
        if (sums[0].unionByName(sums[1]).unionByName(sums[2]).agg(F.max("off").alias("off")).first()["off"] or 0) <= TOLERANCE:
            break
    return fit.select(*DIMS, "tokens", F.coalesce(p, F.lit(0.0)).alias("p"), *[f"goal_{d}" for d in DIMS], *[f"w_{d}" for d in DIMS], "budget")


def reached(fit: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """dim, value, wanted and expected tokens of the sample, met: what `calibrated` makes of every target."""
    out = []
    for d in DIMS:
        per = fit.groupBy(F.lit(d).alias("dim"), F.col(d).alias("value")).agg(
            F.first(f"w_{d}").alias("weight"), F.first("budget").alias("budget"), F.sum(F.col("p") * F.col("tokens")).alias("expected")
        )
        wanted = F.col("budget") * F.col("weight") / F.sum("weight").over(Window.partitionBy("dim"))
        out.append(per.withColumn("wanted", wanted).select("dim", "value", "wanted", "expected", (F.abs(F.col("expected") - F.col("wanted")) <= tolerance * F.col("wanted")).alias("met")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def probabilities(cells: DataFrame, targets: Mapping[str, DataFrame], budget: float = BUDGET, cycles: int = ROUNDS) -> DataFrame:
    """source, lang, topic, ppm: the sampling probability of each cell in millionths, calibrated."""
    return calibrated(cells, targets, budget, cycles).select(*DIMS, F.round(F.col("p") * SCALE).cast("long").alias("ppm"))


def cut_probabilities(cells: DataFrame, targets: Mapping[str, DataFrame], budget: float = BUDGET, cycles: int = CYCLES) -> DataFrame:
    """The same from plain raking: what a cell loses where p is cut at 1 goes to no other cell."""
    total = cells.agg(F.sum("tokens").cast("double").alias("total")).scalar()
    p = F.least(F.lit(1.0), F.lit(budget) * total * F.col("share") / F.col("tokens"))
    return staged(rake(cells, targets, cycles).select(*DIMS, F.round(p * SCALE).cast("long").alias("ppm")), "mix-p")


def mix(docs: DataFrame, topic: Column, targets: Mapping[str, DataFrame] | None = None, budget: float = BUDGET, cycles: int | None = None, id_col: str = "doc_id", text_col: str = "text", calibrate: bool = True) -> DataFrame:
    """docs and, as the last columns, mix_source, mix_lang, mix_topic, mix_p and mix_kept; filter on mix_kept for the sample."""
    cells = cells_of(docs, topic, text_col)
    targets = targets or {"source": tempered(cells, "source", 0.7), "lang": tempered(cells, "lang", 0.8), "topic": tempered(cells, "topic", 0.9)}
    p = probabilities(cells, targets, budget, cycles or ROUNDS) if calibrate else cut_probabilities(cells, targets, budget, cycles or CYCLES)
    own = [free_name(f"mix_{d}", docs) for d in DIMS]
    ppm = free_name("mix_ppm", docs)
    p = p.select(*[F.col(d).alias(c) for d, c in zip(DIMS, own, strict=True)], F.col("ppm").alias(ppm))
    keys = [c.alias(name) for c, name in zip(_keyed(docs, topic), own, strict=True)]
    keyed = docs.select("*", *keys).join(p, own, "left")
    share = F.coalesce(ppm, F.lit(0))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("long") % SCALE
    return keyed.select(*docs.columns, *own, (share / SCALE).alias(free_name("mix_p", docs)), (draw < share).alias(free_name("mix_kept", docs)))


def sampled(docs: DataFrame, topic: Column, **more) -> DataFrame:
    """The documents that `mix` keeps, with their own columns."""
    mixed = mix(docs, topic, **more)
    return mixed.filter(F.col(mixed.columns[-1])).select(*docs.columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, form(text_of("text"))).select(
        "doc_id", *[F.col(f"mix_{d}").alias(d) for d in DIMS], words(text_of("text")).alias("n_tokens"), F.col("mix_p").alias("p"), F.col("mix_kept").alias("kept")
    )


def oracle(budget: float = BUDGET, cycles: int = ROUNDS) -> str:
    """The same in SQL, with the rounds of calibration written out."""
    power = {"source": 0.7, "lang": 0.8, "topic": 0.9}
    parts = [
        r"""d AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
           CASE WHEN contains(t, ' | ') THEN 'table' WHEN contains(t, '###') OR contains(t, '$$$') THEN 'symbols'
                WHEN length(t) >= 4000 THEN 'long prose' ELSE 'prose' END AS topic,
           len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n_tokens
    FROM (SELECT *, coalesce(text, '') AS t FROM documents)
)""",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)",
        f"total AS MATERIALIZED (SELECT {budget} * sum(tokens) AS budget FROM cells)",
    ]

    def factor(src: str, keep: str, part: str, pull: str, goal: str) -> str:
        """The factor f for which sum(tokens * least(1, f * pull)) is the goal: the largest solution over how many pulls are cut."""
        order = f"PARTITION BY {part} ORDER BY pull DESC, source, lang, topic ROWS BETWEEN"
        return (
            f"SELECT {keep}, least(max(CASE WHEN free > 0 THEN (goal - fixed) / free END) OVER (PARTITION BY {part}), max(CASE WHEN pull > 0 THEN 1 / pull END) OVER (PARTITION BY {part})) AS f "
            f"FROM (SELECT *, coalesce(sum(tokens) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed, sum(tokens * pull) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING) AS free "
            f"FROM (SELECT *, {pull} AS pull, {goal} AS goal FROM {src}))"
        )

    for d in DIMS:
        others = ", ".join(f"'' AS {o}" for o in DIMS if o != d)
        parts.append(f"v_{d} AS MATERIALIZED (SELECT {d}, {others}, 1 AS every, sum(tokens) AS tokens, pow(sum(tokens), {power[d]}) AS w, any_value(budget) AS budget FROM cells, total WHERE tokens > 0 GROUP BY {d})")
        parts.append(f"g_{d} AS MATERIALIZED (SELECT {d}, least(tokens, f * w) AS goal FROM ({factor(f'v_{d}', f'{d}, tokens, w', 'every', 'w / tokens', 'budget')}))")
    parts.append(
        "r0 AS MATERIALIZED (SELECT source, lang, topic, tokens, s.goal AS goal_source, l.goal AS goal_lang, t.goal AS goal_topic, 1.0::DOUBLE AS f_source, 1.0::DOUBLE AS f_lang, 1.0::DOUBLE AS f_topic "
        "FROM cells JOIN g_source s USING (source) JOIN g_lang l USING (lang) JOIN g_topic t USING (topic) WHERE tokens > 0)"
    )
    n = 0
    for _ in range(cycles):
        for d in DIMS:
            a, b = (f"f_{o}" for o in DIMS if o != d)
            made = factor(f"r{n}", "* EXCLUDE (pull, goal, fixed, free)", d, f"{a} * {b}", f"goal_{d}")
            parts.append(f"r{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (f) REPLACE (f AS f_{d}) FROM ({made}))")
            n += 1
    parts.append(f"p AS (SELECT source, lang, topic, round(coalesce(least(1.0, f_source * f_lang * f_topic), 0.0) * {SCALE})::BIGINT AS ppm FROM r{n})")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, source, lang, topic, n_tokens, coalesce(ppm, 0) / {SCALE}.0::DOUBLE AS p,
       CAST('0x' || substr(md5('mix:' || doc_id), 1, 8) AS BIGINT) % {SCALE} < coalesce(ppm, 0) AS kept
FROM d LEFT JOIN p USING (source, lang, topic)"""
    )
