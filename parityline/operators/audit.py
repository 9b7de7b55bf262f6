"""The audit of one applied run: what was planned, done and left, as records of five types in one table.

Documents fall into batches of about `batch_rows` by the hash of their id, so a repeated attempt makes the same batches, and every
record comes from joins and partial aggregates over the plan; no batch is a loop on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.operators.apply import unfit_updates
from parityline.operators.validate import REPORTED, PlanRejected

BATCH_ROWS = 1000
#: Status of an insert by its outcome (fixed values).
STATUS_OF = {"created": 201, "exists": 409, "error": 400}


@dataclass(frozen=True)
class Run:
    run_id: str
    event: str
    env: str
    index: str
    at: datetime
    batch_rows: int = BATCH_ROWS


def batch_of(rows: DataFrame, size: int, key: str = "id") -> DataFrame:
    """rows with batch, from 1."""
    n = rows.agg(F.greatest(F.ceil(F.count("*") / size), F.lit(1)).alias("n")).select("n").scalar()
    return rows.withColumn("batch", (F.pmod(F.xxhash64(key), n) + 1).cast("long"))


def check_plan(target: DataFrame, updates: DataFrame, pk: str) -> None:
    """Raise PlanRejected where any planned value names no field of the target or does not fit its type; nothing is written then."""
    found = unfit_updates(target, updates, pk).orderBy("id", "field").limit(REPORTED).collect()
    if found:
        raise PlanRejected([f"{e['id']}.{e['field']}: {e['error']}" for e in found])


def insert_results(target: DataFrame, rows: DataFrame, pk: str, refused: Column | None = None) -> DataFrame:
    """id, body (JSON without null fields), result, status, error of each row: created, exists, or error where `refused` gives a text.

    Of rows that share an id the smallest is created, as `apply_inserts` does, and the others find it there.
    """
    have = target.select(F.trim(F.col(pk).cast("string")).alias("id"), F.lit(True).alias("there")).distinct()
    why = (F.lit(None) if refused is None else refused).cast("string")
    named = rows.select("id", F.struct(*[c for c in rows.columns if c != "id"]).alias("row"), why.alias("error"))
    # Rows of one id, normally one, are folded by a partial aggregate: a repeated id must not make a window of its own.
    folded = named.groupBy("id", "row", "error").agg(F.count("*").alias("n"))
    first = folded.filter("error IS NULL").groupBy("id").agg(F.min("row").alias("least"))
    known = folded.join(first, "id", "left").join(have, "id", "left")
    makes = F.col("error").isNull() & (F.col("row") == F.col("least")) & F.col("there").isNull()
    results = F.transform(
        F.sequence(F.lit(1), F.col("n").cast("int")),
        lambda i: F.when(F.col("error").isNotNull(), "error").when(F.coalesce(makes, F.lit(False)) & (i == 1), "created").otherwise("exists"),
    )
    out = known.select("id", F.to_json("row").alias("body"), F.explode(results).alias("result"), "error")
    codes = F.create_map(*[F.lit(x) for pair in STATUS_OF.items() for x in pair])
    return out.withColumn("status", codes[F.col("result")])


def audit_records(run: Run, updates: DataFrame, results: DataFrame, inserts: DataFrame) -> DataFrame:
    """All records of a run, by type: run_start, update, update_batch_result, insert, run_end.

    updates: id, changes. results: id, result (updated, conflict or failure). inserts: of `insert_results`.
    """
    stamp = F.date_format(F.lit(run.at).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss")
    whose = [F.lit(run.env).alias("env"), F.lit(run.event).alias("event"), F.lit(run.index).alias("index")]

    def records(df: DataFrame, kind: str, *cols: Column | str) -> DataFrame:
        return df.select(stamp.alias("ts"), F.lit(kind).alias("type"), F.lit(run.run_id).alias("run_id"), *cols)

    def counted(df: DataFrame) -> list[Column]:
        names = {"updated": "updated", "conflict": "conflicts", "failure": "failures"}
        return [F.count_if(F.col("result") == k).alias(v) for k, v in names.items()]

    planned = batch_of(updates, run.batch_rows).join(results, "id")
    batches = planned.groupBy("batch").agg(F.count("*").alias("ids_planned"), *counted(planned))
    added = batch_of(inserts, run.batch_rows)
    done = planned.agg(*counted(planned))
    made = added.agg(*[F.count_if(F.col("result") == k).alias(k) for k in STATUS_OF])
    one = updates.sparkSession.range(1)
    parts = [
        records(one, "run_start", *whose),
        records(planned, "update", *whose, "id", "batch", "changes"),
        records(batches, "update_batch_result", "batch", "ids_planned", "updated", "conflicts", "failures"),
        records(added, "insert", *whose, "id", "batch", "status", "result", "error", "body"),
        records(done.join(made), "run_end", "updated", "conflicts", "failures", F.col("created"), F.col("exists").alias("existing"), F.col("error").alias("errors")),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
