"""Comparison of two tables per key and field.

The whole comparison is one full outer join on the text key: keys are cleaned before it, duplicates fall by a partial
aggregate on the same key, and the differing fields of a pair come out of one array in the stage of the join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from parityline.functions.equality import as_text, equal_values
from parityline.functions.keys import filter_bad_keys

DIFF, MISSING_IN_TARGET, MISSING_IN_SOURCE = "diff", "missing_in_target", "missing_in_source"
WHOLE_ROW = "<row>"
#: Which statuses each mode writes.
MODES = {
    "changes": (DIFF,),
    "missing": (MISSING_IN_TARGET,),
    "both": (DIFF, MISSING_IN_TARGET),
    "all": (DIFF, MISSING_IN_TARGET, MISSING_IN_SOURCE),
}


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row for each key: the smallest by `order`, then by the other columns. Copies fold before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[c if c in keys else F.col(f"_first.`{c}`").alias(c) for c in df.columns])


def compare_tables(
    source: DataFrame,
    target: DataFrame,
    pk: str,
    fields: Iterable[str] | None = None,
    by: Sequence[str] = (),
    empty_side: str = "report",
    restrict_target_to_source: bool = False,
    unique: bool = False,
    source_by: Sequence[str] = (),
    keep: str = "both",
    ready: bool = False,
) -> DataFrame:
    """Long form: *by, *source_by, pk, field, source_value, target_value, status.

    fields: defaults to the source's columns but the key's. by: further key columns, such as a window; both sides have
    them. empty_side 'skip': a window (or, without `by`, the table) with no row on one side gives nothing.
    restrict_target_to_source: target rows whose key the source lacks are left out first. unique: keys are known to be
    unique, so duplicates are not looked for. source_by: columns of the source alone, such as its window, that are part of its
    keys and of the result. keep "source": rows that only the target has give nothing, by a left join.
    ready: keys are trimmed, usable and unique already, as `write_keyed` leaves them; two such tables join without a shuffle.
    """
    by, own = list(by), list(source_by)
    names = [f for f in (fields or source.columns) if f != pk and f not in by and f not in own]
    absent = F.lit(None).cast("string")

    def side(df: DataFrame, keys: list[str]) -> DataFrame:
        have = [f for f in names if f in df.columns]
        if ready:
            return df.select(*keys, F.col(pk), *have)
        out = filter_bad_keys(df.select(*keys, F.col(pk), *have), pk)
        return out if unique else first_per_key(out, [*keys, pk])

    s, t = side(source, [*by, *own]), side(target, by)
    if restrict_target_to_source and empty_side == "skip":
        t = t.join(s.select(*by, pk), [*by, pk], "left_semi")
    if empty_side == "skip":
        s, t = _windows_of_both(s, t, by)
    kinds_s, kinds_t = ({f.name: f.dataType for f in x.schema.fields} for x in (s, t))
    left = s.select(*by, *own, pk, F.struct(F.lit(1).alias("_here"), *[f for f in names if f in s.columns]).alias("s"))
    right = t.select(*by, pk, F.struct(F.lit(1).alias("_here"), *[f for f in names if f in t.columns]).alias("t"))
    # Without the rows that only the target has, a left join does; the key is unique on both sides of it.
    # It is merged, not broadcast: both sides lie by key already, and a small file must not pull the other side into its few tasks.
    both = left.join(right.hint("merge"), [*by, pk], "left" if restrict_target_to_source or keep == "source" else "full_outer")

    def row(field: str, a: Column, b: Column, status: str) -> Column:
        return F.struct(F.lit(field).alias("field"), a.alias("source_value"), b.alias("target_value"), F.lit(status).alias("status"))

    found, flags = [], []
    for f in names:
        a, b, ta, tb = _values(f, kinds_s, kinds_t)
        flags.append(~equal_values(a, b, ta, tb))
        found.append(F.when(F.get("_unlike", F.lit(len(found))), row(f, as_text(a, ta), as_text(b, tb), DIFF)))
    pair = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<struct<field:string,source_value:string,target_value:string,status:string>>")
    diffs = (
        F.when(F.col("t").isNull(), F.array(row("*", F.lit(WHOLE_ROW), absent, MISSING_IN_TARGET)))
        .when(F.col("s").isNull(), F.array(row("*", absent, F.lit(WHOLE_ROW), MISSING_IN_SOURCE)))
        .otherwise(pair)
    )
    # Each field is judged once. Pairs without a difference, normally nearly all, leave before any text is made of their values.
    one_sided = F.col("s").isNull() | F.col("t").isNull()
    judged = both.withColumn("_unlike", F.when(~one_sided, F.array(*flags) if flags else F.array().cast("array<boolean>")))
    some = one_sided | F.array_contains("_unlike", True)
    return judged.filter(some).select(*by, *own, F.col(pk).alias("pk"), F.inline(diffs))


def _values(field: str, kinds_s: Mapping[str, DataType], kinds_t: Mapping[str, DataType]) -> tuple[Column, Column, DataType, DataType]:
    """The field on both sides of a pair, null where a side lacks it, with their types."""
    ta, tb = kinds_s.get(field, kinds_t.get(field)), kinds_t.get(field, kinds_s.get(field))
    a = F.col(f"s.`{field}`") if field in kinds_s else F.lit(None).cast(ta)
    b = F.col(f"t.`{field}`") if field in kinds_t else F.lit(None).cast(tb)
    return a, b, ta, tb


def compare_counts(source: DataFrame, target: DataFrame, pk: str, by: Sequence[str], fields: Iterable[str] | None = None) -> DataFrame:
    """*by, rows_source, rows_target, rows_changed (differing fields), rows_missing (keys that the target lacks), from one join.

    Rows with a usable key count, repeated ones each; of rows that share a key the smallest is compared, as in `compare_tables`.
    """
    by = list(by)
    names = [f for f in (fields or source.columns) if f != pk and f not in by]

    def side(df: DataFrame, name: str) -> DataFrame:
        have = [f for f in names if f in df.columns]
        rows = filter_bad_keys(df.select(*by, pk, *have), pk)
        return rows.groupBy(*by, pk).agg(F.min(F.struct(F.lit(1).alias("_here"), *have)).alias(name), F.count("*").alias(f"_n{name}"))

    s, t = side(source, "s"), side(target, "t")
    kinds_s, kinds_t = ({f.name: f.dataType for f in x.schema[name].dataType.fields} for x, name in ((s, "s"), (t, "t")))
    both = s.join(t.hint("merge"), [*by, pk], "full_outer")
    unlike = F.lit(0)
    for f in names:
        unlike = unlike + F.when(equal_values(*_values(f, kinds_s, kinds_t)), 0).otherwise(1)
    paired = F.col("s").isNotNull() & F.col("t").isNotNull()
    return both.groupBy(*by).agg(
        F.coalesce(F.sum("_ns"), F.lit(0)).alias("rows_source"), F.coalesce(F.sum("_nt"), F.lit(0)).alias("rows_target"),
        F.sum(F.when(paired, unlike).otherwise(0)).cast("long").alias("rows_changed"), F.count_if(F.col("t").isNull()).alias("rows_missing"),
    )


def absent_rows(shaped: DataFrame, target: DataFrame, pk: str, error: str = MISSING_IN_TARGET) -> DataFrame:
    """The full shaped rows of keys that the target lacks, duplicates kept, with an error column: no field is compared."""
    there = filter_bad_keys(target.select(pk), pk)
    return filter_bad_keys(shaped, pk).join(there.hint("merge"), pk, "left_anti").withColumn("error", F.lit(error))


def _windows_of_both(s: DataFrame, t: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides without the windows that are empty on the other side."""
    if by:
        return s.join(t.select(*by).distinct(), by, "left_semi"), t.join(s.select(*by).distinct(), by, "left_semi")
    one = F.lit(1)
    some_t, some_s = (x.select(one.alias("_one")).limit(1) for x in (t, s))
    return (
        s.withColumn("_one", one).join(some_t, "_one", "left_semi").drop("_one"),
        t.withColumn("_one", one).join(some_s, "_one", "left_semi").drop("_one"),
    )


def compare_field(source: DataFrame, target: DataFrame, pk: str, field: str) -> DataFrame:
    """Keys on both sides whose one field differs (null equals zero): pk, source_value, target_value."""
    s, t = filter_bad_keys(source.select(pk, field), pk), filter_bad_keys(target.select(pk, field), pk)
    ta, tb = s.schema[field].dataType, t.schema[field].dataType
    both = s.select(F.col(pk).alias("pk"), F.col(field).alias("a")).join(t.select(F.col(pk).alias("pk"), F.col(field).alias("b")), "pk")
    a, b = F.col("a"), F.col("b")
    return both.filter(~equal_values(a, b, ta, tb)).select("pk", as_text(a, ta).alias("source_value"), as_text(b, tb).alias("target_value"))


def missing_rows(shaped: DataFrame, diffs: DataFrame, pk: str, error: str = MISSING_IN_TARGET) -> DataFrame:
    """The full shaped rows of keys that the target lacks, duplicates kept, with an error column."""
    keys = diffs.filter(F.col("status") == MISSING_IN_TARGET).select(F.col("pk").alias(pk))
    return filter_bad_keys(shaped, pk).join(keys, pk, "left_semi").withColumn("error", F.lit(error))


def filter_diff_mode(diffs: DataFrame, mode: str) -> DataFrame:
    return diffs.filter(F.col("status").isin(*MODES[mode]))


def usable_diffs(diffs: DataFrame) -> DataFrame:
    """Rows that name one document and one field."""
    return filter_bad_keys(diffs, "pk").filter(F.col("field").isNotNull() & ~F.col("field").isin("", "*"))


def semi_keys(target: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    """Target rows whose key the source has, compared as text."""
    return filter_bad_keys(target, pk).join(filter_bad_keys(source.select(pk), pk), pk, "left_semi")


def matching(target: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    """Target rows with the further columns of the source rows that have their key, compared as text."""
    return filter_bad_keys(target, pk).join(filter_bad_keys(source, pk), pk)


def key_sets(source: DataFrame, target: DataFrame, pk: str) -> DataFrame:
    """pk, in_source, in_target: each key of either side once, compared as text; both true is the intersection."""
    sides = [filter_bad_keys(df.select(pk), pk).select(pk, F.lit(is_source).alias("_source")) for df, is_source in ((source, True), (target, False))]
    rows = sides[0].unionByName(sides[1])
    return rows.groupBy(F.col(pk).alias("pk")).agg(F.bool_or("_source").alias("in_source"), F.bool_or(~F.col("_source")).alias("in_target"))


def rule_check(source: DataFrame, target: DataFrame, pk: str, rule: Column, field: str) -> DataFrame:
    """outcome (matched / mismatched), n: a value computed from the source against the target's stored one."""
    s = filter_bad_keys(source.select(pk, rule.alias("_rule")), pk)
    t = filter_bad_keys(target.select(pk, F.col(field).alias("_stored")), pk)
    same = equal_values(F.col("_rule"), F.col("_stored"), s.schema["_rule"].dataType, t.schema["_stored"].dataType)
    return s.join(t, pk).groupBy(F.when(same, "matched").otherwise("mismatched").alias("outcome")).agg(F.count("*").alias("n"))


def null_rate_by_group(df: DataFrame, group: str, col: str) -> DataFrame:
    """group, n, blank: rows and null-or-blank values in each group."""
    blank = F.col(col).isNull() | (F.trim(F.col(col).cast("string")) == "")
    return df.groupBy(F.col(group).alias("grp")).agg(F.count("*").alias("n"), F.count_if(blank).alias("blank"))


def diff_rate_by_group(source: DataFrame, target: DataFrame, pk: str, field: str, group: str, tol: float = 1e-9, samples: int = 3) -> DataFrame:
    """grp, n, differing, sample: rows whose values are further apart than tol (null is 0), with the first few keys."""
    s = filter_bad_keys(source.select(pk, F.col(field).alias("_a"), F.col(group).alias("grp")), pk)
    t = filter_bad_keys(target.select(pk, F.col(field).alias("_b")), pk)
    apart = F.abs(F.coalesce(F.col("_a").try_cast("double"), F.lit(0.0)) - F.coalesce(F.col("_b").try_cast("double"), F.lit(0.0))) > tol
    rows = s.join(t, pk).withColumn("_apart", apart)
    totals = rows.groupBy("grp").agg(F.count("*").alias("n"), F.count_if("_apart").alias("differing"))
    first = Window.partitionBy("grp").orderBy(pk)
    few = rows.filter("_apart").withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= samples)
    few = few.groupBy("grp").agg(F.array_join(F.array_sort(F.collect_list(pk)), ",").alias("sample"))
    same = totals["grp"].eqNullSafe(few["grp"])
    return totals.join(few, same, "left").select(totals["grp"], "n", "differing", F.coalesce("sample", F.lit("")).alias("sample"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """value, n, the most frequent first; nulls are a value."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("value"))


def non_null_count(df: DataFrame, mask: Column, col: str) -> DataFrame:
    """n, non_null, non_zero of the rows that the mask takes."""
    x = F.col(col)
    return df.filter(mask).agg(F.count("*").alias("n"), F.count_if(x.isNotNull()).alias("non_null"), F.count_if(F.coalesce(x.try_cast("double"), F.lit(0.0)) != 0).alias("non_zero"))
