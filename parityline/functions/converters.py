"""Named converters: Column expressions that shape applies to whole tables.

A converter takes one Column (or several, for composite fields) and gives one. Nothing here runs a job. The registry maps names to
converters; `registry(extra)` adds an event's own. A Python function is admitted only as a pandas UDF with a
declared type, through `python_converter`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Converter = Callable[..., Column]


def time_to_string(x: Column) -> Column:
    """A timestamp as 'yyyy-MM-dd HH:mm:ss.SSS', milliseconds truncated; a date without a time; null stays.

    The type is looked at when the plan is made: typeof is constant for a column, so one branch stays.
    """
    return F.when(F.typeof(x) == "date", F.date_format(x, "yyyy-MM-dd")).otherwise(F.date_format(x, "yyyy-MM-dd HH:mm:ss.SSS"))


def date_to_string(x: Column) -> Column:
    return F.date_format(x, "yyyy-MM-dd")


def num_to_bool(x: Column) -> Column:
    return x.cast("int") != 0


def int_to_string(x: Column) -> Column:
    """Integer text; 10000.0 gives '10000'; a text that is no integer is kept."""
    return F.coalesce(to_int_strict(x).cast("string"), x.cast("string"))


def str_to_list(x: Column) -> Column:
    """Split at commas; '' gives an empty list; null stays."""
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, ","))


def _century(yy: Column) -> Column:
    return F.when(yy < 70, yy + 2000).otherwise(yy + 1900)


def yymmdd_to_iso(x: Column) -> Column:
    """'991332' is no date: null. Two-digit years below 70 are 20yy, others 19yy."""
    text = F.trim(x.cast("string"))
    six = F.when(text.rlike("^[0-9]{6}$"), text)
    year = _century(F.substring(six, 1, 2).try_cast("int")).cast("string")
    return F.date_format(F.try_to_timestamp(F.concat(year, F.substring(six, 3, 4)), F.lit("yyyyMMdd")), "yyyy-MM-dd")


def to_int_strict(x: Column) -> Column:
    """An integer, else the integer part of a number, else null."""
    text = F.trim(x.cast("string"))
    number = F.when(text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
    return F.coalesce(F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint")), number.try_cast("bigint"))


def int_or_zero(x: Column) -> Column:
    return F.coalesce(to_int_strict(x), F.lit(0).cast("bigint"))


def int_or_neg_one(x: Column) -> Column:
    return F.coalesce(to_int_strict(x), F.lit(-1).cast("bigint"))


def truthy_bool(x: Column) -> Column:
    """A text among 1, true, y, yes, t, or a number other than 0; null is false."""
    text = F.lower(F.trim(x.cast("string")))
    return F.coalesce(text.isin("1", "true", "y", "yes", "t") | (to_int_strict(x) != 0), text.isin("1", "true", "y", "yes", "t"), F.lit(False))


def constant(value: object) -> Converter:
    return lambda *_: F.lit(value)


def last_n(n: int) -> Converter:
    def run(x: Column) -> Column:
        text = F.trim(x.cast("string"))
        return F.when(text != "", F.right(text, F.lit(n)))

    return run


def first_n(n: int) -> Converter:
    def run(x: Column) -> Column:
        text = F.trim(x.cast("string"))
        return F.when(text != "", F.substring(text, 1, n))

    return run


def code_to_label(labels: Mapping[int, str], default: str | None = None, null_stays: bool = True) -> Converter:
    """A code's label; default for codes that are unknown; null for null where null_stays."""

    def run(x: Column) -> Column:
        code = to_int_strict(x)
        known = F.lit(default)
        for k, v in labels.items():
            known = F.when(code == k, v).otherwise(known)
        return F.when(x.isNotNull(), known) if null_stays else known

    return run


def prefixed_id(prefix: str) -> Converter:
    return lambda x: F.concat(F.lit(prefix), to_int_strict(x).cast("string"))


def labelled_id(labels: Mapping[int, str]) -> Converter:
    """The two-column form: the label of the second column, then the integer of the first."""
    return lambda x, kind: F.concat(code_to_label(labels)(kind), to_int_strict(x).cast("string"))


def suffixed_id(n: int) -> Converter:
    return lambda x: F.concat(to_int_strict(x).cast("string"), F.lit(f"_{n}"))


def typed_id(x: Column, kind: Column) -> Column:
    """Suffix _4 for type 4, else _1."""
    suffix = F.when(to_int_strict(kind) == 4, "_4").otherwise("_1")
    return F.concat(to_int_strict(x).cast("string"), suffix)


def month_end(yy: Column, mm: Column) -> Column:
    """Last day of a month of a two-digit year; month 0 counts as January; null for others that are no month."""
    year, month = _century(to_int_strict(yy)), F.when(to_int_strict(mm) == 0, 1).otherwise(to_int_strict(mm))
    ok = month.between(1, 12) & to_int_strict(yy).between(0, 99)
    first = F.when(ok, F.make_date(year.cast("int"), F.when(ok, month).otherwise(1).cast("int"), F.lit(1)))
    return F.date_format(F.last_day(first), "yyyy-MM-dd")


def is_minus_one(x: Column) -> Column:
    return F.coalesce(to_int_strict(x) == -1, F.lit(False))


def is_set(x: Column) -> Column:
    """Neither 0 nor -1; null is false."""
    return F.coalesce(~to_int_strict(x).isin(0, -1), F.lit(False))


def add_days(ts: Column, days: Column) -> Column:
    """A timestamp plus days as millisecond text; null days count as 0; negative or bad days give null."""
    n = F.when(days.isNull(), F.lit(0)).otherwise(to_int_strict(days).cast("int"))
    return F.date_format(ts + F.make_dt_interval(F.when(n >= 0, n)), "yyyy-MM-dd HH:mm:ss.SSS")


def product(a: Column, b: Column, c: Column, d: Column) -> Column:
    """a * b * c * d as a double, c and d truncated to integers; null counts as 0 and a bad text makes it 0."""

    def part(x: Column) -> Column:
        text = F.trim(x.cast("string"))
        return F.when(x.isNull(), 0.0).otherwise(F.when(text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double")))

    def whole(x: Column) -> Column:
        return part(x).try_cast("bigint").cast("double")

    return F.coalesce(part(a) * part(b) * whole(c) * whole(d), F.lit(0.0))


def conditional_positive(status: Column, kind: Column, a: Column, b: Column, kinds_of_a: tuple[int, ...] = (1,)) -> Column:
    """Status 4 and a positive amount: a for the kinds listed, b for others."""
    amount = F.when(to_int_strict(kind).isin(*kinds_of_a), a).otherwise(b).try_cast("double")
    return F.coalesce((to_int_strict(status) == 4) & (amount > 0), F.lit(False))


def value_unless(code: int) -> Converter:
    return lambda x, kind: F.when(F.coalesce(to_int_strict(kind) != code, F.lit(True)), to_int_strict(x))


def value_if(code: int) -> Converter:
    return lambda x, kind: F.when(to_int_strict(kind) == code, F.coalesce(to_int_strict(x), F.lit(0).cast("bigint"))).otherwise(0)


def label_if(code: int, yes: str, no: str) -> Converter:
    return lambda kind: F.when(to_int_strict(kind) == code, yes).otherwise(no)


def digits_list(x: Column) -> Column:
    """',1,a,22,' gives ['1', '22']; ',-1,' gives []; null stays."""
    return F.filter(F.transform(F.split(x, ","), lambda v: F.trim(v)), lambda v: v.rlike("^[0-9]+$"))


def single_list(x: Column) -> Column:
    text = F.trim(x.cast("string"))
    return F.when(text != "", F.array(text))


def coalesce_default(value: object) -> Converter:
    return lambda x: F.coalesce(x, F.lit(value))


def range_label(a: Column, b: Column) -> Column:
    return F.concat(a.cast("string"), F.lit("-"), b.cast("string"))


def add_day_number(date: Column, days: Column) -> Column:
    return F.date_add(date.cast("date"), days.cast("int"))


def python_converter(function: Callable, returns: str) -> Converter:
    """A user's own Python converter (pandas Series in and out), with a declared Spark type."""
    return F.pandas_udf(function, returns)


COMMON: dict[str, Converter] = {
    "time_to_string": time_to_string,
    "date_to_string": date_to_string,
    "num_to_bool": num_to_bool,
    "int_to_string": int_to_string,
    "str_to_list": str_to_list,
    "yymmdd_to_iso": yymmdd_to_iso,
    "to_int_strict": to_int_strict,
    "int_or_zero": int_or_zero,
    "int_or_neg_one": int_or_neg_one,
    "truthy_bool": truthy_bool,
    "zero": constant(0),
    "zero_float": constant(0.0),
    "false": constant(False),
    "last_4": last_n(4),
    "first_6": first_n(6),
    "suffixed_1": suffixed_id(1),
    "typed_id": typed_id,
    "month_end": month_end,
    "is_minus_one": is_minus_one,
    "is_set": is_set,
    "add_days": add_days,
    "product": product,
    "conditional_positive": conditional_positive,
    "digits_list": digits_list,
    "single_list": single_list,
    "range_label": range_label,
    "add_day_number": add_day_number,
}


def registry(*extra: Mapping[str, Converter]) -> dict[str, Converter]:
    """The common converters and an event's own; later ones win."""
    out = dict(COMMON)
    for more in extra:
        out |= more
    return out
