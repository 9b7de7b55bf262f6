"""Table-driven tests of equality, keys, converters and coercion, with the literal edge rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityline.functions import converters as C
from parityline.functions import values as V
from parityline.functions.equality import equal_values, norm_datetime
from parityline.functions.keys import is_blank, norm_key


def one(spark, col, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("_")])
    return row.select(col.alias("x")).first()["x"]


NAN = float("nan")
EQUAL = [
    (None, None, "string", "string", True),
    (None, "", "string", "string", True),
    ("  ", None, "string", "string", True),
    (None, 0, "string", "int", True),
    (None, "0", "string", "string", True),
    ("0.0", None, "string", "string", True),
    (None, False, "string", "boolean", False),
    (None, "a", "string", "string", False),
    (NAN, None, "double", "double", True),
    (NAN, 0.0, "double", "double", True),
    ("nan", "nan", "string", "string", False),
    ("x", "x", "string", "string", True),
    ("nan", NAN, "string", "double", False),
    ("01", 1, "string", "int", True),
    ("1d", 1, "string", "int", False),
    ("1d", "1.0", "string", "string", False),
    (" 7 ", "7", "string", "string", True),
    (9007199254740993, 9007199254740992, "bigint", "bigint", True),
    (True, 1, "boolean", "int", True),
    (True, "false", "boolean", "string", True),
    (False, 0, "boolean", "int", True),
    ("2024-01-02T03:04:05", "2024-01-02 03:04:05.000", "string", "string", True),
    ("2024-01-02 03:04:05", "2024-01-02 03:04:06", "string", "string", False),
    ("a", "A", "string", "string", False),
    ("-1.5e3", -1500, "string", "int", True),
]


@pytest.mark.parametrize(("a", "b", "ta", "tb", "want"), EQUAL)
def test_equal_values(spark, a, b, ta, tb, want):
    kinds = [T.DataType.fromDDL(t) for t in (ta, tb)]
    assert one(spark, equal_values(F.lit(a).cast(ta), F.lit(b).cast(tb), *kinds)) is want
    assert one(spark, equal_values(F.lit(b).cast(tb), F.lit(a).cast(ta), *kinds[::-1])) is want


def test_equal_arrays(spark):
    kind = T.ArrayType(T.StringType())

    def arr(*x):
        return F.array(*[F.lit(v).cast("string") for v in x]) if x else F.array().cast("array<string>")

    assert one(spark, equal_values(arr("a", "b"), arr("a", "b"), kind, kind))
    assert not one(spark, equal_values(arr("a", "b"), arr("b", "a"), kind, kind))
    assert one(spark, equal_values(arr(None), F.lit(None).cast(kind), kind, kind))
    assert not one(spark, equal_values(arr(), F.lit(None).cast(kind), kind, kind))


@pytest.mark.parametrize(("raw", "want"), [("2024-01-02T03:04:05", "2024-01-02 03:04:05.000"), ("2024-01-02", "2024-01-02"), ("x", "x"), ("2024-01-02T03:04", "2024-01-02 03:04")])
def test_norm_datetime(spark, raw, want):
    assert one(spark, norm_datetime(F.lit(raw))) == want


@pytest.mark.parametrize(("raw", "want"), [(" 7 ", "7"), ("NaN", None), ("", None), ("<NA>", None), (None, None), ("Null", None), ("x", "x")])
def test_keys(spark, raw, want):
    assert one(spark, norm_key(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize(("raw", "want"), [(None, True), (" ", True), ("NONE", True), ("null", False), ("0", False)])
def test_blank(spark, raw, want):
    assert one(spark, is_blank(F.lit(raw).cast("string"))) is want


s = lambda v: F.lit(v).cast("string")
def converter_cases():
    return [
        (C.time_to_string(F.lit(datetime(2024, 1, 2, 3, 4, 5, 678999))), "2024-01-02 03:04:05.678"),
        (C.time_to_string(F.lit(None).cast("timestamp")), None),
        (C.num_to_bool(F.lit(2)), True),
        (C.num_to_bool(F.lit(None).cast("int")), None),
        (C.int_to_string(F.lit(10000.0)), "10000"),
        (C.int_to_string(s("abc")), "abc"),
        (C.str_to_list(s("")), []),
        (C.str_to_list(s("a,b")), ["a", "b"]),
        (C.str_to_list(s(None)), None),
        (C.yymmdd_to_iso(s("991332")), None),
        (C.yymmdd_to_iso(s("700101")), "1970-01-01"),
        (C.yymmdd_to_iso(s("691231")), "2069-12-31"),
        (C.yymmdd_to_iso(s("230229")), None),
        (C.int_or_zero(s("1d")), 0),
        (C.int_or_neg_one(s(None)), -1),
        (C.truthy_bool(s(" Yes ")), True),
        (C.truthy_bool(s("2")), True),
        (C.truthy_bool(s("0")), False),
        (C.truthy_bool(s(None)), False),
        (C.to_int_strict(s("12.7")), 12),
        (C.to_int_strict(s("nan")), None),
        (C.last_n(4)(s(" 123456 ")), "3456"),
        (C.last_n(4)(s(" ")), None),
        (C.first_n(6)(s("123")), "123"),
        (C.code_to_label({1: "a"}, "z")(s("1")), "a"),
        (C.code_to_label({1: "a"}, "z")(s("9")), "z"),
        (C.code_to_label({1: "a"}, "z")(s(None)), None),
        (C.code_to_label({1: "a"}, "z", null_stays=False)(s(None)), "z"),
        (C.prefixed_id("P")(s("x")), None),
        (C.labelled_id({1: "A"})(s("7"), F.lit(1)), "A7"),
        (C.suffixed_id(4)(F.lit(7)), "7_4"),
        (C.typed_id(F.lit(7), F.lit(None).cast("int")), "7_1"),
        (C.typed_id(F.lit(7), F.lit(4)), "7_4"),
        (C.month_end(s("24"), s("02")), "2024-02-29"),
        (C.month_end(s("99"), s("0")), "1999-01-31"),
        (C.month_end(s("24"), s("13")), None),
        (C.is_minus_one(s(None)), False),
        (C.is_set(s("5")), True),
        (C.is_set(s("-1")), False),
        (C.add_days(F.lit(datetime(2024, 2, 28)), s(None)), "2024-02-28 00:00:00.000"),
        (C.add_days(F.lit(datetime(2024, 2, 28)), s("2")), "2024-03-01 00:00:00.000"),
        (C.add_days(F.lit(datetime(2024, 2, 28)), s("-2")), None),
        (C.product(s("2"), s("1.5"), s("3.9"), s("2")), 18.0),
        (C.product(s("2"), s("x"), s("3"), s("2")), 0.0),
        (C.product(s("2"), s(None), s("3"), s("2")), 0.0),
        (C.conditional_positive(F.lit(4), F.lit(1), F.lit(5), F.lit(0)), True),
        (C.conditional_positive(F.lit(4), F.lit(2), F.lit(5), F.lit(0)), False),
        (C.value_unless(4)(F.lit(3), F.lit(4)), None),
        (C.value_unless(4)(F.lit(3), F.lit(None).cast("int")), 3),
        (C.value_if(4)(F.lit(3), F.lit(1)), 0),
        (C.label_if(4, "y", "n")(F.lit(4)), "y"),
        (C.digits_list(s(",1,a,22,")), ["1", "22"]),
        (C.digits_list(s(",-1,")), []),
        (C.digits_list(s(None)), None),
        (C.single_list(s(" 5 ")), ["5"]),
        (C.single_list(s(" ")), None),
        (C.coalesce_default("d")(s(None)), "d"),
        (C.range_label(F.lit(1), F.lit(2)), "1-2"),
        (C.range_label(F.lit(1), F.lit(None).cast("int")), None),
        (C.constant(0.0)(F.lit(None)), 0.0),
    ]


def test_converters(spark):
    cases = converter_cases()
    row = spark.range(1).select(*[c.alias(f"c{k}") for k, (c, _) in enumerate(cases)]).first()
    assert [(k, row[k]) for k in range(len(cases))] == [(k, want) for k, (_, want) in enumerate(cases)]


COERCE = [
    ("12.7", "int", 12), ("x", "int", None), ("None", "int", None), ("12.0", "int_str", "12"), ("1e2", "float", 100.0), ("Yes", "bool", True), ("no", "bool", False),
    (None, "bool", None), ("['a','b']", "list", ["a", "b"]), ("a,,b", "list", ["a", "b"]), ("a", "list", ["a"]), ("2024-01-02 03:04:05", "str", "2024-01-02T03:04:05"), ("nan", "str", None),
]


@pytest.mark.parametrize(("raw", "kind", "want"), COERCE)
def test_coerce(spark, raw, kind, want):
    assert one(spark, V.coerce(s(raw), kind)) == want


def test_paths_and_text(spark):
    assert one(spark, V.source_from_path(s(r"C:\x\connector_pg\logging\queries.csv"))) == "pg"
    assert one(spark, V.source_from_path(s("nothing"))) == ""
    assert one(spark, V.event_from_path(s("/a/out/EV/prod/changes/x.parquet"))) == "EV"
    assert one(spark, V.env_from_path(s("/a/out/EV/prod/changes/x.parquet"))) == "prod"
    assert one(spark, V.rel_path(s("/a/out/EV/x"))) == "EV/x"
    assert one(spark, V.sql_fingerprint(s("select  1"))) == one(spark, V.sql_fingerprint(s(" SELECT\n1 ")))
    assert one(spark, V.parse_iso_utc(s("2024-01-02T03:04:05Z"))) == one(spark, V.parse_iso_utc(s("2024-01-02T05:04:05+02:00")))
    assert one(spark, V.parse_iso_utc(s("bad"))) is None
    assert one(spark, V.rows_per_sec(F.lit(10), F.lit(0))) is None
    nested = T.ArrayType(T.StringType())
    assert one(spark, V.scrub(F.array(F.lit("a\nb"), F.lit("c\td")), nested)) == ["a b", "c d"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("['a,b', 'c']", ["a,b", "c"]), ('["it\'s", \'say "x"\', 12, -3.5, True]', ["it's", 'say "x"', "12", "-3.5", "True"]), (r"['a\'b']", ["a'b"]), ("['a', None,]", ["a", None]), ("[]", []),
        ("[a, b]", ["a", "b"]), ("a, b,,c", ["a", "b", "c"]), ("one", ["one"]), ("none", None), ("['a' 'b']", ["'a' 'b'"]),
    ],
)
def test_coerce_list(spark, raw, want):
    assert one(spark, V.coerce(s(raw), "list")) == want
