"""Target schemas: flattening, arrays, and validation of planned values."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types of target fields whose values are checked, by the kind of value that they take (fixed values).
TEXT = {"keyword", "text", "ip", "binary"}
INTEGER = {"byte", "short", "integer", "long"}
DECIMAL = {"half_float", "float", "double", "scaled_float"}
DATE, BOOLEAN, NESTED = {"date"}, {"boolean"}, {"nested"}


#: Errors of a refused plan that are listed.
REPORTED = 50


class PlanRejected(ValueError):
    """A plan with values that the target would not take; `errors` holds the first of them."""

    def __init__(self, errors: list[str]) -> None:
        self.errors = errors
        super().__init__(f"{len(errors)} errors (at most {REPORTED} are listed): " + "; ".join(errors))


@dataclass(frozen=True)
class TargetField:
    field: str
    type: str
    full_path: str
    is_array: bool = False
    format: str = ""


#: Target types of the kinds of value in a document (fixed values); mixed lists and nulls have none of their own.
DESCRIBED = {
    "BIGINT": "long", "DOUBLE": "double", "FLOAT": "double", "DECIMAL": "double", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "date",
    "TIMESTAMP_NTZ": "date", "OBJECT": "object", "STRING": "keyword", "BINARY": "binary", "VOID": "", "VARIANT": "",
}
PATHS = pa.schema([("field", pa.string()), ("type", pa.string()), ("full_path", pa.string()), ("is_array", pa.bool_())])


def type_name(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.IntegralType):
        return "long"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "double"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "date"
    return "object" if isinstance(kind, (T.StructType, T.MapType)) else "keyword"


def flatten_schema(schema: T.StructType, prefix: str = "", skip: frozenset[str] = frozenset()) -> list[TargetField]:
    """One entry for each property with its dotted path; objects get one too; skipped names are left out with all below."""
    out = []
    for f in schema.fields:
        if f.name in skip:
            continue
        inner, is_array = f.dataType, False
        while isinstance(inner, T.ArrayType):
            inner, is_array = inner.elementType, True
        path = f"{prefix}{f.name}"
        out.append(TargetField(f.name, type_name(inner), path, is_array))
        if isinstance(inner, T.StructType):
            out += flatten_schema(inner, f"{path}.", skip)
    return out


#: The parts of a described schema: a quoted name, a bracket or mark, or a plain name or type.
_PARTS = re.compile(r"`(?:[^`]|``)*`|[<>,:]|[^<>,:`\s(]+(?:\([^)]*\))?")


def described_fields(text: str) -> list[TargetField]:
    """The fields of a schema as `schema_of_variant` writes it, such as OBJECT<a: ARRAY<BIGINT>>."""
    parts, at, out = _PARTS.findall(text), 0, []

    def value(prefix: str, field: str, is_array: bool) -> None:
        nonlocal at
        kind = parts[at].split("(")[0]
        at += 1
        if kind == "ARRAY":
            at += 1
            value(prefix, field, True)
            at += 1
            return
        if field:
            out.append(TargetField(field, DESCRIBED.get(kind, "keyword"), prefix[:-1], is_array))
        if kind == "OBJECT":
            at += 1
            while parts[at] != ">":
                name = parts[at][1:-1].replace("``", "`") if parts[at][0] == "`" else parts[at]
                at += 2
                value(f"{prefix}{name}.", name, False)
                at += parts[at] == ","
            at += 1

    value("", "", False)
    return out


def document_paths(docs: DataFrame, sample: int | None = None) -> DataFrame:
    """field, type, full_path, is_array of every kind of value that any document holds; docs: a JSON text column named doc.

    Each document's schema is a text made in the JVM; equal ones meet by a partial aggregate, and only distinct ones are
    taken apart. A path that holds values of several kinds has a row for each. Texts that are no JSON object count for nothing;
    a null value gives the type ''. sample: only that many documents.
    """
    some = docs.select("doc") if sample is None else docs.select("doc").limit(sample)
    kinds = some.select(F.schema_of_variant(F.try_parse_json("doc")).alias("kind")).filter(F.col("kind").startswith("OBJECT")).distinct()

    def paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {f for text in batch.column("kind").to_pylist() for f in described_fields(text)}
            yield pa.RecordBatch.from_pylist([{"field": f.field, "type": f.type, "full_path": f.full_path, "is_array": f.is_array} for f in found], PATHS)

    return kinds.mapInArrow(paths, "field string, type string, full_path string, is_array boolean").distinct()


def detect_arrays(docs: DataFrame, sample: int | None = None) -> list[str]:
    """Dotted paths that are a list in any document of a JSON text column named doc. sample: look only at that many documents."""
    return sorted(r[0] for r in document_paths(docs, sample).filter("is_array").select("full_path").distinct().collect())


def infer_document_schema(docs: DataFrame, sample: int | None = None) -> DataFrame:
    """field, type, format, full_path, is_array of the paths of JSON documents, from their values.

    Whole and broken numbers are double; other values of several kinds give all of them, such as double|keyword, for a person to
    settle; only nulls give keyword. A path is a list where it is one in any document.
    """
    kinds = F.array_sort(F.collect_set(F.nullif("type", F.lit(""))))
    kinds = F.when(F.array_contains(kinds, "double"), F.array_remove(kinds, "long")).otherwise(kinds)
    found = document_paths(docs, sample).groupBy("field", "full_path").agg(kinds.alias("kinds"), F.bool_or("is_array").cast("string").alias("is_array"))
    kind = F.when(F.size("kinds") == 0, "keyword").otherwise(F.array_join("kinds", "|"))
    return found.select("field", kind.alias("type"), F.lit("").alias("format"), "full_path", "is_array")


def infer_target_schema(docs: DataFrame) -> DataFrame:
    """field, type, format, full_path, is_array of the fields of a typed table of documents."""
    rows = [(f.field, f.type, f.format, f.full_path, str(f.is_array).lower()) for f in flatten_schema(docs.schema)]
    return docs.sparkSession.createDataFrame(rows, "field string, type string, format string, full_path string, is_array string")


def _accepts(kind: str, value: T.DataType) -> bool:
    if kind not in TEXT | INTEGER | DECIMAL | DATE | BOOLEAN | NESTED:
        return True  # objects and types that are not known are taken as they are
    if isinstance(value, T.BooleanType) or kind in BOOLEAN:
        return isinstance(value, T.BooleanType) and kind in BOOLEAN
    if kind in INTEGER:
        return isinstance(value, T.IntegralType)
    if kind in DECIMAL:
        return isinstance(value, T.NumericType)
    if kind in DATE:
        return isinstance(value, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.IntegralType))
    if kind in TEXT:
        return isinstance(value, T.StringType)
    return isinstance(value, (T.StructType, T.MapType))


def _element_error(position: Column, name: str) -> Column:
    text = F.concat(F.lit("element "), position.cast("string"), F.lit(": wrong type"))
    return F.when(position.isNotNull(), F.array(F.struct(F.lit(name).alias("field"), text.alias("error"))))


def validate(rows: DataFrame, schema: Mapping[str, TargetField], id_col: str = "id") -> DataFrame:
    """id, field, error: a field that is unknown, a type that does not fit, a list on a scalar, the first bad element of a list by its index.

    Spark's columns have one type, so the type rules are settled when the plan is made and rows decide only by nullness;
    nulls are valid, objects and unknown target types too, and any text is taken for a date.
    """
    errors = []
    for f in rows.schema.fields:
        if f.name == id_col:
            continue
        x, target = F.col(f"`{f.name}`"), schema.get(f.name)

        def error(text, cond, name=f.name):
            return F.when(cond, F.array(F.struct(F.lit(name).alias("field"), F.lit(text).alias("error"))))

        if target is None:
            errors.append(error("not in schema", x.isNotNull()))
        elif target.type in ("", "object"):
            continue
        elif isinstance(f.dataType, T.ArrayType):
            if not target.is_array:
                errors.append(error("list on a scalar", x.isNotNull()))
            elif not _accepts(target.type, f.dataType.elementType):
                bad = F.filter(F.transform(x, lambda v, i: F.when(v.isNotNull(), i)), lambda i: i.isNotNull())
                errors.append(_element_error(F.get(bad, F.lit(0)), f.name))
        elif not _accepts(target.type, f.dataType):
            errors.append(error("boolean on " + target.type if isinstance(f.dataType, T.BooleanType) else "wrong type", x.isNotNull()))
    empty = F.array().cast("array<struct<field:string,error:string>>")
    found = F.concat(*[F.coalesce(e, empty) for e in errors]) if errors else empty
    return rows.select(F.col(id_col).cast("string").alias("id"), F.inline(found))


def validate_plan(rows: DataFrame, schema: Mapping[str, TargetField], id_col: str = "id", report: int = REPORTED) -> None:
    """Raise PlanRejected with the first errors, by id and field, when any planned value does not fit."""
    found = validate(rows, schema, id_col).orderBy("id", "field").limit(report).collect()
    if found:
        raise PlanRejected([f"{e['id']}.{e['field']}: {e['error']}" for e in found])
