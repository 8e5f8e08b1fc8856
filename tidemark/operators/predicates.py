"""FLT-2..FLT-7: a document filter, given as a JSON spec, as one boolean Column.

Comparisons match only values of the literal's own kind, and an array field
matches when any element does, as a document database has it. On typed columns
the result is made of plain comparisons, which reach the Parquet scan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calculated import quote
from tidemark.functions.jsontext import nested_json
from tidemark.functions.literals import bound

# The comparison operators a filter may use.
COMPARISONS = {
    "$eq": lambda c, v: c == v,
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
}
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def document_filter(
    df: DataFrame, spec: str | Mapping[str, Any], variant: str | None = None
) -> DataFrame:
    """Rows of ``df`` that match. ``variant`` names a VARIANT column that holds the
    whole document; without it, fields are columns of ``df``."""
    return df.filter(filter_condition(df.schema, spec, variant))


def filter_condition(
    schema: T.StructType, spec: str | Mapping[str, Any], variant: str | None = None
) -> Column:
    """The document is bound by a lambda: Spark writes out what a column is made of at each mention
    of it in a filter, so a document that is parsed would be parsed again for each."""
    spec = json.loads(spec) if isinstance(spec, str) else spec
    if variant is None:
        return _condition(schema, spec, None)
    return bound(F.col(quote(variant)), lambda document: _condition(schema, spec, document))


def _condition(schema: T.StructType, spec: Mapping[str, Any], variant: Column | None) -> Column:
    parts = []
    for key, wanted in spec.items():
        if key in ("$and", "$or"):
            inner = [_condition(schema, json.loads(one) if isinstance(one, str) else one, variant) for one in wanted]
            parts.append(reduce((lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b), inner))
        elif key.startswith("$"):
            raise ValueError(f"unsupported filter operator: {key}")
        else:
            parts.append(_field_condition(schema, key, wanted, variant))
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def split_filter(spec: str | Mapping[str, Any]) -> tuple[dict[str, Any], dict[str, Any]]:
    """A filter as the part that a document database answers alike, and the rest; both must hold.

    Left to Spark are: texts that may be the hexadecimal form of an id (which the database holds as
    ids), order of texts, moments (which documents may hold as text), patterns (another dialect),
    objects and lists (the database minds the order of keys), ids, and paths with numbers.
    """
    spec = json.loads(spec) if isinstance(spec, str) else spec
    filter_condition(T.StructType([]), spec)  # refuses what no part could answer
    pushed, rest = [], []
    for key, wanted in spec.items():
        if key == "$and":
            for one in wanted:
                inside, left = split_filter(one)
                pushed += [inside] if inside else []
                rest += [left] if left else []
        elif key == "$or":
            whole = all(not split_filter(one)[1] for one in wanted)
            (pushed if whole else rest).append({key: wanted})
        else:
            operators = isinstance(wanted, Mapping) and any(k.startswith("$") for k in wanted) and "$date" not in wanted
            for op, value in (wanted if operators else {"$eq": wanted}).items():
                (pushed if _answers_alike(key, op, value) else rest).append({key: {op: value}})
    return _all_of(pushed), _all_of(rest)


def _all_of(parts: list[dict[str, Any]]) -> dict[str, Any]:
    return {"$and": parts} if len(parts) > 1 else dict(*parts)


ID_TEXT = re.compile("[0-9a-f]{24}", re.IGNORECASE)


def _answers_alike(path: str, op: str, value: Any) -> bool:
    steps = path.split(".")
    if "_id" in steps or any(step.isdigit() for step in steps):
        return False
    if op == "$in":
        return all(_answers_alike(path, "$eq", v) for v in value)
    if isinstance(value, str):
        return op == "$eq" and not ID_TEXT.fullmatch(value)
    return op in COMPARISONS and (value is None or isinstance(value, (bool, int, float)))


def fields_of(spec: str | Mapping[str, Any]) -> set[str]:
    """The paths that a filter looks at."""
    spec = json.loads(spec) if isinstance(spec, str) else spec
    found: set[str] = set()
    for key, wanted in spec.items():
        found |= set().union(*map(fields_of, wanted)) if key in ("$and", "$or") else {key}
    return found


def _field_condition(schema, path: str, wanted: Any, variant: Column | None) -> Column:
    operators = isinstance(wanted, Mapping) and any(k.startswith("$") for k in wanted)
    tests = wanted if operators and "$date" not in wanted else {"$eq": wanted}
    return reduce(
        lambda a, b: a & b,
        [_test(schema, path, op, value, variant) for op, value in tests.items()],
    )


def _test(schema, path: str, op: str, value: Any, variant: Column | None) -> Column:
    if op == "$in":
        return _membership(schema, path, value, variant)
    if op == "$regex":
        return _match(schema, path, value, lambda c, v: c.rlike(value), variant)
    if op not in COMPARISONS:
        raise ValueError(f"unsupported filter operator: {op}")
    if value is None:
        return _missing(schema, path, variant)
    if _is_nested(value):
        if op != "$eq":
            raise ValueError(f"{op} compares no objects or lists")
        return _equals_nested(schema, path, value, variant)
    return _match(schema, path, value, COMPARISONS[op], variant)


def _membership(schema, path: str, values: list[Any], variant: Column | None) -> Column:
    field = None if variant is not None else _resolve(schema, path)
    plain = None not in values and not any(map(_is_nested, values))
    if field and not isinstance(field[1], T.VariantType) and plain:
        c, dtype = field
        element = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        usable = [_literal(v, element) for v in values if _same_kind(v, element)]
        if not usable:
            return F.lit(False)
        if isinstance(dtype, T.ArrayType):
            return F.coalesce(F.arrays_overlap(c, F.array(*usable)), F.lit(False))
        return c.isin(*usable)
    if plain and values:
        if variant is not None:
            return _match_variant(variant, path, values, COMPARISONS["$eq"])
        if field and isinstance(field[1], T.VariantType):
            return _match_variant(field[0], "", values, COMPARISONS["$eq"])
    tests = [_test(schema, path, "$eq", v, variant) for v in values]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def _match(schema, path: str, value: Any, compare, variant: Column | None) -> Column:
    if variant is not None:
        return _match_variant(variant, path, [value], compare)
    field = _resolve(schema, path)
    if field is None:
        return F.lit(False)
    c, dtype = field
    if isinstance(dtype, T.VariantType):
        return _match_variant(c, "", [value], compare)
    if isinstance(dtype, T.ArrayType):
        if not _same_kind(value, dtype.elementType):
            return F.lit(False)
        literal = _literal(value, dtype.elementType)
        return F.coalesce(F.exists(c, lambda x: compare(x, literal)), F.lit(False))
    if not _same_kind(value, dtype):
        return F.lit(False)
    return compare(c, _literal(value, dtype))


def _missing(schema, path: str, variant: Column | None) -> Column:
    if variant is not None:
        return bound(F.try_variant_get(variant, _json_path(path), "variant"), lambda found: found.isNull() | F.is_variant_null(found))
    field = _resolve(schema, path)
    return F.lit(True) if field is None else field[0].isNull()


def _match_variant(doc: Column, path: str, values: list[Any], compare) -> Column:
    """Whether the field compares so with any of the values, or an element of it does."""

    def any_value(item: Column) -> Column:
        kinds = F.schema_of_variant(item)
        return bound(kinds, lambda kind: reduce(lambda a, b: a | b, [_match_item(item, kind, v, compare) for v in values]))

    def matches(found: Column) -> Column:
        items = F.try_variant_get(found, "$", "array<variant>")
        return bound(items, lambda x: F.when(x.isNotNull(), F.exists(x, any_value)).otherwise(any_value(found)))

    return F.coalesce(bound(F.try_variant_get(doc, _json_path(path), "variant"), matches), F.lit(False))


def _match_item(item: Column, kind: Column, value: Any, compare) -> Column:
    """Compare one value of a document, of this type; null when it is of another kind."""
    if isinstance(value, bool):
        return F.when(kind == "BOOLEAN", compare(F.try_variant_get(item, "$", "boolean"), F.lit(value)))
    if isinstance(value, (int, float)):
        inexact = compare(F.try_variant_get(item, "$", "double"), F.lit(float(value)))
        exact = inexact
        number = Decimal(repr(value)) if isinstance(value, float) else Decimal(value)
        # A double would take 64-bit ids next to each other for one.
        if number.is_finite() and abs(number) < Decimal(10) ** 28 and number == round(number, 9):
            literal = F.lit(str(number)).cast("decimal(38,9)")
            exact = compare(F.try_variant_get(item, "$", "decimal(38,9)"), literal)
        return F.when(kind.rlike("^(BIGINT|DECIMAL)"), F.coalesce(exact, inexact)).when(
            kind.rlike("^(DOUBLE|FLOAT)"), inexact
        )
    if isinstance(value, Mapping):
        moment = F.lit(value["$date"]).cast("timestamp")
        wrapped = F.try_variant_get(item, '$["$date"]', "timestamp")
        return F.when(kind.startswith("OBJECT"), compare(wrapped, moment)).when(
            kind.rlike("^(STRING|TIMESTAMP|DATE)"), compare(F.try_variant_get(item, "$", "timestamp"), moment)
        )
    return F.when(kind == "STRING", compare(F.try_variant_get(item, "$", "string"), F.lit(value)))


def _is_nested(value: Any) -> bool:
    return isinstance(value, list) or isinstance(value, Mapping) and "$date" not in value


def _equals_nested(schema, path: str, value: Any, variant: Column | None) -> Column:
    """A field that equals an object or a list as a whole, or holds it as an element.

    Both sides are compared as canonical JSON, in which the order of keys does not matter.
    """
    wanted = F.to_json(F.parse_json(F.lit(json.dumps(value))))
    if variant is not None:
        found = F.try_variant_get(variant, _json_path(path), "variant")
    else:
        field = _resolve(schema, path)
        if field is None:
            return F.lit(False)
        c, dtype = field
        if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            element = F.exists(c, lambda x: nested_json(x, dtype.elementType) == wanted)
            return F.coalesce((nested_json(c, dtype) == wanted) | element, F.lit(False))
        if not isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            return F.lit(False)
        if not isinstance(dtype, T.VariantType):
            return F.coalesce(nested_json(c, dtype) == wanted, F.lit(False))
        found = c

    def equal(found: Column) -> Column:
        items = F.try_variant_get(found, "$", "array<variant>")
        inside = F.coalesce(F.exists(items, lambda x: F.to_json(x) == wanted), F.lit(False))
        return F.coalesce(F.to_json(found) == wanted, F.lit(False)) | inside

    return bound(found, equal)


def _json_path(path: str) -> str:
    return "$" + "".join(f"[{json.dumps(step)}]" for step in path.split(".") if path)


def _resolve(schema: T.StructType, path: str) -> tuple[Column, T.DataType] | None:
    head, *rest = path.split(".")
    if head not in schema.fieldNames():
        return None
    c, dtype = F.col(quote(head)), schema[head].dataType
    for i, step in enumerate(rest):
        if isinstance(dtype, T.VariantType):
            return F.try_variant_get(c, _json_path(".".join(rest[i:])), "variant"), dtype
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        if not isinstance(inner, T.StructType) or step not in inner.fieldNames():
            return None
        field_type = inner[step].dataType
        if isinstance(dtype, T.ArrayType):
            if isinstance(field_type, T.ArrayType):
                c, dtype = F.flatten(c.getField(step)), field_type
            else:
                c, dtype = c.getField(step), T.ArrayType(field_type)
        else:
            c, dtype = c.getField(step), field_type
    return c, dtype


def _same_kind(value: Any, dtype: T.DataType) -> bool:
    if isinstance(value, bool):
        return isinstance(dtype, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(dtype, T.NumericType)
    if isinstance(value, Mapping):
        return "$date" in value and isinstance(dtype, TIMES)
    return isinstance(dtype, T.StringType)


def _literal(value: Any, dtype: T.DataType) -> Column:
    if isinstance(value, Mapping):
        # The text carries its zone; without one it is UTC, as the session is.
        return F.lit(value["$date"]).cast("timestamp").cast(dtype)
    return F.lit(value)
