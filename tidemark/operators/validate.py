"""VAL-1..VAL-11: coerce every column to the destination, then split off bad records.

All decisions that depend on types are taken on the driver while the columns are
built. At run time a plain string costs two prefix tests; only text that starts
with a bracket is parsed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calculated import quote
from tidemark.functions.jsontext import IS_BRACKETED, PARSED, nested_json, quoted, sanitise
from tidemark.functions.literals import IS_LITERAL, ITEMS, bind_sql
from tidemark.functions.text import WHITESPACE, nul, plain_text, strip
from tidemark.operators.nested import lost, rebuilt
from tidemark.operators.schema import SPARK_TYPES, FieldSpec

REASON, LONG = "_reject_reason", "_may_exceed"
TOO_LONG = "Record exceeds the size limit"
COERCED_GROWTH = 20  # a literal gains quotes, then both are escaped in the record
MAX_CHARACTERS = 100 * 1024 * 1024
NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def coerce(
    df: DataFrame,
    schema: Mapping[str, FieldSpec] | None = None,
    array_literals: str = "all",
    text_times: bool = False,
) -> DataFrame:
    """VAL-1..VAL-9 on every column, in one projection.

    ``array_literals='repeated_only'`` leaves ``{a,b}`` alone in columns that are
    neither REPEATED nor JSON.
    """
    return df.select(*coerced_columns(df, schema or {}, array_literals, text_times))


def coerced_columns(
    df: DataFrame,
    schema: Mapping[str, FieldSpec],
    array_literals: str = "all",
    text_times: bool = False,
) -> list[Column]:
    return [
        coerce_column(
            F.col(quote(f.name)), f.dataType, schema.get(f.name), array_literals, text_times
        ).alias(f.name)
        for f in df.schema
    ]


def coerce_column(
    c: Column,
    dtype: T.DataType,
    spec: FieldSpec | None,
    array_literals: str = "all",
    text_times: bool = False,
) -> Column:
    if spec is None:
        return _unknown(c, dtype, array_literals, text_times)
    if spec.type == "RECORD":
        if spec.mode == "REPEATED" and not isinstance(dtype, T.ArrayType):
            c, dtype = _listed(c), T.ArrayType(dtype)
        return sanitise(c, dtype, text_times)
    if spec.type == "JSON":
        return _json_list(c, dtype) if spec.mode == "REPEATED" else _json_value(c, dtype)
    if spec.mode == "REPEATED":
        return _scalar_list(c, dtype, text_times)
    if spec.type == "BYTES" and isinstance(dtype, T.BinaryType):
        return c
    if isinstance(dtype, T.StringType):
        return sanitise(_text_of_parsed(c, array_literals), dtype)
    if isinstance(dtype, NESTED):
        return nested_json(c, dtype)
    return sanitise(c, dtype, text_times)


def _unknown(c: Column, dtype: T.DataType, array_literals: str, text_times: bool) -> Column:
    """VAL-8: parsed text goes back to compact text, native nesting stays."""
    if isinstance(dtype, T.StringType):
        return sanitise(_text_of_parsed(c, array_literals), dtype)
    if isinstance(dtype, T.VariantType):
        return c
    return sanitise(c, dtype, text_times)


def _starts_bracketed(c: Column) -> Column:
    """Cheap for text without brackets, and never looks past the first character."""
    s = F.ltrim(c, F.lit(WHITESPACE))
    return (c.contains("{") | c.contains("[")) & (s.startswith("{") | s.startswith("["))


def _parsed(c: Column, body: str) -> Column:
    """SQL ``body`` over the stripped text ``s`` where the text starts with a bracket."""
    return F.when(_starts_bracketed(c), bind_sql(strip(c), body))


def _text_of_parsed(c: Column, array_literals: str) -> Column:
    """VAL-2, VAL-3, VAL-6: literals and JSON as compact JSON text, other text as it is."""
    literal = f"WHEN {IS_LITERAL} THEN coalesce(to_json({ITEMS}), s)" if array_literals == "all" else ""
    return F.coalesce(_parsed(c, f"CASE {literal} WHEN {IS_BRACKETED} THEN to_json({PARSED}) END"), c)


JSON_TEXT = f"coalesce(CASE WHEN {IS_LITERAL} THEN to_json({ITEMS}) END, to_json({PARSED}))"


def _json_value(c: Column, dtype: T.DataType) -> Column:
    """VAL-5: one JSON value as canonical text."""
    if isinstance(dtype, NESTED):
        return nested_json(c, dtype)
    if not isinstance(dtype, T.StringType):
        return quoted(sanitise(c, dtype, text_times=True))
    return F.coalesce(_parsed(c, JSON_TEXT), quoted(sanitise(c, dtype)))


def _json_list(c: Column, dtype: T.DataType) -> Column:
    """VAL-4 for JSON: a list of JSON texts; null becomes an empty list."""
    if isinstance(dtype, T.ArrayType):
        listed = F.transform(c, lambda x: _json_value(x, dtype.elementType))
    elif isinstance(dtype, T.StringType):
        items = F.transform(
            _parsed(c, f"CASE WHEN {IS_LITERAL} THEN {ITEMS} END"),
            lambda x: _json_value(x, T.StringType()),
        )

        def element(x: Column) -> Column:
            text = _json_value(F.try_variant_get(x, "$", "string"), T.StringType())
            return F.when(F.schema_of_variant(x) == "STRING", text).otherwise(F.to_json(x))

        elements = F.transform(_parsed(c, LIST_OF_JSON), element)
        listed = F.coalesce(items, elements, _listed(_json_value(c, dtype)))
    else:
        listed = _listed(_json_value(c, dtype))
    return F.coalesce(listed, F.array().cast("array<string>"))


LIST_OF_JSON = f"""CASE WHEN NOT ({IS_LITERAL}) AND {IS_BRACKETED}
    THEN try_variant_get({PARSED}, '$', 'array<variant>') END"""


def _scalar_list(c: Column, dtype: T.DataType, text_times: bool) -> Column:
    """VAL-4, VAL-6 per element: a list of scalars; null stays null."""
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, NESTED):
            return F.transform(c, lambda x: nested_json(x, dtype.elementType))
        return sanitise(c, dtype, text_times)
    if not isinstance(dtype, T.StringType):
        if isinstance(dtype, NESTED):
            return _listed(nested_json(c, dtype))
        return _listed(sanitise(c, dtype, text_times))
    return F.coalesce(_parsed(c, SCALARS), _listed(sanitise(c, dtype)))


SCALARS = f"""CASE WHEN {IS_LITERAL} THEN coalesce({ITEMS}, array(s))
    WHEN {IS_BRACKETED} THEN transform(array({PARSED}), v -> coalesce(
        transform(try_variant_get(v, '$', 'array<variant>'), x -> CASE schema_of_variant(x)
            WHEN 'STRING' THEN try_variant_get(x, '$', 'string')
            WHEN 'VOID' THEN NULL ELSE to_json(x) END),
        CASE WHEN v IS NOT NULL THEN array(to_json(v)) END))[0] END"""


def _listed(c: Column) -> Column:
    return F.when(c.isNotNull(), F.array(c))


def json_length(names: Iterable[str]) -> Column:
    """Characters of the record as compact JSON text."""
    record = F.struct(*(F.col(quote(n)) for n in names))
    return F.length(F.to_json(record, {"ignoreNullFields": "false"}))


def reject_reason(df: DataFrame, limit: int = MAX_CHARACTERS) -> Column:
    """VAL-10: why the record cannot be loaded; null when it can."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    has_nul = _any(F.col(quote(n)).contains(nul()) for n in texts)
    too_long = F.when(may_exceed(df.schema, limit, 6), json_length(df.columns) > limit)
    return F.when(has_nul, "Record contains null bytes").when(too_long, TOO_LONG)


def may_exceed(schema: T.StructType, limit: int, growth: int) -> Column:
    """False when the record as JSON is surely shorter than the limit.

    Writing the record out only to measure it costs more than everything else, so
    it is done only for records whose texts are long enough. ``growth`` bounds the
    characters that one character can become: six when it is escaped.
    """
    fixed, parts = 2, []
    for f in schema:
        size = most_characters(F.col(quote(f.name)), f.dataType, growth)
        fixed += 6 * len(f.name) + 6
        if isinstance(size, int):
            fixed += size
        else:
            parts.append(size)
    return reduce(lambda a, b: a + b, parts, F.lit(fixed).cast("bigint")) > limit


def most_characters(c: Column, dtype: T.DataType, growth: int) -> Column | int:
    """The most characters a value can take as JSON: a number where the type alone says it, else
    from the lengths of its texts, wherever they are nested."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return growth * F.coalesce(F.length(c).cast("bigint"), F.lit(1)) + 20
    if isinstance(dtype, T.StructType):
        sizes = [most_characters(c.getField(f.name), f.dataType, growth) for f in dtype]
        fixed = 8 + sum(6 * len(f.name) + 6 for f in dtype) + sum(s for s in sizes if isinstance(s, int))
        measured = [s for s in sizes if not isinstance(s, int)]
        return reduce(lambda a, b: a + b, measured, F.lit(fixed).cast("bigint")) if measured else fixed
    if isinstance(dtype, T.ArrayType):
        return _most_listed(c, dtype.elementType, growth)
    if isinstance(dtype, T.MapType):
        return _most_listed(F.map_keys(c), dtype.keyType, growth) + _most_listed(F.map_values(c), dtype.valueType, growth)
    if isinstance(dtype, T.VariantType):
        return growth * F.coalesce(F.length(F.to_json(c)).cast("bigint"), F.lit(1)) + 20
    return 64


def _most_listed(items: Column, dtype: T.DataType, growth: int) -> Column:
    of_one = most_characters(F.lit(None), dtype, growth) if not isinstance(dtype, T.StructType) else None
    if isinstance(of_one, int):
        total = F.size(items).cast("bigint") * (of_one + 2)
    else:
        start = F.lit(0).cast("bigint")
        total = F.aggregate(items, start, lambda sum_, x: sum_ + F.lit(2) + most_characters(x, dtype, growth))
    return F.greatest(F.coalesce(total, F.lit(0).cast("bigint")), F.lit(0).cast("bigint")) + 20


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def conform(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Cast columns to the destination's types, nested values by field name.

    A value lost in its cast gives the record a ``_reject_reason`` that quotes it,
    unless the record has a reason already.
    """
    columns, reasons = [], [F.col(REASON)] if REASON in df.columns else []
    for f in df.schema:
        if f.name == REASON:
            continue
        c, target = F.col(quote(f.name)), types.get(f.name, f.dataType)
        if target == f.dataType:
            columns.append(c)
            continue
        value = rebuilt(c, f.dataType, target, _cast)
        columns.append(value.alias(f.name))
        is_lost = lost(c, value, f.dataType, target)
        if is_lost is None:
            continue
        why = F.lit(f"{f.name} does not fit {target.simpleString()}: ")
        reasons.append(F.when(is_lost, F.concat(why, plain_text(c, f.dataType))))
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    return df.select(*columns, reason.alias(REASON))


def spark_types(schema: Mapping[str, FieldSpec]) -> dict[str, T.DataType]:
    """The Spark types of a destination schema; a RECORD keeps the type it has."""
    known = {n: (SPARK_TYPES[s.type], s.mode) for n, s in schema.items() if s.type in SPARK_TYPES}
    return {n: T.ArrayType(t) if mode == "REPEATED" else t for n, (t, mode) in known.items()}


def _cast(c: Column, dtype: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.BinaryType) and isinstance(dtype, T.StringType):
        return F.try_to_binary(c, F.lit("base64"))
    if isinstance(target, T.TimestampNTZType) and isinstance(dtype, T.StringType):
        # Text may carry a zone; the session's UTC applies when it does not.
        return c.try_cast("timestamp").cast(target)
    return c.try_cast(target)


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """VAL-11: the records to load, and the others with the reason."""
    return (
        flagged.filter(F.col(REASON).isNull()).drop(REASON),
        flagged.filter(F.col(REASON).isNotNull()),
    )


def validate(
    df: DataFrame,
    schema: Mapping[str, FieldSpec] | None = None,
    array_literals: str = "all",
    limit: int | None = MAX_CHARACTERS,
    require: bool = False,
    typed: bool = False,
) -> DataFrame:
    """Coerced records with ``_reject_reason``; ``split`` separates the two kinds.

    ``require`` also rejects nulls in REQUIRED columns, ``typed`` casts to the
    destination's types and rejects what does not fit; no ``limit`` means any length. Whatever can be decided on
    the source columns is, so that a filter on the reason does not coerce twice.
    """
    schema = schema or {}
    required = [n for n, s in schema.items() if s.mode == "REQUIRED" and n in df.columns]
    absent = [
        F.when(F.col(quote(n)).isNull(), f"Required field {n} is null")
        for n in (required if require else ())
    ]
    long = F.lit(False) if limit is None else may_exceed(df.schema, limit, COERCED_GROWTH)
    checked = df.select(
        "*",
        long.alias(LONG),
        (F.coalesce(*absent) if absent else F.lit(None).cast("string")).alias(REASON),
    )
    coerced = checked.select(*coerced_columns(df, schema, array_literals), LONG, REASON)
    reason = F.col(REASON)
    if limit is not None:
        too_long = F.when(F.col(LONG), json_length(df.columns) > limit)
        reason = F.when(too_long, TOO_LONG).otherwise(reason)
    flagged = coerced.withColumn(REASON, reason).drop(LONG)
    return conform(flagged, spark_types(schema)) if typed else flagged
