"""TRF-1..TRF-19: configured transformations with per-record error fallback.

Each section is one ``select`` over the frame before it. The optimizer merges
them into a single projection where that does not repeat work.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import TransformSpec
from tidemark.functions import convert as conv
from tidemark.functions.calculated import calculate, quote
from tidemark.functions.jsontext import parse, variant_text
from tidemark.functions.text import plain_text
from tidemark.functions.values import apply_value_rule
from tidemark.operators.union import as_type, common_type

ERROR = "_transformation_error"
ORIGINAL = "_original_record"
KEPT = "_keep_original"


@dataclass(frozen=True)
class Transformed:
    """One frame holding every record once: transformed columns, the error text
    and, for failed records only, the original columns as a struct."""

    frame: DataFrame

    def ok(self) -> DataFrame:
        return self.frame.filter(F.col(ERROR).isNull()).drop(ERROR, ORIGINAL)

    def errors(self) -> DataFrame:
        """Failed records with their original values and the error."""
        return self.frame.filter(F.col(ERROR).isNotNull()).select(f"{ORIGINAL}.*", ERROR)

    def merged(self, keep_types: bool = False) -> DataFrame:
        """Both kinds in one frame and one pass, failed records with their original values.

        Where a conversion changed a column's type the two are reconciled to one
        that holds both. ``keep_types`` keeps the converted type, for a table that
        has it; an original value that does not fit is then null in its column and
        quoted in the error.
        """
        new = {f.name: f.dataType for f in self.frame.schema if f.name not in (ERROR, ORIGINAL)}
        old = {f.name: f.dataType for f in self.frame.schema[ORIGINAL].dataType}
        failed = F.col(ERROR).isNotNull()
        columns = []
        for name in [*new, *(n for n in old if n not in new)]:
            found = [types[name] for types in (new, old) if name in types]
            target = found[0] if keep_types else common_type(found)
            after = as_type(F.col(quote(name)), new[name], target) if name in new else F.lit(None)
            before = F.lit(None)
            if name in old:
                original = F.col(ORIGINAL).getField(name)
                if keep_types and old[name] != target:
                    before = original.try_cast(target) if _castable(old[name], target) else before
                else:
                    before = as_type(original, old[name], target)
            columns.append(F.when(failed, before).otherwise(after).alias(name))
        return self.frame.select(*columns, ERROR)


def _castable(*types: T.DataType) -> bool:
    return all(isinstance(t, (T.AtomicType, T.NullType)) for t in types)


def rename_fields(df: DataFrame, mappings: dict[str, str]) -> DataFrame:
    """TRF-1: renames in order; a missing source is ignored, an existing target replaced."""
    source = {name: name for name in df.columns}
    for old, new in mappings.items():
        if old in source:
            source[new] = source.pop(old)
    return df.select(*(F.col(quote(old)).alias(new) for new, old in source.items()))


def flatten_nested(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """TRF-19: dotted paths of structs, VARIANT or JSON text become own columns."""
    return _with(df, {new: nested_value(df, path) for path, new in paths.items()})


def nested_value(df: DataFrame, path: str) -> Column:
    head, *rest = path.split(".")
    types = {f.name: f.dataType for f in df.schema}
    if head not in types:
        return F.lit(None).cast("string")
    c, dtype = F.col(quote(head)), types[head]
    while rest and isinstance(dtype, T.StructType):
        name = rest.pop(0)
        if name not in dtype.fieldNames():
            return F.lit(None).cast("string")
        c, dtype = c.getField(name), dtype[name].dataType
    if not rest:
        return c
    if isinstance(dtype, T.StringType):
        c, dtype = parse(c), T.VariantType()
    if isinstance(dtype, T.VariantType):
        steps = "".join(f"[{json.dumps(step)}]" for step in rest)
        return variant_text(F.try_variant_get(c, f"${steps}", "variant"))
    return F.lit(None).cast("string")


def fill_defaults(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    """TRF-18: a constant where the value is null, or a new column of it."""
    types = {f.name: f.dataType for f in df.schema}
    filled = {}
    for name, value in defaults.items():
        constant = F.lit(value)
        if name in types:
            c = F.col(quote(name))
            constant = F.coalesce(c, constant.try_cast(types[name]))
        filled[name] = constant
    return _with(df, filled)


def transform(df: DataFrame, spec: TransformSpec, keep: Column | None = None) -> Transformed:
    """All sections in order. Original columns are kept of records that fail, and where ``keep`` is true."""
    kept, keep = F.struct("*"), F.lit(False) if keep is None else keep
    if spec.is_empty():
        no_error = F.lit(None).cast("string").alias(ERROR)
        return Transformed(df.select("*", no_error, F.when(keep, kept).alias(ORIGINAL)))
    work = df.select("*", kept.alias(ORIGINAL), keep.alias(KEPT))
    work = rename_fields(work, dict(spec.field_mappings))
    if spec.flatten_nested:
        work = flatten_nested(work, dict(spec.flatten_nested))
    work = _convert_types(work, spec)
    if spec.default_values:
        work = fill_defaults(work, dict(spec.default_values))
    if spec.value_transformations:
        types = {f.name: f.dataType for f in work.schema}
        work = _with(
            work,
            {
                name: apply_value_rule(F.col(quote(name)), types[name], rule)
                for name, rule in spec.value_transformations.items()
                if name in types
            },
        )
    for name, expression in spec.calculated_fields.items():
        work = _with(work, {name: calculate(expression, work.schema)})
    failed = F.col(ERROR).isNotNull()
    return Transformed(work.withColumn(ORIGINAL, F.when(failed | F.col(KEPT), F.col(ORIGINAL))).drop(KEPT))


def _convert_types(df: DataFrame, spec: TransformSpec) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    converted, messages = {}, []
    for name, wanted in spec.type_conversions.items():
        target = conv.target_of(wanted)
        if name not in types or target is None:
            continue
        c = F.col(quote(name))
        converted[name], failed = conv.convert(c, types[name], target, spec.iso_text)
        if failed is not None:
            shown = plain_text(c, types[name])
            text = F.concat(F.lit(f"cannot convert {name} to {target}: "), shown)
            messages.append(F.when(failed, text))
    error = F.coalesce(*messages) if messages else F.lit(None).cast("string")
    return _with(df, {**converted, ERROR: error})


def _with(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns in one projection, keeping the order of the others."""
    kept = [columns.get(n, F.col(quote(n))).alias(n) for n in df.columns]
    new = [c.alias(n) for n, c in columns.items() if n not in df.columns]
    return df.select(*kept, *new)


def chain(df: DataFrame, functions) -> DataFrame:
    """UDF-1: custom DataFrame functions run after the configured sections."""
    return reduce(lambda frame, function: frame.transform(function), functions, df)
