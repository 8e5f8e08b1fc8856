"""PRJ-1..PRJ-3: document projections that include, exclude or reach into nesting."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calculated import quote

ID = "_id"


def project(df: DataFrame, spec: str | Mapping[str, int] | None) -> DataFrame:
    spec = json.loads(spec) if isinstance(spec, str) else dict(spec or {})
    wanted = {path: bool(flag) for path, flag in spec.items()}
    keep_id = wanted.pop(ID, None)
    if len(set(wanted.values())) > 1:
        raise ValueError("a projection either includes or excludes fields")
    include = next(iter(wanted.values()), keep_id)
    if include is None:
        return df
    if include:
        return _include(df, list(wanted), keep_id is not False)
    return _exclude(df, [*wanted, *([ID] if keep_id is False else [])])


def _tree(paths: list[str]) -> dict:
    root: dict = {}
    for path in paths:
        node = root
        for step in path.split("."):
            node = node.setdefault(step, {})
    return root


def _include(df: DataFrame, paths: list[str], with_id: bool) -> DataFrame:
    tree = _tree(paths)
    if with_id:
        tree[ID] = {}
    return df.select(
        *(
            _pick(F.col(quote(f.name)), f.dataType, tree[f.name]).alias(f.name)
            for f in df.schema
            if f.name in tree
        )
    )


def _pick(c: Column, dtype: T.DataType, tree: dict) -> Column:
    """Only the named fields of a value; the nesting around them stays."""
    if not tree:
        return c
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _pick(x, dtype.elementType, tree))
    if isinstance(dtype, T.StructType):
        fields = [
            _pick(c.getField(f.name), f.dataType, tree[f.name]).alias(f.name)
            for f in dtype
            if f.name in tree
        ]
        return F.when(c.isNotNull(), F.struct(*fields)) if fields else F.lit(None)
    if isinstance(dtype, T.VariantType):
        return _pick_variant(c, tree)
    if isinstance(dtype, T.MapType):
        kept = F.map_filter(c, lambda k, _: k.isin(list(tree)))
        return _below(kept, tree, lambda x, below: _pick(x, dtype.valueType, below))
    return F.lit(None).cast(dtype)


def _below(kept: Column, tree: dict, change) -> Column:
    """Map values under the names of ``tree`` that go on, changed by what lies below."""
    deeper = {name: below for name, below in tree.items() if below}
    if not deeper:
        return kept

    def one(key: Column, value: Column) -> Column:
        shown = value
        for name, below in deeper.items():
            shown = F.when(key == name, change(value, below)).otherwise(shown)
        return shown

    return F.transform_values(kept, one)


def _rebuilt(v: Column, fields, otherwise: Column) -> Column:
    """An object of a VARIANT with other fields; in a list, every object in it."""
    as_object = lambda x: F.try_variant_get(x, "$", "map<string,variant>")
    whole = lambda x: F.when(as_object(x).isNotNull(), F.to_variant_object(fields(as_object(x))))
    items = F.try_variant_get(v, "$", "array<variant>")
    listed = F.to_variant_object(F.transform(items, lambda x: F.coalesce(whole(x), x)))
    return F.coalesce(whole(v), F.when(items.isNotNull(), listed), otherwise)


def _pick_variant(v: Column, tree: dict) -> Column:
    def fields(kept: Column) -> Column:
        return _below(F.map_filter(kept, lambda k, _: k.isin(list(tree))), tree, _pick_variant)

    return _rebuilt(v, fields, F.lit(None).cast("variant"))


def _drop_variant(v: Column, tree: dict) -> Column:
    gone = [name for name, below in tree.items() if not below]

    def fields(kept: Column) -> Column:
        return _below(F.map_filter(kept, lambda k, _: ~k.isin(gone)) if gone else kept, tree, _drop_variant)

    return _rebuilt(v, fields, v)


def _exclude(df: DataFrame, paths: list[str]) -> DataFrame:
    tree = _tree(paths)
    columns = []
    for f in df.schema:
        if f.name not in tree:
            columns.append(F.col(quote(f.name)))
        elif tree[f.name]:
            columns.append(_drop(F.col(quote(f.name)), f.dataType, tree[f.name]).alias(f.name))
    return df.select(*columns)


def _drop(c: Column, dtype: T.DataType, tree: dict) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _drop(x, dtype.elementType, tree))
    if isinstance(dtype, T.VariantType):
        return _drop_variant(c, tree)
    if isinstance(dtype, T.MapType):
        gone = [name for name, below in tree.items() if not below]
        kept = F.map_filter(c, lambda k, _: ~k.isin(gone)) if gone else c
        return _below(kept, tree, lambda x, below: _drop(x, dtype.valueType, below))
    if not isinstance(dtype, T.StructType):
        return c
    fields = []
    for f in dtype:
        if f.name not in tree:
            fields.append(c.getField(f.name).alias(f.name))
        elif tree[f.name]:
            fields.append(_drop(c.getField(f.name), f.dataType, tree[f.name]).alias(f.name))
    return F.when(c.isNotNull(), F.struct(*fields))
