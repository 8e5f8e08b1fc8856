"""One lattice of types for unions, tables that grow and values that are cast: by name, at any depth.

Structs join field by field, arrays and maps by what they hold, numbers to the widest;
whatever else differs becomes text, nested values as JSON. Values follow by field *name*: Spark's own cast
of a struct goes by position and would swap the fields of a struct that names them in
another order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.jsontext import nested_json
from tidemark.functions.text import base64_text, iso_time

NESTED = (T.StructType, T.ArrayType, T.MapType)
Cast = Callable[[Column, T.DataType, T.DataType], Column]


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """The least type that holds values of all types."""
    types = [t for t in types if not isinstance(t, T.NullType)] or list(types)
    if all(t == types[0] for t in types):
        return types[0]
    if all(isinstance(t, T.StructType) for t in types):
        return _common_struct(types)
    if all(isinstance(t, T.ArrayType) for t in types):
        return T.ArrayType(common_type([t.elementType for t in types]), any(t.containsNull for t in types))
    if all(isinstance(t, T.MapType) for t in types):
        key = common_type([t.keyType for t in types])
        return T.MapType(key, common_type([t.valueType for t in types]), any(t.valueContainsNull for t in types))
    if all(isinstance(t, T.NumericType) for t in types):
        return _common_number(types)
    return T.StringType()


def _common_struct(types: Sequence[T.StructType]) -> T.StructType:
    found: dict[str, list[T.StructField]] = {}
    for t in types:
        for f in t:
            found.setdefault(f.name, []).append(f)
    return T.StructType([
        T.StructField(name, common_type([f.dataType for f in fields]), len(fields) < len(types) or any(f.nullable for f in fields))
        for name, fields in found.items()
    ])


def _common_number(types: Sequence[T.DataType]) -> T.DataType:
    if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in types):
        return T.DoubleType()
    decimals = [t for t in types if isinstance(t, T.DecimalType)]
    if not decimals:
        return T.LongType()
    whole = max([t.precision - t.scale for t in decimals] + [19] * (len(types) > len(decimals)))
    scale = max(t.scale for t in decimals)
    return T.DecimalType(38, min(scale, 38 - whole))


def grown_type(old: T.DataType, new: T.DataType) -> T.DataType:
    """``old`` grown so that it also holds values of ``new``: more fields, wider numbers.

    Unlike in a union no kind changes: where the two are of different kinds the old type stays and
    values are cast to it.
    """
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {f.name: f.dataType for f in new}
        fields = [T.StructField(f.name, grown_type(f.dataType, known.get(f.name, f.dataType)), f.nullable, f.metadata) for f in old]
        added = [T.StructField(f.name, f.dataType, True, f.metadata) for f in new if f.name not in old.fieldNames()]
        return T.StructType(fields + added)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(grown_type(old.elementType, new.elementType), old.containsNull)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(old.keyType, grown_type(old.valueType, new.valueType), old.valueContainsNull)
    if isinstance(old, T.NumericType) and isinstance(new, T.NumericType) and not _holds(old, new):
        return _common_number([old, new])
    return old


def _holds(old: T.DataType, new: T.DataType) -> bool:
    """Whether a number of type ``new`` always has a place in ``old``; fractions beyond a decimal's scale are rounded."""
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
    if old == new or isinstance(old, T.DoubleType):
        return True
    if isinstance(old, T.DecimalType):
        whole = old.precision - old.scale
        if isinstance(new, T.DecimalType):
            return whole >= new.precision - new.scale and old.scale >= new.scale
        return isinstance(new, T.IntegralType) and whole >= 19 or isinstance(new, (T.FloatType, T.DoubleType))
    if isinstance(new, T.DecimalType):
        return False
    return order.index(type(old)) >= order.index(type(new))


def lacking(old: T.DataType, new: T.DataType, path: str = "") -> list[str]:
    """Paths of the fields below ``path`` that ``new`` has and ``old`` has no place for."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known, found = {f.name: f.dataType for f in old}, []
        for f in new:
            at = f"{path}.{f.name}" if path else f.name
            found += lacking(known[f.name], f.dataType, at) if f.name in known else [at]
        return found
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return lacking(old.elementType, new.elementType, path)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return lacking(old.valueType, new.valueType, path)
    return []


def same_names(a: T.DataType, b: T.DataType) -> bool:
    """Whether a cast by position is one by name: the same fields in the same order at every depth."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return a.fieldNames() == b.fieldNames() and all(same_names(x.dataType, y.dataType) for x, y in zip(a, b, strict=True))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return same_names(a.elementType, b.elementType)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return same_names(a.keyType, b.keyType) and same_names(a.valueType, b.valueType)
    return not isinstance(a, NESTED) and not isinstance(b, NESTED)


def plain_cast(c: Column, dtype: T.DataType, target: T.DataType) -> Column:
    return c.cast(target)


def text_cast(c: Column, dtype: T.DataType, target: T.DataType) -> Column:
    """To text as the engine writes it: ISO times, base64, nested values as JSON."""
    if isinstance(target, T.StringType):
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return iso_time(c, dtype)
        if isinstance(dtype, T.BinaryType):
            return base64_text(c)
        if isinstance(dtype, (*NESTED, T.VariantType)):
            return nested_json(c, dtype)
    return c.cast(target)


def rebuilt(c: Column, dtype: T.DataType, target: T.DataType, cast: Cast = plain_cast) -> Column:
    """A value of ``dtype`` as ``target``: fields by name, null where absent; ``cast`` changes what is not nested."""
    if dtype == target or isinstance(dtype, T.NullType):
        return c if dtype == target else c.cast(target)
    if isinstance(dtype, T.StructType) and isinstance(target, T.StructType):
        known = {f.name: f.dataType for f in dtype}
        fields = [
            (rebuilt(c.getField(f.name), known[f.name], f.dataType, cast) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target
        ]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(c, lambda x: rebuilt(x, dtype.elementType, target.elementType, cast))
    if isinstance(dtype, T.MapType) and isinstance(target, T.MapType):
        keyed = c if dtype.keyType == target.keyType else F.transform_keys(c, lambda k, _: rebuilt(k, dtype.keyType, target.keyType, cast))
        return F.transform_values(keyed, lambda _, x: rebuilt(x, dtype.valueType, target.valueType, cast))
    return cast(c, dtype, target)


def lost(c: Column, made: Column, dtype: T.DataType, target: T.DataType) -> Column | None:
    """Whether some value of ``c`` is null in ``made``, its rebuilt form; None when the types are equal."""
    if dtype == target or isinstance(dtype, T.NullType):
        return None
    if isinstance(dtype, T.StructType) and isinstance(target, T.StructType):
        known = {f.name: f.dataType for f in dtype}
        parts = [lost(c.getField(f.name), made.getField(f.name), known[f.name], f.dataType) for f in target if f.name in known]
        parts = [p for p in parts if p is not None]
        found = F.lit(False)
        for part in parts:
            found = found | F.coalesce(part, F.lit(False))
        return found if parts else None
    if isinstance(dtype, T.ArrayType) and isinstance(target, T.ArrayType):
        if lost(F.lit(None), F.lit(None), dtype.elementType, target.elementType) is None:
            return None
        pairs = F.zip_with(c, made, lambda x, y: F.coalesce(lost(x, y, dtype.elementType, target.elementType), F.lit(False)))
        return F.exists(pairs, lambda x: x)
    if isinstance(dtype, T.MapType) and isinstance(target, T.MapType):
        if lost(F.lit(None), F.lit(None), dtype.valueType, target.valueType) is None:
            return None
        pairs = F.zip_with(F.map_values(c), F.map_values(made), lambda x, y: F.coalesce(lost(x, y, dtype.valueType, target.valueType), F.lit(False)))
        return F.exists(pairs, lambda x: x)
    return c.isNotNull() & made.isNull()
