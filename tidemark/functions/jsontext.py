"""JSON text and VARIANT helpers. Canonical JSON means compact with sorted keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text
from tidemark.functions.literals import bind_sql, bound


# SQL over a stripped text ``s``.
IS_BRACKETED = """((startswith(s, '{') AND endswith(s, '}'))
    OR (startswith(s, '[') AND endswith(s, ']')))"""

# Spark's parser stops after the first value and ignores what follows. So the text is
# parsed as the first item of an array whose second item, a hash of the text, proves
# that the first one ended where the text ends.
PARSED = """transform(array(xxhash64(s)), h -> transform(
    array(try_parse_json(concat('[', s, ',', CAST(h AS STRING), ']'))),
    both -> CASE WHEN try_variant_get(both, '$[1]', 'bigint') = h
                 THEN try_variant_get(both, '$[0]', 'variant') END)[0])[0]"""


def parse(c: Column) -> Column:
    """JSON text as VARIANT; null when the text is not exactly one JSON value."""
    return bind_sql(c, PARSED)


def canonical(c: Column) -> Column:
    """Canonical form of JSON text; null when the text is not valid JSON."""
    return F.to_json(parse(c))


def quoted(c: Column) -> Column:
    """A scalar as a JSON value: strings quoted, numbers and booleans bare."""
    return F.to_json(c.cast("variant"))


def variant_text(v: Column) -> Column:
    """Text of a VARIANT: strings bare, everything else as JSON."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(
        F.when(F.schema_of_variant(v) != "VOID", F.to_json(v))
    )


def nested_json(c: Column, dtype: T.DataType) -> Column:
    """Canonical JSON of a struct, array, map or variant."""
    if isinstance(dtype, T.VariantType):
        return F.to_json(c)
    return F.when(c.isNotNull(), F.to_json(F.to_variant_object(sanitise(c, dtype, text_times=True))))


def sanitise(c: Column, dtype: T.DataType, text_times: bool = False) -> Column:
    """VAL-9 by static type, nested values included.

    NUL leaves strings, binary becomes base64 and, with ``text_times``, times
    become ISO text and decimals plain text. Types that need nothing come back as
    they are, so no expression is added for them.
    """
    if not _needs_cleaning(dtype, text_times):
        return c
    if isinstance(dtype, T.StringType):
        return text.drop_nul(c)
    if isinstance(dtype, T.BinaryType):
        return text.base64_text(c)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return text.iso_time(c, dtype)
    if isinstance(dtype, T.DecimalType):
        return c.cast("string")
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: sanitise(x, dtype.elementType, text_times))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _, x: sanitise(x, dtype.valueType, text_times))
    fields = [sanitise(c.getField(f.name), f.dataType, text_times).alias(f.name) for f in dtype]
    return F.when(c.isNotNull(), F.struct(*fields))


def _needs_cleaning(dtype: T.DataType, text_times: bool) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _needs_cleaning(dtype.elementType, text_times)
    if isinstance(dtype, T.MapType):
        return _needs_cleaning(dtype.valueType, text_times)
    if isinstance(dtype, T.StructType):
        return any(_needs_cleaning(f.dataType, text_times) for f in dtype)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return True
    times = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
    return text_times and isinstance(dtype, times)


_TEXT = r'"(?:[^"\\]|\\.)*+"'
_NUMBER = r'"(-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)"'
# The wrappers of extended JSON. Ids, dates and binary values become their
# text, numbers become numbers; not-a-number and the infinities stay wrapped.
_WRAPPERS = (
    ('"$number', r'\{\s*"\$number(?:Long|Int|Double|Decimal)"\s*:\s*' + _NUMBER + r"\s*\}"),
    ('"$oid"', r'\{\s*"\$oid"\s*:\s*(' + _TEXT + r")\s*\}"),
    ('"$date"', r'\{\s*"\$date"\s*:\s*(' + _TEXT + r")\s*\}"),
    ('"$binary"', r'\{\s*"\$binary"\s*:\s*\{\s*"base64"\s*:\s*(' + _TEXT + r')\s*,\s*"subType"\s*:\s*' + _TEXT + r"\s*\}\s*\}"),
)


def unwrap(json: Column) -> Column:
    """SRC-6 on JSON text: ``{"$oid": "..."}`` and its kin, at any depth, become plain values.

    A quote inside a JSON string is always escaped, so a wrapper cannot be mistaken for text.
    Each step is bound, as its text is mentioned three times.
    """
    for name, pattern in _WRAPPERS:
        json = bound(json, lambda s: F.when(s.contains(name), F.regexp_replace(s, pattern, "$1")).otherwise(s))
    return json


def stringify_ids(c: Column, dtype: T.DataType, ids: tuple[str, ...] = ("_id",), is_id: bool = False) -> Column:
    """SRC-6 by static type, recursively: ``$oid`` structs become text, and so do binary
    values of fields named in ``ids``. Other binary values stay what they are."""
    if not _has_id(dtype, ids, is_id):
        return c
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: stringify_ids(x, dtype.elementType, ids, is_id))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _, x: stringify_ids(x, dtype.valueType, ids, is_id))
    if dtype.fieldNames() == ["$oid"]:
        return c.getField("$oid")
    fields = [stringify_ids(c.getField(f.name), f.dataType, ids, f.name in ids).alias(f.name) for f in dtype]
    return F.when(c.isNotNull(), F.struct(*fields))


def _has_id(dtype: T.DataType, ids: tuple[str, ...], is_id: bool) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_id(dtype.elementType, ids, is_id)
    if isinstance(dtype, T.MapType):
        return _has_id(dtype.valueType, ids, is_id)
    if isinstance(dtype, T.StructType):
        return dtype.fieldNames() == ["$oid"] or any(_has_id(f.dataType, ids, f.name in ids) for f in dtype)
    return is_id and isinstance(dtype, T.BinaryType)
