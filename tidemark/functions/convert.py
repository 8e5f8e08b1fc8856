"""TRF-2..TRF-7: type conversions that yield null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import iso_time, plain_text, strip

# The number and time texts that a conversion accepts.
NUMBER_TEXT = (
    r"^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"
    r"|^(?i)([+-]?inf(inity)?|nan)$"
)
TIME_TEXT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?)?(Z|[+-]\d{2}:\d{2})?)?$"
)
TARGETS = ("string", "integer", "float", "boolean", "timestamp")


def target_of(name: str) -> str | None:
    """The known target for a configured name in any case, or None."""
    lowered = name.strip().lower()
    return lowered if lowered in TARGETS else None


def to_float(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        number = strip(c)
        plain = F.replace(number, F.lit("_"), F.lit(""))
        return F.when(number.rlike(NUMBER_TEXT), plain.try_cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def to_integer(c: Column, dtype: T.DataType) -> Column:
    """By way of double, so it truncates toward zero and '29.99' gives 29."""
    return to_float(c, dtype).try_cast("bigint")


def to_boolean(c: Column, dtype: T.DataType) -> Column:
    """Truth of the value, not of its meaning: any non-empty text is true."""
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.length(c) > 0
    if isinstance(dtype, T.NumericType):
        return c != 0
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.size(c) > 0
    return F.when(c.isNotNull(), F.lit(True))


def parse_boolean(c: Column) -> Column:
    """The meaning of the text: 'false', 'no' and '0' are false."""
    return c.try_cast("boolean")


def to_timestamp(c: Column, dtype: T.DataType) -> Column:
    """ISO text as a zone-less UTC timestamp; values of other types stay as they are."""
    if isinstance(dtype, T.StringType):
        # An hour without minutes is valid ISO text that a cast does not read.
        padded = F.regexp_replace(c, r"^(.{10}[T ]\d{2})(Z|[+-]\d{2}:\d{2})?$", "$1:00$2")
        parsed = padded.try_cast("timestamp").cast("timestamp_ntz")
        return F.when(c.rlike(TIME_TEXT), parsed)
    return c


def convert(
    c: Column, dtype: T.DataType, target: str, iso_text: bool = False
) -> tuple[Column, Column | None]:
    """The converted column, and whether it failed (None when it cannot fail)."""
    if target == "string":
        return plain_text(c, dtype), None
    if target == "boolean":
        return to_boolean(c, dtype), None
    if target == "timestamp":
        value = to_timestamp(c, dtype)
        if not isinstance(dtype, T.StringType):
            return value, None
        failed = c.isNotNull() & value.isNull()
        return (iso_time(value, T.TimestampNTZType()) if iso_text else value), failed
    value = to_integer(c, dtype) if target == "integer" else to_float(c, dtype)
    return value, c.isNotNull() & value.isNull()
