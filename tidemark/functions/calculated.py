"""TRF-13..TRF-15: calculated fields ``a + b``, ``len(a)`` and ``a``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import plain_text


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted_table(name: str) -> str:
    """A table name with every part quoted; one that brings its own quotes stays."""
    return name if "`" in name else ".".join(map(quote, name.split(".")))


def calculate(expression: str, schema: T.StructType) -> Column:
    types = {f.name: f.dataType for f in schema}
    if "+" in expression:
        terms = [_addend(name.strip(), types) for name in expression.split("+")]
        return reduce(F.try_add, terms)
    if "len(" in expression:
        name = expression.replace("len(", "").replace(")", "")
        if name not in types:
            return F.lit(0).cast("bigint")
        return F.length(plain_text(F.col(quote(name)), types[name])).cast("bigint")
    if expression in types:
        return F.col(quote(expression))
    return F.lit(None).cast("string")


def _addend(name: str, types: dict[str, T.DataType]) -> Column:
    """A missing field counts as 0; a field that is no number makes the sum null."""
    if name not in types:
        return F.lit(0).cast("bigint")
    c, dtype = F.col(quote(name)), types[name]
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(dtype, T.NumericType):
        return c
    return F.lit(None).cast("double")
