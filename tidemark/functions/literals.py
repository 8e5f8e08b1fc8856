"""VAL-1, VAL-2: array literals such as ``{a,"b,c",NULL}`` as Spark arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import WHITESPACE, strip

# SQL over a stripped text ``s``. As text it costs the driver one call per column;
# built from Column objects it costs hundreds, which adds up in a wide table.
IS_LITERAL = "startswith(s, '{') AND endswith(s, '}') AND NOT contains(s, ':')"

# Splitting on the quote character leaves quoted text at the odd positions. An empty
# piece between two quoted ones was a doubled quote, so it turns into a quote; a comma
# separates items only in the even pieces.
_SEPARATED = """transform(array(split(inner, '"', -1)), pieces -> split(array_join(
    transform(pieces, (piece, i) -> CASE
        WHEN i % 2 = 1 THEN piece
        WHEN i > 0 AND i < size(pieces) - 1 AND piece = '' THEN '"'
        ELSE replace(piece, ',', char(0)) END), ''), char(0), -1))[0]"""

ITEMS = f"""CASE WHEN NOT contains(s, char(10)) THEN transform(
    filter(
        transform(
            transform(array(replace(substr(s, 2, length(s) - 2), char(0), '')),
                inner -> CASE WHEN contains(inner, '"') THEN {_SEPARATED}
                              ELSE split(inner, ',', -1) END)[0],
            item -> btrim(item, '{WHITESPACE}')),
        item -> item <> '' AND upper(item) <> 'NULL'),
    item -> CASE WHEN length(item) >= 2 AND startswith(item, '"') AND endswith(item, '"')
                 THEN replace(substr(item, 2, length(item) - 2), '""', '"')
                 ELSE item END) END"""


def bind_sql(value: Column, body: str) -> Column:
    """The SQL ``body`` over ``s``, the value, which is evaluated once.

    Spark shares repeated subexpressions only where they are always evaluated;
    inside a CASE branch every mention would run again.
    """
    return F.get(F.call_function("transform", F.array(value), F.expr(f"s -> {body}")), F.lit(0))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_array_literal(c: Column) -> Column:
    """The items when ``c`` is an array literal, else null (also when it spans lines)."""
    shaped = "startswith(s, '{') AND endswith(s, '}')"
    return bind_sql(strip(c), f"CASE WHEN {shaped} THEN {ITEMS} END")
