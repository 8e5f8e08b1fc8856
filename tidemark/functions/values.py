"""TRF-8..TRF-12: value transformations. Null stays null."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import plain_text, strip


def java_replacement(replacement: str) -> str:
    r"""A replacement written with ``\1`` or ``\g<name>`` in the form Spark reads."""
    out = replacement.replace("$", r"\$")
    out = re.sub(r"\\g<(\d+)>", r"${\1}", out)
    out = re.sub(r"\$\{(\d+)\}", r"$\1", out)
    out = re.sub(r"\\g<(\w+)>", r"${\1}", out)
    return re.sub(r"\\(\d)", r"$\1", out)


def java_pattern(pattern: str) -> str:
    """Named groups written ``(?P<name>...)`` and ``(?P=name)`` in Java's form."""
    return re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))


def apply_value_rule(c: Column, dtype: T.DataType, rule: Mapping[str, str]) -> Column:
    kind = rule["type"]
    if kind == "regex_replace":
        return F.regexp_replace(
            plain_text(c, dtype),
            java_pattern(rule["pattern"]),
            java_replacement(rule["replacement"]),
        )
    if kind == "upper":
        return F.upper(plain_text(c, dtype))
    if kind == "lower":
        return F.lower(plain_text(c, dtype))
    if kind == "trim":
        return strip(plain_text(c, dtype))
    return c
