"""SET-1, SET-2: bag union of sources whose schemas differ, nested ones by field name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calculated import quote
from tidemark.operators.nested import common_type, rebuilt, text_cast


def as_type(c: Column, dtype: T.DataType, target: T.DataType) -> Column:
    return rebuilt(c, dtype, target, text_cast)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, duplicates kept; a missing column is null.

    Types are settled before the union: Spark would widen int and string to
    bigint and fail at run time, and match the fields of structs by position. Each branch stays a plain projection of its own
    scan, so filters still reach every source.
    """
    if not frames:
        raise ValueError("no source selected")
    if len(frames) == 1:
        return frames[0]
    types: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for f in frame.schema:
            types.setdefault(f.name, []).append(f.dataType)
    target = {name: common_type(found) for name, found in types.items()}
    settled = [
        frame.select(
            *(as_type(F.col(quote(f.name)), f.dataType, target[f.name]).alias(f.name)
              for f in frame.schema)
        )
        for frame in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), settled)
