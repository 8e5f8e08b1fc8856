"""INC-*, FLT-1: read only what is newer than the destination's high-water mark.

Bounds are settled on the driver before the read is planned, so the filter
carries typed literals that reach Parquet, JDBC and partition pruning alike.

Rows committed late with a timestamp at or below the mark are never read, and a
null timestamp is read only when the whole history is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calculated import quote, quoted_table

# Fixed value: the oldest start.
OLDEST = datetime(1900, 1, 1)
ON_EMPTY = ("all_rows", "since_1900", "lookback")


@dataclass(frozen=True)
class Window:
    """The half-open range ``(start, end]``, in UTC without a zone."""

    start: datetime
    end: datetime


def high_water_mark(df: DataFrame, timestamp: str) -> datetime | None:
    """INC-1: the newest timestamp; None when there is no row."""
    newest = F.max(F.col(quote(timestamp))).cast("timestamp_ntz")
    return df.agg(newest.alias("mark")).first()["mark"]


def destination_mark(
    spark: SparkSession, table: str, timestamp: str, day_column: str | None = None
) -> datetime | None:
    """INC-1, INC-2: the mark of a table; a missing table counts as empty.

    With a day partition derived from the same timestamp only the newest day is
    scanned. Failures other than a missing table are raised: taking one for an
    empty destination would read the whole history again.
    """
    if not spark.catalog.tableExists(table):
        return None
    df = spark.table(table)
    if timestamp not in df.columns:
        raise ValueError(f"{table} has no column {timestamp}")
    if day_column and day_column in df.columns:
        df = df.filter(F.col(quote(day_column)) == newest_day(spark, table, day_column))
    return high_water_mark(df, timestamp)


def newest_day(spark: SparkSession, table: str, day_column: str) -> Column:
    """The newest day partition: from the catalog's partition list when it keeps
    one, else as a scalar subquery that becomes a partition filter."""
    try:
        listed = spark.sql(f"SHOW PARTITIONS {quoted_table(table)}")
    except AnalysisException:
        day = spark.table(table).agg(F.max(quote(day_column)).alias("day"))
        return day.scalar()
    text = F.regexp_extract("partition", re.escape(day_column) + r"=(\d{4}-\d{2}-\d{2})", 1)
    newest = listed.agg(F.max(F.when(text != "", text)).alias("day")).first()["day"]
    return F.lit(newest).cast("date")


def sync_window(
    mark: datetime | None, now: datetime, on_empty: str = "all_rows", fallback_days: int = 1
) -> Window | None:
    """INC-3..INC-6: the range to read; None means every row."""
    if on_empty not in ON_EMPTY:
        raise ValueError(f"on_empty is one of {ON_EMPTY}")
    end = now.replace(microsecond=0)
    if mark is not None:
        return Window(mark, end)
    if on_empty == "all_rows":
        return None
    if on_empty == "since_1900":
        return Window(OLDEST, end)
    return Window(end - timedelta(days=fallback_days), end)


def timestamp_literal(moment: datetime, dtype: T.DataType) -> Column:
    """A literal of the column's own type, so no cast lands on the column."""
    return F.lit(moment.isoformat(sep=" ")).cast(dtype)


def in_window(c: Column, dtype: T.DataType, window: Window | None) -> Column:
    """FLT-1: strictly after the start, up to and including the end."""
    if window is None:
        return F.lit(True)
    return (c > timestamp_literal(window.start, dtype)) & (
        c <= timestamp_literal(window.end, dtype)
    )


def extract(
    df: DataFrame, timestamp: str, window: Window | None, day_column: str | None = None
) -> DataFrame:
    """Rows in the window. A day partition column adds the predicate that prunes it."""
    if window is None:
        return df
    kept = df.filter(in_window(F.col(quote(timestamp)), df.schema[timestamp].dataType, window))
    if day_column:
        day = F.col(quote(day_column))
        first, last = (F.lit(m.date().isoformat()).cast("date") for m in (window.start, window.end))
        kept = kept.filter((day >= first) & (day <= last))
    return kept


def window_arguments(window: Window | None, now: datetime) -> dict[str, str]:
    """INC-8: the template's two values as text."""
    window = window or Window(OLDEST, now.replace(microsecond=0))
    return {
        "start_timestamp": window.start.isoformat(sep=" "),
        "end_timestamp": window.end.isoformat(sep=" "),
    }


def _placed(template: str, window: Window | None, predicate: str) -> str:
    """A template with its ``{window}`` filled in.

    The bounds of the whole history are no predicate at all, so a template that spells
    its own bounds cannot read it: null and later timestamps would be lost silently.
    """
    if window is None and "{window}" not in template:
        raise ValueError("a template that reads the whole history takes {window} as its condition")
    return template.replace("{window}", predicate if window else "(1 = 1)")


def bind_template(
    template: str, window: Window | None, now: datetime, timestamp: str = "updated_at"
) -> tuple[str, dict[str, str]]:
    """INC-8: a template as SQL with named parameters, and their values, for Spark SQL."""
    column = quote(timestamp)
    template = _placed(template, window, f"({column} > :start_timestamp AND {column} <= :end_timestamp)")
    bound = re.sub(r"'?\{(start_timestamp|end_timestamp)\}'?", r":\1", template)
    values = window_arguments(window, now)
    return bound, {name: text for name, text in values.items() if f":{name}" in bound}


def fill_template(
    template: str, window: Window | None, now: datetime, timestamp: str = "updated_at"
) -> str:
    """INC-8 for a database that takes plain SQL text. The values are formatted from
    datetimes, so nothing else can enter the text."""
    bounds = f"({timestamp} > '{{start_timestamp}}' AND {timestamp} <= '{{end_timestamp}}')"
    template = _placed(template, window, bounds)
    for name, text in window_arguments(window, now).items():
        template = template.replace("{" + name + "}", text)
    return template


def clipped(window: Window | None, least: date, most: date) -> Window:
    """The part of the window that has rows: slices of it are empty only by the source's own gaps.
    Bounds of a DATE column are its days' midnights."""
    least, most = (m if isinstance(m, datetime) else datetime.combine(m, time()) for m in (least, most))
    before = least - timedelta(seconds=1)
    if window is None:
        return Window(before, most)
    return Window(max(window.start, before), min(window.end, most))


def window_slices(window: Window, parts: int, days: bool = False) -> list[Window]:
    """Adjoining sub-windows that cover the window exactly: one JDBC partition each.

    With ``days`` all bounds go back to their midnight, which is the same range for a DATE column.
    """
    step = (window.end - window.start) / parts
    bounds = [window.start + step * i for i in range(parts)] + [window.end]
    if days:
        bounds = [datetime.combine(b.date(), time()) for b in bounds]
    return [Window(a, b) for a, b in zip(bounds, bounds[1:]) if a < b]
