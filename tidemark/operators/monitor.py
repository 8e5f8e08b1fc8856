"""WIN-*, MON-1, AGG-*, SRT-1, LIM-1: checks on what a sync has written."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calculated import quote


def _col(name: str) -> Column:
    return F.col(quote(name))


def _ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def hourly_counts(df: DataFrame, timestamp: str, since: datetime | None = None) -> DataFrame:
    """Records per hour; combined in each task, so one row per hour and task is shuffled."""
    rows = df.filter(_col(timestamp).isNotNull())
    if since is not None:
        rows = rows.filter(_col(timestamp) >= _ntz(since))
    hour = F.date_trunc("hour", _col(timestamp)).cast("timestamp_ntz")
    return rows.groupBy(hour.alias("hour_bucket")).agg(F.count(F.lit(1)).alias("records"))


def sync_gaps(df: DataFrame, timestamp: str, since: datetime | None = None) -> DataFrame:
    """WIN-1: hours whose predecessor lies more than an hour back, newest first.

    The unpartitioned window sees hour buckets, not rows: at most 8,784 a year,
    whatever the table holds.
    """
    by_hour = Window.orderBy("hour_bucket")
    previous = F.lag("hour_bucket").over(by_hour)
    return (
        hourly_counts(df, timestamp, since)
        .withColumn("prev_hour", previous)
        .withColumn("hours_gap", F.timestamp_diff("HOUR", F.col("prev_hour"), F.col("hour_bucket")))
        .filter("hours_gap > 1")
        .orderBy(F.desc("hour_bucket"))
    )


def low_volume_hours(
    df: DataFrame, timestamp: str, start: datetime, end: datetime, threshold: int = 100
) -> DataFrame:
    """WIN-2: hours with fewer records than the threshold, empty hours included. The
    calendar is generated, so an hour without rows is seen. Hours are whole: the range is
    widened to the hours that ``start`` and ``end`` lie in."""
    start = start.replace(minute=0, second=0, microsecond=0)
    end = -((start - end) // timedelta(hours=1)) * timedelta(hours=1) + start
    rows = df.filter((_col(timestamp) >= _ntz(start)) & (_col(timestamp) < _ntz(end)))
    counts = hourly_counts(rows, timestamp)
    hours = max(0, (end - start) // timedelta(hours=1))
    calendar = df.sparkSession.range(hours).select(
        F.timestamp_add("HOUR", F.col("id"), _ntz(start)).alias("hour_bucket")
    )
    return (
        calendar.join(counts, "hour_bucket", "left")
        .select("hour_bucket", F.coalesce("records", F.lit(0)).alias("records"))
        .filter(F.col("records") < threshold)
        .orderBy(F.desc("hour_bucket"))
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], timestamp: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """WIN-3: the current version of every key.

    A rank filter lets Spark keep one row per key in each task before it shuffles
    (WindowGroupLimit), so a key that holds a third of the rows sends one row per task.
    """
    newest = Window.partitionBy(*map(_col, keys)).orderBy(
        _col(timestamp).desc_nulls_last(), *(_col(c).desc_nulls_last() for c in tie_break)
    )
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WIN-4: keys seen more than once, with how often."""
    return df.groupBy(*map(_col, keys)).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def freshness(df: DataFrame, timestamp: str, now: datetime) -> DataFrame:
    """MON-1: newest timestamp, whole minutes behind ``now``, and number of records."""
    newest = F.max(_col(timestamp)).cast("timestamp_ntz")
    return df.agg(newest.alias("last_synced_timestamp"), F.count(F.lit(1)).alias("total_records")).select(
        "last_synced_timestamp",
        F.timestamp_diff("MINUTE", F.col("last_synced_timestamp"), _ntz(now)).alias("minutes_behind"),
        "total_records",
    )


def record_count(df: DataFrame) -> DataFrame:
    """AGG-1, AGG-6: the number of records, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("records"))


def daily_totals(df: DataFrame, timestamp: str, amount: str) -> DataFrame:
    """AGG-4: count and sum per day."""
    return df.groupBy(F.to_date(_col(timestamp)).alias("day")).agg(
        F.count(F.lit(1)).alias("records"), F.sum(_col(amount)).alias("total")
    )


def activity_by_key(df: DataFrame, key: str, timestamp: str) -> DataFrame:
    """AGG-5: count and newest timestamp per key."""
    return df.groupBy(_col(key)).agg(
        F.count(F.lit(1)).alias("records"), F.max(_col(timestamp)).alias("last_seen")
    )


def enrich(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """JOI-1..JOI-3: inner equi-join.

    The plan is left to Spark: it broadcasts the dimension only when its size is
    known to lie under the threshold, and otherwise AQE splits hot keys.
    """
    return facts.join(dimension, facts[quote(fact_key)] == dimension[quote(dimension_key)], "inner")


def ordered(df: DataFrame, timestamp: str, tie_break: Sequence[str]) -> DataFrame:
    """SRT-1: by time; the tie-break lets a hot timestamp spread over several ranges."""
    return df.orderBy(_col(timestamp), *map(_col, tie_break))


def top(df: DataFrame, by: str, tie_break: Sequence[str], n: int) -> DataFrame:
    """LIM-1: the first n by value: n rows per task, never a full sort."""
    return df.orderBy(_col(by).desc(), *map(_col, tie_break)).limit(n)
