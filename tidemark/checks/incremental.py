"""INC: marks, windows, templates and repeated runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks import check, new_sink, table, view
from tidemark.config import SourceSpec, SyncJob, SyncSpec
from tidemark.operators.current import CurrentVersions
from tidemark.operators.incremental import (
    bind_template,
    destination_mark,
    extract,
    high_water_mark,
    sync_window,
)
from tidemark.operators.ledger import Ledger
from tidemark.operators.monitor import latest_per_key, ordered
from tidemark.operators.write import day_column, write_table
from tidemark.plans.sync import run_sync
from tidemark.session import shared_dir
from tidemark.sources.relational import sql_rows

NOW = datetime(1999, 1, 1)
CUT = "o_orderdate <= TIMESTAMP_NTZ'1998-01-01 00:00:00'"
MARK_SQL = "(SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01')"


def _destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(CUT)


EVENT_MARK = "(SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00')"


@check(
    "inc_1_high_water_mark",
    f"SELECT {EVENT_MARK} AS mark, count(*) AS newer FROM events WHERE ts > {EVENT_MARK}",
)
def mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of a day-partitioned table, for which only the newest day is scanned."""
    events = table(spark, sf_dir, "events")
    sink = new_sink(spark, partition_field="ts")
    write_table(events.filter("ts <= TIMESTAMP_NTZ'2024-01-20 12:00:00'"), sink)
    found = destination_mark(spark, sink.table, "ts", day_column("ts"))
    newest = F.lit(found.isoformat(sep=" ")).cast("timestamp_ntz")
    newer = events.filter(F.col("ts") > newest)
    return newer.agg(F.count(F.lit(1)).alias("newer")).withColumn("mark", newest)


@check(
    "inc_1_mark_from_ledger",
    """SELECT max(o_orderdate) FILTER (o_orderdate <= TIMESTAMP '1998-01-01') AS first, max(o_orderdate) FILTER (o_orderdate <= TIMESTAMP '1999-01-01') AS second,
       count(*) FILTER (o_orderdate <= TIMESTAMP '1999-01-01') AS rows FROM orders""",
)
def mark_from_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marks that two runs leave in the ledger, and the rows they say they wrote."""
    job = SyncJob(
        [SourceSpec("postgresql", {"query": f"SELECT * FROM {view(spark, sf_dir, 'orders')}"})],
        new_sink(spark, partition_field="o_orderdate"),
        SyncSpec(incremental=True, timestamp_column="o_orderdate", on_empty="since_1900", ledger=f"{shared_dir(spark)}/ledger"),
    )
    ledger, marks = Ledger(job.sync.ledger), []
    for now in (datetime(1998, 1, 1), NOW):
        run_sync(spark, job, now)
        marks.append(ledger.mark(spark, job.sink.table, day_column("o_orderdate")))
    written = ledger.runs(spark, job.sink.table).agg(F.sum("rows").alias("rows"))
    first, second = (F.lit(m.isoformat(sep=" ")).cast("timestamp_ntz") for m in marks)
    return written.select(first.alias("first"), second.alias("second"), "rows")


@check("inc_2_missing_destination", "SELECT * FROM orders")
def missing_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = destination_mark(spark, "no_such_table_here", "o_orderdate")
    return extract(table(spark, sf_dir, "orders"), "o_orderdate", sync_window(found, NOW))


@check(
    "inc_3_incremental_window",
    f"SELECT * FROM orders WHERE o_orderdate > {MARK_SQL} AND o_orderdate <= TIMESTAMP '1999-01-01'",
)
def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which orders are new since the last sync?"""
    window = sync_window(high_water_mark(_destination(spark, sf_dir), "o_orderdate"), NOW)
    return extract(table(spark, sf_dir, "orders"), "o_orderdate", window)


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose urgent ones have not been stamped yet."""
    stamped = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").withColumn("updated_at", stamped)


GAPS = """SELECT *, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS updated_at FROM orders"""


@check("inc_4_all_history", GAPS)
def all_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No predicate at all: null and future timestamps come too."""
    return extract(_with_gaps(spark, sf_dir), "updated_at", sync_window(None, NOW, "all_rows"))


@check(
    "inc_5_since_1900",
    f"SELECT * FROM ({GAPS}) WHERE updated_at > TIMESTAMP '1900-01-01' AND updated_at <= TIMESTAMP '1999-01-01'",
)
def since_1900(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_with_gaps(spark, sf_dir), "updated_at", sync_window(None, NOW, "since_1900"))


@check(
    "inc_6_lookback",
    "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-12-02' AND o_orderdate <= TIMESTAMP '1999-01-01'",
)
def lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = sync_window(None, NOW, "lookback", fallback_days=30)
    return extract(table(spark, sf_dir, "orders"), "o_orderdate", window)


@check(
    "inc_7_ordered_extraction",
    """SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS nth
       FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '1999-01-01'""",
)
def ordered_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in time order. The number of a row is where the extraction put it: its partition
    and its place there, without another sort."""
    from pyspark.sql import Window as W

    window = sync_window(datetime(1998, 1, 1), NOW)
    rows = ordered(
        extract(table(spark, sf_dir, "orders"), "o_orderdate", window), "o_orderdate", ["o_orderkey"]
    )
    path = f"{shared_dir(spark)}/ordered"
    rows.withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("part", F.shiftright("at", 33))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row for each partition
    starts = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, "part").withColumn("nth", F.col("start") + place + 1).drop("part", "at", "start")


TEMPLATE = """SELECT o_orderkey, o_orderdate, o_orderstatus FROM {table}
    WHERE o_orderdate > '{start_timestamp}' AND o_orderdate <= '{end_timestamp}'
      AND o_orderstatus IN ('F', 'O') ORDER BY o_orderdate ASC"""


@check(
    "inc_8_template_parameters",
    """SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
       WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '1999-01-01'
       AND o_orderstatus IN ('F', 'O')""",
)
def template_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = TEMPLATE.replace("{table}", view(spark, sf_dir, "orders"))
    window = sync_window(datetime(1998, 1, 1), NOW)
    query, arguments = bind_template(template, window, NOW)
    return sql_rows(spark, query, arguments)


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a changing source: an open order is closed a year after it was placed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    later = F.timestamp_add("DAY", F.lit(365), F.col("o_orderdate")).cast("timestamp_ntz")
    closed = orders.filter("o_orderstatus = 'O'").select(
        "o_orderkey", F.lit("F").alias("o_orderstatus"), later.alias("o_orderdate")
    )
    return orders.unionByName(closed)


VERSIONS = """SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
    UNION ALL SELECT o_orderkey, 'F', o_orderdate + INTERVAL 365 DAY FROM orders WHERE o_orderstatus = 'O'"""


def _two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _versions(spark, sf_dir).createOrReplaceTempView("order_versions")
    sink = new_sink(spark, partition_field=None, clustering_fields=("o_orderkey",))
    job = SyncJob(
        sources=[SourceSpec("postgresql", {"query": "SELECT * FROM order_versions"})],
        sink=sink,
        sync=SyncSpec(incremental=True, timestamp_column="o_orderdate", on_empty="since_1900"),
    )
    for now in (datetime(1997, 1, 1), datetime(1998, 1, 1), datetime(1998, 1, 1), NOW):
        run_sync(spark, job, now)
    return spark.table(sink.table).select("o_orderkey", "o_orderstatus", "o_orderdate")


@check(
    "inc_9_run_to_run",
    f"SELECT * FROM ({VERSIONS}) WHERE o_orderdate <= TIMESTAMP '1999-01-01'",
)
def run_to_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs, one of them repeated; every version arrives exactly once."""
    return _two_runs(spark, sf_dir)


@check(
    "inc_9_kept_versions",
    """SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""",
)
def kept_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three increments, which overlap, into a kept table of current versions; the last one is repeated."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    kept = CurrentVersions(f"{shared_dir(spark)}/current", ["user_id", "event_type"], "ts", ["event_id"], buckets=32)
    day = F.dayofmonth("ts")
    for rows in (events.filter(day <= 12), events.filter(day.between(10, 22)), events.filter(day >= 20)):
        kept.merge(rows)
    assert kept.merge(events.filter(day >= 20)) == []
    return kept.read(spark)


@check(
    "inc_9_current_versions",
    f"""SELECT o_orderkey, o_orderstatus, o_orderdate FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, o_orderstatus DESC) AS n
        FROM ({VERSIONS}) WHERE o_orderdate <= TIMESTAMP '1999-01-01') WHERE n = 1""",
)
def current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(_two_runs(spark, sf_dir), ["o_orderkey"], "o_orderdate", ["o_orderstatus"])
