"""AGG, JOI, WIN, MON, SRT, LIM: aggregates, joins and checks on synced data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.checks import check, new_sink, table
from tidemark.operators import monitor
from tidemark.operators.incremental import Window, extract
from tidemark.operators.schema import path_type_counts
from tidemark.operators.write import write_table
from tidemark.sources.documents import parse_documents

START, END = datetime(2024, 1, 1), datetime(2024, 1, 31)


@check(
    "agg_1_processed_count",
    "SELECT event_type, count(*) AS records, (SELECT count(*) FROM events) AS processed FROM events GROUP BY event_type",
)
def processed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count rides on the write as an observation; nothing is read a second time."""
    seen = Observation()
    sink = new_sink(spark, partition_field="ts")
    events = table(spark, sf_dir, "events").observe(seen, F.count(F.lit(1)).alias("processed"))
    write_table(events, sink)
    per_type = spark.table(sink.table).groupBy("event_type").agg(F.count(F.lit(1)).alias("records"))
    return per_type.withColumn("processed", F.lit(seen.get["processed"]).cast("bigint"))


@check("agg_2_global_max", "SELECT max(ts) AS newest FROM events")
def global_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.max("ts").alias("newest"))


@check(
    "agg_3_count_by_path_and_type",
    """SELECT 'role' AS path, 'string' AS type, count(*) AS n FROM conversations
       UNION ALL SELECT 'turn', 'int', count(*) FROM conversations
       UNION ALL SELECT 'body', CASE role WHEN 'user' THEN 'string' ELSE 'object' END, count(*)
            FROM conversations GROUP BY 2
       UNION ALL SELECT 'body.text', 'string', count(*) FROM conversations WHERE role <> 'user'""",
)
def count_by_path_and_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as documents whose body is text for users and an object for others."""
    turns = table(spark, sf_dir, "conversations")
    head = F.concat(F.lit('{"role":'), F.to_json(F.col("role").cast("variant")), F.lit(',"turn":'), F.col("turn"))
    text = F.to_json(F.col("text").cast("variant"))
    body = F.when(F.col("role") == "user", text).otherwise(F.concat(F.lit('{"text":'), text, F.lit("}")))
    raw = F.concat(head, F.lit(',"body":'), body, F.lit("}"))
    documents = parse_documents(turns.select(raw.alias("raw")), "raw")
    return path_type_counts(documents, "document")


@check(
    "agg_4_count_and_sum_by_date",
    """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS records,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""",
)
def count_and_sum_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.col("o_totalprice").cast("decimal(18,2)")
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", exact)
    totals = monitor.daily_totals(orders, "o_orderdate", "o_totalprice")
    return totals.withColumn("total", F.col("total").cast("double"))


@check(
    "agg_5_count_and_max_by_key",
    "SELECT user_id, count(*) AS records, max(ts) AS last_seen FROM events GROUP BY user_id",
)
def count_and_max_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.activity_by_key(table(spark, sf_dir, "events"), "user_id", "ts")


@check("agg_6_document_count", "SELECT count(*) AS records FROM documents")
def document_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.record_count(table(spark, sf_dir, "documents"))


@check(
    "joi_1_enrichment",
    """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders
       JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'""",
)
def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    joined = monitor.enrich(orders, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey")
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@check(
    "joi_2_enrichment_in_window",
    """SELECT o_orderkey, o_orderdate, c_name FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1998-01-01'""",
)
def enrichment_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = Window(datetime(1997, 1, 1), datetime(1998, 1, 1))
    orders = extract(table(spark, sf_dir, "orders"), "o_orderdate", window)
    joined = monitor.enrich(orders, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey")
    return joined.select("o_orderkey", "o_orderdate", "c_name")


@check(
    "joi_3_across_sources",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, s_name, n_name FROM lineitem
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
)
def across_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts from files, the dimension from a table of the catalog."""
    sink = new_sink(spark)
    write_table(table(spark, sf_dir, "supplier"), sink)
    suppliers = monitor.enrich(
        spark.table(sink.table), table(spark, sf_dir, "nation"), "s_nationkey", "n_nationkey"
    )
    joined = monitor.enrich(table(spark, sf_dir, "lineitem"), suppliers, "l_suppkey", "s_suppkey")
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "s_name", "n_name")


@check(
    "win_1_gap_detection",
    """SELECT * FROM (SELECT hour_bucket, records, lag(hour_bucket) OVER (ORDER BY hour_bucket) AS prev_hour,
            date_diff('hour', lag(hour_bucket) OVER (ORDER BY hour_bucket), hour_bucket) AS hours_gap
        FROM (SELECT date_trunc('hour', o_orderdate) AS hour_bucket, count(*) AS records FROM orders GROUP BY 1))
       WHERE hours_gap > 1""",
)
def gap_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders carry a day, so every day is an hour bucket and the hours between are gaps."""
    return monitor.sync_gaps(table(spark, sf_dir, "orders"), "o_orderdate")


@check(
    "win_1_gaps_of_events",
    """SELECT * FROM (SELECT hour_bucket, records, lag(hour_bucket) OVER (ORDER BY hour_bucket) AS prev_hour,
            date_diff('hour', lag(hour_bucket) OVER (ORDER BY hour_bucket), hour_bucket) AS hours_gap
        FROM (SELECT date_trunc('hour', ts) AS hour_bucket, count(*) AS records FROM events GROUP BY 1)) WHERE hours_gap > 1""",
)
def gaps_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.sync_gaps(table(spark, sf_dir, "events"), "ts")


LOW_HOURS = """SELECT hour_bucket, coalesce(records, 0) AS records FROM
            (SELECT unnest(generate_series(TIMESTAMP '{first}', TIMESTAMP '{last}', INTERVAL 1 HOUR)) AS hour_bucket)
        LEFT JOIN (SELECT date_trunc('hour', ts) AS hour_bucket, count(*) AS records FROM events GROUP BY 1) USING (hour_bucket)
        WHERE coalesce(records, 0) < 15"""


@check("win_2_low_volume_hours", LOW_HOURS.format(first="2024-01-01", last="2024-01-30 23:00:00"))
def low_volume_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.low_volume_hours(table(spark, sf_dir, "events"), "ts", START, END, threshold=15)


@check("win_2_bounds_off_the_hour", LOW_HOURS.format(first="2024-01-03 04:00:00", last="2024-02-02 17:00:00"))
def low_volume_off_the_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours that the bounds lie in count as a whole."""
    start, end = datetime(2024, 1, 3, 4, 30), datetime(2024, 2, 2, 17, 0, 1)
    return monitor.low_volume_hours(table(spark, sf_dir, "events"), "ts", start, end, threshold=15)


@check(
    "win_3_latest_per_key",
    """SELECT event_id, ts, user_id, event_type FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""",
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return monitor.latest_per_key(events, ["user_id", "event_type"], "ts", ["event_id"])


@check(
    "win_4_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@check(
    "mon_1_freshness",
    """SELECT max(ts) AS last_synced_timestamp,
        datesub('minute', max(ts), TIMESTAMP '2024-02-01 12:00:00') AS minutes_behind,
        count(*) AS total_records FROM events""",
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.freshness(table(spark, sf_dir, "events"), "ts", datetime(2024, 2, 1, 12))


@check("srt_1_order_by_time", "SELECT * FROM events ORDER BY ts, event_id")
def order_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.ordered(table(spark, sf_dir, "events"), "ts", ["event_id"])


@check(
    "lim_1_top_orders",
    "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.top(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderkey"], 100)
