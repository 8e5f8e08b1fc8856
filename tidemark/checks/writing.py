"""SNK: creating and writing destination tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.checks import check, new_sink, table
from tidemark.checks.reading import PLACES, _places
from tidemark.operators import schema as schemas
from tidemark.operators.write import TableNotEmpty, create_table, write_batch, write_table
from tidemark.session import shared_dir


@check("snk_1_create_from_schema", "SELECT * FROM events")
def create_from_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is created from the mapped schema; creating it again changes nothing."""
    events = table(spark, sf_dir, "events")
    sink = new_sink(spark, partition_field=None)
    mapped = schemas.map_schema(schemas.declared_schema(events, schemas.RELATIONAL), schemas.RELATIONAL)
    struct = schemas.destination_struct(schemas.mapped_rows(mapped))
    assert create_table(spark, sink, struct)
    write_table(events, sink)
    assert not create_table(spark, sink, struct)
    return spark.table(sink.table)


@check(
    "snk_2_day_partitions",
    "SELECT event_id, ts, CAST(ts AS DATE) AS ts_day FROM events",
)
def day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark, partition_field="ts")
    write_table(table(spark, sf_dir, "events").select("event_id", "ts"), sink)
    return spark.table(sink.table)


@check("snk_2_absent_partition_field", "SELECT * FROM supplier")
def absent_partition_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark, partition_field="updated_at")
    write_table(table(spark, sf_dir, "supplier"), sink)
    return spark.table(sink.table)


@check(
    "snk_3_clustering",
    "SELECT *, CAST(ts AS DATE) AS ts_day FROM events",
)
def clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark, partition_field="ts", clustering_fields=("user_id", "event_type"))
    write_table(table(spark, sf_dir, "events"), sink)
    return spark.table(sink.table)


@check(
    "snk_3_files_apart",
    """SELECT CAST(ts AS DATE) AS ts_day, count(*) AS n, count(DISTINCT user_id) AS users, 0::BIGINT AS overlaps
       FROM events GROUP BY 1""",
)
def files_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day: rows and users of the table as written, and pairs of neighbouring files that share more than
    the user between them. Small files, so that a day has several."""
    events = table(spark, sf_dir, "events")
    sink = new_sink(spark, partition_field="ts", clustering_fields=("user_id", "event_type"), cluster="table", file_bytes=1024)
    write_table(events, sink)
    stored = spark.table(sink.table)
    by_day = Window.partitionBy("ts_day").orderBy("least", "most")
    files = stored.groupBy("ts_day", F.col("_metadata.file_path").alias("file")).agg(
        F.min("user_id").alias("least"), F.max("user_id").alias("most")
    )
    shared = files.withColumn("before", F.max("most").over(by_day.rowsBetween(Window.unboundedPreceding, -1)))
    days = shared.groupBy("ts_day").agg(F.count_if(F.col("before") > F.col("least")).alias("overlaps"))
    rows = stored.groupBy("ts_day").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))
    return rows.join(days, "ts_day").select("ts_day", "n", "users", "overlaps")


@check("snk_4_drop_and_recreate", "SELECT s_suppkey, s_name FROM supplier")
def drop_and_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    write_table(table(spark, sf_dir, "customer"), sink)
    write_table(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
        replace(sink, delete_existing=True),
    )
    return spark.table(sink.table)


@check("snk_5_append", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    suppliers = table(spark, sf_dir, "supplier")
    write_table(suppliers, sink)
    write_table(suppliers.select(*reversed(suppliers.columns)), sink)
    return spark.table(sink.table)


@check("snk_6_truncate", "SELECT *, CAST(ts AS DATE) AS ts_day FROM events WHERE event_type = 'view'")
def truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark, partition_field="ts", write="truncate")
    events = table(spark, sf_dir, "events")
    write_table(events, sink)
    write_table(events.filter("event_type = 'view'"), sink)
    return spark.table(sink.table)


@check("snk_7_write_if_empty", "SELECT * FROM supplier")
def write_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write is refused and leaves the table as it was."""
    sink = new_sink(spark, write="empty")
    suppliers = table(spark, sf_dir, "supplier")
    write_table(suppliers, sink)
    try:
        write_table(suppliers, sink)
    except TableNotEmpty:
        return spark.table(sink.table)
    raise AssertionError("a table with rows was written to")


@check("snk_8_create_if_needed", "SELECT * FROM part")
def create_if_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark, create="if_needed")
    write_table(table(spark, sf_dir, "part"), sink)
    return spark.table(sink.table)


@check("snk_9_create_never", "SELECT * FROM part")
def create_never(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused while the table is missing, accepted once it exists."""
    sink = new_sink(spark, create="never")
    parts = table(spark, sf_dir, "part")
    try:
        write_table(parts, sink)
    except LookupError:
        create_table(spark, sink, parts.schema)
        write_table(parts, sink)
        return spark.table(sink.table)
    raise AssertionError("a missing table was created")


@check(
    "snk_10_added_columns",
    """SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_acctbal, CAST(NULL AS INTEGER) AS s_nationkey FROM supplier
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier""",
)
def added_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    suppliers = table(spark, sf_dir, "supplier")
    write_table(suppliers.select("s_suppkey", "s_name"), sink)
    write_table(suppliers, sink)
    return spark.table(sink.table)


@check(
    "snk_10_nested_columns",
    """SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, NULL::INT AS region, c_acctbal AS balance, 'c' AS kind, NULL AS name FROM customer
       UNION ALL SELECT s_suppkey, s_nationkey + 5000000000, 'S' || s_nationkey, NULL, s_acctbal, 's', s_name FROM supplier
       UNION ALL SELECT n_nationkey, NULL, NULL, n_regionkey, NULL, NULL, NULL FROM nation""",
)
def nested_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches whose nested fields come in another order, are new or wider are appended; old rows read null."""
    sink = new_sink(spark)
    for batch in _places(spark, sf_dir):
        write_table(batch, sink)
    return spark.table(sink.table).selectExpr(*PLACES)


@check("snk_batch_rerun", "SELECT event_id, user_id, event_type AS sync_batch FROM events")
def batch_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeated batch replaces itself and leaves the other batches alone."""
    path = f"{shared_dir(spark)}/batches"
    events = table(spark, sf_dir, "events")
    for kind in ("view", "signup", "purchase", "click", "error", "view", "click"):
        rows = events.filter(F.col("event_type") == kind)
        write_batch(rows.select("event_id", "user_id"), path, kind)
    return spark.read.schema("event_id BIGINT, user_id BIGINT, sync_batch STRING").parquet(path)
