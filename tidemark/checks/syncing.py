"""PIP: whole syncs."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.checks import check, new_sink, table, view
from tidemark.config import SourceSpec, SyncJob, SyncSpec, TransformSpec
from tidemark.operators.schema import destination_struct
from tidemark.operators.write import create_table
from tidemark.plans.sync import run_sync
from tidemark.session import shared_dir

NOW = datetime(1999, 1, 1)
FIRST = datetime(1998, 1, 1)


@check(
    "pip_1_full_refresh",
    """SELECT o_orderkey AS id, o_custkey, lower(o_orderstatus) AS status, o_totalprice, o_orderdate,
        o_orderpriority, o_custkey + o_orderkey AS keys FROM orders""",
)
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes leave the rows of one."""
    orders = view(spark, sf_dir, "orders")
    job = SyncJob(
        sources=[SourceSpec("postgresql", {"query": f"SELECT * FROM {orders}"})],
        sink=new_sink(spark, write="truncate", partition_field=None, clustering_fields=("o_custkey",)),
        transform=TransformSpec(
            field_mappings={"o_orderkey": "id", "o_orderstatus": "status"},
            value_transformations={"status": {"type": "lower"}},
            calculated_fields={"keys": "o_custkey + id"},
        ),
    )
    run_sync(spark, job, NOW)
    result = run_sync(spark, job, NOW)
    return spark.table(result.table)


def _incremental_job(spark: SparkSession, sf_dir: str, on_empty: str, days: int = 1) -> SyncJob:
    orders = view(spark, sf_dir, "orders")
    return SyncJob(
        sources=[SourceSpec("postgresql", {"query": f"SELECT * FROM {orders}"})],
        sink=new_sink(spark, partition_field=None),
        sync=SyncSpec(
            incremental=True, timestamp_column="o_orderdate", on_empty=on_empty, fallback_days=days
        ),
    )


@check("pip_2_incremental_sync", "SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '1999-01-01'")
def incremental_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _incremental_job(spark, sf_dir, "since_1900")
    run_sync(spark, job, FIRST)
    result = run_sync(spark, job, NOW)
    return spark.table(result.table)


@check(
    "pip_2_template_sync",
    """SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
       WHERE o_orderdate <= TIMESTAMP '1999-01-01' AND o_orderstatus IN ('F', 'O')""",
)
def template_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base query with placeholders, run twice; the second run reads only what is new."""
    template = f"""SELECT o_orderkey, o_orderdate, o_orderstatus FROM {view(spark, sf_dir, 'orders')}
        WHERE o_orderdate > '{{start_timestamp}}' AND o_orderdate <= '{{end_timestamp}}'
          AND o_orderstatus IN ('F', 'O') ORDER BY o_orderdate ASC"""
    job = replace(
        _incremental_job(spark, sf_dir, "since_1900"),
        sources=[SourceSpec("postgresql", {"template": template})],
    )
    run_sync(spark, job, FIRST)
    return spark.table(run_sync(spark, job, NOW).table)


@check(
    "pip_failed_conversions",
    """SELECT p_partkey, price, CASE WHEN price IS NULL THEN 'cannot convert price to float: on request' END
        AS _transformation_error FROM (SELECT p_partkey, CASE WHEN p_brand <> 'Brand#7' THEN p_retailprice END AS price FROM part)""",
)
def failed_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record whose conversion fails is written too, with the reason beside it."""
    text = F.when(F.col("p_brand") == "Brand#7", "on request").otherwise(F.col("p_retailprice").cast("string"))
    parts = table(spark, sf_dir, "part").select("p_partkey", text.alias("price"))
    parts.createOrReplaceTempView("priced_parts")
    job = SyncJob(
        sources=[SourceSpec("postgresql", {"query": "SELECT * FROM priced_parts"})],
        sink=new_sink(spark, partition_field=None),
        transform=TransformSpec(type_conversions={"price": "FLOAT"}),
    )
    return spark.table(run_sync(spark, job, NOW).table)


@check("pip_3_historical_load", "SELECT * FROM orders")
def historical_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = run_sync(spark, _incremental_job(spark, sf_dir, "all_rows"), NOW)
    return spark.table(result.table)


@check(
    "pip_4_lookback_first_run",
    "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-12-02' AND o_orderdate <= TIMESTAMP '1999-01-01'",
)
def lookback_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = run_sync(spark, _incremental_job(spark, sf_dir, "lookback", days=30), NOW)
    return spark.table(result.table)


@check(
    "pip_5_document_sync",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "_id", o_totalprice AS total, o_orderdate AS created_at,
        '{"priority":"' || o_orderpriority || '"}' AS customer, '["' || o_orderstatus || '", "' || o_orderpriority || '"]' AS tags
       FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000""",
)
def document_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents, filtered and projected, into a table created from their schema."""
    from tidemark.checks.reading import ORDER_DOCUMENT, _order_documents

    path = f"{shared_dir(spark)}/documents"
    _order_documents(spark, sf_dir).write.json(path)
    job = SyncJob(
        sources=[
            SourceSpec(
                "mongodb",
                {
                    "path": path,
                    "schema": ORDER_DOCUMENT,
                    "filter": '{"status": "F", "total": {"$gte": 100000}}',
                    "projection": '{"total": 1, "created_at": 1, "customer.priority": 1, "tags": 1}',
                },
            )
        ],
        sink=new_sink(spark, partition_field=None),
        sync=SyncSpec(measure_schema=True),
    )
    result = run_sync(spark, job, NOW)
    written = spark.table(result.table)
    shown = F.concat(F.lit("["), F.array_join("tags", ", "), F.lit("]"))
    return written.withColumn("tags", shown)


@check(
    "pip_6_query_copy",
    """SELECT user_id, event_type, ts, json_extract_string(props, '$.k') AS page, CAST(ts AS DATE) AS ts_day
       FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
)
def query_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = view(spark, sf_dir, "events")
    query = f"""SELECT user_id, event_type, ts, get_json_object(props, '$.k') AS page FROM {events}
        WHERE to_date(ts) = to_date(:today)"""
    job = SyncJob(
        sources=[SourceSpec("bigquery", {"query": query, "arguments": {"today": "2024-01-15"}})],
        sink=new_sink(spark, write="truncate", partition_field="ts"),
    )
    return spark.table(run_sync(spark, job, NOW).table)


@check(
    "pip_7_multi_source_union",
    """SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS code, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, 'S' || s_nationkey, NULL FROM supplier""",
)
def multi_source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = view(spark, sf_dir, "customer")
    path = f"{shared_dir(spark)}/suppliers"
    table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("code"),
    ).write.json(path)
    query = f"""SELECT c_custkey AS id, c_name AS name, c_nationkey AS code, c_mktsegment AS segment
        FROM {customer}"""
    job = SyncJob(
        sources=[
            SourceSpec("postgresql", {"query": query}),
            SourceSpec("mongodb", {"path": path, "schema": "id BIGINT, name STRING, code STRING"}),
        ],
        sink=new_sink(spark, partition_field=None),
    )
    return spark.table(run_sync(spark, job, NOW).table)


@check("pip_8_table_replication", "SELECT * FROM lineitem")
def table_replication(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = new_sink(spark, partition_field=None), new_sink(spark, partition_field=None)
    first = SyncJob(
        sources=[SourceSpec("bigquery", {"query": f"SELECT * FROM {view(spark, sf_dir, 'lineitem')}"})],
        sink=source,
    )
    run_sync(spark, first, NOW)
    copy = replace(first, sources=[SourceSpec("bigquery", {"table": source.table})], sink=target)
    return spark.table(run_sync(spark, copy, NOW).table)


@check(
    "pip_rejected_records",
    """SELECT doc_id, lang, CASE WHEN doc_id IS NULL THEN 'x' END AS reason FROM documents
       WHERE lang <> 'fr' UNION ALL SELECT doc_id, lang, 'Required field source is null' FROM documents WHERE lang = 'fr'""",
)
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows are kept as data, with the reason."""
    from tidemark.operators.schema import FieldSpec
    from tidemark.operators.validate import REASON, validate

    source = F.when(F.col("lang") != "fr", F.col("source"))
    documents = table(spark, sf_dir, "documents").withColumn("source", source)
    flagged = validate(documents, {"source": FieldSpec("STRING", "REQUIRED")}, require=True)
    return flagged.select("doc_id", "lang", F.col(REASON).alias("reason"))


@check(
    "pip_rejects_of_a_sync",
    """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'validation' WHEN p_size % 5 = 1 THEN 'transformation'
        WHEN p_size % 5 = 2 THEN 'types' ELSE 'table' END AS found_in FROM part""",
)
def rejects_of_a_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three kinds of reject, read back from their folders; a repeated refresh replaces them."""
    kind = F.col("p_size") % 5
    table(spark, sf_dir, "part").select(
        "p_partkey", F.when(kind != 0, F.col("p_brand")).alias("brand"),
        F.when(kind == 1, F.lit("on request")).otherwise(F.lit("2.5")).alias("price"),
        F.when(kind == 2, F.lit("many")).otherwise(F.col("p_size").cast("string")).alias("size"),
    ).createOrReplaceTempView("parts_in_text")
    sink = new_sink(spark, write="truncate", partition_field=None)
    columns = (("p_partkey", "INTEGER"), ("brand", "STRING"), ("price", "FLOAT"), ("size", "INTEGER"))
    rows = [
        Row(name=n, destination_type=t, mode="REQUIRED" if n == "brand" else "NULLABLE", description=n) for n, t in columns
    ]
    create_table(spark, sink, destination_struct(rows))
    job = SyncJob(
        sources=[SourceSpec("postgresql", {"query": "SELECT * FROM parts_in_text"})],
        sink=sink,
        transform=TransformSpec(type_conversions={"price": "FLOAT"}),
        rejects_path=f"{shared_dir(spark)}/rejects",
        require_fields=True,
    )
    run_sync(spark, job, NOW)
    result = run_sync(spark, job, NOW)
    found = spark.table(result.table).select("p_partkey", F.lit("table").alias("found_in"))
    for folder in ("validation", "transformation", "types"):
        rejects = spark.read.parquet(f"{result.rejects}/{folder}")
        found = found.unionByName(rejects.select("p_partkey", F.lit(folder).alias("found_in")))
    return found


@check("pip_2_template_all_rows", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS o_orderdate FROM orders")
def template_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run of a template reads rows without and after the window's time as well."""
    orders = table(spark, sf_dir, "orders")
    dated = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")).alias("o_orderdate")
    orders.select("o_orderkey", dated).createOrReplaceTempView("orders_partly_dated")
    template = "SELECT * FROM orders_partly_dated WHERE {window} ORDER BY o_orderdate"
    job = replace(
        _incremental_job(spark, sf_dir, "all_rows"), sources=[SourceSpec("postgresql", {"template": template})]
    )
    return spark.table(run_sync(spark, job, FIRST).table)


@check("pip_recreate_incremental", "SELECT * FROM orders")
def recreate_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A destination created anew by an incremental sync holds all history, not only what is new."""
    job = _incremental_job(spark, sf_dir, "all_rows")
    run_sync(spark, job, FIRST)
    again = replace(job, sink=replace(job.sink, delete_existing=True))
    return spark.table(run_sync(spark, again, NOW).table)
