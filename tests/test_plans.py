"""The physical plans that the design relies on."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import checks
from tidemark.checks import new_sink, table
from tidemark.operators import monitor
from tidemark.operators.incremental import Window, extract, newest_day
from tidemark.operators.predicates import document_filter
from tidemark.operators.schema import FieldSpec, first_walk
from tidemark.operators.validate import validate
from tidemark.operators.write import layout, with_day, write_table

checks.load()
WINDOW = Window(datetime(2024, 1, 10), datetime(2024, 1, 12))


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", ["sch_3_document_schema", "val_4_repeated", "val_5_json_column", "trf_17_all_records",
                                  "flt_7_and_or_on_variant", "val_1_array_literal", "win_1_gap_detection"])
def test_no_python_on_executors(spark, sf_dir, name):
    text = plan(checks.QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_window_reaches_the_scan(spark, sf_dir):
    text = plan(extract(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", WINDOW))
    assert "GreaterThan(ts,2024-01-10T00:00)" in text and "LessThanOrEqual(ts,2024-01-12T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_day_predicate_prunes_partitions(spark, sf_dir):
    sink = new_sink(spark, partition_field="ts")
    write_table(table(spark, sf_dir, "events").select("event_id", "ts"), sink)
    stored = spark.table(sink.table)
    assert "PartitionFilters: [isnotnull(ts_day" in plan(extract(stored, "ts", WINDOW, "ts_day"))
    newest = stored.filter(F.col("ts_day") == newest_day(spark, sink.table, "ts_day"))
    assert "PartitionFilters: [isnotnull(ts_day" in plan(newest.agg(F.max("ts")))


def test_document_filter_reaches_the_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = plan(document_filter(orders, '{"o_orderstatus": "F", "o_totalprice": {"$gte": 1000}}'))
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThanOrEqual(o_totalprice,1000.0)" in text


def test_validation_is_one_narrow_stage(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = plan(validate(events, {"props": FieldSpec("JSON")}))
    assert "Exchange" not in text


def test_latest_per_key_reduces_before_the_shuffle(spark, sf_dir):
    text = plan(monitor.latest_per_key(table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"]))
    assert text.count("WindowGroupLimit") >= 2 and text.count("Exchange hashpartitioning") <= 1


def test_top_is_no_full_sort(spark, sf_dir):
    text = plan(monitor.top(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderkey"], 10))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_layout_lets_a_hot_day_be_split(spark, sf_dir):
    events = with_day(table(spark, sf_dir, "events"), "ts")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(layout(events, "ts_day", ["user_id"]))


def test_a_hot_day_is_written_by_several_tasks(spark):
    """A third of all rows on one day, all alike, still leaves that day in several files."""
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(
            F.date_add(F.lit("2024-01-02").cast("date"), (F.col("id") % 50).cast("int")).cast("string")
        ).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise(F.uuid()).alias("payload"),
    )
    sink = new_sink(spark, partition_field="ts", clustering_fields=("payload",))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "100k")
    try:
        write_table(rows, sink)
    finally:
        spark.conf.unset(key)
    stored = spark.table(sink.table)
    files = stored.filter("ts_day = DATE'2024-01-01'").select("_metadata.file_name").distinct().count()
    assert files > 1 and stored.count() == 300_000


def test_document_schema_shuffles_counts_only(spark, sf_dir):
    documents = table(spark, sf_dir, "orders").select(F.to_variant_object(F.struct("*")).alias("document"))
    text = plan(first_walk(documents, "document"))
    assert "Python" not in text and "partial_count" in text and text.count("Exchange hashpartitioning") <= 1
