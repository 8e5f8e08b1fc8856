"""Dispositions, layout and schema evolution of destination tables."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.checks import new_sink
from tidemark.config import SourceSpec, SyncJob, SyncSpec
from tidemark.operators import write
from tidemark.operators.write import TableNotEmpty, create_table, layout, write_batch, write_table
from tidemark.plans.sync import run_sync
from tidemark.session import shared_dir


@pytest.fixture
def rows(spark):
    return spark.range(6).select(
        "id", F.timestamp_add("HOUR", F.col("id") * 12, F.lit("2024-01-01").cast("timestamp_ntz")).alias("updated_at")
    )


def test_dispositions(spark, rows):
    sink = new_sink(spark)
    write_table(rows, sink)
    write_table(rows, sink)
    assert spark.table(sink.table).count() == 12
    with pytest.raises(TableNotEmpty):
        write_table(rows, replace(sink, write="empty"))
    write_table(rows.limit(1), replace(sink, write="truncate"))
    assert spark.table(sink.table).count() == 1
    with pytest.raises(LookupError):
        write_table(rows, new_sink(spark, create="never"))
    with pytest.raises(ValueError):
        write_table(rows, replace(sink, write="upsert"))


def test_truncate_replaces_every_partition_in_a_dynamic_session(spark, rows):
    sink = new_sink(spark)
    write_table(rows, sink)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(rows.filter("id = 0"), replace(sink, write="truncate"))
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.table(sink.table).count() == 1


def test_day_partitions_and_null_days(spark, rows):
    sink = new_sink(spark)
    write_table(rows.union(spark.sql("SELECT 99L, CAST(NULL AS TIMESTAMP_NTZ)")), sink)
    days = {str(r["updated_at_day"]): r["count"] for r in spark.table(sink.table).groupBy("updated_at_day").count().collect()}
    assert days == {"2024-01-01": 2, "2024-01-02": 2, "2024-01-03": 2, "None": 1}


def test_delete_existing_removes_the_rows_too(spark, rows):
    sink = new_sink(spark)
    write_table(rows, sink)
    assert create_table(spark, replace(sink, delete_existing=True), rows.schema)
    assert spark.table(sink.table).count() == 0


def test_columns_are_matched_by_name_and_added(spark, rows):
    sink = new_sink(spark)
    write_table(rows, sink)
    write_table(rows.select("updated_at", F.lit("n").alias("note"), "id"), sink)
    stored = spark.table(sink.table)
    assert stored.filter("note = 'n'").count() == 6 and stored.filter("note IS NULL").count() == 6


def test_data_the_table_lacks_a_column_for_is_refused(spark, rows):
    sink = new_sink(spark, add_columns=False)
    write_table(rows, sink)
    with pytest.raises(ValueError):
        write_table(rows.withColumn("note", F.lit("n")), sink)
    assert spark.table(sink.table).count() == 6


def test_contradicting_options_are_refused(spark, rows):
    never = new_sink(spark, create="never", delete_existing=True)
    with pytest.raises(ValueError):
        write_table(rows, replace(never, create="if_needed", write="nope"))
    with pytest.raises(ValueError):
        run_sync(spark, SyncJob([SourceSpec("postgresql", {"query": "SELECT 1"})], never), datetime(2024, 1, 1))


def test_created_anew_by_an_incremental_sync(spark, rows):
    """Everything is read again, and the old rows go only when the new ones are there."""
    rows.createOrReplaceTempView("anew_rows")
    job = SyncJob([SourceSpec("postgresql", {"query": "SELECT * FROM anew_rows"})], new_sink(spark), SyncSpec(incremental=True))
    now = datetime(2024, 2, 1)
    assert run_sync(spark, job, now).written == 6
    anew = replace(job, sink=replace(job.sink, delete_existing=True))
    result = run_sync(spark, anew, now)
    assert (result.table, result.written, spark.table(job.sink.table).count()) == (job.sink.table, 6, 6)
    own = replace(anew, sources=[SourceSpec("postgresql", {"query": f"SELECT id, updated_at FROM {job.sink.table}"})])
    with pytest.raises(ValueError):
        run_sync(spark, own, now)
    assert spark.table(job.sink.table).count() == 6


def test_no_row_is_lost(spark):
    """Rows written and rows rejected are the rows read, also without a folder for rejects and with default options."""
    spark.sql("SELECT id, id AS code FROM range(5)").createOrReplaceTempView("left_rows")
    spark.sql("SELECT id + 100 AS id, concat('S', id) AS code FROM range(7)").createOrReplaceTempView("right_rows")
    sources = [SourceSpec("postgresql", {"query": f"SELECT * FROM {v}"}) for v in ("left_rows", "right_rows")]
    job = SyncJob(sources, new_sink(spark))
    result = run_sync(spark, job, datetime(2024, 1, 1))
    assert (result.written, result.rejected, spark.table(job.sink.table).count()) == (12, 0, 12)
    spark.sql(f"CREATE TABLE {job.sink.table}_n (id BIGINT, code BIGINT) USING parquet LOCATION '{job.sink.path}_n'")
    narrow = replace(job, sink=replace(job.sink, table=f"{job.sink.table}_n", path=f"{job.sink.path}_n"))
    result = run_sync(spark, narrow, datetime(2024, 1, 1))
    assert (result.written, result.rejected) == (5, 7)
    assert spark.read.parquet(f"{result.rejects}/types").count() == 7


def test_clustering_is_checked(rows):
    with pytest.raises(ValueError):
        layout(rows, None, ["nope"])


def test_a_batch_replaces_itself(spark, rows):
    path = f"{shared_dir(spark)}/batches"
    for batch, n in (("a", 6), ("b", 2), ("a", 3)):
        write_batch(rows.filter(F.col("id") < n), path, batch)
    stored = {r["sync_batch"]: r["count"] for r in spark.read.parquet(path).groupBy("sync_batch").count().collect()}
    assert stored == {"a": 3, "b": 2}


def test_rejects_are_written_and_counted(spark):
    spark.sql("SELECT 1 AS id, 'x' AS t").createOrReplaceTempView("reject_rows")
    job = SyncJob(
        [SourceSpec("postgresql", {"query": "SELECT * FROM reject_rows"})],
        new_sink(spark),
        rejects_path=f"{shared_dir(spark)}/rejects",
    )
    result = run_sync(spark, job, datetime(2024, 1, 1))
    assert (result.written, result.rejected) == (1, 0)
    spark.sql("SELECT * FROM VALUES ('7', 'y'), ('seven', 'z') AS r(id, t)").createOrReplaceTempView("reject_rows")
    result = run_sync(spark, job, datetime(2024, 1, 1))
    assert (result.written, result.rejected) == (1, 1)
    assert sorted(r["id"] for r in spark.table(job.sink.table).collect()) == [1, 7]
    misfit = spark.read.parquet(f"{job.rejects_path}/types").first()
    assert misfit["t"] == "z" and misfit["_reject_reason"] == "id does not fit bigint: seven"


def test_small_files_of_a_clustered_table_share_tasks(spark):
    """As many files as were asked for, each a run of the order, but tasks that don't grow with them."""
    days = F.timestamp_add("DAY", F.col("id") % 3, F.lit("2024-01-01").cast("timestamp_ntz"))
    rows = spark.range(0, 6_000, 1, 4).select((F.col("id") * 7919 % 1009).alias("a"), days.alias("ts"), F.uuid().alias("c"))
    for mode in ("append", "truncate"):
        sink = new_sink(spark, partition_field="ts", clustering_fields=("a",), cluster="table", file_bytes=1024, write=mode)
        write_table(rows, sink)
        stored = spark.table(sink.table)
        files = stored.groupBy("ts_day", "_metadata.file_name").agg(F.min("a").alias("least"), F.max("a").alias("most"), F.count("*").alias("n")).collect()
        files.sort(key=lambda r: (r["ts_day"], r["least"], r["most"]))
        assert len(files) > 150 and sum(r["n"] for r in files) == stored.distinct().count() == 6_000
        assert all(x["ts_day"] != y["ts_day"] or x["most"] <= y["least"] for x, y in zip(files, files[1:], strict=False))
        tasks = {r["file_name"].split("-")[1] for r in files}
        assert len(tasks) <= write.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        assert int(spark.conf.get(write.FILE_ROWS)) == 0
