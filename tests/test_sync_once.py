"""Ledger of runs, one evaluation of each row, and the database's own catalog."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.checks import new_sink
from tidemark.config import SourceSpec, SyncJob, SyncSpec, TransformSpec
from tidemark.operators import schema as schemas
from tidemark.operators import write
from tidemark.operators.ledger import BEGUN, Ledger
from tidemark.operators.write import write_table
from tidemark.plans import sync
from tidemark.plans.sync import run_sync
from tidemark.session import shared_dir
from tests.test_plans import plan

NOW = datetime(2024, 1, 5)


def rows_until(spark, day: int):
    moment = "timestamp_ntz'2024-01-01 06:00:00' + make_dt_interval(CAST(id AS INT))"
    spark.sql(f"SELECT id, {moment} AS updated_at FROM range({day})").createOrReplaceTempView("ledger_rows")


@pytest.fixture
def job(spark):
    source = SourceSpec("postgresql", {"query": "SELECT * FROM ledger_rows"})
    return SyncJob([source], new_sink(spark), SyncSpec(incremental=True, ledger=f"{shared_dir(spark)}/ledger"))


def test_mark_without_a_scan(spark, job, monkeypatch):
    rows_until(spark, 3)
    assert run_sync(spark, job, datetime(2024, 1, 10)).written == 3
    ledger = Ledger(job.sync.ledger)
    assert ledger.mark(spark, job.sink.table, "updated_at_day") == datetime(2024, 1, 3, 6)
    rows_until(spark, 5)
    monkeypatch.setattr(sync, "destination_mark", lambda *a: pytest.fail("the table was scanned"))
    assert run_sync(spark, job, datetime(2024, 1, 10)).written == 2
    assert run_sync(spark, job, datetime(2024, 1, 10)).written == 0
    assert ledger.mark(spark, job.sink.table, "updated_at_day") == datetime(2024, 1, 5, 6)
    assert job.sink.path not in plan(ledger.runs(spark, job.sink.table))


def test_ledger_that_can_not_be_believed(spark, job):
    ledger = Ledger(job.sync.ledger)
    assert ledger.mark(spark, job.sink.table) is None
    rows_until(spark, 3)
    run_sync(spark, job, NOW)
    # Another writer added a day.
    write_table(spark.sql("SELECT 9L AS id, timestamp_ntz'2024-01-04 01:00:00' AS updated_at"), job.sink)
    assert ledger.mark(spark, job.sink.table, "updated_at_day") is None
    rows_until(spark, 4)
    assert run_sync(spark, job, NOW).window.start == datetime(2024, 1, 4, 1)
    # A run broke off after its data were written.
    assert ledger.mark(spark, job.sink.table, "updated_at_day") == datetime(2024, 1, 4, 6)
    ledger.note(spark, job.sink.table, "broken", BEGUN, sync._clock())
    assert ledger.mark(spark, job.sink.table, "updated_at_day") is None
    rows_until(spark, 5)
    assert run_sync(spark, job, datetime(2024, 1, 9)).written == 1
    assert ledger.mark(spark, job.sink.table, "updated_at_day") == datetime(2024, 1, 5, 6)


def test_truncate_sets_the_mark_back(spark, job):
    rows_until(spark, 4)
    run_sync(spark, job, datetime(2024, 1, 9))
    rows_until(spark, 2)
    again = replace(job, sink=replace(job.sink, write="truncate"), sync=replace(job.sync, incremental=False))
    run_sync(spark, again, datetime(2024, 1, 9))
    assert Ledger(job.sync.ledger).mark(spark, job.sink.table) == datetime(2024, 1, 2, 6)


@pytest.mark.parametrize("rejects", [True, False])
def test_each_row_is_evaluated_once(spark, rejects):
    """Rows, invalid, failed and misfit records come from one evaluation, whatever the source does meanwhile."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(i):
        calls.add(1)
        return "x" * 500 if i % 10 == 0 else "soon" if i % 10 == 1 else str(i)

    def read(session, options):
        # Not deterministic: a second evaluation would deal rows otherwise.
        df = session.range(0, 200, 1, 4).withColumn("t", seen.asNondeterministic()("id"))
        return df.withColumn("r", F.rand() < 0.5).withColumn("n", F.when(F.col("r"), F.col("t")).otherwise(F.lit("7")))

    from tidemark.sources import register_reader

    register_reader("once", read)
    folder = f"{shared_dir(spark)}/rejects" if rejects else None
    job = SyncJob(
        [SourceSpec("once")], new_sink(spark, partition_field=None), SyncSpec(auto_schema=False),
        TransformSpec(type_conversions={"n": "INTEGER"}), rejects_path=folder, stage=True, max_record_chars=300,
    )
    result = run_sync(spark, job, NOW)
    assert calls.value == 200
    table = spark.table(job.sink.table)
    kinds = ["validation", "transformation"] if rejects else ["validation"]
    found = {kind: spark.read.parquet(f"{result.rejects}/{kind}").count() for kind in kinds}
    assert result.written == table.count() and table.count() + sum(found.values()) == 200
    assert found["validation"] == result.rejected == 20 and found.get("transformation", result.failed) == result.failed > 0


def test_staged_records_are_those_of_two_passes(spark):
    texts = "(1, 'a', '1'), (2, concat('nul', chr(0)), '2'), (3, 'c', 'x'), (4, 'd', NULL)"
    spark.sql(f"SELECT *, NULL AS nothing FROM VALUES {texts} AS t(id, name, n)").createOrReplaceTempView("staged_rows")
    found = []
    for stage in (True, False):
        folder = f"{shared_dir(spark)}/rejects"
        job = SyncJob(
            [SourceSpec("postgresql", {"query": "SELECT id, name, n FROM staged_rows"})], new_sink(spark, partition_field=None),
            transform=TransformSpec(type_conversions={"n": "INTEGER"}, field_mappings={"name": "title"}), rejects_path=folder, stage=stage,
            custom=[lambda df: df.withColumn("twice", F.col("id") * 2)],
        )
        result = run_sync(spark, job, NOW)
        rejected = {}
        for kind, n in (("validation", result.rejected), ("transformation", result.failed)):
            if n:
                df = spark.read.parquet(f"{folder}/{kind}")
                rejected[kind] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
        rows = spark.table(job.sink.table)
        found.append((result.written, result.rejected, result.failed, sorted(map(str, rows.select(*sorted(rows.columns)).collect())), rejected))
    assert found[0] == found[1] and found[0][:3] != (4, 0, 0)


def test_catalog_of_the_database(spark, monkeypatch):
    """The driver shows text; the catalog says JSON, lengths, defaults and what is required."""
    spark.sql("""SELECT 1L AS id, '{"a":1}' AS payload, 'x' AS code, '2.5' AS price, array('t') AS tags""").createOrReplaceTempView("catalog_rows")
    said = [
        ("id", "bigint", None, 0, "nextval('s')", 1), ("payload", "jsonb", None, 1, None, 2), ("code", "character varying", 12, 0, "'x'", 3),
        ("price", "text", None, 1, None, 4), ("tags", "ARRAY", None, 1, None, 5), ("unread", "uuid", None, 1, None, 6),
    ]
    asked = []

    def fake(session, source):
        asked.append(source.query)
        return session.createDataFrame(said, "name STRING, type STRING, max_length INT, is_nullable INT, `default` STRING, position INT")

    monkeypatch.setattr(sync, "read_relational", fake)
    monkeypatch.setattr(sync, "read_rows", lambda session, *a: session.table("catalog_rows"))
    job = SyncJob(
        [SourceSpec("postgresql", {"url": "jdbc:x", "table": "sales.orders", "partitions": 1})], new_sink(spark, partition_field=None),
        transform=TransformSpec(field_mappings={"payload": "document"}, type_conversions={"price": "FLOAT"}),
    )
    run_sync(spark, job, NOW)
    assert len(asked) == 1 and "table_schema = 'sales' AND table_name = 'orders'" in asked[0]
    schema = spark.table(job.sink.table).schema
    specs = schemas.field_specs(schema)
    assert specs["document"].type == "JSON" and specs["code"].type == "STRING" and specs["price"].type == "FLOAT"
    assert (specs["id"].mode, specs["code"].mode, specs["tags"].mode) == ("REQUIRED", "REQUIRED", "REPEATED")
    assert schema["code"].metadata["max_length"] == 12 and schema["code"].metadata["default"] == "'x'" and "unread" not in schema.names
    assert spark.table(job.sink.table).first()["document"] == '{"a":1}'
    assert sync.source_catalog(spark, SourceSpec("postgresql", {"query": "SELECT 1"})) is None


def test_files_of_a_clustered_table_are_apart(spark):
    """Also with a value that holds half of all rows: the next field splits it, and no file grows with it."""
    rows = spark.range(0, 20_000, 1, 4).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 7 ELSE id % 50 END AS a", "CASE WHEN id % 4 = 0 THEN 0 ELSE id % 97 END AS b", "uuid() AS c"
    )
    sink = new_sink(spark, partition_field=None, clustering_fields=("a", "b"), cluster="table", file_bytes=80_000)
    write_table(rows, sink)
    key = F.struct("a", "b")
    files = spark.table(sink.table).groupBy("_metadata.file_path").agg(F.min(key).alias("least"), F.max(key).alias("most"), F.count("*").alias("n")).collect()
    files.sort(key=lambda r: (r["least"], r["most"]))
    assert len(files) > 5 and sum(r["n"] for r in files) == 20_000 and max(r["n"] for r in files) < 20_000 / len(files) * 3
    assert all(x["most"] <= y["least"] for x, y in zip(files, files[1:], strict=False))
    with pytest.raises(ValueError):
        write_table(rows, replace(sink, cluster="nothing"))
    assert write.CLUSTERED == ("files", "table")
