"""Kept current versions, and custom data sources."""

from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.checks import new_sink
from tidemark.config import SourceSpec, SyncJob, SyncSpec
from tidemark.operators import current
from tidemark.operators.current import CurrentVersions
from tidemark.operators.incremental import Window
from tidemark.operators.monitor import latest_per_key
from tidemark.plans.sync import read_rows, run_sync
from tidemark.session import shared_dir
from tidemark.sources import read_source
from tidemark.sources.custom import Adapter, Condition, as_text, from_text, matching, register_source
from tests.test_plans import plan


def versions(spark, lo: int, hi: int):
    """Keys 0 to 99 and null, versions by day; ties in the timestamp."""
    return spark.range(lo, hi).selectExpr(
        "nullif(id * 7 % 101, 100) AS k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id / 60 AS INT)) AS at", "id AS v", "concat('n', id % 3) AS name"
    )


def same(a, b) -> bool:
    columns = sorted(a.columns)
    return sorted(map(str, a.select(*columns).collect())) == sorted(map(str, b.select(*columns).collect()))


@pytest.fixture
def table(spark):
    return CurrentVersions(f"{shared_dir(spark)}/current", ["k"], "at", ["v"], buckets=16)


def test_increments_leave_the_latest_versions(spark, table):
    assert table.read(spark) is None
    every = versions(spark, 0, 600)
    assert len(table.merge(versions(spark, 0, 200))) == 16
    assert table.merge(versions(spark, 150, 400)) and table.merge(versions(spark, 390, 600))
    assert same(table.read(spark), latest_per_key(every, ["k"], "at", ["v"]))


def test_only_touched_buckets_are_rewritten(spark, table):
    table.merge(versions(spark, 0, 600))
    before = {r[0]: r[1] for r in spark.read.parquet(table.path).groupBy("_bucket").agg(F.max("_metadata.file_modification_time")).collect()}
    assert table.merge(versions(spark, 0, 300)) == []  # older versions, and a re-run
    few = versions(spark, 600, 603)
    rewritten = table.merge(few)
    assert 1 <= len(rewritten) <= 3 and table.merge(few) == []
    after = {r[0]: r[1] for r in spark.read.parquet(table.path).groupBy("_bucket").agg(F.max("_metadata.file_modification_time")).collect()}
    assert {b for b in after if after[b] != before[b]} == set(rewritten)
    assert same(table.read(spark), latest_per_key(versions(spark, 0, 603), ["k"], "at", ["v"]))


def test_a_run_that_breaks_off_is_finished(spark, table, monkeypatch):
    table.merge(versions(spark, 0, 200))

    class Stopped(Exception):
        pass

    finish, calls = CurrentVersions._finish, []

    def stop(self, session):
        calls.append(1)
        if len(calls) == 2:
            raise Stopped
        finish(self, session)

    with monkeypatch.context() as patch:
        patch.setattr(current.CurrentVersions, "_finish", stop)
        with pytest.raises(Stopped):
            table.merge(versions(spark, 200, 400))
    table.merge(versions(spark, 0, 1))
    assert same(table.read(spark), latest_per_key(versions(spark, 0, 400), ["k"], "at", ["v"]))


def test_rows_with_fields_the_table_lacks_are_refused(spark, table):
    table.merge(versions(spark, 0, 10))
    with pytest.raises(ValueError):
        table.merge(versions(spark, 0, 10).withColumn("more", F.lit(1)))
    table.merge(versions(spark, 10, 20).drop("name"))
    assert table.read(spark).filter("name IS NULL").count() == 10


class Days(Adapter):
    """A row an hour, one slice a day."""

    def schema(self, options):
        return "id BIGINT, at TIMESTAMP_NTZ, name STRING"

    def plan(self, options, conditions):
        days = range(int(options["days"]))
        least = max((c.value for c in conditions if c.comparison in (">", ">=")), default=datetime.min)
        return [d for d in days if datetime(2024, 1, d + 1, 23) >= least]

    def read(self, options, schema, conditions, piece):
        hours = range(24)
        batch = pa.record_batch(
            [pa.array([24 * piece + h for h in hours]), pa.array([datetime(2024, 1, piece + 1, h) for h in hours], pa.timestamp("us")),
             pa.array([None if h % 5 == 0 else f"h{h % 4}" for h in hours])], ["id", "at", "name"],
        )
        yield matching(batch, conditions)


def test_custom_data_source(spark):
    register_source(spark, "test_days", Days())
    df = spark.read.format("test_days").option("days", 6).load()
    assert df.rdd.getNumPartitions() == 6 and df.count() == 144
    asked = [Condition("at", ">", datetime(2024, 1, 5, 12)), Condition("name", "in", ["h2", "h3"])]
    window = read_source(spark, SourceSpec("test_days", {"days": 6, "conditions": asked}))
    assert window.rdd.getNumPartitions() == 2
    wanted = [i for i in range(109, 144) if i % 24 % 5 and i % 24 % 4 in (2, 3)]
    assert sorted(r["id"] for r in window.collect()) == wanted
    # One DataFrame, several filters: none of them stays for the next.
    assert df.filter("at > timestamp_ntz'2024-01-05 12:00:00'").count() == 35
    assert df.filter("name IN ('h1', 'h3') OR id = 0").count() == sum(1 for i in range(144) if i == 0 or (i % 24 % 5 and i % 24 % 4 in (1, 3)))
    assert df.count() == 144 and from_text(as_text(asked)) == asked


def test_a_sync_gives_its_window_to_the_source(spark):
    register_source(spark, "test_days", Days())
    job = SyncJob([SourceSpec("test_days", {"days": 9})], new_sink(spark, partition_field="at"), SyncSpec(incremental=True, timestamp_column="at", on_empty="since_1900"))
    assert run_sync(spark, job, datetime(2024, 1, 3, 5)).written == 54
    frame = read_rows(spark, job.sources[0], job, Window(datetime(2024, 1, 3, 5), datetime(2024, 1, 5)), datetime(2024, 1, 5))
    assert frame.rdd.getNumPartitions() == 7
    assert run_sync(spark, job, datetime(2024, 1, 5)).written == 43 and spark.table(job.sink.table).count() == 97


def test_conditions():
    batch = pa.record_batch([pa.array([1, None, 3, 4])], ["a"])
    for comparison, value, left in (("=", 3, [3]), (">", 1, [3, 4]), (">=", 3, [3, 4]), ("<", 3, [1]), ("<=", 3, [1, 3]), ("in", (1, 4), [1, 4]), ("not null", None, [1, 3, 4])):
        assert matching(batch, [Condition("a", comparison, value)]).column("a").to_pylist() == left
