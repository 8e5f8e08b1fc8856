"""Nested types: joined, grown and cast by field name; tables that are replaced and recovered."""

from dataclasses import replace
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checks import new_sink
from tidemark.config import SourceSpec, SyncJob
from tidemark.operators import nested, write
from tidemark.operators.validate import REASON, conform
from tidemark.operators.write import write_table
from tidemark.plans.sync import run_sync

NOW = datetime(2024, 1, 1)
LEAVES = st.sampled_from([T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DecimalType(10, 2), T.BooleanType()])
TYPES = st.recursive(
    LEAVES,
    lambda inner: st.one_of(
        st.builds(T.ArrayType, inner),
        st.builds(lambda v: T.MapType(T.StringType(), v), inner),
        st.dictionaries(st.sampled_from("abcd"), inner, min_size=1, max_size=3).map(
            lambda d: T.StructType([T.StructField(k, t) for k, t in d.items()])
        ),
    ),
    max_leaves=6,
)


@given(TYPES, TYPES)
@settings(max_examples=300, deadline=None)
def test_the_lattice(a, b):
    joined = nested.common_type([a, b])
    assert nested.common_type([a, a]) == a and nested.common_type([a, T.NullType()]) == a
    assert nested.common_type([joined, a]) == joined and nested.common_type([joined, b]) == joined
    grown = nested.grown_type(a, b)
    assert nested.grown_type(grown, b) == grown and nested.grown_type(grown, a) == grown
    assert nested.lacking(grown, b) == [] and nested.lacking(a, a) == []


def test_values_follow_by_name(spark):
    df = spark.sql(
        "SELECT named_struct('b', 20, 'a', 10, 'c', array(named_struct('y', 1, 'x', 'one'), NULL)) AS s, map('k', named_struct('v', 1, 'u', 2)) AS m"
    )
    target = T._parse_datatype_string("a BIGINT, b STRING, c ARRAY<STRUCT<x: STRING, y: DOUBLE, z: DATE>>, d INT")
    maps = T._parse_datatype_string("MAP<STRING, STRUCT<u: INT, v: INT>>")
    row = df.select(
        nested.rebuilt(F.col("s"), df.schema["s"].dataType, target).alias("s"), nested.rebuilt(F.col("m"), df.schema["m"].dataType, maps).alias("m")
    ).first()
    assert row["s"].asDict(recursive=True) == {"a": 10, "b": "20", "c": [{"x": "one", "y": 1.0, "z": None}, None], "d": None}
    assert row["m"]["k"].asDict() == {"u": 2, "v": 1}


def test_a_nested_value_that_does_not_fit_is_rejected(spark):
    df = spark.sql("SELECT * FROM VALUES (1, named_struct('n', '7', 'l', array('1', NULL))), (2, named_struct('n', 'x', 'l', array('1'))), "
                   "(3, named_struct('n', '8', 'l', array('2', 'y'))), (4, NULL) AS t(id, s)")  # fmt: skip
    rows = conform(df, {"s": T._parse_datatype_string("l ARRAY<INT>, n INT")}).collect()
    bad = {r["id"]: r[REASON] for r in rows if r[REASON]}
    assert set(bad) == {2, 3} and "s does not fit" in bad[2]
    assert rows[0]["s"].asDict() == {"l": [1, None], "n": 7} and rows[3]["s"] is None


BATCHES = [
    "SELECT 1 AS id, named_struct('a', 10, 'b', 'x') AS s, timestamp_ntz'2024-01-01 00:00:00' AS updated_at",
    "SELECT 2 AS id, named_struct('b', 'y', 'a', 20) AS s, timestamp_ntz'2024-01-02 00:00:00' AS updated_at",
    "SELECT 3 AS id, named_struct('c', named_struct('d', 1.5D), 'b', 'z', 'a', 5000000000) AS s, timestamp_ntz'2024-01-02 00:00:00' AS updated_at",
]
STORED = [(1, 10, "x", None), (2, 20, "y", None), (3, 5000000000, "z", 1.5)]


@pytest.mark.parametrize(("managed", "day"), [(False, "updated_at"), (True, "updated_at"), (False, None)])
def test_nested_fields_are_reordered_added_and_widened(spark, managed, day):
    sink = new_sink(spark, partition_field=day)
    sink = replace(sink, path=None) if managed else sink
    for batch in BATCHES:
        write_table(spark.sql(batch), sink)
    stored = spark.table(sink.table)
    assert sorted(tuple(r) for r in stored.select("id", "s.a", "s.b", "s.c.d").collect()) == STORED
    write_table(spark.sql(BATCHES[0]), replace(sink, write="truncate"))
    assert spark.table(sink.table).count() == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{sink.table}__")]


def test_nested_fields_in_a_sync(spark):
    sink = new_sink(spark)
    write_table(spark.sql(BATCHES[0]), sink)
    for batch in BATCHES[1:]:
        spark.sql(batch).createOrReplaceTempView("nested_batch")
        result = run_sync(spark, SyncJob([SourceSpec("postgresql", {"query": "SELECT * FROM nested_batch"})], sink), NOW)
        assert (result.written, result.rejected) == (1, 0)
    assert sorted(tuple(r) for r in spark.table(sink.table).select("id", "s.a", "s.b", "s.c.d").collect()) == STORED


def test_nested_fields_are_refused_where_the_table_may_not_grow(spark):
    sink = new_sink(spark, add_columns=False)
    write_table(spark.sql(BATCHES[0]), sink)
    with pytest.raises(ValueError, match="s.c"):
        write_table(spark.sql(BATCHES[2]), sink)
    write_table(spark.sql(BATCHES[1]), sink)
    assert sorted(tuple(r) for r in spark.table(sink.table).select("id", "s.a", "s.b").collect()) == [r[:3] for r in STORED[:2]]


def test_a_wider_number_widens_the_column(spark):
    sink = new_sink(spark, partition_field=None)
    for value in ("1", "5000000000", "1.5D", "CAST(2.25 AS DECIMAL(10,2))"):
        write_table(spark.sql(f"SELECT {value} AS n"), sink)
    assert sorted(r["n"] for r in spark.table(sink.table).collect()) == [1.0, 1.5, 2.25, 5e9]


def test_metadata_outlives_growth(spark):
    sink = new_sink(spark, partition_field=None)
    kept = T.StructType([T.StructField("j", T.StringType(), True, {"destination_type": "JSON"}), T.StructField("s", T._parse_datatype_string("a INT"))])
    write.create_table(spark, sink, kept)
    write_table(spark.sql("SELECT '{}' AS j, named_struct('a', 1, 'b', 2) AS s"), sink)
    assert spark.table(sink.table).schema["j"].metadata["destination_type"] == "JSON"


class Stopped(Exception):
    pass


@pytest.mark.parametrize("managed", [False, True])
@pytest.mark.parametrize("step", range(8))
def test_a_replacement_that_is_broken_off(spark, monkeypatch, step, managed):
    """Stopped after each step, the table holds the old rows or the new ones after the next run's recovery."""
    sink = replace(new_sink(spark, partition_field=None), delete_existing=True)
    sink = replace(sink, path=None) if managed else sink
    write_table(spark.range(3).toDF("id"), replace(sink, delete_existing=False))
    spark.range(10, 15).toDF("id").createOrReplaceTempView("new_rows")
    job = SyncJob([SourceSpec("postgresql", {"query": "SELECT * FROM new_rows"})], sink)
    done = []

    def stopping(run):
        def wrapped(*args):
            if len(done) >= step:
                raise Stopped
            result = run(*args)
            done.append(run.__name__)
            if len(done) >= step:
                raise Stopped
            return result

        return wrapped

    with monkeypatch.context() as patch:
        for name in ("_rename", "retire", "drop_table"):
            patch.setattr(write, name, stopping(getattr(write, name)))
        try:
            run_sync(spark, job, NOW)
        except Stopped:
            pass
    write.recover(spark, sink.table)
    found = sorted(r["id"] for r in spark.table(sink.table).collect())
    assert found in ([0, 1, 2], [10, 11, 12, 13, 14])
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{sink.table}__")]
    assert run_sync(spark, job, NOW).written == 5
    assert sorted(r["id"] for r in spark.table(sink.table).collect()) == [10, 11, 12, 13, 14]


def test_growth_that_is_broken_off_keeps_the_files(spark, monkeypatch):
    """The grown entry lies over the same files: recovery must drop the other entry without them."""
    sink = new_sink(spark)
    write_table(spark.sql(BATCHES[0]), sink)
    renamed = write._rename

    def once(spark_, old, new):
        renamed(spark_, old, new)
        raise Stopped

    for _ in range(3):
        with monkeypatch.context() as patch:
            patch.setattr(write, "_rename", once)
            with pytest.raises(Stopped):
                write_table(spark.sql(BATCHES[2]), sink) if spark.catalog.tableExists(sink.table) else write.recover(spark, sink.table)
        if spark.catalog.tableExists(sink.table) and "c" in spark.table(sink.table).schema["s"].dataType.names:
            break
    write.recover(spark, sink.table)
    assert [r["id"] for r in spark.table(sink.table).collect()] == [1]
    write_table(spark.sql(BATCHES[2]), sink)
    assert sorted(r["id"] for r in spark.table(sink.table).collect()) == [1, 3]
