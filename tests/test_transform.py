"""Configured transformations."""

from pyspark.sql import functions as F

from tidemark.config import TransformSpec
from tidemark.operators.transform import ERROR, chain, transform


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_rename_and_convert(spark):
    df = spark.createDataFrame(
        [(1, "Widget", "29.99", "5", "2024-01-15"), (2, "Gadget", "19.99", "3", "2024-01-16")],
        "old_id BIGINT, old_name STRING, price_string STRING, quantity_string STRING, created_at STRING",
    )
    spec = TransformSpec.from_json(
        """{"field_mappings": {"old_id": "id", "old_name": "name"},
            "type_conversions": {"price_string": "FLOAT", "quantity_string": "INTEGER"}}"""
    )
    got = sorted(rows(transform(df, spec).ok()), key=lambda r: r["id"])
    assert [(r["id"], r["name"], r["price_string"], r["quantity_string"]) for r in got] == [
        (1, "Widget", 29.99, 5), (2, "Gadget", 19.99, 3)
    ]
    assert "old_id" not in got[0]


def test_unreadable_config_passes_through(spark):
    df = spark.range(2)
    for text in (None, "", "{not json", "[1]"):
        spec = TransformSpec.from_json(text)
        assert spec.is_empty() and rows(transform(df, spec).ok()) == rows(df)


def test_failed_record_keeps_its_original_values(spark):
    df = spark.createDataFrame([(1, "5"), (2, "abc"), (3, None)], "id INT, n STRING")
    done = transform(
        df,
        TransformSpec(
            field_mappings={"id": "key"}, type_conversions={"n": "integer"}, calculated_fields={"m": "n + key"}
        ),
    )
    assert rows(done.errors()) == [{"id": 2, "n": "abc", ERROR: "cannot convert n to integer: abc"}]
    assert sorted(rows(done.ok()), key=lambda r: r["key"]) == [
        {"key": 1, "n": 5, "m": 6}, {"key": 3, "n": None, "m": None}
    ]
    merged = sorted(rows(done.merged()), key=lambda r: r["key"] or r["id"])
    assert merged[1] == {"key": None, "n": "abc", "m": None, "id": 2, ERROR: "cannot convert n to integer: abc"}
    assert merged[0]["n"] == "5"


def test_values_of_types_that_cannot_be_numbers_fail(spark):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS t")
    done = transform(df, TransformSpec(type_conversions={"t": "float"}))
    assert done.errors().count() == 1 and done.ok().count() == 0


def test_null_stays_null_in_value_rules(spark):
    df = spark.createDataFrame([(None,)], "s STRING")
    for rule in ("upper", "lower", "trim"):
        assert transform(df, TransformSpec(value_transformations={"s": {"type": rule}})).ok().first()["s"] is None


def test_calculated_fields(spark):
    df = spark.createDataFrame([(1, 2.5, "x", True, None)], "a INT, b DOUBLE, s STRING, f BOOLEAN, z INT")
    fields = {
        "sum": "a + b", "missing": "a + nope", "text": "a + s", "null": "a + z", "flag": "a + f",
        "length": "len(b)", "no_length": "len(nope)", "again": "sum + sum", "copy": "s", "none": "nope",
    }
    got = transform(df, TransformSpec(calculated_fields=fields)).ok().first().asDict()
    assert {k: got[k] for k in fields} == {
        "sum": 3.5, "missing": 1, "text": None, "null": None, "flag": 2, "length": 3, "no_length": 0,
        "again": 7.0, "copy": "x", "none": None,
    }


def test_defaults_and_flatten(spark):
    df = spark.createDataFrame([(1, None, '{"a": {"b": [1]}, "c": "t"}')], "id INT, s STRING, j STRING")
    spec = TransformSpec(
        flatten_nested={"j.a.b": "list", "j.c": "text", "j.x.y": "gone", "nope.a": "none"},
        default_values={"s": "active", "version": "1.0", "id": 9},
    )
    got = transform(df, spec).ok().first().asDict()
    assert (got["list"], got["text"], got["gone"], got["none"]) == ("[1]", "t", None, None)
    assert (got["s"], got["version"], got["id"]) == ("active", "1.0", 1)


def test_custom_functions_run_in_order(spark):
    add = lambda n: lambda df: df.withColumn("id", F.col("id") * 2 + n)
    assert rows(chain(spark.range(1), [add(1), add(5)])) == [{"id": 7}]
