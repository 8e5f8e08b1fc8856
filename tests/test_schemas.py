"""Schema detection and mapping."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions.jsontext import parse
from tidemark.operators import schema as schemas
from tidemark.sources.documents import parse_documents


def inferred(spark, documents, **options):
    texts = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "i INT, raw STRING")
    rows = schemas.document_schema(parse_documents(texts, "raw"), "document", **options).collect()
    return {r["name"]: r.asDict() for r in rows}


def test_nested_document_paths(spark):
    document = {
        "_id": "a",
        "user": {"name": "n", "email": "e", "profile": {"age": 3, "city": "c", "more": {"deep": 1}}},
        "items": [{"product": "p", "quantity": 2}, {"other": 1}],
    }
    assert set(inferred(spark, [document], compat=True)) == {
        "_id", "user", "user.name", "user.email", "user.profile", "user.profile.age",
        "user.profile.city", "user.profile.more", "items", "items.product", "items.quantity",
    }


def test_heterogeneous_documents(spark):
    found = inferred(
        spark,
        [
            {"event_data": {"product_id": "P", "price": 29.99, "currency": "USD", "quantity": 2}},
            {"event_data": {"product_id": "Q", "duration_seconds": 45}},
        ],
    )
    assert found["event_data.product_id"]["nullable"] is False
    for name in ("price", "currency", "quantity", "duration_seconds"):
        field = found[f"event_data.{name}"]
        assert field["nullable"] is True and field["frequency"] == 0.5
    assert found["event_data.price"]["type"] == "double"
    assert found["event_data.quantity"]["type"] == "int"


def test_null_counts_as_present_and_loses_ties(spark):
    found = inferred(spark, [{"a": None}, {"a": 1}, {"b": "x"}, {"b": 2}])
    assert found["a"]["type"] == "int" and found["a"]["sample_count"] == 2
    assert found["a"]["type_frequency"] == 0.5 and found["b"]["type"] == "int"


def test_row_order_does_not_matter(spark):
    documents = [{"a": 1, "b": {"c": [1]}}, {"a": "x"}, {"a": 2.5, "b": []}, {"b": {"c": None}}]
    assert inferred(spark, documents) == inferred(spark, documents[::-1])


def test_a_dot_in_a_key_counts_as_depth(spark):
    assert set(inferred(spark, [{"a.b": {"c": {"d": 1}}}], compat=True)) == {"a.b", "a.b.c"}
    assert set(inferred(spark, [{"a.b": {"c": {"d": 1}}}])) == {"a.b", "a.b.c", "a.b.c.d"}


def test_arrays_nested_three_and_more_deep(spark):
    documents = [
        {"a": [[[{"x": 1}]]]},
        {"a": [[[[[{"x": 2.5, "y": [[[[{"z": "t"}]], 7]]}, 3]]], {"x": 1}]]},
        {"a": [[[]]], "b": [[[1, 2]]]},
    ]
    found = inferred(spark, documents)
    assert set(found) == {"a", "a.x", "a.y", "a.y.z", "b"}
    assert (found["a"]["type"], found["a"]["sample_count"], found["a"]["type_frequency"]) == ("array", 3, 1.0)
    assert (found["a.x"]["type"], found["a.x"]["sample_count"]) == ("int", 2)
    assert (found["a.y.z"]["type"], found["a.y.z"]["sample_count"]) == ("string", 1)
    texts = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "i INT, raw STRING")
    counts = schemas.path_type_counts(parse_documents(texts, "raw"), "document").collect()
    assert {(r["path"], r["type"], r["n"]) for r in counts} == {
        ("a", "array", 3), ("a.x", "int", 2), ("a.x", "double", 1), ("a.y", "array", 1), ("a.y.z", "string", 1), ("b", "array", 1),
    }


def test_all_elements_count_once_for_a_document(spark):
    found = inferred(spark, [{"a": [{"x": 1}, {"x": 2}, {"x": "t", "y": {"z": [[{"w": 1}]]}}]}, {"a": []}])
    assert set(found) == {"a", "a.x", "a.y", "a.y.z", "a.y.z.w"}
    assert (found["a.x"]["type"], found["a.x"]["sample_count"], found["a.x"]["frequency"]) == ("int", 1, 0.5)


def mapped(spark, rows, kind, mapping="fixed", columns="name STRING, type STRING, nullable BOOLEAN"):
    df = schemas.map_schema(spark.createDataFrame(rows, columns), kind, mapping)
    return {r["name"]: (r["destination_type"], r["mode"]) for r in df.collect()}


def test_catalog_rows(spark):
    rows = [
        ("id", "integer", False), ("name", "character varying", True),
        ("created_at", "timestamp without time zone", False), ("metadata", "jsonb", True),
        ("tags", "ARRAY", True), ("day", "date", True), ("raw", "bytea", True),
        ("at", "time without time zone", True), ("kind", "USER-DEFINED", True), ("sizes", "integer[]", True),
    ]
    assert mapped(spark, rows, schemas.RELATIONAL) == {
        "id": ("INTEGER", "REQUIRED"), "name": ("STRING", "NULLABLE"),
        "created_at": ("TIMESTAMP", "REQUIRED"), "metadata": ("JSON", "NULLABLE"),
        "tags": ("STRING", "REPEATED"), "day": ("DATE", "NULLABLE"), "raw": ("BYTES", "NULLABLE"),
        "at": ("TIME", "NULLABLE"), "kind": ("STRING", "NULLABLE"), "sizes": ("INTEGER", "REPEATED"),
    }
    compat = mapped(spark, rows, schemas.RELATIONAL, "compat")
    assert compat["day"][0] == "TIMESTAMP" and compat["raw"][0] == "STRING"
    assert compat["tags"] == ("JSON", "REPEATED") and compat["at"][0] == "STRING"


def test_warehouse_rows(spark):
    columns = "name STRING, type STRING, mode STRING, nullable BOOLEAN"
    rows = [
        ("id", "INTEGER", "REQUIRED", False), ("name", "STRING", "NULLABLE", True),
        ("metadata", "JSON", "NULLABLE", True), ("tags", "STRING", "REPEATED", False),
        ("timestamp", "TIMESTAMP", "NULLABLE", True), ("place", "GEOGRAPHY", "NULLABLE", True),
    ]
    got = mapped(spark, rows, schemas.WAREHOUSE, columns=columns)
    assert got == {r[0]: (r[1], r[2]) for r in rows}
    assert mapped(spark, rows, schemas.WAREHOUSE, "compat", columns)["place"][0] == "STRING"


def test_struct_keeps_type_mode_and_comment(spark):
    rows = spark.createDataFrame([("a.b", "int", True), ("a", "object", False)], "name STRING, type STRING, nullable BOOLEAN")
    struct = schemas.destination_struct(schemas.mapped_rows(schemas.map_schema(rows, schemas.DOCUMENT)))
    assert struct.fieldNames() == ["a"]
    assert schemas.field_specs(struct) == {"a": schemas.FieldSpec("JSON", "REQUIRED")}
    assert struct["a"].metadata["comment"] == "Auto-generated from source column: a (object)"


def test_declared_schema_reads_no_rows(spark):
    df = spark.range(1).select(
        F.col("id"), F.array(F.lit(1.5)).alias("xs"), F.struct(F.lit(1).alias("a")).alias("s")
    )
    rows = {r["name"]: (r["type"], r["mode"]) for r in schemas.declared_schema(df, schemas.WAREHOUSE).collect()}
    assert rows == {"id": ("INTEGER", "REQUIRED"), "xs": ("FLOAT", "REPEATED"), "s": ("RECORD", "REQUIRED")}


def kind_of(v):
    if isinstance(v, dict):
        return {("$oid",): "objectId", ("$date",): "date"}.get(tuple(v), "object")
    names = {bool: "boolean", int: "int", float: "double", str: "string", list: "array", type(None): "null"}
    return names[type(v)]


def brute_paths(document, prefix="", found=None):
    """Paths and types of one document, for comparison only."""
    found = [] if found is None else found
    for key, v in document.items():
        kind = kind_of(v)
        found.append((prefix + key, kind))
        inner = v if kind == "object" else (v[0] if kind == "array" and v else None)
        if prefix.count(".") < 2 and isinstance(inner, dict) and kind_of(inner) == "object":
            brute_paths(inner, f"{prefix}{key}.", found)
    return found


def test_random_documents(spark):
    rng = random.Random(11)

    def value(depth):
        choice = rng.randrange(10 if depth < 5 else 7)
        if choice < 7:
            return [None, True, 7, 2.5, "x", {"$oid": "a1"}, {"$date": "2024-01-01"}][choice]
        if choice == 7:
            return [value(depth + 1) for _ in range(rng.randrange(3))]
        return {rng.choice(["a", "b", "c", "d.e"]): value(depth + 1) for _ in range(rng.randrange(4))}

    documents = [{k: value(1) for k in rng.sample(["a", "b", "c", "d.e", "f"], 3)} for _ in range(300)]
    expected = Counter(p for d in documents for p in brute_paths(d))
    texts = spark.createDataFrame([(json.dumps(d),) for d in documents], "raw STRING")
    # Ids stay wrapped here, so that their class is seen.
    variants = texts.select(parse(F.col("raw")).alias("document"))
    got = {(r["path"], r["type"]): r["n"] for r in schemas.path_type_counts(variants, "document", compat=True).collect()}
    assert got == dict(expected)


@pytest.mark.parametrize("per_core", [0, 1, 2])
def test_documents_are_walked_by_several_tasks_of_a_core(spark, per_core):
    """Also where the source has a partition for each core: the walk of one would last as long as all of it."""
    cores = spark.sparkContext.defaultParallelism
    texts = spark.range(0, 400, 1, max(1, per_core * cores)).select(F.format_string('{"a":{"b":%d}}', "id").alias("raw"))
    variants = texts.select(parse(F.col("raw")).alias("document"))
    assert schemas._documents(variants, "document").rdd.getNumPartitions() >= 4 * cores
    assert {(r["path"], r["n"]) for r in schemas.path_type_counts(variants, "document").collect()} == {("a", 400), ("a.b", 400)}
