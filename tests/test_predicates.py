"""Document filters and projections."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import predicates
from tidemark.operators.predicates import document_filter
from tidemark.operators.projection import project
from tidemark.sources.documents import DocumentSource, parse_documents, pipeline

DOCUMENTS = [
    """{"_id":"1","status":"active","age":17,"verified":true,"tags":["vip","new"],"email":"a@example.com",
        "created_at":"2024-12-31T00:00:00","plan":"free","credits":150,"profile":{"name":"A","age":1},
        "items":[{"sku":"x","n":1},{"sku":"y","n":9}]}""",
    """{"_id":"2","status":"active","age":18,"verified":false,"tags":["old"],"email":"b@example.org",
        "created_at":"2025-01-01T00:00:00","plan":"premium","credits":0,"profile":{"name":"B","age":2},"items":[]}""",
    """{"_id":"3","status":"closed","age":65,"verified":true,"tags":[],"email":"c@example.com",
        "created_at":"2025-02-01T00:00:00","plan":"premium","credits":500,"profile":null}""",
]
SCHEMA = """_id STRING, status STRING, age INT, verified BOOLEAN, tags ARRAY<STRING>, email STRING,
    created_at TIMESTAMP_NTZ, plan STRING, credits INT, profile STRUCT<name: STRING, age: INT>,
    items ARRAY<STRUCT<sku: STRING, n: INT>>"""

FILTERS = [
    ('{"status": "active"}', {"1", "2"}),
    ('{"status": "active", "verified": true}', {"1"}),
    ('{"age": {"$gte": 18, "$lte": 65}}', {"2", "3"}),
    ('{"age": {"$gt": 17, "$lt": 65}}', {"2"}),
    ('{"tags": {"$in": ["premium", "vip"]}}', {"1"}),
    ('{"tags": "old"}', {"2"}),
    ('{"age": {"$in": [17, 65]}}', {"1", "3"}),
    (r'{"email": {"$regex": "@example\\.com$"}}', {"1", "3"}),
    ('{"created_at": {"$gte": {"$date": "2025-01-01T00:00:00Z"}}}', {"2", "3"}),
    ("""{"$and": [{"status": "active"}, {"$or": [{"plan": "premium"}, {"credits": {"$gte": 100}}]}]}""", {"1", "2"}),
    ('{"profile.name": "B"}', {"2"}),
    ('{"profile": null}', {"3"}),
    ('{"items.sku": "y"}', {"1"}),
    ('{"items.n": {"$gt": 5}}', {"1"}),
    ('{"age": "17"}', set()),
    ('{"status": 1}', set()),
    ('{"nope": 1}', set()),
    ("{}", {"1", "2", "3"}),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([(d,) for d in DOCUMENTS], "raw STRING")


@pytest.fixture(scope="module")
def typed(raw):
    return raw.select(F.from_json("raw", SCHEMA).alias("d")).select("d.*")


def ids(df):
    return {r["_id"] for r in df.collect()}


@pytest.mark.parametrize("spec, wanted", FILTERS)
def test_filters_on_typed_documents(typed, spec, wanted):
    assert ids(document_filter(typed, spec)) == wanted


@pytest.mark.parametrize("spec, wanted", [f for f in FILTERS if "items" not in f[0]])
def test_filters_on_variant_documents(raw, spec, wanted):
    documents = parse_documents(raw, "raw")
    found = document_filter(documents, spec, variant="document")
    assert ids(found.select(F.get_json_object("raw", "$._id").alias("_id"))) == wanted


@pytest.mark.parametrize("spec", ['{"a": {"$near": 1}}', '{"$where": "1"}'])
def test_unknown_operators_are_refused(typed, spec):
    with pytest.raises(ValueError):
        document_filter(typed, spec)


def test_projections(typed):
    assert project(typed, '{"status": 1, "age": 1, "nope": 1}').columns == ["_id", "status", "age"]
    assert project(typed, '{"_id": 0, "status": 1}').columns == ["status"]
    assert "age" not in project(typed, '{"age": 0, "tags": 0}').columns
    assert project(typed, '{"_id": 0}').columns == typed.columns[1:]
    assert project(typed, "{}").columns == typed.columns
    nested = project(typed, '{"profile.name": 1, "items.sku": 1}')
    first = {r["_id"]: r for r in nested.collect()}
    assert first["1"]["profile"].asDict() == {"name": "A"} and first["3"]["profile"] is None
    assert [i.asDict() for i in first["1"]["items"]] == [{"sku": "x"}, {"sku": "y"}]
    dropped = project(typed, '{"profile.name": 0}')
    assert dropped.schema["profile"].dataType.fieldNames() == ["age"]
    with pytest.raises(ValueError):
        project(typed, '{"a": 1, "b": 0}')


LEAF = st.one_of(st.integers(-2, 4), st.floats(-2, 4).map(lambda x: round(x, 1)), st.booleans(), st.none(), st.sampled_from(["a", "b", "5f" * 12]))
TESTS = st.one_of(
    LEAF, st.fixed_dictionaries({}, optional={"$gte": st.integers(-2, 4), "$lt": st.sampled_from([3, 2.5, "b"]), "$in": st.lists(LEAF, max_size=3)}).filter(bool),
    st.just({"$regex": "^a"}), st.just({"$date": "2024-01-01T00:00:00Z"}),
)
FILTERS = st.recursive(
    st.dictionaries(st.sampled_from(["x", "y", "n.z", "_id"]), TESTS, max_size=3),
    lambda inner: st.builds(lambda k, v: {k: v}, st.sampled_from(["$and", "$or"]), st.lists(inner, min_size=1, max_size=3)), max_leaves=5,
)


def test_both_parts_of_a_filter_are_the_whole(spark):
    """On documents of uneven shape, for random filters."""
    found = []

    @given(FILTERS)
    @settings(max_examples=40, deadline=None, database=None)
    def collect(spec):
        found.append(spec)

    collect()
    rng = random.Random(3)
    values = [0, 1, 2.5, "a", "b", True, None, [1, "a"], "5f" * 12]
    documents = [json.dumps({k: rng.choice(values) for k in ("x", "y", "_id") if rng.random() < 0.8} | {"n": {"z": rng.choice(values)}}) for _ in range(60)]
    df = spark.createDataFrame([(d,) for d in documents], "raw STRING").select("raw", F.parse_json("raw").alias("v")).cache()
    columns = []
    for k, spec in enumerate(found):
        pushed, rest = predicates.split_filter(spec)
        both = predicates.filter_condition(df.schema, pushed, "v") & predicates.filter_condition(df.schema, rest, "v")
        columns.append((predicates.filter_condition(df.schema, spec, "v") != both).alias(f"c{k}"))
    for at in range(0, len(columns), 10):
        assert not any(any(r) for r in df.select(*columns[at : at + 10]).collect())


def test_what_a_database_is_asked(spark):
    spec = {"a": 5, "b": {"$gt": 1, "$regex": "x"}, "_id": "5f", "c": "5f" * 12, "$or": [{"d": 1}, {"e": {"$lt": "z"}}], "$and": [{"f": None}, {"g": {"$date": "2024-01-01"}}]}
    pushed, rest = predicates.split_filter(spec)
    assert pushed == {"$and": [{"a": {"$eq": 5}}, {"b": {"$gt": 1}}, {"f": {"$eq": None}}]}
    assert predicates.fields_of(rest) == {"b", "_id", "c", "d", "e", "g"} and predicates.split_filter({}) == ({}, {})
    source = DocumentSource("d", "c", filter=spec, projection={"a": 1, "n.z": 1, "_id": 0})
    stages, left = pipeline(source)
    assert stages == [{"$match": pushed}, {"$project": {"a": 1, "b": 1, "c": 1, "d": 1, "e": 1, "g": 1, "n": 1, "_id": 1}}] and left == rest
    assert pipeline(DocumentSource("d", "c", projection={"secret": 0})) == ([], {})
    with pytest.raises(ValueError):
        predicates.split_filter({"a": {"$where": "1"}})


def test_a_parsed_document_is_parsed_once_for_a_filter(spark):
    """Spark writes out what a column is made of at each of its mentions, so one may be left."""
    raws = ['{"n": {"$numberLong": "3"}, "at": {"$date": "2024-01-02T00:00:00Z"}}', '{"n": [1, 3.0, "x"]}', '{"n": "3"}', '{"n": null}', "{}", None, "[]", "no JSON"]
    texts = spark.createDataFrame([(i, raw) for i, raw in enumerate(raws)], "i INT, raw STRING")
    documents = parse_documents(texts, "raw")
    for spec, wanted in (
        ({"n": {"$in": [3, 5, 7, "x"]}}, [0, 1]),
        ({"n": {"$in": ["3", None]}}, [2, 3, 4, 5, 6, 7]),
        ({"n": {"$in": []}}, []),
        ({"$or": [{"n": {"$gt": 2, "$lt": 4}}, {"at": {"$gte": {"$date": "2024-01-01T00:00:00Z"}}}]}, [0, 1]),
        ({"n": [1, 3.0, "x"]}, [1]),
        ({"n": None}, [3, 4, 5, 6, 7]),
    ):
        kept = document_filter(documents, json.dumps(spec), variant="document").select("i")
        assert sorted(r["i"] for r in kept.collect()) == wanted, spec
        text = kept._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("parseJson") <= 1 and text.count("regexp_replace") <= 4
