"""Coercion and rejection against the record-wise rules written out in Python."""

import base64
import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from tidemark.operators.schema import FieldSpec
from tidemark.operators.validate import REASON, coerce, reject_reason, split, validate


def one(spark, value, spec, dtype="STRING", **options):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return coerce(df, {"x": spec} if spec else None, **options).first()["x"]


TEXTS = ["plain", "{hello}", "{a, b}", '{"k": 1}', "[1, 2]", "{broken: }", "[1,", "  {x}  ", "{}", "[]", "",
         '{"k":1} x}', "{a\nb}", "a [b] c", "[not json]"]


def compact(v):
    return json.dumps(v, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def is_json(s):
    try:
        json.loads(s)
    except ValueError:
        return False
    return True


def expected_text(v):
    """The rules for a text column, record by record."""
    s = v.strip()
    if s.startswith("{") and s.endswith("}") and ":" not in s:
        if "\n" in s:
            return s
        return compact([i.strip() for i in s[1:-1].split(",") if i.strip()])
    wrapped = (s[:1], s[-1:]) in (("{", "}"), ("[", "]"))
    return compact(json.loads(s)) if wrapped and is_json(s) else v


@pytest.mark.parametrize("spec", [FieldSpec("STRING"), None])
def test_text_columns(spark, spec):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(TEXTS)], "i INT, x STRING")
    schema = {"x": spec} if spec else None
    got = {r["i"]: r["x"] for r in coerce(df, schema).collect()}
    assert [got[i] for i in range(len(TEXTS))] == [expected_text(v) for v in TEXTS]


def test_literals_can_be_limited_to_lists(spark):
    assert one(spark, "{hello}", FieldSpec("STRING"), array_literals="repeated_only") == "{hello}"
    lists = FieldSpec("STRING", "REPEATED")
    assert one(spark, "{hello}", lists, array_literals="repeated_only") == ["hello"]


@pytest.mark.parametrize(
    "value, wanted",
    [("{a,b}", ["a", "b"]), ('[1,"x",{"b":1},null]', ["1", "x", '{"b":1}', None]), ('{"k": 1}', ['{"k":1}']),
     ("plain", ["plain"]), ("[bad", ["[bad"]), ("{}", []), (None, None)],
)
def test_repeated_scalars(spark, value, wanted):
    assert one(spark, value, FieldSpec("STRING", "REPEATED")) == wanted


@pytest.mark.parametrize(
    "value, wanted",
    [("{a,b}", ['"a"', '"b"']), ('[1,"{\\"z\\":1}"]', ["1", '{"z":1}']), ("plain", ['"plain"']),
     ('{"k": 1}', ['{"k":1}']), (None, [])],
)
def test_repeated_json(spark, value, wanted):
    assert one(spark, value, FieldSpec("JSON", "REPEATED")) == wanted


@pytest.mark.parametrize(
    "value, dtype, wanted",
    [('{"b":1,"a":2}', "STRING", '{"a":2,"b":1}'), ("plain", "STRING", '"plain"'), ("{a}", "STRING", '["a"]'),
     (5, "BIGINT", "5"), (True, "BOOLEAN", "true"), (None, "STRING", None), ("[bad", "STRING", '"[bad"'),
     ((1, "x\0"), "STRUCT<b: INT, a: STRING>", '{"a":"x","b":1}'), ([1, 2], "ARRAY<INT>", "[1,2]"),
     (datetime(2024, 1, 1, 2), "TIMESTAMP_NTZ", '"2024-01-01T02:00:00"'), (Decimal("1.50"), "DECIMAL(9,2)", '"1.50"')],
)
def test_json_values(spark, value, dtype, wanted):
    assert one(spark, value, FieldSpec("JSON"), dtype) == wanted


def test_record_passes_and_scalar_takes_nested_as_text(spark):
    dtype = "STRUCT<b: INT, a: STRING>"
    assert one(spark, (1, "x"), FieldSpec("RECORD"), dtype).asDict() == {"b": 1, "a": "x"}
    assert one(spark, (1, "x"), FieldSpec("STRING"), dtype) == '{"a":"x","b":1}'
    assert one(spark, (1, "x"), None, dtype).asDict() == {"b": 1, "a": "x"}


def test_times_stay_typed_unless_text_is_asked_for(spark):
    assert one(spark, date(2024, 1, 1), None, "DATE") == date(2024, 1, 1)
    assert one(spark, date(2024, 1, 1), None, "DATE", text_times=True) == "2024-01-01"


def test_mixed_records_all_become_valid(spark):
    rows = [(1, "valid", 1), (2, "nul\0name", 2), (3, None, None), (4, "x", 4)]
    df = spark.createDataFrame(rows, "id BIGINT, name STRING, value BIGINT")
    valid, rejects = split(validate(df))
    assert valid.count() == 4 and rejects.count() == 0
    assert "nulname" in [r["name"] for r in valid.collect()]
    raw = spark.createDataFrame([(bytearray(b"bytes"),)], "name BINARY")
    assert coerce(raw).first()["name"] == base64.b64encode(b"bytes").decode()


def test_reasons(spark):
    rows = [(1, "ok"), (2, "nul\0"), (3, "x" * 200)]
    df = spark.createDataFrame(rows, "id INT, name STRING")
    got = {r["id"]: r["why"] for r in df.select("id", reject_reason(df, 100).alias("why")).collect()}
    assert got == {1: None, 2: "Record contains null bytes", 3: "Record exceeds the size limit"}


@pytest.mark.parametrize("limit", [10, 60, 100, 300])
def test_the_length_shortcut_changes_nothing(spark, limit):
    """Rows are rejected exactly when their JSON text is too long, whatever they hold."""
    rows = [(i, text * i, [text]) for i in range(0, 12, 3) for text in ("a", '"', "\x01", "{a,b}", "é")]
    for columns in (["i", "t"], ["i", "t", "l"]):
        df = spark.createDataFrame(rows, "i INT, t STRING, l ARRAY<STRING>").select(*columns)
        flagged = validate(df, {"t": FieldSpec("STRING")}, limit=limit).collect()
        for row in flagged:
            record = {c: row[c] for c in columns}
            too_long = len(json.dumps(record, ensure_ascii=False, separators=(",", ":"))) > limit
            assert (row[REASON] is not None) == too_long


def test_valid_and_rejected_make_up_the_input(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(50)], "i INT, t STRING")
    valid, rejects = split(validate(df, limit=40))
    kept, dropped = {r["i"] for r in valid.collect()}, {r["i"] for r in rejects.collect()}
    assert kept | dropped == set(range(50)) and not kept & dropped and dropped


def test_required_and_typed(spark):
    df = spark.createDataFrame(
        [(1, "2.5", "{1,2}"), (2, "abc", None), (None, "1", "{x}")], "id INT, n STRING, l STRING"
    )
    schema = {
        "id": FieldSpec("INTEGER", "REQUIRED"), "n": FieldSpec("FLOAT"), "l": FieldSpec("INTEGER", "REPEATED")
    }
    flagged = validate(df, schema, require=True, typed=True)
    assert flagged.schema["n"].dataType.simpleString() == "double"
    reasons = {r["id"]: r[REASON] for r in flagged.collect()}
    assert reasons[1] is None and reasons[2] == "n does not fit double: abc"
    assert reasons[None] == "Required field id is null"


def test_nested_records_are_measured_only_if_they_may_be_long(spark):
    from tidemark.operators.validate import json_length, may_exceed

    df = spark.sql("""SELECT * FROM VALUES
        (named_struct('a', 'x', 'n', 1), array(1.5D, 2D), map('k', array('v')), array(named_struct('t', repeat('y', 50)))),
        (named_struct('a', repeat('"', 900), 'n', NULL), NULL, NULL, NULL), (NULL, array_repeat(1D, 200), map(repeat('k', 300), NULL), array(NULL)),
        (NULL, NULL, map('a', array('b', repeat('c', 400)), 'd', NULL), array(named_struct('t', NULL), named_struct('t', repeat('z', 500)))) AS t(s, l, m, r)""")
    for limit in (20, 100, 300, 1000, 3000, 100_000):
        rows = df.select(may_exceed(df.schema, limit, 6).alias("may"), json_length(df.columns).alias("n")).collect()
        assert all(r["may"] or r["n"] <= limit for r in rows)
    assert not any(r["may"] for r in rows)
