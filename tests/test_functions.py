"""Text forms, array literals and JSON text against Python's own results."""

import base64
import json
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import convert as conv
from tidemark.functions import jsontext, literals, text
from tidemark.functions.values import java_pattern, java_replacement


def column(spark, values, dtype, expression):
    """The expression over a one-column frame, in the order of the values."""
    rows = [(i, v) for i, v in enumerate(values)]
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("v", dtype)])
    df = spark.createDataFrame(rows, schema).select("i", expression(F.col("v")).alias("x"))
    return [r["x"] for r in df.orderBy("i").collect()]


LITERALS = {
    "{}": [],
    "{a,b,c}": ["a", "b", "c"],
    '{"a","b","c"}': ["a", "b", "c"],
    '{"a,b","c"}': ["a,b", "c"],
    "{NULL,a,b}": ["a", "b"],
    '{"NULL","a","b"}': ["a", "b"],
    '{"a""b","c"}': ['a"b', "c"],
    "{1,2,3}": ["1", "2", "3"],
    "{ a , b , c }": ["a", "b", "c"],
    "not_an_array": None,
    "{a,,b}": ["a", "b"],
    '{""}': [],
    "{{a,b},{c}}": ["{a", "b}", "{c}"],
    '{"a,b,c}': ["a,b,c"],
    '{x"a""b"y,z}': ['xa"by', "z"],
    '{"""x"""}': ["x"],
    "  {a}\n": ["a"],
    "{a\nb}": None,
    "{null,Null,nullable}": ["nullable"],
}


def test_array_literals(spark):
    got = column(spark, list(LITERALS), T.StringType(), literals.parse_array_literal)
    assert got == list(LITERALS.values())


def test_array_literal_of_null(spark):
    assert column(spark, [None], T.StringType(), literals.parse_array_literal) == [None]


def brute_items(s):
    """Items by walking the characters, for comparison only."""
    items, now, quoted, i = [], [], False, 0
    while i < len(s):
        if s[i] == '"' and quoted and s[i + 1 : i + 2] == '"':
            now.append('"')
            i += 1
        elif s[i] == '"':
            quoted = not quoted
        elif s[i] == "," and not quoted:
            items.append("".join(now))
            now = []
        else:
            now.append(s[i])
        i += 1
    items.append("".join(now))
    kept = [x.strip() for x in items if x.strip() and x.strip().upper() != "NULL"]
    return [
        x[1:-1].replace('""', '"') if len(x) >= 2 and x[0] == x[-1] == '"' else x for x in kept
    ]


def test_random_array_literals(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice('ab,"" {}N') for _ in range(rng.randint(0, 14))) for _ in range(500)]
    got = column(spark, ["{" + t + "}" for t in texts], T.StringType(), literals.parse_array_literal)
    assert got == [brute_items(t) for t in texts]


def test_strip_matches_every_whitespace_character(spark):
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    values = [c + " x " + c for c in text.WHITESPACE]
    assert set(column(spark, values, T.StringType(), text.strip)) == {"x"}


def test_float_text(spark):
    rng = random.Random(3)
    values = [0.0, 1.0, -2.5, 1e7, 1e15, 1e16, 1.5e16, 1e-3, 1e-4, 1.2e-4, 1e-5, 1e100, -1e-7, 100.0]
    values += [round(rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20), 3) for _ in range(300)]
    values += [float("inf"), float("-inf"), float("nan")]
    got = column(spark, values, T.DoubleType(), text.float_text)
    for value, shown in zip(values, got):
        # Before Java 19 a large double may print one digit more than it needs.
        assert shown == str(value) or (abs(value) > 2**53 and float(shown) == value)


def test_sanitise(spark):
    clean = lambda d: lambda c: jsontext.sanitise(c, d, text_times=True)
    assert column(spark, ["test\0data"], T.StringType(), clean(T.StringType())) == ["testdata"]
    long = bytes(range(256))
    got = column(spark, [bytearray(b"binary data"), bytearray(long)], T.BinaryType(), clean(T.BinaryType()))
    assert got == ["YmluYXJ5IGRhdGE=", base64.b64encode(long).decode()]
    moments = [datetime(2024, 1, 15, 10, 30), datetime(2024, 1, 15, 10, 30, 0, 500)]
    got = column(spark, moments, T.TimestampNTZType(), clean(T.TimestampNTZType()))
    assert got == [m.isoformat() for m in moments]
    assert column(spark, [date(2024, 1, 15)], T.DateType(), clean(T.DateType())) == ["2024-01-15"]
    assert column(spark, [42, None], T.LongType(), clean(T.LongType())) == [42, None]


def test_sanitise_nested(spark):
    dtype = T.ArrayType(
        T.StructType([T.StructField("t", T.StringType()), T.StructField("b", T.BinaryType())])
    )
    got = column(
        spark, [[("a\0", bytearray(b"x"))], None], dtype, lambda c: jsontext.sanitise(c, dtype)
    )
    assert [r.asDict() for r in got[0]] == [{"t": "a", "b": "eA=="}] and got[1] is None


@pytest.mark.parametrize(
    "bad", ['{"a":1} more}', '{"a":1}{"b":2}', "[1,2] [3]", "{'a':1}", '{"a":01}', "[1,]", "", "[1],6]"]
)
def test_parse_refuses_what_is_not_one_json_value(spark, bad):
    assert column(spark, [bad], T.StringType(), jsontext.canonical) == [None]


def test_canonical_json(spark):
    values = [{"b": [1, 2.5, None], "a": {"z": "é\n\"", "y": True}}, [], {}, [{"k": "v"}]]
    got = column(spark, [json.dumps(v) for v in values], T.StringType(), jsontext.canonical)
    assert got == [
        json.dumps(v, sort_keys=True, ensure_ascii=False, separators=(",", ":")) for v in values
    ]


def test_ids_to_text(spark):
    raw = '{"_id": {"$oid": "507f"}, "list": [{"$oid":"a1"}, {"x": {"$oid": "b2"}}], "t": "{\\"$oid\\":\\"no\\"}"}'
    got = column(spark, [raw], T.StringType(), lambda c: jsontext.canonical(jsontext.unwrap(c)))
    assert json.loads(got[0]) == {"_id": "507f", "list": ["a1", {"x": "b2"}], "t": '{"$oid":"no"}'}


def python_number(value):
    try:
        return float(value)
    except ValueError:
        return None


def test_to_float_accepts_what_a_number_parser_accepts(spark):
    values = ["1", " 2.5 ", "-3e4", ".5", "5.", "1_000", "1__0", "_1", "inf", "-Infinity", "5d", "5f",
              "0x10", "", "abc", "1e", "+7", "1,000"]
    got = column(spark, values, T.StringType(), lambda c: conv.to_float(c, T.StringType()))
    assert got == [python_number(v) for v in values]


def test_to_integer_truncates(spark):
    values = ["29.99", "-2.7", "5", "abc", "inf", "nan", "1e30", None]
    got = column(spark, values, T.StringType(), lambda c: conv.to_integer(c, T.StringType()))
    assert got == [29, -2, 5, None, None, None, None, None]


def test_to_boolean_is_truthiness(spark):
    got = column(spark, ["false", "0", "", "x", None], T.StringType(),
                 lambda c: conv.to_boolean(c, T.StringType()))
    assert got == [True, True, False, True, None]


def test_to_timestamp(spark):
    values = ["2024-01-15T10:30:00Z", "2024-01-15 10:30:00.123456", "2024-01-15", "2024-01-15T10",
              "2024-01-15T10:30:00+02:00", "15/01/2024", "2024-13-01", "2024", ""]
    got = column(spark, values, T.StringType(), lambda c: conv.to_timestamp(c, T.StringType()))
    assert got == [
        datetime(2024, 1, 15, 10, 30), datetime(2024, 1, 15, 10, 30, 0, 123456), datetime(2024, 1, 15),
        datetime(2024, 1, 15, 10), datetime(2024, 1, 15, 8, 30), None, None, None, None,
    ]


def test_regex_texts():
    assert java_replacement(r"\2 of \g<kind> for $5 \g<1>") == r"$2 of ${kind} for \$5 $1"
    assert java_pattern(r"(?P<a>x)(?P=a)") == r"(?<a>x)\k<a>"
