"""TRF, UDF-1: configured transformations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.config import TransformSpec
from tidemark.functions.convert import parse_boolean
from tidemark.operators.transform import ERROR, chain, transform


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a price as text that some brands write in words, and a ragged name."""
    price = F.col("p_retailprice").cast("string")
    worded = F.when(F.col("p_brand") == "Brand#7", "on request").otherwise(price)
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_type", "p_retailprice",
        worded.alias("price_text"),
        F.concat(F.lit("\t "), F.col("p_name"), F.lit(" \n")).alias("label"),
    )


PARTS = """(SELECT p_partkey, p_size, p_type, p_retailprice, p_name, p_brand,
    CASE WHEN p_brand = 'Brand#7' THEN 'on request' ELSE CAST(p_retailprice AS VARCHAR) END AS price_text,
    chr(9) || ' ' || p_name || chr(160) || chr(10) AS label FROM part)"""


@check(
    "trf_1_rename",
    "SELECT o_orderkey AS id, o_custkey AS o_totalprice, o_orderpriority AS stage FROM orders",
)
def rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An existing target is replaced, a missing source ignored, a chain followed."""
    config = """{"field_mappings": {"o_orderkey": "id", "o_custkey": "o_totalprice", "missing": "x",
        "o_orderpriority": "level", "level": "stage"}}"""
    renamed = transform(_orders(spark, sf_dir), TransformSpec.from_json(config)).ok()
    return renamed.select("id", "o_totalprice", "stage")


@check(
    "trf_2_to_string",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
        CAST(o_totalprice * 1000 AS VARCHAR) AS big, CAST(o_totalprice / 1e10 AS VARCHAR) AS small,
        CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS closed,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate FROM orders""",
)
def to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") * 1000).alias("big"),
        (F.col("o_totalprice") / 1e10).alias("small"),
        (F.col("o_orderstatus") == "F").alias("closed"), "o_orderdate",
    )
    texts = ("o_custkey", "big", "small", "closed", "o_orderdate")
    return transform(orders, TransformSpec(type_conversions={c: "STRING" for c in texts})).ok()


@check(
    "trf_3_to_integer",
    """SELECT event_id, CAST(trunc(-value) AS BIGINT) AS value, CAST(trunc(value) AS BIGINT) AS value_text FROM events""",
)
def to_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toward zero, from numbers and from text."""
    events = table(spark, sf_dir, "events").select(
        "event_id", (-F.col("value")).alias("value"),
        F.concat(F.lit(" "), F.col("value").cast("string"), F.lit("\n")).alias("value_text"),
    )
    spec = TransformSpec(type_conversions={"value": "integer", "value_text": "INTEGER"})
    return transform(events, spec).ok()


@check("trf_4_to_float", "SELECT o_orderkey, o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders")
def to_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("o_totalprice"), "o_custkey"
    )
    spec = TransformSpec(type_conversions={"o_totalprice": "float", "o_custkey": "FLOAT"})
    return transform(orders, spec).ok()


@check(
    "trf_5_to_boolean",
    """SELECT p_partkey, p_size - 11 <> 0 AS size_flag, true AS text_flag, p_type <> 'SMALL' AS empty_flag,
        p_size >= 20 AS meant FROM part""",
)
def to_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth of the value: 'false' is true, as text; its meaning is a separate function."""
    meant = F.when(F.col("p_size") >= 20, "true").otherwise("false")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") - 11).alias("size_flag"), meant.alias("text_flag"),
        F.when(F.col("p_type") == "SMALL", "").otherwise("x").alias("empty_flag"),
        parse_boolean(meant).alias("meant"),
    )
    flags = ("size_flag", "text_flag", "empty_flag")
    return transform(parts, TransformSpec(type_conversions={c: "BOOLEAN" for c in flags})).ok()


@check(
    "trf_6_to_timestamp",
    r"""SELECT event_id, ts AS plain, CAST(ts AS DATE)::TIMESTAMP AS day, ts AS zulu, ts - INTERVAL 2 HOUR AS zoned,
        regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\.000000$', '') AS text FROM events""",
)
def to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    events = table(spark, sf_dir, "events").select(
        "event_id", iso.alias("plain"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.concat(iso, F.lit("Z")).alias("zulu"), F.concat(iso, F.lit("+02:00")).alias("zoned"),
        iso.alias("text"),
    )
    typed = ("plain", "day", "zulu", "zoned")
    events = transform(events, TransformSpec(type_conversions={c: "timestamp" for c in typed})).ok()
    return transform(
        events, TransformSpec(type_conversions={"text": "timestamp"}, iso_text=True)
    ).ok()


@check("trf_7_unknown_target", "SELECT event_id, user_id, value FROM events")
def unknown_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    spec = TransformSpec(type_conversions={"user_id": "complex", "value": "NUMBER", "gone": "float"})
    return transform(events, spec).ok()


@check(
    "trf_8_regex_replace",
    r"""SELECT c_custkey, regexp_replace(c_name, '^(\w+)#0*(\d+)$', '\2 of \1', 'g') AS c_name,
        regexp_replace(c_mktsegment, '[AEIOU]', '$', 'g') AS c_mktsegment FROM customer""",
)
def regex_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "c_name": {
            "type": "regex_replace",
            "pattern": r"^(?P<kind>\w+)#0*(\d+)$",
            "replacement": r"\2 of \g<kind>",
        },
        "c_mktsegment": {"type": "regex_replace", "pattern": "[AEIOU]", "replacement": "$"},
    }
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return transform(customers, TransformSpec(value_transformations=rules)).ok()


def _value_check(name: str, rule: str, sql: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        parts = _parts(spark, sf_dir).select("p_partkey", "label", "p_type")
        rules = {"label": {"type": rule}, "p_type": {"type": rule}, "gone": {"type": rule}}
        return transform(parts, TransformSpec(value_transformations=rules)).ok()

    check(name, sql)(query)


_value_check("trf_9_upper", "upper", f"SELECT p_partkey, upper(label) AS label, upper(p_type) AS p_type FROM {PARTS}")
_value_check("trf_10_lower", "lower", f"SELECT p_partkey, lower(label) AS label, lower(p_type) AS p_type FROM {PARTS}")
_value_check("trf_11_trim", "trim", f"SELECT p_partkey, p_name AS label, trim(p_type) AS p_type FROM {PARTS}")
_value_check("trf_12_unknown_rule", "reverse", f"SELECT p_partkey, label, p_type FROM {PARTS}")


@check(
    "trf_13_sum",
    """SELECT l_orderkey, l_linenumber, l_discount + l_tax AS rates, l_orderkey + l_linenumber AS keys,
        l_quantity AS with_missing, CAST(NULL AS DOUBLE) AS with_text FROM lineitem""",
)
def sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing field counts as 0, text makes the sum null."""
    fields = {
        "rates": "l_discount + l_tax", "keys": "l_orderkey + l_linenumber",
        "with_missing": "l_quantity + no_such_field", "with_text": "l_quantity + l_returnflag",
    }
    done = transform(table(spark, sf_dir, "lineitem"), TransformSpec(calculated_fields=fields)).ok()
    return done.select("l_orderkey", "l_linenumber", *fields)


@check(
    "trf_14_length",
    """SELECT doc_id, length(text) AS n_text, length(CAST(n_chars AS VARCHAR)) AS n_digits,
        CAST(0 AS BIGINT) AS n_missing FROM documents""",
)
def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"n_text": "len(text)", "n_digits": "len(n_chars)", "n_missing": "len(no_such_field)"}
    done = transform(table(spark, sf_dir, "documents"), TransformSpec(calculated_fields=fields)).ok()
    return done.select("doc_id", *fields)


@check(
    "trf_15_copy",
    "SELECT s_suppkey, s_name AS label, CAST(NULL AS VARCHAR) AS absent FROM supplier",
)
def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TransformSpec(calculated_fields={"label": "s_name", "absent": "no_such_field"})
    return transform(table(spark, sf_dir, "supplier"), spec).ok().select("s_suppkey", "label", "absent")


@check(
    "trf_16_sequential_fields",
    """SELECT l_orderkey, l_linenumber, l_discount + l_tax AS rates,
        (l_discount + l_tax) + l_quantity AS more, l_discount + l_tax AS again FROM lineitem""",
)
def sequential_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"rates": "l_discount + l_tax", "more": "rates + l_quantity", "again": "rates"}
    done = transform(table(spark, sf_dir, "lineitem"), TransformSpec(calculated_fields=fields)).ok()
    return done.select("l_orderkey", "l_linenumber", *fields)


PRICE_SPEC = TransformSpec(
    field_mappings={"price_text": "price"},
    type_conversions={"price": "float"},
    value_transformations={"p_type": {"type": "lower"}},
    calculated_fields={"total": "price + p_size"},
)


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir).select("p_partkey", "p_size", "p_type", "price_text")


@check(
    "trf_17_error_records",
    f"""SELECT p_partkey, p_size, p_type, price_text,
        'cannot convert price to float: on request' AS _transformation_error
       FROM {PARTS} WHERE price_text = 'on request'""",
)
def error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failed record keeps all its original values and says why."""
    return transform(_priced(spark, sf_dir), PRICE_SPEC).errors()


@check(
    "trf_17_good_records",
    f"""SELECT p_partkey, p_size, lower(p_type) AS p_type, p_retailprice AS price,
        p_retailprice + p_size AS total FROM {PARTS} WHERE price_text <> 'on request'""",
)
def good_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(_priced(spark, sf_dir), PRICE_SPEC).ok()


@check(
    "trf_17_all_records",
    f"""SELECT p_partkey, p_size, CASE WHEN bad THEN p_type ELSE lower(p_type) END AS p_type,
        CASE WHEN NOT bad THEN p_retailprice END AS price, CASE WHEN NOT bad THEN p_retailprice + p_size END AS total,
        CASE WHEN bad THEN price_text END AS price_text,
        CASE WHEN bad THEN 'cannot convert price to float: on request' END AS _transformation_error
       FROM (SELECT *, price_text = 'on request' AS bad FROM {PARTS})""",
)
def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds in one frame, from one pass."""
    return transform(_priced(spark, sf_dir), PRICE_SPEC).merged()


@check(
    "trf_18_default_values",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0.5 ELSE value END AS value,
        'pending' AS status FROM events""",
)
def default_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_type") != "error", F.col("value"))
    events = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return transform(events, TransformSpec(default_values={"value": 0.5, "status": "pending"})).ok()


@check(
    "trf_19_flatten_nested",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS kind, user_id AS who,
        CAST(NULL AS VARCHAR) AS gone FROM events""",
)
def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths into JSON text and into structs; a path that is not there gives null."""
    inner = F.struct(F.col("event_type").alias("kind"), F.struct(F.col("user_id").alias("id")).alias("user"))
    events = table(spark, sf_dir, "events").select("event_id", "props", inner.alias("data"))
    paths = {"props.k": "k", "data.kind": "kind", "data.user.id": "who", "data.user.name": "gone"}
    done = transform(events, TransformSpec(flatten_nested=paths)).ok()
    return done.select("event_id", *paths.values())


ALL_SECTIONS = TransformSpec(
    field_mappings={"p_partkey": "id", "price_text": "price"},
    type_conversions={"price": "INTEGER"},
    value_transformations={"label": {"type": "trim"}},
    calculated_fields={"total": "price + p_size", "label_length": "len(label)"},
)


@check(
    "trf_all_sections",
    f"""SELECT p_partkey AS id, p_size, p_type, trim(p_name) AS label, CAST(trunc(p_retailprice) AS BIGINT) AS price,
        CAST(trunc(p_retailprice) AS BIGINT) + p_size AS total, length(p_name) AS label_length,
        CASE WHEN price_text = 'on request' THEN 'x' END AS _transformation_error
       FROM {PARTS} WHERE price_text <> 'on request'""",
)
def all_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename, convert, clean and calculate in one configuration."""
    parts = _parts(spark, sf_dir).drop("p_retailprice")
    return transform(parts, ALL_SECTIONS).ok().withColumn(ERROR, F.lit(None).cast("string"))


@check(
    "trf_all_sections_merged",
    f"""SELECT p_size, p_type, CASE WHEN bad THEN label ELSE trim(p_name) END AS label, CASE WHEN NOT bad THEN p_partkey END AS id,
        CASE WHEN NOT bad THEN CAST(trunc(p_retailprice) AS BIGINT) END AS price,
        CASE WHEN NOT bad THEN CAST(trunc(p_retailprice) AS BIGINT) + p_size END AS total,
        CASE WHEN NOT bad THEN length(p_name) END AS label_length,
        CASE WHEN bad THEN p_partkey END AS p_partkey, CASE WHEN bad THEN price_text END AS price_text,
        CASE WHEN bad THEN 'cannot convert price to integer: on request' END AS _transformation_error
       FROM (SELECT *, price_text = 'on request' AS bad FROM {PARTS})""",
)
def all_sections_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same configuration with every record: failed ones keep their original values and say why."""
    parts = _parts(spark, sf_dir).drop("p_retailprice")
    return transform(parts, ALL_SECTIONS).merged()


@check(
    "udf_1_custom_transform",
    "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders WHERE o_orderstatus = 'F'",
)
def custom_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Custom steps are functions from DataFrame to DataFrame."""

    def closed_only(df: DataFrame) -> DataFrame:
        return df.filter("o_orderstatus = 'F'")

    def doubled(df: DataFrame) -> DataFrame:
        return df.select("o_orderkey", (F.col("o_totalprice") * 2).alias("doubled"))

    return chain(_orders(spark, sf_dir), [closed_only, doubled])
