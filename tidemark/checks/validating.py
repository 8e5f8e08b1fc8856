"""VAL: coercion to the destination schema, sanitising and rejection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.functions.jsontext import sanitise
from tidemark.functions.literals import parse_array_literal
from tidemark.functions.text import escape_controls
from tidemark.operators.schema import FieldSpec
from tidemark.operators.validate import REASON, coerce, reject_reason, validate


@check(
    "val_1_array_literal",
    """SELECT p_partkey, p_brand || '|' || p_type || ',' || p_name || '|say "' || p_name || '"' AS items,
        CAST(3 AS BIGINT) AS n FROM part""",
)
def array_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    literal = F.concat(
        F.lit("{ "), F.col("p_brand"), F.lit(' ,"'), F.col("p_type"), F.lit(","), name,
        F.lit('",NULL,,"say ""'), name, F.lit('"""}'),
    )
    items = parse_array_literal(literal)
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(items, "|").alias("items"), F.size(items).cast("bigint").alias("n")
    )


@check(
    "val_2_literal_in_text",
    """SELECT p_partkey, CASE WHEN p_size < 20 THEN '["' || p_name || '","' || p_type || '"]'
        WHEN p_size < 30 THEN '{x: ' || p_name || '}' ELSE p_name END AS note FROM part""",
)
def literal_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal in a text column becomes JSON text; braces with a colon stay."""
    name, size = F.col("p_name"), F.col("p_size")
    note = (
        F.when(size < 20, F.concat(F.lit("{"), name, F.lit(", "), F.col("p_type"), F.lit("}")))
        .when(size < 30, F.concat(F.lit("{x: "), name, F.lit("}")))
        .otherwise(name)
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", note.alias("note"))
    return coerce(parts, {"note": FieldSpec("STRING")})


@check(
    "val_3_json_text",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN props || ' and more}'
        WHEN event_type = 'view' THEN '[' || user_id || ',"' || event_type || '"]'
        ELSE CAST(json(props) AS VARCHAR) END AS props FROM events""",
)
def json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid JSON is compacted, broken JSON stays as it was."""
    kind = F.col("event_type")
    props = (
        F.when(kind == "error", F.concat(F.col("props"), F.lit(" and more}")))
        .when(kind == "view", F.concat(F.lit("[ "), F.col("user_id"), F.lit(' , "'), kind, F.lit('" ]')))
        .otherwise(F.col("props"))
    )
    events = table(spark, sf_dir, "events").select("event_id", props.alias("props"))
    return coerce(events, {"event_id": FieldSpec("INTEGER"), "props": FieldSpec("STRING")})


@check(
    "val_4_repeated",
    """SELECT event_id, '[' || user_id || ']' AS users,
        CASE event_type WHEN 'view' THEN '["a","b"]' WHEN 'click' THEN '["1","x","{\\"y\\":2}"]'
            WHEN 'error' THEN NULL ELSE '["' || event_type || '"]' END AS tags,
        CASE WHEN event_type = 'error' THEN '[]' ELSE '["\\"' || event_type || '\\""]' END AS extras
       FROM events""",
)
def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    tags = (
        F.when(kind == "view", "{a,b}")
        .when(kind == "click", '[1, "x", {"y": 2}]')
        .when(kind != "error", kind)
    )
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("users"), tags.alias("tags"),
        F.when(kind != "error", kind).alias("extras"),
    )
    lists = coerce(
        events,
        {
            "users": FieldSpec("INTEGER", "REPEATED"),
            "tags": FieldSpec("STRING", "REPEATED"),
            "extras": FieldSpec("JSON", "REPEATED"),
        },
    )
    return lists.select("event_id", *(F.to_json(c).alias(c) for c in ("users", "tags", "extras")))


@check(
    "val_5_json_column",
    """SELECT event_id, CAST(json(props) AS VARCHAR) AS props, '"' || event_type || '"' AS event_type,
        CAST(user_id AS VARCHAR) AS user_id, '"{' || event_type || ' not json]"' AS broken FROM events""",
)
def json_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.concat(F.lit("{"), F.col("event_type"), F.lit(" not json]"))
    events = table(spark, sf_dir, "events").select(
        "event_id", "props", "event_type", "user_id", broken.alias("broken")
    )
    as_json = FieldSpec("JSON")
    return coerce(
        events,
        {"props": as_json, "event_type": as_json, "user_id": as_json, "broken": as_json},
    )


@check(
    "val_6_nested_in_scalar",
    """SELECT o_orderkey, '{"priority":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}' AS detail,
        '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags FROM orders""",
)
def nested_in_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", detail.alias("detail"), F.array("o_orderstatus", "o_orderpriority").alias("tags")
    )
    return coerce(orders, {"detail": FieldSpec("STRING"), "tags": FieldSpec("STRING")})


@check("val_7_record", "SELECT o_orderkey, o_orderstatus AS status, o_custkey AS customer FROM orders")
def record(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", detail.alias("detail"))
    return coerce(orders, {"detail": FieldSpec("RECORD")}).select("o_orderkey", "detail.*")


@check(
    "val_8_unknown_column",
    """SELECT event_id, CAST(json(props) AS VARCHAR) AS props, '["' || event_type || '"]' AS literal,
        event_type AS plain, user_id FROM events""",
)
def unknown_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    literal = F.concat(F.lit("{"), F.col("event_type"), F.lit("}"))
    events = table(spark, sf_dir, "events").select(
        "event_id", "props", literal.alias("literal"), F.col("event_type").alias("plain"), "user_id"
    )
    return coerce(events)


@check(
    "val_9_sanitise",
    """SELECT doc_id, text, base64(encode(text)) AS raw, lang || '/' || source AS nested FROM documents""",
)
def sanitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    nul = F.char(F.lit(0))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(nul, F.col("text"), nul).alias("text"),
        F.encode("text", "UTF-8").alias("raw"),
        F.array(F.struct(F.concat(F.col("lang"), nul).alias("lang"), F.col("source").alias("source")))
        .alias("nested"),
    )
    clean = documents.select(
        *(sanitise(F.col(f.name), f.dataType, text_times=True).alias(f.name) for f in documents.schema)
    )
    first = F.element_at("nested", 1)
    return clean.withColumn(
        "nested", F.concat(first.getField("lang"), F.lit("/"), first.getField("source"))
    )


SIZE = 2000


@check(
    "val_10_record_validity",
    f"""SELECT doc_id, CASE WHEN length(CAST(to_json({{'doc_id': doc_id, 'text': text, 'lang': lang,
        'source': source, 'n_chars': n_chars}}) AS VARCHAR)) > {SIZE}
        THEN 'Record exceeds the size limit' END AS reason FROM documents""",
)
def record_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", reject_reason(documents, limit=SIZE).alias("reason"))


@check(
    "val_11_drop_invalid",
    f"""SELECT lang, kept, count(*) AS documents FROM (SELECT lang, length(CAST(to_json({{'doc_id': doc_id,
        'text': text, 'lang': lang, 'source': source, 'n_chars': n_chars}}) AS VARCHAR)) <= {SIZE} AS kept
        FROM documents) GROUP BY lang, kept""",
)
def drop_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = validate(table(spark, sf_dir, "documents"), limit=SIZE)
    kept = F.col(REASON).isNull().alias("kept")
    return flagged.groupBy("lang", kept).agg(F.count(F.lit(1)).alias("documents"))


@check(
    "val_12_control_characters",
    r"SELECT doc_id, replace(replace(text, chr(13), '\r'), chr(10), '\n') AS text FROM documents",
)
def control_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", escape_controls(F.col("text")).alias("text"))
