"""SCH, UDF-3: schemas measured on data, and their mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks import check, table
from tidemark.operators import schema as schemas
from tidemark.sources.documents import parse_documents


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose errors have no value."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf_dir, "events").withColumn("value", value)


GAPPY = "(SELECT *, CASE WHEN event_type <> 'error' THEN value END AS kept FROM events)"


def _relational_sql() -> str:
    columns = [
        ("event_id", "bigint", "event_id"), ("ts", "timestamp without time zone", "ts"),
        ("user_id", "bigint", "user_id"), ("event_type", "text", "event_type"),
        ("value", "double precision", "kept"), ("props", "text", "props"),
    ]
    rows = []
    for position, (name, kind, column) in enumerate(columns, start=1):
        length = f"max(length({column}))" if kind == "text" else "NULL"
        rows.append(
            f"""SELECT '{name}' AS name, '{kind}' AS type, CAST({length} AS BIGINT) AS max_length,
                count({column}) < count(*) AS nullable, CAST(NULL AS VARCHAR) AS "default",
                CAST({position} AS BIGINT) AS position FROM {GAPPY}"""
        )
    return " UNION ALL ".join(rows)


@check("sch_1_relational_schema", _relational_sql())
def relational_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.relational_schema(_gappy_events(spark, sf_dir))


def _warehouse_sql(source: str, columns: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS name, '{kind}' AS type, CAST(NULL AS VARCHAR) AS description,
            CASE WHEN '{mode}' = 'REPEATED' THEN 'REPEATED'
                 WHEN count({name}) < count(*) THEN 'NULLABLE' ELSE 'REQUIRED' END AS mode,
            '{mode}' <> 'REPEATED' AND count({name}) < count(*) AS nullable FROM {source}"""
        for name, kind, mode in columns
    )


@check(
    "sch_2_warehouse_schema",
    _warehouse_sql(
        "embeddings",
        [("vec_id", "INTEGER", ""), ("embedding", "FLOAT", "REPEATED"), ("label", "INTEGER", "")],
    ),
)
def warehouse_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.warehouse_schema(table(spark, sf_dir, "embeddings"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents of uneven shape: ids and dates as wrappers, a field that is
    absent for some, one that is null for some, one of two types, and four levels."""
    status = F.col("o_orderstatus")
    text = F.concat(
        F.lit('{"_id":{"$oid":"'), F.lpad(F.lower(F.hex("o_orderkey")), 24, "0"),
        F.lit('"},"customer":{"id":'), F.col("o_custkey").cast("string"),
        F.lit(',"tier":{"level":"'), F.col("o_orderpriority"),
        F.lit('","extra":{"deep":1}}},"items":[{"sku":"'), status,
        F.lit('","quantity":2},{"other":true}]'),
        F.when(status == "F", ',"note":"closed"').otherwise(""),
        F.when(status == "O", ',"flag":null').otherwise(',"flag":true'),
        F.when(status == "P", F.concat(F.lit(',"price":'), F.col("o_totalprice").cast("string")))
        .otherwise(F.lit(',"price":"on request"')),
        F.lit(',"created":{"$date":"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"}}'),
    )
    return table(spark, sf_dir, "orders").select(text.alias("raw"))


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.jsontext import parse

    return _documents(spark, sf_dir).select(parse(F.col("raw")).alias("document"))


# (path, type, number of documents as SQL over ``orders``)
PATHS = [
    ("_id", "objectId", "count(*)"), ("customer", "object", "count(*)"),
    ("customer.id", "int", "count(*)"), ("customer.tier", "object", "count(*)"),
    ("customer.tier.level", "string", "count(*)"), ("customer.tier.extra", "object", "count(*)"),
    ("items", "array", "count(*)"), ("items.sku", "string", "count(*)"),
    ("items.quantity", "int", "count(*)"), ("created", "date", "count(*)"),
    ("note", "string", "count(*) FILTER (o_orderstatus = 'F')"),
    ("flag", "null", "count(*) FILTER (o_orderstatus = 'O')"),
    ("flag", "boolean", "count(*) FILTER (o_orderstatus <> 'O')"),
    ("price", "double", "count(*) FILTER (o_orderstatus = 'P')"),
    ("price", "string", "count(*) FILTER (o_orderstatus <> 'P')"),
]
# Beyond three segments, and in elements after the first.
DEEPER = [("customer.tier.extra.deep", "int", "count(*)"), ("items.other", "boolean", "count(*)")]


def _counts(paths: list[tuple]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{path}' AS path, '{kind}' AS type, {n} AS n FROM orders" for path, kind, n in paths
    )


COUNTS, COMPAT_COUNTS = _counts(PATHS + DEEPER), _counts(PATHS)
STATISTICS = f"""SELECT path AS name, arg_max(type, n) AS type,
    sum(n) < (SELECT count(*) FROM orders) AS nullable,
    sum(n) / (SELECT count(*) FROM orders) AS frequency, max(n) / sum(n) AS type_frequency,
    CAST(sum(n) AS BIGINT) AS sample_count FROM ({COUNTS}) GROUP BY path"""


@check("sch_3_document_schema", STATISTICS)
def document_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.document_schema(_variants(spark, sf_dir), "document")


@check("sch_4_path_walk", COUNTS)
def path_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.path_type_counts(_variants(spark, sf_dir), "document")


@check("sch_4_path_walk_compat", COMPAT_COUNTS)
def path_walk_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three segments deep, arrays by their first element."""
    return schemas.path_type_counts(_variants(spark, sf_dir), "document", compat=True)


@check(
    "sch_5_value_classes",
    """SELECT kind, count(*) AS events FROM (SELECT CASE event_type WHEN 'view' THEN 'null'
        WHEN 'click' THEN CASE WHEN user_id < 50 THEN 'boolean' ELSE 'int' END
        WHEN 'signup' THEN 'double' WHEN 'error' THEN CASE WHEN user_id < 50 THEN 'string' ELSE 'array' END
        ELSE CASE WHEN user_id < 20 THEN 'objectId' WHEN user_id < 50 THEN 'date' ELSE 'object' END END AS kind
       FROM events) GROUP BY kind""",
)
def value_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.jsontext import parse

    kind, user = F.col("event_type"), F.col("user_id")
    text = (
        F.when(kind == "view", "null")
        .when(kind == "click", F.when(user < 50, "true").otherwise(user.cast("string")))
        .when(kind == "signup", F.concat(user.cast("string"), F.lit(".25")))
        .when(kind == "error", F.when(user < 50, '"text"').otherwise('[1,"a"]'))
        .when(user < 20, '{"$oid":"507f1f77bcf86cd799439011"}')
        .when(user < 50, '{"$date":"2024-01-01T00:00:00Z"}')
        .otherwise(F.col("props"))
    )
    events = table(spark, sf_dir, "events").select(parse(text).alias("v"))
    return events.groupBy(schemas.value_kind(F.col("v")).alias("kind")).agg(
        F.count(F.lit(1)).alias("events")
    )


@check(
    "sch_6_field_statistics",
    """SELECT 'k' AS name, 'int' AS type, false AS nullable, 1.0::DOUBLE AS frequency,
              1.0::DOUBLE AS type_frequency, count(*) AS sample_count FROM events
       UNION ALL SELECT 'page', 'string', true, count(*) FILTER (event_type = 'view') / count(*), 1.0,
              count(*) FILTER (event_type = 'view') FROM events
       UNION ALL SELECT 'amount', 'double', true, count(*) FILTER (event_type = 'purchase') / count(*), 1.0,
              count(*) FILTER (event_type = 'purchase') FROM events""",
)
def field_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    added = (
        F.when(kind == "view", ',"page":"home"}')
        .when(kind == "purchase", F.concat(F.lit(',"amount":'), F.col("value").cast("string"), F.lit("}")))
        .otherwise("}")
    )
    events = table(spark, sf_dir, "events")
    texts = events.select(F.concat(F.rtrim(F.col("props"), F.lit("}")), added).alias("raw"))
    return schemas.document_schema(parse_documents(texts, "raw"), "document")


def _mapped_sql(source: str, columns: list[tuple[str, str, str]]) -> str:
    """Columns as (name, source type, destination type), none of them repeated."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS name, '{target}' AS destination_type,
            CASE WHEN count({name}) < count(*) THEN 'NULLABLE' ELSE 'REQUIRED' END AS mode,
            'Auto-generated from source column: {name} ({kind})' AS description FROM {source}"""
        for name, kind, target in columns
    )


@check(
    "sch_7_type_mapping",
    _mapped_sql(
        "lineitem",
        [(n, "bigint", "INTEGER") for n in ("l_orderkey", "l_partkey", "l_suppkey")]
        + [("l_linenumber", "integer", "INTEGER")]
        + [(n, "double precision", "FLOAT") for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
        + [(n, "text", "STRING") for n in ("l_returnflag", "l_linestatus")]
        + [("l_shipdate", "timestamp without time zone", "TIMESTAMP")],
    ),
)
def type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = schemas.relational_schema(table(spark, sf_dir, "lineitem"))
    return schemas.map_schema(found, schemas.RELATIONAL)


@check(
    "sch_7_type_mapping_compat",
    _mapped_sql(
        "orders",
        [("o_orderkey", "integer", "INTEGER"), ("o_custkey", "integer", "INTEGER"),
         ("o_orderstatus", "string", "STRING"), ("o_totalprice", "float", "STRING"),
         ("o_orderdate", "datetime", "STRING"), ("o_orderpriority", "string", "STRING")],
    ),
)
def type_mapping_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = schemas.warehouse_schema(table(spark, sf_dir, "orders"))
    return schemas.map_schema(found, schemas.WAREHOUSE, "compat")


@check(
    "sch_8_field_modes",
    """SELECT 'vec_id' AS name, 'INTEGER' AS destination_type,
              CASE WHEN count(vec_id) < count(*) THEN 'NULLABLE' ELSE 'REQUIRED' END AS mode FROM embeddings
       UNION ALL SELECT 'embedding', 'FLOAT', 'REPEATED'
       UNION ALL SELECT 'label', 'INTEGER', 'NULLABLE'""",
)
def field_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated, required, and a label that is null where it was zero."""
    label = F.when(F.col("label") != 0, F.col("label"))
    found = schemas.relational_schema(table(spark, sf_dir, "embeddings").withColumn("label", label))
    return schemas.map_schema(found, schemas.RELATIONAL).select("name", "destination_type", "mode")


@check(
    "sch_9_field_descriptions",
    f"""SELECT name, 'Auto-generated from source column: ' || name || ' (' || lower(type) || ')' AS description,
        CASE WHEN type = 'array' THEN 'REPEATED' WHEN nullable THEN 'NULLABLE' ELSE 'REQUIRED' END AS mode,
        CASE type WHEN 'int' THEN 'INTEGER' WHEN 'object' THEN 'JSON' WHEN 'array' THEN 'JSON'
             WHEN 'boolean' THEN 'BOOLEAN' WHEN 'date' THEN 'TIMESTAMP' WHEN 'double' THEN 'FLOAT'
             ELSE 'STRING' END AS destination_type FROM ({STATISTICS})""",
)
def field_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = schemas.document_schema(_variants(spark, sf_dir), "document")
    return schemas.map_schema(found, schemas.DOCUMENT)


@check(
    "udf_3_custom_schema_detector",
    """SELECT 'c_custkey' AS name, 'bigint' AS type, count(c_custkey) < count(*) AS nullable,
              count(DISTINCT c_custkey) = count(*) AS is_unique FROM customer
       UNION ALL SELECT 'c_name', 'text', count(c_name) < count(*), count(DISTINCT c_name) = count(*) FROM customer
       UNION ALL SELECT 'c_mktsegment', 'text', count(c_mktsegment) < count(*),
              count(DISTINCT c_mktsegment) = count(*) FROM customer""",
)
def custom_schema_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detector is any function that returns a schema frame, registered for a kind of source;
    this one adds uniqueness. Values are counted by column and value, combined in each task."""
    from tidemark.plans.sync import DETECTORS, register_detector

    def detect(df: DataFrame) -> DataFrame:
        cells = [
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(schemas.relational_type_name(f.dataType)).alias("type"),
                F.col(f.name).cast("string").alias("value"),
            )
            for f in df.schema
        ]
        values = df.select(F.inline(F.array(*cells))).groupBy("name", "type", "value").agg(F.count(F.lit(1)).alias("n"))
        absent = F.max(F.col("value").isNull())
        return values.groupBy("name", "type").agg(absent.alias("nullable"), (~absent & (F.max("n") == 1)).alias("is_unique"))

    register_detector("customers", detect)
    return DETECTORS["customers"](table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"))
