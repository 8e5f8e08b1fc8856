"""SRC, FLT, PRJ, SET, UDF-2: reading, filtering, projecting and uniting sources."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checks import check, new_sink, table, view
from tidemark.config import SourceSpec
from tidemark.functions.text import iso_time
from tidemark.operators import schema as schemas
from tidemark.operators.incremental import Window, extract
from tidemark.operators.predicates import document_filter, fields_of, split_filter
from tidemark.operators.projection import project
from tidemark.operators.union import union_all
from tidemark.operators.write import write_table
from tidemark.session import shared_dir
from tidemark.sources import read_source, read_sources, register_reader, source_names
from tidemark.sources.custom import Adapter, Condition, matching, register_source, window_conditions
from tidemark.sources.documents import DocumentSource, parse_documents, read_documents
from tidemark.sources.warehouse import read_shards

NTZ = T.TimestampNTZType()


# --- sources ---------------------------------------------------------------------


@check(
    "src_1_sql_query",
    "SELECT event_id, user_id, value FROM events WHERE event_type IN ('purchase', 'signup')",
)
def sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = view(spark, sf_dir, "events")
    query = f"SELECT event_id, user_id, value FROM {events} WHERE event_type IN ('purchase', 'signup')"
    return read_source(spark, SourceSpec("postgresql", {"query": query}))


@check(
    "src_2_warehouse_query",
    """SELECT user_id, count(*) AS event_count, max(ts) AS last_event FROM events
       WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 7 GROUP BY user_id""",
)
def warehouse_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = view(spark, sf_dir, "events")
    options = {
        "query": f"""SELECT user_id, count(*) AS event_count, max(ts) AS last_event FROM {events}
                     WHERE ts >= date_sub(to_date(:today), 7) GROUP BY user_id""",
        "table": "ignored_because_the_query_wins",
        "arguments": {"today": "2024-01-30"},
    }
    return read_source(spark, SourceSpec("bigquery", options))


@check("src_3_table_source", "SELECT * FROM customer")
def table_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    write_table(table(spark, sf_dir, "customer"), sink)
    return read_source(spark, SourceSpec("bigquery", {"table": sink.table}))


def _order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested documents with a string id, a sub-object and an array."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("created_at"),
        F.struct(
            F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("priority")
        ).alias("customer"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
    )


ORDER_DOCUMENT = """_id STRING, status STRING, total DOUBLE, created_at TIMESTAMP_NTZ,
    customer STRUCT<id: BIGINT, priority: STRING>, tags ARRAY<STRING>"""


@check(
    "src_4_document_collection",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "_id", o_totalprice AS total, o_orderpriority AS priority
       FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000""",
)
def document_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/documents"
    _order_documents(spark, sf_dir).write.json(path)
    source = DocumentSource(
        path=path,
        schema=ORDER_DOCUMENT,
        filter='{"status": "F", "total": {"$gte": 100000}}',
        projection='{"total": 1, "customer.priority": 1}',
    )
    return read_documents(spark, source).select("_id", "total", "customer.priority")


@check(
    "src_5_reader_values",
    r"""SELECT event_id, CAST(value AS VARCHAR) AS value,
        regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\.000000$', '') AS ts,
        strftime(ts, '%Y-%m-%d') AS day FROM events""",
)
def reader_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.text import float_text

    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        float_text(F.col("value")).alias("value"),
        iso_time(F.col("ts"), NTZ).alias("ts"),
        iso_time(F.to_date("ts"), T.DateType()).alias("day"),
    )


@check(
    "src_6_id_to_text",
    """SELECT c_custkey, '{"_id":"' || printf('%024x', c_custkey) || '","links":[{"nation":"'
        || printf('%024x', c_nationkey) || '"}],"segment":"' || c_mktsegment || '"}' AS document
       FROM customer""",
)
def id_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    def wrapped(c: str):
        text = F.lpad(F.lower(F.hex(F.col(c).cast("bigint"))), 24, "0")
        return F.struct(text.alias("$oid"))

    links = F.array(F.struct(wrapped("c_nationkey").alias("nation")))
    record = F.struct(
        wrapped("c_custkey").alias("_id"), F.col("c_mktsegment").alias("segment"), links.alias("links")
    )
    texts = table(spark, sf_dir, "customer").select("c_custkey", F.to_json(record).alias("raw"))
    return parse_documents(texts, "raw").select("c_custkey", F.to_json("document").alias("document"))


@check(
    "src_7_source_selection",
    """SELECT c_custkey AS id, c_name AS name FROM customer
       UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def source_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = view(spark, sf_dir, "customer"), view(spark, sf_dir, "supplier")
    options = {
        "postgresql": {"query": f"SELECT c_custkey AS id, c_name AS name FROM {customer}"},
        "bigquery": {"query": f"SELECT s_suppkey AS id, s_name AS name FROM {supplier}"},
    }
    chosen = source_names("postgresql, bigquery")
    return union_all(read_sources(spark, [SourceSpec(n, options[n]) for n in chosen]))


@check(
    "src_8_destination_schema",
    """SELECT 'o_orderkey' AS name, 'INTEGER' AS type, 'REQUIRED' AS mode, count(o_orderkey) AS present FROM orders
       UNION ALL SELECT 'o_custkey', 'INTEGER', 'REQUIRED', count(o_custkey) FROM orders
       UNION ALL SELECT 'o_orderstatus', 'STRING', 'REQUIRED', count(o_orderstatus) FROM orders
       UNION ALL SELECT 'o_totalprice', 'FLOAT', 'REQUIRED', count(o_totalprice) FROM orders
       UNION ALL SELECT 'o_orderdate', 'TIMESTAMP', 'REQUIRED', count(o_orderdate) FROM orders
       UNION ALL SELECT 'o_orderpriority', 'STRING', 'REQUIRED', count(o_orderpriority) FROM orders""",
)
def destination_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.write import create_table

    orders = table(spark, sf_dir, "orders")
    sink = new_sink(spark, partition_field=None)
    mapped = schemas.map_schema(schemas.relational_schema(orders), schemas.RELATIONAL)
    create_table(spark, sink, schemas.destination_struct(schemas.mapped_rows(mapped)))
    write_table(orders, sink)
    fields = schemas.destination_schema(spark, sink.table)
    rows = [
        F.struct(
            F.lit(name).alias("name"), F.lit(f.type).alias("type"), F.lit(f.mode).alias("mode"),
            F.count(name).alias("present"),
        )
        for name, f in fields.items()
    ]
    return spark.table(sink.table).agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


@check(
    "src_9_wildcard_tables",
    """SELECT event_id, user_id, strftime(ts, '%Y%m%d') AS table_suffix FROM events
       WHERE strftime(ts, '%Y%m%d') BETWEEN '20240110' AND '20240119'""",
)
def wildcard_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/shards"
    shard = F.date_format("ts", "yyyyMMdd")
    events = table(spark, sf_dir, "events").withColumn("shard", shard)
    events.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)
    shards = read_shards(spark, f"{path}/shard=*")
    return shards.filter(F.col("table_suffix").between("20240110", "20240119")).select(
        "event_id", "user_id", "table_suffix"
    )


@check(
    "src_9_growing_shards",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS user_id,
              CASE event_type WHEN 'view' THEN CAST(user_id AS DOUBLE) WHEN 'click' THEN value END AS amount,
              CASE WHEN event_type = 'click' THEN props END AS props, event_type AS table_suffix FROM events
       WHERE event_type IN ('view', 'click', 'error')""",
)
def growing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later shards have more columns, one of them of another type than before."""
    path = f"{shared_dir(spark)}/growing"
    events = table(spark, sf_dir, "events")
    columns = {
        "view": ["event_id", F.col("user_id").alias("amount")],
        "click": ["user_id", "event_id", F.col("value").alias("amount"), "props"],
        "error": ["event_id", "user_id"],
    }
    for kind, chosen in columns.items():
        events.filter(F.col("event_type") == kind).select(*chosen).write.parquet(f"{path}/events_{kind}")
    return read_shards(spark, f"{path}/events_*")


# --- filters ---------------------------------------------------------------------


@check(
    "flt_1_window_predicate",
    """SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-01 00:00:00'
       AND o_orderdate <= TIMESTAMP '1998-01-01 00:00:00'""",
)
def window_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = Window(datetime(1997, 6, 1), datetime(1998, 1, 1))
    return extract(table(spark, sf_dir, "orders"), "o_orderdate", window)


FLAT = """SELECT CAST(o_orderkey AS VARCHAR) AS "_id", o_orderstatus AS status, o_totalprice AS total,
    o_orderdate AS created_at, o_custkey AS customer_id, o_orderpriority AS priority FROM orders"""


def _flat(documents: DataFrame) -> DataFrame:
    return documents.select(
        "_id", "status", "total", "created_at",
        F.col("customer.id").alias("customer_id"), F.col("customer.priority").alias("priority"),
    )


def _filter_check(name: str, spec: str, where: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat(document_filter(_order_documents(spark, sf_dir), spec))

    check(name, f"{FLAT} WHERE {where}")(query)


_filter_check(
    "flt_2_equality",
    '{"status": "F", "customer.priority": "1-URGENT"}',
    "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
)
_filter_check(
    "flt_3_range",
    '{"total": {"$gte": 50000, "$lt": 200000}, "customer.id": {"$gt": 10, "$lte": 900}}',
    "o_totalprice >= 50000 AND o_totalprice < 200000 AND o_custkey > 10 AND o_custkey <= 900",
)
_filter_check(
    "flt_4_membership",
    '{"status": {"$in": ["F", "P"]}}',
    "o_orderstatus IN ('F', 'P')",
)
_filter_check(
    "flt_4_membership_in_array",
    '{"tags": {"$in": ["2-HIGH", "1-URGENT"]}}',
    "o_orderpriority IN ('2-HIGH', '1-URGENT')",
)
_filter_check(
    "flt_5_regex",
    '{"customer.priority": {"$regex": "^[12]-.*H$|LOW"}}',
    "regexp_matches(o_orderpriority, '^[12]-.*H$|LOW')",
)
_filter_check(
    "flt_6_date_literal",
    '{"created_at": {"$gte": {"$date": "1997-01-01T00:00:00Z"}, "$lt": {"$date": "1998-01-01T02:00:00+02:00"}}}',
    "o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'",
)
NESTED_FILTER = """{"$and": [{"status": "F"},
    {"$or": [{"customer.priority": "1-URGENT"}, {"total": {"$gte": 400000}}, {"tags": "5-LOW"}]}]}"""
NESTED_WHERE = """o_orderstatus = 'F' AND (o_orderpriority = '1-URGENT' OR o_totalprice >= 400000
    OR o_orderpriority = '5-LOW')"""
_filter_check("flt_7_and_or", NESTED_FILTER, NESTED_WHERE)


@check("flt_7_and_or_on_variant", f"{FLAT} WHERE {NESTED_WHERE}")
def and_or_on_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same filter on documents whose structure is not declared."""
    documents = _order_documents(spark, sf_dir)
    whole = documents.withColumn("document", F.to_variant_object(F.struct(*documents.columns)))
    return _flat(document_filter(whole, NESTED_FILTER, variant="document"))


BEYOND_DOUBLES = 2**53  # from here on a double can't tell neighbours apart


def _wide_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as VARIANT documents with ids above 2^53 and extended-JSON dates and numbers."""
    text = F.concat(
        F.lit('{"n":{"$numberLong":"'), (F.col("o_orderkey") + BEYOND_DOUBLES).cast("string"),
        F.lit('"},"customer":{"secret":"x","priority":"'), "o_orderpriority", F.lit('","id":'), F.col("o_custkey").cast("string"),
        F.lit('},"at":{"$date":"'), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"}}'),
    )
    return parse_documents(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("raw")), "raw").drop("raw")


def _wide_check(name: str, spec: str, where: str) -> None:
    @check(name, f"SELECT o_orderkey FROM orders WHERE {where}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return document_filter(_wide_documents(spark, sf_dir), spec, variant="document").select("o_orderkey")


_wide_check("flt_2_equality_on_variant", f'{{"n": {BEYOND_DOUBLES + 7}}}', "o_orderkey = 7")
_wide_check(
    "flt_2_object_equality_on_variant",
    '{"customer": {"id": 10, "priority": "1-URGENT", "secret": "x"}}',
    "o_custkey = 10 AND o_orderpriority = '1-URGENT'",
)
_wide_check(
    "flt_3_range_on_variant",
    f'{{"n": {{"$gt": {BEYOND_DOUBLES + 11}, "$lte": {BEYOND_DOUBLES + 1001}}}}}',
    "o_orderkey > 11 AND o_orderkey <= 1001",
)
_wide_check(
    "flt_4_membership_on_variant",
    f'{{"n": {{"$in": [{BEYOND_DOUBLES + 1}, {BEYOND_DOUBLES + 33}]}}}}',
    "o_orderkey IN (1, 33)",
)
_wide_check(
    "flt_6_date_on_variant", '{"at": {"$gte": {"$date": "1997-01-01T00:00:00Z"}}}', "o_orderdate >= TIMESTAMP '1997-01-01'"
)

WIDE_JSON = """'{"at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '","customer":{"id":' || o_custkey || ',"priority":"' || o_orderpriority
    || '"},"n":' || (o_orderkey + 9007199254740992) || '}'"""


@check("prj_2_exclusion_in_variant", f"SELECT o_orderkey, {WIDE_JSON} AS document FROM orders")
def exclusion_in_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = project(_wide_documents(spark, sf_dir), '{"document.customer.secret": 0}')
    return kept.withColumn("document", F.to_json("document"))


@check(
    "prj_3_nested_path_in_variant",
    """SELECT o_orderkey, '{"customer":{"priority":"' || o_orderpriority || '"}}' AS document FROM orders""",
)
def nested_path_in_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = project(_wide_documents(spark, sf_dir), '{"o_orderkey": 1, "document.customer.priority": 1}')
    return kept.withColumn("document", F.to_json("document"))


@check(
    "flt_8_sql_predicates",
    """SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events
       WHERE event_type IN ('view', 'click') AND NOT (event_type = 'error')
       AND CAST(ts AS DATE) >= DATE '2024-01-30' - 7 AND value > 10""",
)
def sql_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = view(spark, sf_dir, "events")
    query = f"""SELECT event_id, user_id, event_type, to_date(ts) AS day FROM {events}
        WHERE event_type IN ('view', 'click') AND NOT (event_type = 'error')
        AND ts >= date_sub(to_date(:today), 7) AND value > 10"""
    options = {"query": query, "arguments": {"today": "2024-01-30"}}
    return read_source(spark, SourceSpec("postgresql", options))


# --- projections -----------------------------------------------------------------


@check(
    "prj_1_inclusion",
    'SELECT CAST(o_orderkey AS VARCHAR) AS "_id", o_orderstatus AS status, o_totalprice AS total FROM orders',
)
def inclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_order_documents(spark, sf_dir), '{"status": 1, "total": 1, "absent": 1}')


@check(
    "prj_1_inclusion_without_id",
    "SELECT o_orderstatus AS status, o_totalprice AS total FROM orders",
)
def inclusion_without_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_order_documents(spark, sf_dir), '{"_id": 0, "status": 1, "total": 1}')


@check(
    "prj_2_exclusion",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "_id", o_orderstatus AS status, o_orderdate AS created_at
       FROM orders""",
)
def exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_order_documents(spark, sf_dir), '{"total": 0, "customer": 0, "tags": 0}')


@check(
    "prj_3_nested_path",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "_id", o_totalprice AS total,
        '{"priority":"' || o_orderpriority || '"}' AS customer FROM orders""",
)
def nested_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = project(_order_documents(spark, sf_dir), '{"total": 1, "customer.priority": 1}')
    return kept.withColumn("customer", F.to_json("customer"))


@check("prj_4_explicit_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def explicit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = view(spark, sf_dir, "lineitem")
    query = f"SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem}"
    return read_source(spark, SourceSpec("postgresql", {"query": query}))


@check(
    "prj_5_json_scalar",
    "SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events",
)
def json_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = view(spark, sf_dir, "events")
    query = f"SELECT event_id, event_type, get_json_object(props, '$.k') AS k FROM {events}"
    return read_source(spark, SourceSpec("bigquery", {"query": query}))


# --- set operations --------------------------------------------------------------


@check(
    "set_1_union_sources",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(c_nationkey AS VARCHAR) AS code,
              c_mktsegment AS segment, NULL AS region FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'S' || s_nationkey, NULL, NULL FROM supplier
       UNION ALL SELECT n_nationkey, n_name, NULL, NULL, NULL, n_regionkey FROM nation""",
)
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three schemas: ids of two widths, a code that is a number in one and text in another."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("code"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("code"),
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("region"),
    )
    return union_all([customer, supplier, nation])


def _places(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Customers, suppliers and nations with a nested place: fields in another order, one more, one wider."""
    return [
        table(spark, sf_dir, "customer").selectExpr(
            "c_custkey AS id", "named_struct('nation', c_nationkey, 'segment', c_mktsegment) AS place",
            "array(named_struct('balance', c_acctbal, 'kind', 'c')) AS parts",
        ),
        table(spark, sf_dir, "supplier").selectExpr(
            "s_suppkey AS id", "named_struct('segment', concat('S', s_nationkey), 'nation', CAST(s_nationkey AS BIGINT) + 5000000000) AS place",
            "array(named_struct('kind', 's', 'balance', s_acctbal, 'extra', named_struct('name', s_name))) AS parts",
        ),
        table(spark, sf_dir, "nation").selectExpr("n_nationkey AS id", "named_struct('region', named_struct('key', n_regionkey)) AS place"),
    ]


PLACES = ["id", "place.nation", "place.segment", "place.region.key AS region", "parts[0].balance AS balance", "parts[0].kind AS kind", "parts[0].extra.name AS name"]


@check(
    "set_1_union_nested",
    """SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, NULL::INT AS region, c_acctbal AS balance, 'c' AS kind, NULL AS name FROM customer
       UNION ALL SELECT s_suppkey, s_nationkey + 5000000000, 'S' || s_nationkey, NULL, s_acctbal, 's', s_name FROM supplier
       UNION ALL SELECT n_nationkey, NULL, NULL, n_regionkey, NULL, NULL, NULL FROM nation""",
)
def union_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs, and structs in arrays, are joined field by field."""
    return union_all(_places(spark, sf_dir)).selectExpr(*PLACES)


@check("set_2_single_source", "SELECT * FROM supplier")
def single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all([table(spark, sf_dir, "supplier")])


@check("udf_2_custom_source", "SELECT p_partkey, p_name, p_retailprice FROM part")
def custom_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    def read_parts(session: SparkSession, options: dict) -> DataFrame:
        return session.read.parquet(options["path"]).select("p_partkey", "p_name", "p_retailprice")

    register_reader("parts", read_parts)
    return read_source(spark, SourceSpec("parts", {"path": f"{sf_dir}/part.parquet"}))


@check(
    "src_4_split_filter",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_custkey >= 10 AND o_orderstatus IN ('F', 'P')
       AND o_orderpriority LIKE '1-%' AND (o_totalprice > 100000 OR o_orderstatus = 'P') AND o_orderdate >= TIMESTAMP '1994-01-01'""",
)
def split_document_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part that a database would answer, then the part left to Spark, give what the whole filter gives."""
    spec = {
        "o_custkey": {"$gte": 10}, "o_orderstatus": {"$in": ["F", "P"]}, "o_orderpriority": {"$regex": "^1-"},
        "$or": [{"o_totalprice": {"$gt": 100000}}, {"o_orderstatus": "P"}], "o_orderdate": {"$gte": {"$date": "1994-01-01T00:00:00Z"}},
    }
    pushed, rest = split_filter(spec)
    assert fields_of(pushed) == {"o_custkey", "o_orderstatus", "o_totalprice"} and fields_of(rest) == {"o_orderpriority", "o_orderdate"}
    return document_filter(document_filter(table(spark, sf_dir, "orders"), pushed), rest).select("o_orderkey", "o_orderstatus")


class ParquetSlices(Adapter):
    """A Parquet file as a source of one's own, in slices of rows."""

    def schema(self, options: dict[str, str]) -> str:
        return options["columns"]

    def plan(self, options: dict[str, str], conditions: Sequence[Condition]) -> list[tuple[int, int]]:
        file = parquet.ParquetFile(options["path"])
        step = max(1, file.metadata.num_rows // int(options["slices"]) + 1)
        return [(at, step) for at in range(0, max(1, file.metadata.num_rows), step)]

    def read(self, options, schema, conditions, piece) -> Iterator[pa.RecordBatch]:
        at, step = piece
        begin = 0
        for batch in parquet.ParquetFile(options["path"]).iter_batches(batch_size=10_000, columns=schema.names):
            wanted = batch.slice(max(0, at - begin), max(0, min(begin + batch.num_rows, at + step) - max(at, begin)))
            begin += batch.num_rows
            if wanted.num_rows:
                yield matching(wanted, conditions)
            if begin >= at + step:
                break


@check(
    "udf_2_data_source",
    """SELECT event_id, ts, user_id, event_type FROM events
       WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00' AND user_id IN (1, 2, 3, 5, 8, 13, 21)""",
)
def data_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A format of one's own, read in slices; the window and the list of users reach the source."""
    register_source(spark, "parquet_slices", ParquetSlices())
    window, users = Window(datetime(2024, 1, 10), datetime(2024, 1, 20)), [1, 2, 3, 5, 8, 13, 21]
    conditions = [*window_conditions("ts", window), Condition("user_id", "in", users)]
    options = {"conditions": conditions, "path": f"{sf_dir}/events.parquet", "columns": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING", "slices": "8"}
    events = read_source(spark, SourceSpec("parquet_slices", options))
    return extract(events, "ts", window).filter(F.col("user_id").isin(users))
