"""Source options, selection, union and shards. No database is needed or started."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.config import SourceSpec
from tidemark.operators.incremental import Window
from tidemark.operators.union import union_all
from tidemark.session import shared_dir
from tidemark.sources import read_source, source_names
from tidemark.sources import documents as docs
from tidemark.sources import relational as rel
from tidemark.sources import warehouse as wh


def test_jdbc_options():
    source = rel.RelationalSource("jdbc:x", query="SELECT * FROM t;", user="u", password="p")
    options = rel.jdbc_options(source)
    assert options["dbtable"] == "(SELECT * FROM t) AS source_rows"
    assert options["user"] == "u" and "numPartitions" not in options
    split = rel.RelationalSource("jdbc:x", table="t", partition_column="id", lower_bound=1, upper_bound=9, partitions=4)
    options = rel.jdbc_options(split)
    assert (options["dbtable"], options["partitionColumn"], options["numPartitions"]) == ("t", "id", "4")
    with pytest.raises(ValueError):
        rel.jdbc_options(rel.RelationalSource("jdbc:x", table="t", partition_column="id"))
    for query in (None, "", "  "):
        with pytest.raises(ValueError):
            rel.jdbc_options(rel.RelationalSource("jdbc:x", query=query))


def test_window_predicates_touch_and_cover():
    window = Window(datetime(2024, 1, 1), datetime(2024, 1, 3))
    assert rel.window_predicates("ts", window, 2) == [
        "ts > '2024-01-01 00:00:00' AND ts <= '2024-01-02 00:00:00'",
        "ts > '2024-01-02 00:00:00' AND ts <= '2024-01-03 00:00:00'",
    ]


def test_catalog_query(spark):
    sql = rel.catalog_columns_sql("orders")
    assert "table_schema = 'public' AND table_name = 'orders'" in sql
    assert "table_schema = 'sales'" in rel.catalog_columns_sql("sales.orders")
    with pytest.raises(ValueError):
        rel.catalog_columns_sql("orders' OR 1=1")
    rows = spark.createDataFrame(
        [("id", "integer", None, 0, None, 1)],
        "name STRING, type STRING, max_length INT, is_nullable INT, `default` STRING, position INT",
    )
    assert rel.columns_from_catalog(rows).first()["nullable"] is False


def test_document_connection():
    by_host = docs.DocumentSource("d", "c", host="h", port=1, user="u", password="p")
    assert docs.connector_options(by_host)["connection.uri"] == "mongodb://u:p@h:1"
    by_string = docs.DocumentSource("d", "c", connection_string="mongodb://z", host="h")
    assert docs.connector_options(by_string)["connection.uri"] == "mongodb://z"
    assert docs.connector_options(docs.DocumentSource("d", "c"))["connection.uri"] == "mongodb://localhost:27017"
    with pytest.raises(ValueError):
        docs.connector_options(docs.DocumentSource("d"))


def test_warehouse_source(spark):
    assert wh.table_name("p", "d", "t") == "p.d.t"
    with pytest.raises(ValueError):
        wh.table_name("p", "", "t")
    with pytest.raises(ValueError):
        wh.read_warehouse(spark, wh.WarehouseSource())
    both = wh.WarehouseSource(query="SELECT 1", table="t", project="p")
    assert wh.connector_options(both) == {"query": "SELECT 1", "parentProject": "p"}


def test_selection():
    assert source_names(" postgresql , MongoDB ") == ["postgresql", "mongodb"]
    for wrong in ("oracle", "postgresql,nothing", ""):
        with pytest.raises(ValueError):
            source_names(wrong)


def test_empty_query_is_refused(spark):
    with pytest.raises(ValueError):
        read_source(spark, SourceSpec("postgresql", {"query": " "}))


def test_binary_and_wrapped_ids_become_text(spark):
    df = spark.createDataFrame(
        [(bytearray.fromhex("0aff"), bytearray(b"raw"), {"k": ("d2",)}, ("507f",), [(("b1",), 1)])],
        "_id BINARY, body BINARY, m MAP<STRING, STRUCT<`$oid`: STRING>>, ref STRUCT<`$oid`: STRING>, list ARRAY<STRUCT<r: STRUCT<`$oid`: STRING>, n: INT>>",
    )
    row = docs.ids_as_text(df).first()
    assert (bytes(row["body"]), row["m"]) == (b"raw", {"k": "d2"})
    assert (row["_id"], row["ref"], row["list"][0].asDict()) == ("0aff", "507f", {"r": "b1", "n": 1})


def test_extended_json_becomes_plain(spark):
    text = """{"_id":{"$oid":"5f"},"n":{"$numberLong":"9007199254740993"},"p":[{"$numberDecimal":"1.50"},{"$numberInt":"-2"}],
        "at":{"$date":"2024-01-01T00:00:00Z"},"b":{"$binary":{"base64":"AP8=","subType":"00"}},"t":"say {\\"$oid\\": 1}"}"""
    df = docs.parse_documents(spark.createDataFrame([(text,)], "raw STRING"), "raw").select(F.to_json("document").alias("j"))
    assert df.first().j == (
        '{"_id":"5f","at":"2024-01-01T00:00:00Z","b":"AP8=","n":9007199254740993,"p":[1.5,-2],"t":"say {\\"$oid\\": 1}"}'
    )


def test_union_settles_types(spark):
    a = spark.sql("SELECT 1 AS id, 1.5D AS n, 'x' AS s, named_struct('b', 1) AS j, DATE'2024-01-01' AS d")
    b = spark.sql("SELECT 2L AS id, CAST(2 AS DECIMAL(5,2)) AS n, 7 AS s, '{}' AS j, 'soon' AS d, NULL AS id2")
    rows = {r["id"]: r.asDict() for r in union_all([a, b]).collect()}
    assert rows[1] == {"id": 1, "n": 1.5, "s": "x", "j": '{"b":1}', "d": "2024-01-01", "id2": None}
    assert rows[2] == {"id": 2, "n": 2.0, "s": "7", "j": "{}", "d": "soon", "id2": None}
    assert union_all([a, a]).count() == 2 and union_all([a]) is a
    with pytest.raises(ValueError):
        union_all([])


def test_shards_read_only_the_named_files(spark):
    path = f"{shared_dir(spark)}/events"
    for day in ("20240101", "20240102", "20240103"):
        spark.range(3).withColumn("d", F.lit(day)).write.parquet(f"{path}/events_{day}")
    shards = wh.read_shards(spark, f"{path}/events_*").filter("table_suffix = '20240102'")
    assert {(r["d"], r["table_suffix"]) for r in shards.collect()} == {("20240102", "20240102")}
    with pytest.raises(ValueError):
        wh.read_shards(spark, f"{path}/events")


def test_shards_that_grow(spark):
    path = f"{shared_dir(spark)}/grow"
    spark.sql("SELECT 1 AS id").write.parquet(f"{path}/t_1")
    spark.sql("SELECT 'x' AS extra, 2 AS id, named_struct('a', 1) AS s").write.parquet(f"{path}/t_2")
    rows = {r["id"]: (r["extra"], r["table_suffix"]) for r in wh.read_shards(spark, f"{path}/t_*").collect()}
    assert rows == {1: (None, "1"), 2: ("x", "2")}
    spark.sql("SELECT 3.5D AS id, named_struct('b', 'y', 'a', 5000000000) AS s").write.parquet(f"{path}/t_3")
    rows = {r["id"]: (r["extra"], r["table_suffix"], r["s"] and r["s"].asDict()) for r in wh.read_shards(spark, f"{path}/t_*").collect()}
    assert rows == {1.0: (None, "1", None), 2.0: ("x", "2", {"a": 1, "b": None}), 3.5: (None, "3", {"a": 5000000000, "b": "y"})}


@pytest.mark.parametrize(("query", "kept", "limited"), [
    ("SELECT * FROM t WHERE a > 1 ORDER BY ts DESC", "SELECT * FROM t WHERE a > 1", False),
    ("SELECT * FROM t WHERE a > 1 ORDER BY ts DESC, lower(b) NULLS LAST;", "SELECT * FROM t WHERE a > 1", False),
    ("SELECT * FROM t ORDER BY ts DESC LIMIT 100", None, True),
    ("SELECT * FROM t ORDER BY ts OFFSET 10 ROWS FETCH NEXT 5 ROWS ONLY", None, True),
    ("SELECT * FROM t ORDER BY ts\nFETCH FIRST ROW ONLY", None, True),
    ("SELECT * FROM t LIMIT 7", None, True),
    ("SELECT * FROM (SELECT * FROM t ORDER BY ts LIMIT 5) x", None, False),
    ("SELECT * FROM (SELECT * FROM t ORDER BY ts LIMIT 5) x ORDER BY a", "SELECT * FROM (SELECT * FROM t ORDER BY ts LIMIT 5) x", False),
    ("SELECT 'no ORDER BY LIMIT (' AS c, \"limit\" FROM t -- LIMIT 3", None, False),
    ("SELECT row_number() OVER (ORDER BY ts) AS n FROM t", None, False),
])
def test_orders_and_limits(query, kept, limited):
    assert rel.unordered(query) == (kept or query) and rel.is_limited(query) == limited
