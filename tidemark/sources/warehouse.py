"""SRC-2, SRC-3, SRC-9: warehouse queries, tables and sharded tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.union import union_all
from tidemark.sources.relational import sql_rows


@dataclass(frozen=True)
class WarehouseSource:
    """A query wins over a table. ``format`` names a connector; without it the
    query or table is Spark's own."""

    query: str | None = None
    table: str | None = None
    arguments: Mapping[str, str] | None = None
    format: str | None = None
    project: str | None = None


def table_name(project: str, dataset: str, table: str) -> str:
    """The three-part name; every part is needed."""
    parts = (project, dataset, table)
    if not all(parts):
        raise ValueError("project, dataset and table are all needed")
    return ".".join(parts)


def read_warehouse(spark: SparkSession, source: WarehouseSource) -> DataFrame:
    if not source.query and not source.table:
        raise ValueError("a warehouse source needs a query or a table")
    if source.format:
        return spark.read.format(source.format).options(**connector_options(source)).load()
    if source.query:
        return sql_rows(spark, source.query, source.arguments)
    return spark.table(source.table)


def connector_options(source: WarehouseSource) -> dict[str, str]:
    options = {"query": source.query} if source.query else {"table": source.table}
    if source.project:
        options["parentProject"] = source.project
    return options


def read_shards(spark: SparkSession, pattern: str, suffix_column: str = "table_suffix") -> DataFrame:
    """SRC-9: all folders ``<prefix>*`` as one table with the part after the prefix.

    A filter on that column names files, not rows, so Spark drops the files of
    other shards before it reads them. Shards may have grown: a column that a shard lacks is
    null in its rows, and types that differ are joined as in a union.
    """
    if not pattern.endswith("*") or pattern.count("*") != 1:
        raise ValueError("a shard pattern ends in its only '*'")
    prefix = pattern[:-1].rsplit("/", 1)[-1]
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    suffix = F.substr(folder, F.lit(len(prefix) + 1)).alias(suffix_column)
    base = pattern.rsplit("/", 1)[0]
    try:
        # Footers are read by tasks; columns of any shard are columns of all.
        return spark.read.option("basePath", base).option("mergeSchema", "true").parquet(pattern).select("*", suffix)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    # Types differ, so each shard is read by its own schema and the union settles them.
    folders = sorted({file.rsplit("/", 1)[0] for file in spark.read.option("basePath", base).parquet(pattern).inputFiles()})
    return union_all([spark.read.parquet(f).select("*", suffix) for f in folders])
