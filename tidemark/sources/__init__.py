"""SRC-7, UDF-2: readers by name, and the selection of several sources."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import SourceSpec
from tidemark.sources.documents import DocumentSource, read_documents
from tidemark.sources.relational import RelationalSource, read_relational, sql_rows
from tidemark.sources.warehouse import WarehouseSource, read_warehouse

Reader = Callable[[SparkSession, dict], DataFrame]


def _relational(spark: SparkSession, options: dict) -> DataFrame:
    if options.get("url"):
        return read_relational(spark, RelationalSource(**options))
    return sql_rows(spark, options.get("query"), options.get("arguments"))


READERS: dict[str, Reader] = {
    "postgresql": _relational,
    "mongodb": lambda spark, options: read_documents(spark, DocumentSource(**options)),
    "bigquery": lambda spark, options: read_warehouse(spark, WarehouseSource(**options)),
}


def register_reader(name: str, reader: Reader) -> None:
    """UDF-2: a custom source is a function from session and options to a DataFrame."""
    READERS[name] = reader


def source_names(selection: str) -> list[str]:
    """SRC-7: a comma-separated selection. Unknown names are refused."""
    names = [name.strip().lower() for name in selection.split(",") if name.strip()]
    unknown = [name for name in names if name not in READERS]
    if unknown or not names:
        raise ValueError(f"unknown sources: {unknown or selection!r}")
    return names


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    (name,) = source_names(spec.kind)
    return READERS[name](spark, dict(spec.options))


def read_sources(spark: SparkSession, specs: Iterable[SourceSpec]) -> list[DataFrame]:
    return [read_source(spark, spec) for spec in specs]
