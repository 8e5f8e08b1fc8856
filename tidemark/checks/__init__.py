"""Registered queries: every operator run over the driver's tables, with oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import SinkSpec
from tidemark.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query, and the SQL that must give the same rows."""

    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The table as a temporary view, for queries that are SQL text."""
    alias = f"source_{name}"
    table(spark, sf_dir, name).createOrReplaceTempView(alias)
    return alias


def new_sink(spark: SparkSession, **options) -> SinkSpec:
    """A destination of its own in the shared folder."""
    name = f"sync_{uuid.uuid4().hex[:12]}"
    return SinkSpec(table=name, path=f"{shared_dir(spark)}/{name}", **options)


def load() -> None:
    """Import the modules that register queries."""
    from tidemark.checks import (  # noqa: F401
        incremental,
        monitoring,
        reading,
        schemas,
        syncing,
        transforming,
        validating,
        writing,
    )
