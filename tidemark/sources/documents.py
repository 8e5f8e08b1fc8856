"""SRC-4, SRC-6: document collections, by connector or as JSON lines."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calculated import quote
from tidemark.functions.jsontext import parse, stringify_ids, unwrap
from tidemark.operators.predicates import document_filter, fields_of, split_filter
from tidemark.operators.projection import project


@dataclass(frozen=True)
class DocumentSource:
    """A connection string wins over host and port; credentials are optional.

    ``path`` reads JSON lines instead of a database, ``schema`` declares their type.
    """

    database: str | None = None
    collection: str | None = None
    connection_string: str | None = None
    host: str = "localhost"
    port: int = 27017
    user: str | None = None
    password: str | None = None
    path: str | None = None
    schema: str | T.StructType | None = None
    filter: str | Mapping[str, Any] | None = None
    projection: str | Mapping[str, int] | None = None
    extra: Mapping[str, str] = field(default_factory=dict)


def connector_options(source: DocumentSource) -> dict[str, str]:
    if not source.database or not source.collection:
        raise ValueError("a document source needs a database and a collection")
    uri = source.connection_string
    if not uri:
        login = f"{source.user}:{source.password}@" if source.user and source.password else ""
        uri = f"mongodb://{login}{source.host}:{source.port}"
    return {
        "connection.uri": uri,
        "database": source.database,
        "collection": source.collection,
        **source.extra,
    }


def pipeline(source: DocumentSource) -> tuple[list[dict[str, Any]], dict[str, Any]]:
    """What the database does for a read, as stages of its own, and the filter that is left to Spark.

    With a projection that names the wanted fields, others are left where they are, but for
    those that the rest of the filter looks at; Spark shapes what arrives.
    """
    pushed, rest = split_filter(source.filter) if source.filter else ({}, {})
    stages: list[dict[str, Any]] = [{"$match": pushed}] if pushed else []
    chosen = json.loads(source.projection) if isinstance(source.projection, str) else source.projection or {}
    wanted = {name for name, use in chosen.items() if use}
    if wanted - {"_id"}:
        heads = {path.split(".")[0] for path in wanted | fields_of(rest)}
        keeps_id = chosen.get("_id", 1) or "_id" in heads
        stages.append({"$project": {name: 1 for name in sorted(heads - {"_id"})} | {"_id": 1 if keeps_id else 0}})
    return stages, rest


def read_documents(spark: SparkSession, source: DocumentSource) -> DataFrame:
    """Filtered and projected documents, ids as text. Over files the filter sits directly on the
    scan; a database answers what it answers alike, before documents travel."""
    if source.path:
        reader = spark.read.schema(source.schema) if source.schema else spark.read
        documents = reader.json(source.path)
        return shape_documents(documents, source.filter, source.projection)
    stages, rest = pipeline(source)
    asked = {"aggregation.pipeline": json.dumps(stages)} if stages else {}
    if "aggregation.pipeline" in source.extra:  # the source's own pipeline comes first, so all is left to Spark
        asked, rest = {}, source.filter
    documents = spark.read.format("mongodb").options(**asked | connector_options(source)).load()
    return shape_documents(documents, rest, source.projection)


def shape_documents(
    documents: DataFrame,
    filter_spec: str | Mapping[str, Any] | None = None,
    projection: str | Mapping[str, int] | None = None,
) -> DataFrame:
    documents = ids_as_text(documents)
    if filter_spec:
        documents = document_filter(documents, filter_spec)
    return project(documents, projection)


def ids_as_text(df: DataFrame, ids: tuple[str, ...] = ("_id",)) -> DataFrame:
    """``ids`` names the fields whose binary values are ids."""
    return df.select(
        *(stringify_ids(F.col(quote(f.name)), f.dataType, ids, f.name in ids).alias(f.name) for f in df.schema)
    )


def parse_documents(df: DataFrame, text_column: str, to: str = "document") -> DataFrame:
    """JSON text with extended-JSON wrappers taken off, as one VARIANT column."""
    return df.withColumn(to, parse(unwrap(F.col(quote(text_column)))))
