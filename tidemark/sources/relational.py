"""SRC-1, SCH-1: SELECTs against a relational database over JDBC, read in parallel."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.incremental import Window, clipped, window_slices


@dataclass(frozen=True)
class RelationalSource:
    """A query or a table. It is split over tasks by its own partition column and bounds,
    or by the sync's timestamp; ``partitions=1`` says that one task is enough."""

    url: str
    query: str | None = None
    table: str | None = None
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    partition_column: str | None = None
    lower_bound: str | int | None = None
    upper_bound: str | int | None = None
    partitions: int = 32
    fetch_size: int = 10_000
    extra: Mapping[str, str] = field(default_factory=dict)

    def relation(self) -> str:
        """What JDBC reads: the table, or the query as a derived table."""
        return self.table or f"({require_query(self.query)}) AS source_rows"


# What is outside the last parentheses and quotes of a query.
QUOTED = re.compile(r"""'(?:[^']|'')*'|"[^"]*"|`[^`]*`|--[^\n]*|/\*.*?\*/""", re.DOTALL)
LAST_ORDER = re.compile(r"\bORDER\s+BY\b", re.IGNORECASE)
LIMITS = re.compile(r"\b(LIMIT|OFFSET|FETCH|TOP)\b", re.IGNORECASE)


def _outer(query: str) -> str:
    """The query with quoted texts, comments and everything in parentheses blanked, at the same places."""
    blanked = QUOTED.sub(lambda m: "_" * len(m[0]), query)
    depth, kept = 0, []
    for c in blanked:
        depth -= c == ")" and depth > 0
        kept.append(c if depth == 0 else "_")
        depth += c == "("
    return "".join(kept)


def is_limited(query: str) -> bool:
    """Whether the query itself says how many of its rows are wanted, so that slices of it would be other rows."""
    return bool(LIMITS.search(_outer(require_query(query))))


def unordered(query: str) -> str:
    """A query without its last ORDER BY, which a derived table may not have and slices do not need.

    With a limit the order says which rows are wanted, so it stays.
    """
    query = require_query(query)
    found = list(LAST_ORDER.finditer(_outer(query)))
    # An ORDER BY in front of a set operation can't be outside parentheses, so the last one ends the query.
    return query if not found or is_limited(query) else query[: found[-1].start()].rstrip()


def require_query(query: str | None) -> str:
    if not query or not query.strip():
        raise ValueError("the source query cannot be empty")
    return query.strip().rstrip(";")


def jdbc_options(source: RelationalSource) -> dict[str, str]:
    options = {
        "url": source.url,
        "dbtable": source.relation(),
        "fetchsize": str(source.fetch_size),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        **source.extra,
    }
    for key, value in (("user", source.user), ("password", source.password), ("driver", source.driver)):
        if value:
            options[key] = value
    if source.partition_column:
        if source.lower_bound is None or source.upper_bound is None:
            raise ValueError("a partition column needs a lower and an upper bound")
        options |= {
            "partitionColumn": source.partition_column,
            "lowerBound": str(source.lower_bound),
            "upperBound": str(source.upper_bound),
            "numPartitions": str(source.partitions),
        }
    return options


def read_relational(spark: SparkSession, source: RelationalSource) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(source)).load()


def window_predicates(timestamp: str, window: Window, parts: int, days: bool = False) -> list[str]:
    """WHERE texts that cut the window into adjoining slices, one per task; for a DATE column
    (``days``) by whole days."""

    def text(moment: datetime) -> str:
        return moment.date().isoformat() if days else moment.isoformat(sep=" ")

    return [
        f"{timestamp} > '{text(s.start)}' AND {timestamp} <= '{text(s.end)}'"
        for s in window_slices(window, parts, days)
    ]


def source_bounds(spark: SparkSession, source: RelationalSource, timestamp: str) -> tuple:
    """Least and newest timestamp and the number of null ones; the database computes the one row."""
    options = jdbc_options(replace(source, partition_column=None))
    asked = (
        f"(SELECT min({timestamp}) AS least, max({timestamp}) AS most, "
        f"sum(CASE WHEN {timestamp} IS NULL THEN 1 ELSE 0 END) AS nulls FROM {options['dbtable']}) AS bounds"
    )
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    row = spark.read.jdbc(options["url"], asked, properties=properties).first()
    return row["least"], row["most"], row["nulls"] or 0


def slice_predicates(
    timestamp: str, window: Window | None, parts: int, least, most, nulls: int
) -> list[str]:
    """One WHERE text per task: slices of what the source really holds of the window, and
    one for null timestamps when all rows are read."""
    found = []
    if least is not None:
        days = not isinstance(least, datetime)
        found = window_predicates(timestamp, clipped(window, least, most), parts, days)
    if window is None and nulls:
        found.append(f"{timestamp} IS NULL")
    return found or ["1 = 0"]


def read_slices(
    spark: SparkSession, source: RelationalSource, timestamp: str, window: Window | None
) -> DataFrame:
    """A read in which every task asks the database for its own slice: of a window, a
    first load or a full refresh alike."""
    least, most, nulls = source_bounds(spark, source, timestamp)
    options = jdbc_options(source)
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(
        options["url"],
        options["dbtable"],
        predicates=slice_predicates(timestamp, window, source.partitions, least, most, nulls),
        properties=properties,
    )


def catalog_columns_sql(table: str, default_schema: str = "public") -> str:
    """SCH-1 from a database catalog: the query whose result is the schema frame."""
    schema, _, name = table.rpartition(".")
    schema = schema or default_schema
    for part in (schema, name):
        if not part.replace("_", "").isalnum():
            raise ValueError(f"not a plain table name: {table}")
    return (
        "SELECT column_name AS name, data_type AS type, "
        "character_maximum_length AS max_length, "
        "CASE WHEN is_nullable = 'YES' THEN 1 ELSE 0 END AS is_nullable, "
        'column_default AS "default", ordinal_position AS position '
        "FROM information_schema.columns "
        f"WHERE table_schema = '{schema}' AND table_name = '{name}'"
    )


def columns_from_catalog(rows: DataFrame) -> DataFrame:
    """The catalog query's rows in the shape the schema operators use."""
    return rows.selectExpr(
        "name", "type", "cast(max_length AS bigint) AS max_length", "is_nullable = 1 AS nullable",
        "`default`", "cast(position AS bigint) AS position",
    )


def sql_rows(
    spark: SparkSession, query: str | None, arguments: Mapping[str, str] | Sequence | None = None
) -> DataFrame:
    """SRC-1 and SRC-2 for tables Spark itself can see: a SELECT with bound parameters."""
    return spark.sql(require_query(query), args=arguments or None)
