"""UDF-2: a source of one's own as a data source of Spark: slices, conditions, Arrow batches.

An adapter says what columns it has, which slices a read falls into, and yields Arrow batches of a
slice. Slices are read by tasks, as many at once as the cluster has cores, and a lost task is
read again. What a read asks for is given with it, as conditions on columns; a sync gives its
window. The adapter may use them to spare slices and rows; Spark filters what arrives all the same.

    class Tickets(Adapter):
        def schema(self, options): return "id BIGINT, opened TIMESTAMP_NTZ"
        def plan(self, options, conditions): return [{"page": n} for n in range(40)]
        def read(self, options, schema, conditions, piece): yield pyarrow.RecordBatch...

    register_source(spark, "tickets", Tickets())
    spark.read.format("tickets").option("url", ...).load()

Filters are not taken from Spark's plan: its pushdown to Python sources keeps those of one query for
the next one over the same DataFrame, which then lacks rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

from tidemark.operators.incremental import Window
from tidemark.sources import register_reader

CONDITIONS = "conditions"
NAMES: set[str] = set()


@dataclass(frozen=True)
class Condition:
    """``column`` compared with ``value`` by =, >, >=, < or <=; for ``in`` a list of values, for ``not null`` nothing."""

    column: str
    comparison: str
    value: Any = None


def as_text(conditions: Sequence[Condition]) -> str:
    """Conditions as the option that carries them."""

    def told(value: Any) -> Any:
        if isinstance(value, datetime):
            return {"datetime": value.isoformat()}
        return {"date": value.isoformat()} if isinstance(value, date) else value

    return json.dumps([[c.column, c.comparison, [told(v) for v in c.value] if c.comparison == "in" else told(c.value)] for c in conditions])


def from_text(text: str) -> list[Condition]:
    def read(value: Any) -> Any:
        if isinstance(value, list):
            return [read(v) for v in value]
        if isinstance(value, dict):
            return datetime.fromisoformat(value["datetime"]) if "datetime" in value else date.fromisoformat(value["date"])
        return value

    return [Condition(column, comparison, read(value)) for column, comparison, value in json.loads(text)]


def window_conditions(column: str, window: Window) -> list[Condition]:
    return [Condition(column, ">", window.start), Condition(column, "<=", window.end)]


class Adapter:
    """What a custom source has to say. Adapters travel to tasks, so they hold no connection."""

    def schema(self, options: dict[str, str]) -> str | T.StructType:
        raise NotImplementedError

    def plan(self, options: dict[str, str], conditions: Sequence[Condition]) -> Sequence[Any]:
        """The slices of a read, each of which a task reads; ``conditions`` may spare some."""
        return [None]

    def read(self, options: dict[str, str], schema: T.StructType, conditions: Sequence[Condition], piece: Any) -> Iterator[pa.RecordBatch]:
        """The rows of a slice, all columns in the schema's order; at least those that meet the conditions."""
        raise NotImplementedError


def matching(batch: pa.RecordBatch, conditions: Sequence[Condition]) -> pa.RecordBatch:
    """The rows of a batch that meet all conditions, for adapters whose source can't filter."""
    for c in conditions:
        values = batch.column(c.column)
        if c.comparison == "not null":
            mask = values.is_valid()
        elif c.comparison == "in":
            mask = pc.is_in(values, pa.array(c.value, values.type))
        else:
            compare = {"=": pc.equal, ">": pc.greater, ">=": pc.greater_equal, "<": pc.less, "<=": pc.less_equal}[c.comparison]
            mask = compare(values, pa.scalar(c.value, values.type))
        batch = batch.filter(mask)
    return batch


class _Piece(ds.InputPartition):
    def __init__(self, value: Any):
        super().__init__(value)


class _Reader(ds.DataSourceReader):
    def __init__(self, adapter: Adapter, options: dict[str, str], schema: T.StructType):
        self.conditions = from_text(options.pop(CONDITIONS, "[]"))
        self.adapter, self.options, self.schema = adapter, options, schema

    def partitions(self):
        return [_Piece(p) for p in self.adapter.plan(self.options, self.conditions)]

    def read(self, partition):
        yield from self.adapter.read(self.options, self.schema, self.conditions, partition.value)


def register_source(spark: SparkSession, name: str, adapter: Adapter) -> None:
    """Make an adapter a format of the session's reader, and a source of syncs under the same name."""

    class Source(ds.DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return adapter.schema(dict(self.options))

        def reader(self, schema):
            return _Reader(adapter, dict(self.options), schema)

    spark.dataSource.register(Source)

    def load(session: SparkSession, options: dict) -> DataFrame:
        asked = {CONDITIONS: as_text(options[CONDITIONS])} if CONDITIONS in options else {}
        return session.read.format(name).options(**options | asked).load()

    register_reader(name, load)
    NAMES.add(name)
