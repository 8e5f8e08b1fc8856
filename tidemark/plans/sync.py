"""PIP-1..PIP-8: one sync, from sources to the destination table.

Everything up to the write is one lazy plan. The driver runs at most three small
jobs before it: the schema aggregate, the high-water mark and the emptiness test.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import SourceSpec, SyncJob
from tidemark.functions.calculated import quote
from tidemark.operators import schema as schemas
from tidemark.operators.incremental import (
    Window,
    bind_template,
    destination_mark,
    extract,
    fill_template,
    sync_window,
)
from tidemark.operators.ledger import BEGUN, ENDED, Ledger
from tidemark.operators.nested import NESTED, grown_type
from tidemark.operators.transform import ERROR, ORIGINAL, Transformed, chain, transform
from tidemark.operators.union import union_all
from tidemark.operators.validate import REASON, conform, split, validate
from tidemark.operators.write import create_table, day_column, recover, replacement, swap_in, write_batch, write_table
from tidemark.session import shared_dir
from tidemark.sources import custom, read_source
from tidemark.sources.relational import (
    RelationalSource,
    catalog_columns_sql,
    columns_from_catalog,
    is_limited,
    read_relational,
    read_slices,
    unordered,
)

log = logging.getLogger(__name__)

KINDS = {"mongodb": schemas.DOCUMENT, "bigquery": schemas.WAREHOUSE}
Detector = Callable[[DataFrame], DataFrame]
DETECTORS: dict[str, Detector] = {}


@dataclass(frozen=True)
class SyncResult:
    table: str
    window: Window | None
    written: int
    rejected: int
    failed: int = 0
    fallback: str | None = None
    rejects: str | None = None  # the folder that holds this run's rejected records


def run_sync(spark: SparkSession, job: SyncJob, now: datetime) -> SyncResult:
    """Run one sync. ``now`` is UTC and ends the window, so that a repeated run reads
    the same rows.

    A destination that is to be created anew is empty from the start: everything the
    options say about an empty one is read, into a new table that takes the old one's
    place when it is written.
    """
    _refuse(job)
    recover(spark, job.sink.table)
    anew = job.sink.delete_existing and spark.catalog.tableExists(job.sink.table)
    target, job = job.sink.table, replace(job, sink=replacement(job.sink)) if anew else job
    window, fallback, mark = _window(spark, job, now)
    frames = [read_rows(spark, source, job, window, now, fallback) for source in job.sources]
    if anew:
        _refuse_own_rows(spark, frames, target)
    united = union_all(frames)
    if job.sync.auto_schema:
        _prepare_table(spark, job, united)
    checked, converted, fitted = Observation(), Observation(), Observation()
    destination = schemas.destination_schema(spark, job.sink.table)
    flagged = validate(united, destination, job.array_literals, job.max_record_chars, job.require_fields)
    flagged = _counted(flagged, checked, REASON)
    if job.rejects_path is not None if job.stage is None else job.stage:
        invalid, result = _staged(spark, flagged, job, converted)
    else:
        valid, invalid = split(flagged)
        result = Transformed(_counted(transform(valid, job.transform).frame, converted, ERROR))
    finished = finish(result, job)
    types = _target_types(spark, job, finished) if destination else {}
    rows, misfits = split(_counted(conform(finished, types), fitted, REASON, job.sync.timestamp_column))
    ledger, run = job.sync.ledger and Ledger(job.sync.ledger), uuid.uuid4().hex
    if ledger:
        ledger.note(spark, target, run, BEGUN, _clock(), window)
    write_table(rows, job.sink)
    (_, n_invalid, _), (_, n_failed, _), (n_rows, n_misfits, newest) = (
        _observed(seen, united) for seen in (checked, converted, fitted)
    )
    kinds = [("validation", invalid, n_invalid), ("types", misfits, n_misfits)]
    if job.rejects_path:
        kinds.append(("transformation", result.errors(), n_failed))
    folder = job.rejects_path
    for kind, rejects, n in kinds:
        if n:
            folder = folder or shared_dir(spark)
            write_batch(rejects, f"{folder}/{kind}", now.isoformat())
    if anew:
        swap_in(spark, job.sink.table, target)
    if ledger:
        reached = [m for m in (newest, None if job.sink.write == "truncate" else mark) if m is not None]
        ledger.note(spark, target, run, ENDED, _clock(), window, max(reached, default=None), n_rows - n_misfits)
    return SyncResult(
        target, window, n_rows - n_misfits, n_invalid + n_misfits, n_failed, fallback, folder
    )


def _clock() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


ROUTE = "_route"


def _staged(spark: SparkSession, flagged: DataFrame, job: SyncJob, converted: Observation) -> tuple[DataFrame, Transformed]:
    """VAL-11, TRF-17 in one evaluation: all records, written once by route, and read back apart.

    Records that failed validation keep their source columns; what follows reads the staged files,
    so a source that changes meanwhile changes nothing.
    """
    invalid = F.col(REASON).isNotNull()
    frame = transform(flagged, job.transform, keep=invalid).frame
    route = F.when(invalid, "invalid").when(F.col(ERROR).isNotNull(), "failed").otherwise("rows")
    frame = frame.select("*", route.alias(ROUTE))
    failed = F.when(~invalid, F.col(ERROR))
    frame = frame.withColumn(ERROR, failed)
    frame = _counted(frame, converted, ERROR)
    # Parquet has no place for a column that is always null; the table's type is settled later.
    untyped = {f.name for f in frame.schema if isinstance(f.dataType, T.NullType)}
    storable = frame.select(*(F.col(quote(c)).cast("string").alias(c) if c in untyped else F.col(quote(c)) for c in frame.columns))
    path = shared_dir(spark)
    storable.write.partitionBy(ROUTE).parquet(path)
    stored = spark.read.schema(storable.schema).parquet(path)
    own = [f"{ORIGINAL}.{quote(c)}" for c in flagged.columns]
    valid = stored.filter(F.col(ROUTE) != "invalid").drop(ROUTE, REASON)
    originals = F.struct(*(F.col(ORIGINAL).getField(c).alias(c) for c in flagged.columns if c != REASON))
    valid = valid.withColumn(ORIGINAL, F.when(F.col(ERROR).isNotNull(), originals))
    return stored.filter(F.col(ROUTE) == "invalid").select(*own), Transformed(valid)


def _target_types(spark: SparkSession, job: SyncJob, rows: DataFrame) -> dict[str, T.DataType]:
    """What each column is cast to: the table's type. A nested column grows with the data if the
    table may; a value that its type can't hold is rejected."""
    table = {f.name: f.dataType for f in spark.table(job.sink.table).schema}
    if job.sink.add_columns:
        table |= {f.name: grown_type(table[f.name], f.dataType) for f in rows.schema if isinstance(table.get(f.name), NESTED)}
    return table


def _refuse(job: SyncJob) -> None:
    """Options that contradict each other."""
    if job.sink.delete_existing and job.sink.create == "never":
        raise ValueError("a table that is never created can't be created anew")
    if job.sync.on_error == "full" and job.sink.write != "truncate":
        raise ValueError("reading everything after an error needs write='truncate', or it would append all rows again")


def _refuse_own_rows(spark: SparkSession, frames: list[DataFrame], table: str) -> None:
    """A source that reads the table it replaces would mix its old and new rows."""
    own = set(spark.table(table).inputFiles())
    if any(own & set(frame.inputFiles()) for frame in frames):
        raise ValueError(f"a source reads {table}, which is to be created anew")


def _counted(df: DataFrame, observation: Observation, flag: str, timestamp: str | None = None) -> DataFrame:
    """AGG-1: rows, flagged rows, and the newest timestamp of the others, seen while they are written."""
    moment = F.col(quote(timestamp)) if timestamp in df.columns else F.lit(None).cast("timestamp_ntz")
    newest = F.max(F.when(F.col(flag).isNull(), moment).try_cast("timestamp_ntz"))
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), F.count(flag).alias("bad"), newest.alias("newest"))


def _observed(seen: Observation, source: DataFrame) -> tuple[int, int, datetime | None]:
    """Rows, those flagged, and the newest timestamp. When AQE finds the input empty it drops the
    observed node with it, and there is nothing to fetch."""
    try:
        counts = seen.get
    except Py4JJavaError:
        if not source.isEmpty():
            raise
        return 0, 0, None
    return counts["rows"], counts["bad"], counts["newest"]


def read_rows(
    spark: SparkSession,
    source: SourceSpec,
    job: SyncJob,
    window: Window | None,
    now: datetime,
    fallback: str | None = None,
) -> DataFrame:
    """A source's new rows. A template brings its own predicate; otherwise the window
    becomes a filter on the source's scan. Over JDBC every read is cut into slices: by the
    source's own partition column, else by the timestamp. A query with a limit is read in one task."""
    options, column = dict(source.options), job.sync.source_timestamp or job.sync.timestamp_column
    template = options.pop("template", None)
    filled = template and job.sync.incremental and not (fallback and options.get("query"))
    if filled and not options.get("url"):
        options["query"], options["arguments"] = bind_template(template, window, now, column)
        return read_source(spark, SourceSpec(source.kind, options))
    if filled:
        options["query"] = unordered(fill_template(template, window, now, column))
    limited = options.get("url") and options.get("query") and is_limited(options["query"])
    if limited and options.get("partition_column"):
        raise ValueError("a query with a limit can't be cut: each slice would ask for rows of its own")
    if options.get("url") and not options.get("partition_column") and not limited:
        relation = RelationalSource(**options)
        if job.sync.incremental or job.sync.source_timestamp:
            return read_slices(spark, relation, column, None if filled else window)
        if relation.partitions > 1:
            raise ValueError(
                "nothing to split the read on: name a partition_column with bounds or a source_timestamp, or ask for partitions=1"
            )
    if source.kind in custom.NAMES and window is not None:
        options[custom.CONDITIONS] = [*options.get(custom.CONDITIONS, ()), *custom.window_conditions(column, window)]
    frame = read_source(spark, SourceSpec(source.kind, options))
    if filled or not job.sync.incremental:
        return frame
    if column not in frame.columns:
        raise ValueError(f"source {source.kind} has no column {column}; each run would append all its rows again")
    return extract(frame, column, window)


def finish(result: Transformed, job: SyncJob) -> DataFrame:
    """The rows for the table: TRF-17's choice for failed records, then custom functions."""
    if job.rejects_path or not job.transform.type_conversions:
        return chain(result.ok(), job.custom)
    return chain(result.merged(keep_types=True), job.custom)


def _window(spark: SparkSession, job: SyncJob, now: datetime) -> tuple[Window | None, str | None, datetime | None]:
    """The range to read, why it is everything, and the table's mark: from the ledger if it can be believed."""
    if not job.sync.incremental:
        return None, None, None
    column = job.sync.timestamp_column
    try:
        day = day_column(column) if column == job.sink.partition_field else None
        mark = Ledger(job.sync.ledger).mark(spark, job.sink.table, day) if job.sync.ledger else None
        if mark is None:
            mark = destination_mark(spark, job.sink.table, column, day)
    except (PySparkException, ValueError) as error:
        if job.sync.on_error != "full":
            raise
        log.warning("high-water mark unknown, reading everything: %s", error)
        return None, str(error), None
    return sync_window(mark, now, job.sync.on_empty, job.sync.fallback_days), None, mark


def _prepare_table(spark: SparkSession, job: SyncJob, united: DataFrame) -> None:
    """Create the destination, unless it is there, so that it fits the rows of all
    sources as the transformation leaves them."""
    if job.sink.create == "never" or spark.catalog.tableExists(job.sink.table):
        return
    try:
        transformed = finish(transform(united, job.transform), job)
        rows = schemas.mapped_rows(detect_schema(transformed, job), transformed.columns)
        struct = schemas.destination_struct(rows)
        create_table(spark, job.sink, schemas.with_catalog(struct, catalog_columns(spark, job)))
    except PySparkException as error:
        if job.sink.strict:
            raise
        log.warning("destination not created from the source schema: %s", error)


def catalog_columns(spark: SparkSession, job: SyncJob) -> dict[str, Row]:
    """SCH-1: what the databases' own catalogs say of the columns that reach the table unchanged.

    A driver shows a JSON column as text and knows no lengths and defaults; the catalog does. A
    column counts under its mapped name, unless a transformation makes its value or sources disagree.
    """
    spec, found = job.transform, {}
    made = {*spec.type_conversions, *spec.value_transformations, *spec.calculated_fields, *spec.flatten_nested.values()}
    for source in job.sources:
        rows = source_catalog(spark, source)
        for row in schemas.map_schema(rows, schemas.RELATIONAL, job.sync.mapping).join(rows, "name").collect() if rows is not None else ():
            name = spec.field_mappings.get(row["name"], row["name"])
            if name not in made:
                found.setdefault(name, []).append(row)
    return {n: rows[0] for n, rows in found.items() if len({r["destination_type"] for r in rows}) == 1}


def source_catalog(spark: SparkSession, source: SourceSpec) -> DataFrame | None:
    """The catalog's rows of a table that is read over JDBC, asked beside the data."""
    options = dict(source.options)
    if not options.get("url") or not options.get("table") or options.get("query") or options.get("template"):
        return None
    keys = ("url", "user", "password", "driver", "extra")
    asked = RelationalSource(query=catalog_columns_sql(options["table"]), partitions=1, **{k: options[k] for k in keys if k in options})
    return columns_from_catalog(read_relational(spark, asked))


def register_detector(kind: str, detector: Detector) -> None:
    """UDF-3: a schema detector for the sources of a kind."""
    DETECTORS[kind] = detector


def detect_schema(primary: DataFrame, job: SyncJob) -> DataFrame:
    """SCH-1..SCH-9: from what the sources declare, measured, or by the first source's own
    detector. ``primary`` holds the rows of all sources. ``catalog_columns`` adds what a database
    says of its own."""
    if detector := DETECTORS.get(job.sources[0].kind):
        kind = KINDS.get(job.sources[0].kind, schemas.RELATIONAL)
        return schemas.map_schema(detector(primary), kind, job.sync.mapping)
    kind = KINDS.get(job.sources[0].kind, schemas.RELATIONAL)
    if not job.sync.measure_schema:
        found = schemas.declared_schema(primary, kind)
    elif kind == schemas.WAREHOUSE:
        found = schemas.warehouse_schema(primary)
    elif kind == schemas.DOCUMENT:
        document = F.to_variant_object(F.struct("*")).alias("document")
        found = schemas.document_schema(primary.select(document), "document")
    else:
        found = schemas.relational_schema(primary)
    return schemas.map_schema(found, kind, job.sync.mapping)
