"""SNK-1..SNK-10: create, partition, cluster and write destination tables.

Tables are Parquet tables of the catalog. A table partitioned by day carries a
derived column ``<field>_day``; a filter on it prunes partitions.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import SinkSpec
from tidemark.functions.calculated import quote, quoted_table
from tidemark.operators.nested import grown_type, lacking, rebuilt
from tidemark.session import shared_dir

_SETTINGS = threading.Lock()
FILE_ROWS = "spark.sql.files.maxRecordsPerFile"
WRITES = ("append", "truncate", "empty")
CLUSTERED = ("files", "table")
PLACE = "_place"
TASK_BYTES, TASKS_PER_CORE = 4 << 20, 4  # stored bytes that a task writes when files are smaller, and tasks at least
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


class TableNotEmpty(RuntimeError):
    """Write-if-empty found rows."""


def day_column(field: str) -> str:
    return f"{field}_day"


def partition_day(schema: T.StructType, field: str | None) -> str | None:
    """SNK-2: the day column, or None when the field is absent or is no time."""
    if field and field in schema.fieldNames() and isinstance(schema[field].dataType, TIMES):
        return day_column(field)
    return None


def with_day(df: DataFrame, field: str) -> DataFrame:
    return df.withColumn(day_column(field), F.to_date(F.col(quote(field))))


def layout(df: DataFrame, day: str | None, clustering: Sequence[str] = ()) -> DataFrame:
    """SNK-2, SNK-3: rows of a day together, sorted by the clustering fields in each file.

    The rebalance hint sends a day to one task and lets AQE split a day that is
    larger than a partition should be, even when all its rows are alike, because
    it splits by map output. Unlike a range partitioning it does not evaluate the
    rows twice to sample them. Sorted files give Parquet tight row-group statistics.
    """
    missing = [c for c in clustering if c not in df.columns]
    if missing:
        raise ValueError(f"clustering fields not in the data: {missing}")
    keys = [F.col(quote(c)) for c in ([day] if day else []) + list(clustering)]
    if day:
        df = df.hint("rebalance", F.col(quote(day)))
    return df.sortWithinPartitions(*keys) if keys else df


def clustered(df: DataFrame, day: str | None, clustering: Sequence[str], file_bytes: int) -> tuple[DataFrame, int]:
    """SNK-3 across files: each file holds a range of (day, clustering fields) apart from the others'.

    Rows are evaluated once, into the shared folder; the ranges' bounds come from a sample of what
    was stored. A value too heavy for a file is split by the next field, and equal rows by their
    place, so that no file grows with the heaviest value: neighbours share at most one value.
    A task sorts a range and writes it as one file, or, where files are small, as a run of files of
    ``rows_per_file`` rows each: tasks grow with the bytes, not with the number of files.
    """
    keys = [c for c in ([day] if day else []) + list(clustering) if c]
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    files = stored.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count("*").alias("n"))
    total, rows = (n or 0 for n in files.agg(F.sum("file_size"), F.sum("n")).first())
    wanted = max(1, -(-total // file_bytes))
    tasks = min(wanted, max(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES)))
    placed = stored.withColumn(PLACE, F.monotonically_increasing_id())
    ranges = placed.repartitionByRange(tasks, *(F.col(quote(c)) for c in keys), F.col(PLACE))
    rows_per_file = -(-rows // wanted) if tasks < wanted else 0
    return ranges.sortWithinPartitions(*(F.col(quote(c)) for c in keys)).drop(PLACE), rows_per_file


def create_table(spark: SparkSession, spec: SinkSpec, schema: T.StructType) -> bool:
    """SNK-1, SNK-4: create the table from a schema; False when it was there already."""
    if spec.create == "never" and spec.delete_existing:
        raise ValueError("a table that is never created can't be created anew")
    if spec.delete_existing:
        drop_table(spark, spec.table)
    if spark.catalog.tableExists(spec.table):
        return False
    empty = spark.createDataFrame([], schema)
    day = partition_day(schema, spec.partition_field)
    if day:
        empty = with_day(empty, spec.partition_field)
    writer = empty.write.format("parquet").mode("ignore")
    if day:
        writer = writer.partitionBy(day)
    if spec.path:
        writer = writer.option("path", spec.path)
    writer.saveAsTable(spec.table)
    return True


def drop_table(spark: SparkSession, table: str) -> None:
    """Rows included: those of a table with its own path would outlive the entry."""
    if spark.catalog.tableExists(table):
        _replace_all(spark.createDataFrame([], spark.table(table).schema), table)
        spark.sql(f"DROP TABLE {quoted_table(table)}")


def grow_table(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """SNK-10: the table grows to hold the data; old rows read null in what is new. Returns the new paths.

    New columns are added to the catalog's entry. New nested fields and wider numbers need a new
    entry: over the same files where Parquet reads the old ones as the new type (and nothing but a
    comment is noted of the columns), else over rewritten rows. Either takes the old one's place as ``swap_in`` does it.
    """
    old = spark.table(table).schema
    grown = grown_type(old, schema)
    if grown == old:
        return []
    new = lacking(old, schema)
    plain = T.StructType(grown.fields[len(old):])
    if T.StructType(grown.fields[: len(old)]) == old:
        # The day columns come last, so new columns are listed by name, not by place.
        spark.sql(f"ALTER TABLE {quoted_table(table)} ADD COLUMNS ({plain.toDDL()})")
        return new
    details = _details(spark, table)
    days = details["partitions"]
    beside = staged(table)
    retire(spark, beside, table)
    noted = any(set(f.metadata) - {"comment"} for f in grown)  # SQL can't carry over what is noted of columns
    if details["external"] and readable_as(old, grown) and not noted:
        columns = [f for f in grown if f.name not in days] + [grown[d] for d in days]
        ddl = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in columns]).toDDL()
        parts = f" PARTITIONED BY ({', '.join(quote(d) for d in days)})" if days else ""
        spark.sql(f"CREATE TABLE {quoted_table(beside)} ({ddl}) USING parquet{parts} LOCATION '{details['location']}'")
        if days:
            spark.catalog.recoverPartitions(beside)
    else:
        writer = align(spark.table(table), grown).write.format("parquet")
        if days:
            writer = writer.partitionBy(*days)
        if details["external"]:
            writer = writer.option("path", f"{details['location'].rstrip('/')}_{uuid.uuid4().hex[:8]}")
        writer.saveAsTable(beside)
    swap_in(spark, beside, table)
    return new


def readable_as(old: T.DataType, new: T.DataType) -> bool:
    """Whether Parquet files of type ``old`` are read as ``new``: fields by name, some numbers wider."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {f.name: f.dataType for f in old}
        return all(readable_as(known[f.name], f.dataType) for f in new if f.name in known)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return readable_as(old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return readable_as(old.keyType, new.keyType) and readable_as(old.valueType, new.valueType)
    small = (T.ByteType, T.ShortType, T.IntegerType)
    if isinstance(old, small):
        return isinstance(new, (*small, T.LongType, T.DoubleType))
    return old == new or (isinstance(old, T.FloatType) and isinstance(new, T.DoubleType))


def _details(spark: SparkSession, table: str) -> dict:
    """Location, partition columns and whether the table has a path of its own."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(table)}").collect()
    at = next(i for i, r in enumerate(rows) if r["col_name"] == "# Detailed Table Information")
    found = {r["col_name"]: r["data_type"] for r in rows[at:]}
    days = [c.name for c in spark.catalog.listColumns(quoted_table(table)) if c.isPartition]
    return {"location": found["Location"], "external": found["Type"] == "EXTERNAL", "partitions": days}


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the table's order and types, nested fields by name; what the data lacks is null."""
    types = {f.name: f.dataType for f in df.schema}
    return df.select(
        *(
            (rebuilt(F.col(quote(f.name)), types[f.name], f.dataType) if f.name in types
             else F.lit(None).cast(f.dataType)).alias(f.name, metadata=f.metadata)
            for f in schema
        )
    )


def write_table(df: DataFrame, spec: SinkSpec) -> None:
    """SNK-5..SNK-9: write by disposition. Truncate replaces all rows, keeps the table."""
    if spec.write not in WRITES:
        raise ValueError(f"write is one of {WRITES}")
    spark = df.sparkSession
    recover(spark, spec.table)
    if spec.create == "never" and not spark.catalog.tableExists(spec.table):
        raise LookupError(f"table {spec.table} does not exist")
    create_table(spark, spec, df.schema)
    if spec.write == "empty" and not spark.table(spec.table).isEmpty():
        raise TableNotEmpty(spec.table)
    if spec.add_columns:
        grow_table(spark, spec.table, df.schema)
    elif missing := lacking(spark.table(spec.table).schema, df.schema):
        raise ValueError(f"{spec.table} lacks fields of the data: {sorted(missing)}")
    target = spark.table(spec.table).schema
    day = day_column(spec.partition_field) if spec.partition_field else None
    if day not in target.fieldNames():
        day = None
    elif spec.partition_field in df.columns:
        df = with_day(df, spec.partition_field)
    if spec.cluster not in CLUSTERED:
        raise ValueError(f"cluster is one of {CLUSTERED}")
    missing = [c for c in spec.clustering_fields if c not in df.columns]
    rows_per_file = 0
    if spec.cluster == "table" and spec.clustering_fields and not missing:
        laid_out, rows_per_file = clustered(align(df, target), day, spec.clustering_fields, spec.file_bytes)
    else:
        laid_out = layout(align(df, target), day, spec.clustering_fields)
    if spec.write == "truncate":
        _replace_all(laid_out, spec.table, rows_per_file)
    elif rows_per_file:
        _insert(laid_out, spec.table, {FILE_ROWS: rows_per_file})
    else:
        laid_out.write.insertInto(spec.table)


def _replace_all(df: DataFrame, table: str, rows_per_file: int = 0) -> None:
    """Overwrite every partition, also in a session that overwrites only touched ones."""
    files = {FILE_ROWS: rows_per_file} if rows_per_file else {}
    _insert(df, table, {"spark.sql.sources.partitionOverwriteMode": "static"} | files, overwrite=True)


def _insert(df: DataFrame, table: str, settings: Mapping[str, str | int], overwrite: bool = False) -> None:
    """Insert under these settings.

    Inserting into a table of the catalog takes them from the session alone (a writer
    option has no effect there), so a session runs one such write at a time.
    """
    conf = df.sparkSession.conf
    with _SETTINGS:
        before = {key: conf.get(key) for key in settings}
        for key, value in settings.items():
            conf.set(key, value)
        try:
            df.write.insertInto(table, overwrite=overwrite)
        finally:
            for key, value in before.items():
                conf.set(key, value)


def staged(table: str) -> str:
    """The name of what is being written to take the table's place."""
    return f"{table}__staged"


def ready(table: str) -> str:
    """The name of what is written and may take the table's place."""
    return f"{table}__ready"


def retired(table: str) -> str:
    """The name of what the table was."""
    return f"{table}__retired"


def replacement(spec: SinkSpec) -> SinkSpec:
    """SNK-4: a new table beside the old one, to be swapped in when it is written."""
    path = f"{spec.path.rstrip('/')}_{uuid.uuid4().hex[:8]}" if spec.path else None
    return replace(spec, table=staged(spec.table), path=path, delete_existing=False)


def swap_in(spark: SparkSession, new: str, table: str) -> None:
    """SNK-4: the written table ``new`` takes the place of ``table``; old rows go last.

    Three renames, each of which leaves one table that holds all rows of one of the two; the
    first one says that the new table is whole. ``recover`` finishes a swap that was broken off
    after it, and undoes what was broken off before. Readers find no table between the second
    and the third rename.
    """
    _rename(spark, new, ready(table))
    recover(spark, table)


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo a replacement of ``table`` that was broken off; nothing happens if none was.

    A run of the same table that is still going on must not be interfered with: one run a table.
    """
    there = spark.catalog.tableExists
    if there(ready(table)):
        if there(table):
            retire(spark, retired(table), table)
            _rename(spark, table, retired(table))
        _rename(spark, ready(table), table)
    elif there(retired(table)) and not there(table):
        _rename(spark, retired(table), table)
    for name in (staged(table), retired(table)):
        retire(spark, name, table)


def retire(spark: SparkSession, name: str, successor: str | None = None) -> None:
    """Drop a table with its rows, or its entry alone where ``successor`` has the same files."""
    if not spark.catalog.tableExists(name):
        return
    shared = successor and spark.catalog.tableExists(successor) and _details(spark, successor)["location"] == _details(spark, name)["location"]
    if shared:
        spark.sql(f"DROP TABLE {quoted_table(name)}")
    else:
        drop_table(spark, name)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {quoted_table(old)} RENAME TO {quoted_table(new)}")
    details = _details(spark, new)
    if details["partitions"] and not details["external"]:  # their folders have moved with the table
        spark.sql(f"MSCK REPAIR TABLE {quoted_table(new)} SYNC PARTITIONS")


def write_batch(df: DataFrame, path: str, batch: str, batch_column: str = "sync_batch") -> None:
    """An append that can be repeated: a batch owns its partition and replaces it.

    A retried or re-run batch overwrites what it wrote before instead of doubling
    it; other batches are untouched.
    """
    (
        df.withColumn(batch_column, F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(batch_column)
        .parquet(path)
    )
