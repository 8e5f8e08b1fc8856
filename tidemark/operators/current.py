"""INC-9, WIN-3: a kept table of current versions, of which a run rewrites only what its rows touch.

Rows lie in folders by a hash of their key. A run takes the newest version of each of its keys,
reads the buckets these fall into and rewrites those in which some version is newer than the stored
one. Work grows with the run and with the share of buckets it touches, not with the history; with as
many buckets as fit the table (some hundred MB each) a small run touches few.

Merged buckets are written beside the table first and noted as pending, so that a run that breaks
off while it replaces them is finished by the next one. One run a table at a time. Of versions with
equal timestamp and tie-break the stored one stays. A null key is a key like others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calculated import quote
from tidemark.operators.monitor import latest_per_key
from tidemark.operators.nested import lacking
from tidemark.operators.write import align
from tidemark.session import shared_dir

BUCKET, STORED = "_bucket", "_stored"


@dataclass(frozen=True)
class CurrentVersions:
    """A table of the newest row of each key, at ``path``. The number of buckets stays with the table."""

    path: str
    keys: Sequence[str]
    timestamp: str
    tie_break: Sequence[str] = ()
    buckets: int = 256

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The current versions; None before the first run."""
        stored = _read(spark, self.path)
        return None if stored is None else stored.drop(BUCKET)

    def merge(self, rows: DataFrame) -> list[int]:
        """Bring in new rows, old ones among them included; returns the buckets that were rewritten."""
        spark = rows.sparkSession
        self._finish(spark)
        stored = _read(spark, self.path)
        schema = rows.schema if stored is None else stored.drop(BUCKET).schema
        if more := lacking(schema, rows.schema):
            raise ValueError(f"{self.path} lacks fields of the rows: {more}")
        bucket = F.pmod(F.xxhash64(*(F.col(quote(k)) for k in self.keys)), F.lit(self.buckets)).cast("int")
        new = latest_per_key(align(rows, schema), self.keys, self.timestamp, self.tie_break)
        new = _kept(new.withColumn(BUCKET, bucket).withColumn(STORED, F.lit(0)))
        merged = new
        if stored is not None:
            # At most ``buckets`` numbers reach the driver; as literals they prune the folders that are read.
            touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
            old = stored.filter(F.col(BUCKET).isin(touched)).withColumn(STORED, F.lit(1))
            merged = _kept(latest_per_key(new.unionByName(old), self.keys, self.timestamp, [*self.tie_break, STORED]))
        changed = sorted(r[0] for r in merged.filter(F.col(STORED) == 0).select(BUCKET).distinct().collect())
        if changed:
            (folder,) = {f.rsplit("/", 1)[0] for f in merged.inputFiles()}
            self._note(spark, folder, changed)
            self._finish(spark)
        return changed

    def _note(self, spark: SparkSession, folder: str | None, changed: list[int]) -> None:
        pending = spark.createDataFrame([(folder, changed)] if folder else [], "folder STRING, buckets ARRAY<INT>")
        pending.coalesce(1).write.mode("overwrite").parquet(f"{self.path.rstrip('/')}__pending")

    def _finish(self, spark: SparkSession) -> None:
        """Replace the pending buckets by their merged rows, as often as it takes."""
        try:
            pending = spark.read.schema("folder STRING, buckets ARRAY<INT>").parquet(f"{self.path.rstrip('/')}__pending").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        if pending is None:
            return
        merged = spark.read.parquet(pending["folder"]).filter(F.col(BUCKET).isin(pending["buckets"])).drop(STORED)
        writer = merged.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(self.path)
        self._note(spark, None, [])


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _kept(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
