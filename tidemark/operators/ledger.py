"""A small table of runs, from which the next run takes its high-water mark without a scan.

A run writes a row when it begins and another one when its data are written, with the mark they
reach. Rows are Parquet files of a folder, one folder a destination table; a run reads them all,
so the work grows with the number of runs and not with the data. The mark is believed only if

* the newest run has ended (one that broke off may have written data and no mark),
* the table's newest day, which the catalog or the folder names tell, is not after the mark's.

Otherwise the caller scans the table as if there were no ledger. One run a table at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import Window, newest_day

SCHEMA = (
    "table_name STRING, run STRING, event STRING, at TIMESTAMP_NTZ, window_start TIMESTAMP_NTZ, "
    "window_end TIMESTAMP_NTZ, mark TIMESTAMP_NTZ, rows BIGINT"
)
BEGUN, ENDED = "begun", "ended"


@dataclass(frozen=True)
class Ledger:
    """Runs of all tables, below ``path``."""

    path: str

    def _folder(self, table: str) -> str:
        return f"{self.path.rstrip('/')}/{table.replace('`', '')}"

    def note(
        self, spark: SparkSession, table: str, run: str, event: str, at: datetime, window: Window | None = None,
        mark: datetime | None = None, rows: int | None = None,
    ) -> None:
        """One row; ``run`` names the run, so that a repeated one replaces nothing and adds its own rows."""
        row = (table, run, event, at, window and window.start, window and window.end, mark, rows)
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self._folder(table))

    def runs(self, spark: SparkSession, table: str) -> DataFrame:
        """All rows of a table; none if no run was noted."""
        try:
            return spark.read.schema(SCHEMA).parquet(self._folder(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], SCHEMA)

    def mark(self, spark: SparkSession, table: str, day_column: str | None = None) -> datetime | None:
        """The table's mark, or None when it has to be looked for in the data."""
        if not spark.catalog.tableExists(table):
            return None
        # Runs are few, and one row is collected. A run that broke off counts until the next one has ended.
        runs = self.runs(spark, table).groupBy("run").agg(F.max("at").alias("at"), F.max(F.col("event") == ENDED).alias("ended"), F.max("mark").alias("mark"))
        state = runs.agg(F.max_by(F.struct("ended", "mark"), "at").alias("last")).first()["last"]
        if not state or not state["ended"] or state["mark"] is None:
            return None
        if day_column and day_column in spark.table(table).columns:
            after = spark.range(1).select((newest_day(spark, table, day_column) > F.lit(state["mark"].date())).alias("after"))
            if after.first()["after"]:
                return None
        return state["mark"]
