"""Time the headline syncs and operators; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query runs
once to warm up and once for the clock, and its whole result is consumed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tidemark import checks
from tidemark.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Query, and the table whose rows it has to read.
HEADLINE = {
    "pip_1_full_refresh": "orders",
    "pip_2_incremental_sync": "orders",
    "pip_5_document_sync": "orders",
    "pip_7_multi_source_union": "customer",
    "pip_8_table_replication": "lineitem",
    "inc_3_incremental_window": "orders",
    "snk_3_clustering": "events",
    "sch_1_relational_schema": "events",
    "sch_3_document_schema": "orders",
    "val_4_repeated": "events",
    "val_5_json_column": "events",
    "val_9_sanitise": "documents",
    "val_11_drop_invalid": "documents",
    "trf_16_sequential_fields": "lineitem",
    "trf_17_all_records": "part",
    "set_1_union_sources": "customer",
    "flt_7_and_or": "orders",
    "flt_7_and_or_on_variant": "orders",
    "win_3_latest_per_key": "events",
    "win_4_duplicates": "lineitem",
    "joi_3_across_sources": "lineitem",
    "mon_1_freshness": "events",
}


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    checks.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    checks.load()
    spark = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rates = {}, {}
    for name, source in HEADLINE.items():
        run(spark, name)
        seconds[name] = round(run(spark, name), 3)
        rows = checks.table(spark, SF_DIR, source).count()
        rates[name] = round(rows / seconds[name])
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
