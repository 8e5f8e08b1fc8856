"""Compare a query's rows with those of its oracle SQL."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def value(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, (int, Decimal)):
        return float(v) if isinstance(v, Decimal) else v
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return repr(v)


def differences(df: DataFrame, connection, sql: str) -> str | None:
    """None when both sides hold the same columns and the same bag of rows."""
    names = sorted(df.columns)
    got = Counter(tuple(value(row[n]) for n in names) for row in df.collect())
    cursor = connection.execute(sql)
    wanted_names = [d[0] for d in cursor.description]
    if sorted(wanted_names) != names:
        return f"columns {names} against {sorted(wanted_names)}"
    order = [wanted_names.index(n) for n in names]
    wanted = Counter(tuple(value(row[i]) for i in order) for row in cursor.fetchall())
    if got == wanted:
        return None
    extra, lacking = got - wanted, wanted - got
    return (
        f"{sum(got.values())} rows against {sum(wanted.values())}; columns {names}; "
        f"only ours {list(extra)[:2]}; only theirs {list(lacking)[:2]}"
    )
