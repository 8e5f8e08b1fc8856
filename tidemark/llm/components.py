"""Connected components of an edge table, by Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep


def _towards_least(edges: DataFrame, large: bool) -> DataFrame:
    """One half round: every node sends its larger (or its smaller) neighbours to the least one it knows."""
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = edges.join(least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node that has an edge (a, b); a component is named by its least id.

    Alternates large and small stars until nothing changes, in about log(longest path)
    rounds. Minima are combined before each shuffle, and every round is written to the shared
    folder, so lineage stays short.
    """
    now = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = None
    while True:
        # Larger node first: (a, b) with a > b, so small stars gather at a.
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        state = seen
        now = keep(_towards_least(_towards_least(now, large=True), large=False))
