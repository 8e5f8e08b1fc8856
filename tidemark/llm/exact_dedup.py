"""Exact dedup: frequent digests are found by Misra-Gries and removed on the map side, the rest by a shuffle.

Texts are equal when identical after lower-casing A-Z; a null text is an empty one. The row
with the largest id of each group stays. Rows that repeat an id and its text count as copies
of one document: in ``decide`` all of them carry the same decision, ``drop_copies`` leaves
one. A null id is smaller than any other. A very long text is hashed whole, in the memory of its
task. An empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, keep, only_in, trimmed, unused, whole_text

COUNTERS = 1 << 15  # Misra-Gries counters of a task, and the most digests broadcast: under 4 MB


def digests(docs: DataFrame) -> DataFrame:
    """Id and SHA-256 of the normalised text of every row."""
    return docs.select("doc_id", F.sha2(ascii_lower(whole_text()), 256).alias("text_sha256"))


def misra_gries(counters: dict, batch: dict, size: int = COUNTERS) -> dict:
    """Merge a batch's counts into a summary of ``size`` counters.

    Where there are more, the largest that does not fit is taken off all, so a counter is short
    of the true count by at most the total weight over ``size`` + 1.
    """
    merged = dict(counters)
    for key, count in batch.items():
        merged[key] = merged.get(key, 0) + count
    if len(merged) <= size:
        return merged
    values = np.fromiter(merged.values(), np.int64, len(merged))
    cut = int(np.partition(values, len(values) - size - 1)[len(values) - size - 1])
    return {key: count - cut for key, count in merged.items() if count > cut}


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters: dict = {}
    for batch in batches:
        seen = batch.column(0).value_counts()
        counters = misra_gries(counters, dict(zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist(), strict=True)))
    # A digest met once in a task says nothing about a frequent one.
    found = {k: v for k, v in counters.items() if v > 1}
    yield pa.RecordBatch.from_pydict({"text_sha256": pa.array(list(found), pa.string()), "least": pa.array(list(found.values()), pa.int64())})


def heavy_winners(digests: DataFrame) -> DataFrame:
    """Exact winner and size of the groups that Misra-Gries finds; at most ``COUNTERS`` rows.

    A group with a larger share than 1/COUNTERS of some task is found; whatever is missed is
    small and goes the ordinary way, so the result never depends on the summary.
    """
    candidates = (
        digests.select("text_sha256").mapInArrow(trimmed(_summaries), "text_sha256 string, least long")
        .groupBy("text_sha256").agg(F.sum("least").alias("least"))
        .orderBy(F.desc("least"), "text_sha256").limit(COUNTERS)
    )
    return (
        digests.join(F.broadcast(candidates.select("text_sha256")), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )


def decide(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = keep(digests(docs))
    winners = keep(heavy_winners(rows))
    heavy = rows.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    light = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti").select(
        "text_sha256", "doc_id", F.max("doc_id").over(group).alias("keep_id"), F.count("*").over(group).alias("group_size")
    )
    both = heavy.unionByName(light)
    return both.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.

    Ids decide, so that texts are compared by digest and move only to meet the ids of dropped rows.
    """
    decisions = keep(decide(docs))
    # Ids that several rows share are the only ones whose texts must be looked at again.
    repeated = keep(decisions.groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    rest = only_in(docs, decisions.filter("NOT kept").select("doc_id").unionByName(repeated), "left_anti")
    sha, other_id, other_sha, place = (unused(docs, n) for n in ("__sha", "__id", "__kept_sha", "__n"))
    doubtful = only_in(docs, repeated, "left_semi").withColumn(sha, F.sha2(ascii_lower(whole_text()), 256))
    kept = decisions.filter("kept").select(F.col("doc_id").alias(other_id), F.col("text_sha256").alias(other_sha)).distinct()
    chosen = doubtful.join(kept, F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col(sha) == F.col(other_sha)), "left_semi")
    first = Window.partitionBy("doc_id", sha).orderBy("text")
    one = chosen.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1).drop(place, sha)
    return rest.unionByName(one)
