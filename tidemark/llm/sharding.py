"""Balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Labels start evenly by hash. Nodes move to the label most of their neighbours have (on a tie
they stay, else the least label wins). In even rounds those with a lesser neighbour may move,
so that a star settles at once; in odd rounds half of all nodes, drawn anew, may. For each
pair of shards as many move as come back, and more only while the linked nodes of the target
are fewer than an equal share. Nodes without links fill up what remains: at the end shards
that are too full give rows away, unlinked ones first, so that row counts are at most one
apart. The state is a table that every round rewrites in the shared folder.

Documents of equal text are linked in stars of bounded size, and the stars of a group to one of
them. A group too large for a shard is salted into chunks, each with stars of its own. The number
of rounds is a parameter. A null text has no bytes, a very long one is hashed whole. Rows that repeat,
and rows without an id, are documents of their own and get a slot each. An empty table gives an empty
result; only ``doc_id`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import join_hot, keep, whole_text

SHARDS = 16
ROUNDS = 6
CHUNK_SHARE = 2  # a group is salted into chunks of at most one of so many parts of a shard
STAR = 1024  # rows of a group of equal texts that are linked to the same one of them
BUCKET_ROWS = 20_000  # rows of a shard that are numbered together


def equal_text_links(rows: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """(a, b): each row of a group of equal texts and the least row of its star, and the stars of a
    chunk among each other. ``rows``: row, digest. No row has many more than ``STAR`` links of the first kind."""
    groups = keep(rows.groupBy("digest").agg(F.count("*").alias("size")).filter("size > 1"))
    room = F.greatest(F.lit(2), F.ceil(F.lit(total / shards / CHUNK_SHARE)))
    chunks = F.ceil(F.col("size") / room)
    stars = F.ceil(F.col("size") / chunks / F.lit(STAR)).cast("long")
    member = join_hot(rows, groups, "digest", "size", total).filter("size IS NOT NULL").select(
        "row", "digest", F.pmod(F.xxhash64("row", F.lit(1)), chunks.cast("long")).alias("chunk"),
        F.pmod(F.xxhash64("row", F.lit(3)), stars).alias("star"),
    )
    member = keep(member)
    hubs = member.groupBy("digest", "chunk", "star").agg(F.min("row").alias("b"))
    own = member.join(hubs, ["digest", "chunk", "star"]).select(F.col("row").alias("a"), "b")
    first = hubs.groupBy("digest", "chunk").agg(F.min("b").alias("first"))
    between = hubs.join(first, ["digest", "chunk"]).select(F.col("b").alias("a"), F.col("first").alias("b"))
    return own.unionByName(between).filter("a <> b")


def by_hash(rows: DataFrame, shards: int) -> DataFrame:
    return rows.select("row", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("label"))


def propagate(links: DataFrame, room: float, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(row, label) of the linked nodes. ``links``: a, b, in one direction; ``room``: nodes that a shard takes."""
    both = keep(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = keep(by_hash(both.select(F.col("a").alias("row")).distinct(), shards))
    for turn in range(rounds):
        # Counts are combined before the shuffle, so a node with many neighbours gets a few rows.
        votes = both.join(labels.select(F.col("row").alias("b"), F.col("label").alias("to")), "b").groupBy("a", "to").agg(
            F.count("*").alias("count"), F.min("b").alias("least")
        )
        ranked = votes.join(labels.withColumnRenamed("row", "a"), "a").groupBy("a", F.col("label").alias("from")).agg(
            F.max(F.struct("count", (F.col("to") == F.col("label")).alias("stays"), (-F.col("to")).alias("order"))).alias("best"),
            F.min("least").alias("least"),
        )
        may = F.pmod(F.xxhash64("a", F.lit(-1 - turn)), F.lit(2)) == 0 if turn % 2 else F.col("least") < F.col("a")
        wish = keep(
            ranked.filter(~F.col("best.stays") & may)
            .select("a", "from", (-F.col("best.order")).cast("int").alias("to"))
        )
        # At most shards * shards rows from here to the broadcast.
        flow = wish.groupBy("from", "to").agg(F.count("*").alias("n"))
        back = flow.select(F.col("from").alias("to"), F.col("to").alias("from"), F.col("n").alias("back"))
        size = labels.groupBy(F.col("label").alias("to")).agg(F.count("*").alias("size"))
        pair = flow.join(back, ["from", "to"], "left").join(size, "to", "left")
        matched = F.least("n", F.coalesce("back", F.lit(0)))
        extra = F.sum(F.col("n") - matched).over(Window.partitionBy("to"))
        free = F.greatest(F.lit(room) - F.coalesce("size", F.lit(0)), F.lit(0.0))
        share = F.when(extra > 0, F.least(F.lit(1.0), free / extra)).otherwise(0.0)
        quota = pair.select("from", "to", ((matched + (F.col("n") - matched) * share) / F.col("n")).alias("quota"))
        chance = F.pmod(F.xxhash64("a", F.lit(turn)), F.lit(1 << 30)) / F.lit(1 << 30)
        moved = wish.join(F.broadcast(quota), ["from", "to"]).filter(chance < F.col("quota")).select(F.col("a").alias("row"), "to")
        labels = keep(labels.join(moved, "row", "left").select("row", F.coalesce("to", "label").alias("label")))
    return labels


def _by_shard(values: list[int], shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), shard + 1)


def even_rows(rows: DataFrame, labels: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """(row, shard, slot) of all ``rows``, which may have a label: counts at most one apart, slots gapless from 0."""
    buckets = max(4, -(-total // (shards * BUCKET_ROWS)))
    start = by_hash(rows, shards).withColumnRenamed("label", "start")
    graded = keep(
        start.join(labels, "row", "left").select(
            "row", F.coalesce("label", "start").alias("label"), F.col("label").isNull().cast("int").alias("grade"),
            F.pmod(F.xxhash64("row", F.lit(2)), F.lit(buckets)).alias("bucket"),
        )
    )
    cells = graded.groupBy("label", "grade", "bucket").agg(F.count("*").alias("cell"))
    before = Window.partitionBy("label").orderBy("grade", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("start", F.coalesce(F.sum("cell").over(before), F.lit(0))).drop("cell")
    within = Window.partitionBy("label", "grade", "bucket").orderBy("row")
    numbered = graded.join(starts, ["label", "grade", "bucket"]).select(
        "row", "label", (F.col("start") + F.row_number().over(within) - 1).alias("rank")
    )
    size = [0] * shards
    for label, count in graded.groupBy("label").count().collect():  # one row for each shard
        size[label] = count
    target = [total // shards + (s < total % shards) for s in range(shards)]
    surplus = [max(0, c - t) for c, t in zip(size, target, strict=True)]
    lack = [max(0, t - c) for c, t in zip(size, target, strict=True)]
    label, rank = F.col("label"), F.col("rank")
    stays = rank < _by_shard(target, label)
    # Surplus rows are numbered across shards; each lacking shard takes the next of them.
    spare = rank - _by_shard(target, label) + _by_shard([sum(surplus[:s]) for s in range(shards)], label)
    shard, slot = label, rank
    for s in range(shards):
        first = sum(lack[:s])
        takes = ~stays & (spare >= first) & (spare < first + lack[s])
        shard = F.when(takes, F.lit(s)).otherwise(shard)
        slot = F.when(takes, spare - first + size[s]).otherwise(slot)
    return numbered.select("row", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: no law for growing)."""
    text = whole_text()
    rows = keep(
        docs.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"),
        )
    )
    total = rows.count()
    links = keep(equal_text_links(rows.select("row", "digest"), total, shards))
    placed = even_rows(rows.select("row"), propagate(links, total / shards, shards, rounds), total, shards)
    return rows.join(placed, "row").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
