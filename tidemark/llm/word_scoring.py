"""Language-model scores by stupid backoff over word n-grams of orders 1 to 3.

Words are runs of other bytes than ASCII white space, as they are written; a text is preceded
by start marks and followed by an end mark. Texts are dealt to two folds by a hash of the text,
so that copies share one, and a text is scored by the counts of the other fold: no text vouches
for itself. Counts are taken over all documents and all n-grams, so they grow with the corpus.

S(w | context) = count(context w) / count(context), if the n-gram occurs, else 0.4 * S(w |
shorter context); an unknown word counts as one of N + 1, N being the words and end marks of
the fold. N-grams are 64-bit hashes, so two of them share counts with a chance of n / 2**64.

1. Documents are stored by blocks of bounded size, as compressed chunks of rows. A block lists its distinct
   n-grams, with how often the texts of either fold hold each. They move as rows of those that share
   their first bits, so that one takes some 9 bytes and not 12.
2. These rows are partitioned by the first bits, once, and exploded to (block, gram, n0, n1). Spark adds them
   up to a table (gram, n0, n1), which is joined to the exploded rows where they lie. An n-gram that one
   fold alone holds can't help to score the other, so it is left out. What is found goes back to its
   block by place in its list.
3. This is done for words and pairs, then for each longer order. An n-gram is in both folds only if its
   first and its last n - 1 words are, so a longer one is asked for only where both of these were found;
   the others are known to be left out. No n-gram that counts is lost.
4. Logarithms are summed per document. Rows moved are linear in the input: no n-gram is asked for more
   often than there are blocks that hold it. What a pass has shuffled is deleted when it is stored.

A null text is an empty one and has the end mark alone. Repeated rows get the same score
each; a null id is kept as it is. An empty table gives an empty result. Memory: the texts and n-grams
of a block, or of one longer text; a million answers; in the join, the n-grams of a partition that both
folds hold, so there must be as many partitions as the input needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import IS_SPACE, byte_slices, give_back, keep, mix, range_hashes, runs, whole_text

BACKOFF = 0.4
ORDER = 3
BLOCK_BYTES = 16 << 20  # of text that asks for its n-grams together
CHUNK_BYTES = 1 << 20  # of text that is compressed together
PACKED_ROWS = 1 << 20  # answers that are sorted by block together
RANGE_BITS = 3  # n-grams of a block are sorted in so many ranges, as a power of two
BATCH = 1 << 13  # rows of n-grams that leave a task together
SHARED = 32  # words for each row of n-grams that share their first bits
PASS_SETTINGS = {
    # What a pass has shuffled is deleted when it is stored: nothing else reads it.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Rows that share first bits lie together, so a join by these and the n-gram needs no other exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def word_grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each order, the n-grams that end at each word and at the end mark; and how many each text has."""
    starts, ends, first = runs(~IS_SPACE[data], offsets)
    sizes, gap = np.diff(first) + 1, order - 1
    # Each text moves right by the marks of those before it: ``gap`` start marks and an end mark each.
    room = np.full(len(starts) + (order * len(sizes)), _START)
    place = np.arange(len(starts)) + np.repeat(np.arange(len(sizes)) * order + gap, sizes - 1)
    room[place] = range_hashes(data, starts, ends)
    after = np.cumsum(sizes + gap)
    room[after - 1] = _END
    own = np.ones(len(room), bool)
    for k in range(gap):
        own[after - sizes - 1 - k] = False
    at = np.flatnonzero(own)
    found = []
    for n in range(1, order + 1):
        gram = np.full(len(at), n, np.uint64)
        for k in range(n - 1, -1, -1):
            gram = mix(gram * _MULTIPLIER + room[at - k])
        found.append(gram)
    return found, sizes


def _chunk(block: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    """One row for some texts of a block: how many n-grams of an order and texts either fold has, and id, fold and text compressed."""
    folds = rows.column(1).to_numpy()
    sizes = np.concatenate([np.diff(runs(~IS_SPACE[data], offsets)[2]) + 1 for data, offsets in byte_slices(rows.column(2))])
    sink = pa.BufferOutputStream()
    some = rows.select([0, 1, 2])
    with pa.ipc.new_stream(sink, some.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as writer:
        writer.write_batch(some)
    numbers = [block, *(int(sizes[folds == k].sum()) for k in (0, 1)), *(int((folds == k).sum()) for k in (0, 1))]
    columns = [*(pa.array([n], pa.int64()) for n in numbers), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "n0", "n1", "texts0", "texts1", "chunk"])


def _blocks(limit: int):
    """Number rows by block, which ends when it holds enough text, and compress them in chunks."""

    def run(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in texts:
            begin, size = 0, 0
            for i, n in enumerate(batch.column(3).to_pylist()):
                full = held and held + n > limit
                if i > begin and (full or size + n > CHUNK_BYTES):
                    yield _chunk(block, batch.slice(begin, i - begin))
                    begin, size = i, 0
                if full:
                    block, held = block + 1, 0
                held, size = held + n, size + n
            if begin < batch.num_rows:
                yield _chunk(block, batch.slice(begin))

    return run


def _listed(grams: np.ndarray, folds: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """The list of a block: its distinct n-grams by their first bits, these, n0 and n1; and where each given one is in it."""
    places, lists, begin = np.empty(len(grams), np.int32), [], 0
    first = (grams >> np.uint64(64 - RANGE_BITS)).astype(np.uint8)
    for k in range(1 << RANGE_BITS):  # some at a time, for memory
        own = np.flatnonzero(first == k)
        found, at = np.unique(grams[own], return_inverse=True)
        n1 = np.bincount(at[folds[own] == 1], minlength=len(found))
        n0 = np.bincount(at, minlength=len(found)) - n1
        part = (found >> np.uint64(64 - bits)).astype(np.int32)
        # Equal counts side by side are stored in little room.
        order = np.argsort(part * 3 + np.where(n0 + n1 == 1, n1, 2), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(begin, begin + len(order))
        places[own] = place[at]
        lists.append((found[order], part[order], n0[order].astype(np.int32), n1[order].astype(np.int32)))
        begin += len(order)
    return *map(np.concatenate, zip(*lists)), places


def _read(chunks: pa.ChunkedArray, order: int) -> tuple[pa.Table, np.ndarray, list[np.ndarray], np.ndarray]:
    """Texts of a block: id and fold; of their n-grams, the fold, those of each order, and how many each text has."""
    give_back()
    rows, found, sizes = [], [[] for _ in range(order)], []
    for chunk in chunks:
        rows.append(pa.ipc.open_stream(chunk.as_buffer()).read_all())
        for data, offsets in byte_slices(rows[-1]["text"]):
            grams, n = word_grams(data, offsets, order)
            for k, gram in enumerate(grams):
                found[k].append(gram)
            sizes.append(n)
        rows[-1] = rows[-1].drop_columns("text")
    table, n = pa.concat_tables(rows), np.concatenate(sizes)
    return table, np.repeat(table["fold"].to_numpy().astype(np.int8), n), [np.concatenate(found.pop(0)) for _ in range(order)], n


def _passes(order: int) -> list[list[int]]:
    """The orders that each pass asks for."""
    return [list(range(1, min(order, 2) + 1)), *([k] for k in range(3, order + 1))]


def _counts(grams: list[np.ndarray], folds: np.ndarray, sizes: np.ndarray, answers: pa.Table | None, step: int, order: int, bits: int):
    """After some passes: what the other fold counts of each n-gram, by order; and the list that the next pass asks for. Empties ``grams``."""
    counts, first = [], np.cumsum(sizes) - sizes
    for k, orders in enumerate(_passes(order)):
        asks = np.ones(len(folds), bool)
        if k:
            asks = counts[-1] > 0
            before = np.append(True, asks[:-1])
            before[first] = True  # start marks alone
            asks &= before
        asked = np.concatenate([grams.pop(0)[asks] for _ in orders])
        found, part, n0, n1, place = _listed(asked, np.tile(folds[asks], len(orders)), bits)
        if k == step:
            return counts, (found, part, n0, n1)
        del asked, found, n0, n1
        all0, all1 = _unpacked(answers.filter(pc.equal(answers["step"], k)), part)
        for own in np.split(place, len(orders)):
            counts.append(np.zeros(len(folds)))
            counts[-1][asks] = np.where(folds[asks] == 0, all1[own], all0[own])
    return counts, None


_ASKED = "part int, block long, top array<short>, mid array<short>, low array<int>, n0 array<int>, n1 array<int>"


def _asked(step: int, order: int, bits: int):
    """Texts of a block, and what was found before: what it asks for, a row for those that share their first bits."""

    def rows(block: int, texts: pa.Table, answers: pa.Table | None) -> pa.Table:
        _, folds, grams, sizes = _read(texts["chunk"], max(_passes(order)[step]))
        found, part, n0, n1 = _counts(grams, folds, sizes, answers, step, order, bits)[1]
        begin = np.flatnonzero(np.append(True, np.diff(part) > 0)) if len(part) else np.zeros(0, np.int64)
        offsets = pa.array(np.append(begin, len(part)), pa.int32())
        pieces = found.view("<u2").reshape(-1, 4).view(np.int16)
        lists = {"top": pieces[:, 3].copy(), "mid": pieces[:, 2].copy(), "low": found.astype(np.uint32).view(np.int32), "n0": n0.astype(np.int32), "n1": n1.astype(np.int32)}
        keys = {"part": part[begin].astype(np.int32), "block": np.full(len(begin), block, np.int64)}
        table = pa.table({**keys, **{name: pa.ListArray.from_arrays(offsets, pa.array(values)) for name, values in lists.items()}})
        return pa.concat_tables([table.slice(k, BATCH) for k in range(0, max(1, len(begin)), BATCH)])

    if step:
        return lambda key, texts, answers: rows(key[0].as_py(), texts, answers)
    return lambda key, texts: rows(key[0].as_py(), texts, None)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, part, pos, n0, n1), many to a row: sorted steps of the places and the counts, byte by byte, compressed."""

    def out(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        blocks, parts, pos, n0, n1 = (rows[name].to_numpy() for name in ("block", "part", "pos", "n0", "n1"))
        places = parts.astype(np.int64) << 32 | pos
        order = np.lexsort((places, blocks))
        values = np.stack([places[order], n0[order], n1[order]])
        edges = [0, *(np.flatnonzero(np.diff(blocks[order])) + 1).tolist(), len(order)]
        for begin, end in zip(edges, edges[1:]):
            some = values[:, begin:end].copy()
            some[0] = np.diff(some[0], prepend=0)
            flat = some.view(np.uint8).reshape(3, end - begin, 8).transpose(0, 2, 1).tobytes()
            columns = [pa.array([int(blocks[order[begin]])]), pa.array([end - begin]), pa.array([pa.compress(flat, "zstd", asbytes=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "n", "packed"])

    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= PACKED_ROWS:
            yield from out(held)
            held, n = [], 0
    if n:
        yield from out(held)


def _unpacked(answers: pa.Table, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What either fold counts of each n-gram of a list with these first bits; 0 where nothing was found."""
    all0, all1 = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    for n, packed in zip(answers["n"].to_pylist(), answers["packed"]):
        flat = np.frombuffer(pa.decompress(packed.as_buffer(), 24 * n, "zstd"), np.uint8)
        steps, n0, n1 = np.ascontiguousarray(flat.reshape(3, 8, n).transpose(0, 2, 1)).view(np.int64).reshape(3, n)
        places = np.cumsum(steps)
        at = np.searchsorted(part, places >> 32) + (places & 0xFFFFFFFF)
        all0[at], all1[at] = n0, n1
    return all0, all1


def _logs(n: list[np.ndarray], sizes: np.ndarray, all_grams: np.ndarray, all_texts: np.ndarray) -> np.ndarray:
    """The log score at each place, from the counts of its n-grams of every order."""
    first = np.cumsum(sizes) - sizes
    logs = np.log(1 / (all_grams + 1)) + np.log(BACKOFF)
    for k, count in enumerate(n):
        if k:
            context = np.empty(len(count))
            context[1:] = n[k - 1][:-1]
            context[first] = all_texts[first]  # start marks alone
            logs = logs + np.log(BACKOFF)
        else:
            context = all_grams
        seen = count > 0
        logs[seen] = np.log(count[seen] / context[seen])
    return logs


def _sums(order: int, bits: int, id_name: str, totals: list[tuple[int, int]]):
    """Texts of a block, and the counts that were found for its n-grams: the log score of each text."""

    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows, folds, grams, sizes = _read(texts["chunk"], order)
        n, _ = _counts(grams, folds, sizes, answers, len(_passes(order)), order, bits)
        others = np.array(totals, np.float64)[1 - folds]
        sums = np.add.reduceat(_logs(n, sizes, others[:, 0], others[:, 1]), np.cumsum(sizes) - sizes)
        return pa.table({id_name: rows["doc_id"], "fold": rows["fold"], "n_grams": pa.array(sizes, pa.int64()), "log_score": pa.array(sums)})

    return run


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def found_in_both(asked: DataFrame) -> DataFrame:
    """(block, part, pos, n0, n1): where n-grams that both folds hold are asked for, with the count of the fold that may score them, else 0."""
    near = asked.repartition("part")
    rows = near.select("part", "block", F.posexplode(F.arrays_zip("top", "mid", "low", "n0", "n1")).alias("pos", "a")).selectExpr(
        "part", "block", "pos", "a.n0", "a.n1", "shiftleft(CAST(a.top AS long), 48) | shiftleft(a.mid & 65535L, 32) | (a.low & 4294967295L) AS gram"
    )
    # ``blocks > 0`` always holds. Both sides of the join then need all columns, so that they share one exchange.
    counts = rows.groupBy("part", "gram").agg(F.sum("n0").alias("all0"), F.sum("n1").alias("all1"), F.count("block").alias("blocks"))
    shared = counts.filter("all0 > 0 AND all1 > 0 AND blocks > 0").drop("blocks")
    return rows.join(shared.hint("shuffle_hash"), ["part", "gram"]).selectExpr("block", "part", "pos", "IF(n1 > 0, all0, 0L) AS n0", "IF(n0 > 0, all1, 0L) AS n1")


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, fold, n_grams (words and end mark), log_score (sum of natural logs)."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    text = whole_text()
    rows = docs.select("doc_id", F.pmod(F.crc32(text), F.lit(2)).cast("int").alias("fold"), text.alias("text"), F.octet_length(text).cast("long").alias("size"))
    # Blocks must be the same when counted and when scored, so they are stored.
    blocks = keep(rows.mapInArrow(_blocks(BLOCK_BYTES), "block long, n0 long, n1 long, texts0 long, texts1 long, chunk binary"))
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("n0", "n1", "texts0", "texts1")]
    seen = blocks.agg(*sums, F.count_distinct("block").alias("blocks")).first()
    totals = [(seen.n0, seen.texts0), (seen.n1, seen.texts1)]
    bits = min(16, max(8, ((seen.n0 + seen.n1) // max(1, seen.blocks * SHARED)).bit_length() - 1))
    by_block = blocks.select("block", "chunk").groupBy("block")
    answers = None
    for step in range(len(_passes(order))):
        if answers is None:
            asked = by_block.applyInArrow(_asked(step, order, bits), _ASKED)
        else:
            asked = by_block.cogroup(answers.groupBy("block")).applyInArrow(_asked(step, order, bits), _ASKED)
        with _settings(spark, PASS_SETTINGS):
            found = keep(found_in_both(asked).mapInArrow(_packed, "block long, n long, packed binary"))
        found = found.withColumn("step", F.lit(step))
        answers = found if answers is None else answers.unionAll(found)
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(_sums(order, bits, "doc_id", totals), f"doc_id {kind}, fold int, n_grams long, log_score double")
