"""Grouping of spelling variants: words one edit apart, found by blocked Gram matrices.

The words of a text are its maximal runs of ``A-Za-z`` and U+00C0 to U+00FF, A-Z lower-cased.
Those of ``least_length`` code points that occur ``least_count`` times overall are compared. Two
are near if one inserted, deleted or replaced code point makes them equal. A word's form is its
near word of most occurrences (of ties, the least word), if these are ``factor`` times the
word's own; its root is found by following forms.

1. Words are counted by Spark, combined on the map side.
2. An edit changes at most two letter counts. The letters are dealt to ``g`` groups, so that two
   near words agree on the counts of all letters of ``g - 2`` groups at least. Every choice of
   so many groups cuts the words of one length into blocks of equal counts; longer words by one
   visit the block of the length below. ``g`` grows with the number of words, so that blocks
   stay small.
3. Rows come sorted by block and are cut to tiles of ``TILE`` rows; large blocks are cut to parts,
   of which a task holds one and lets the others pass. A NumPy product of two tiles' letter
   counts gives all squared distances; those of two (same length) or one (adjacent lengths)
   are verified as edits, in the first block only in which a pair can meet.
4. Each task says how many near words it found for a word and which is the largest; these are
   combined by word, and roots follow by joins that double the steps.

A null text has no words. Rows that repeat are counted each. Text of any length is read whole. An
empty table gives an empty result. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, keep

LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]  # code points, all of one byte in Latin-1
TILE = 256  # rows of one product's side
PART = 1 << 15  # words of a block that one task holds


def runs(docs: DataFrame, least_length: int) -> DataFrame:
    """(doc_id, run) of all runs of letters that are long enough, A-Z lower-cased."""
    pattern = F.lit(f"[a-zÀ-ÿ]{{{least_length},}}")
    found = F.regexp_extract_all(ascii_lower(F.col("text")), pattern, F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def misspelt(doc_id: Column, run: Column, every: int = 199) -> Column:
    """The run, without one code point if ``every`` divides the checksum of ``<doc_id>:<run>`` (null id: empty)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """(word, n) of a column ``word``."""
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def deal_letters(counts: dict[int, int], groups: int) -> np.ndarray:
    """The group of each of LETTERS, so that the groups hold about as many letters of all words."""
    totals, group = [0] * groups, np.zeros(len(LETTERS), np.int64)
    for code in sorted(LETTERS, key=lambda c: (-counts.get(c, 0), c)):
        least = totals.index(min(totals))
        group[LETTERS.index(code)] = least
        totals[least] += counts.get(code, 0) + 1
    return group


def letter_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each word holds each letter."""
    place = np.zeros(256, np.int64)
    place[LETTERS] = np.arange(len(LETTERS))
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    flat = np.bincount(rows * len(LETTERS) + place[data], minlength=(len(offsets) - 1) * len(LETTERS))
    return flat.reshape(-1, len(LETTERS)).astype(np.float32)


def _encoded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    latin = [w.encode("latin-1") for w in words]
    return np.frombuffer(b"".join(latin), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in latin], dtype=np.int64)]).astype(np.int64)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _blocks(group: np.ndarray, choices: list[tuple[int, ...]]):
    """Rows (word, n): one for each choice of groups and side: block, choice, side, word, n."""
    weight = np.random.default_rng(11).integers(1, 1 << 62, len(LETTERS), dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _encoded(batch.column(0).to_pylist())
            counts, lengths = letter_counts(data, offsets).astype(np.uint64), np.diff(offsets).astype(np.uint64)
            # A hash of the counts: blocks that share one are compared together, which costs time only.
            sums = np.stack([(counts[:, group == g] * weight[group == g]).sum(axis=1, dtype=np.uint64) for g in range(group.max() + 1)])
            for choice, groups in enumerate(choices):
                chosen = sum(sums[g] * np.uint64(2 * g + 3) for g in groups) + np.uint64(choice + 1)
                for side in (0, 1):
                    key = (chosen * _MIX + (lengths - np.uint64(side))) * _MIX
                    key ^= key >> np.uint64(29)
                    columns = [pa.array(key.view(np.int64)), pa.array(np.full(len(key), choice, np.int32)), pa.array(np.full(len(key), side, np.int32))]
                    yield pa.RecordBatch.from_arrays([*columns, batch.column(0), batch.column(1)], ["block", "choice", "side", "word", "n"])

    return run


class Tile:
    """Rows of one or several blocks, with what is needed to compare them."""

    def __init__(self, rows: dict[str, np.ndarray]):
        self.block, self.part, self.choice, self.side, self.stage, self.n = (rows[k] for k in ("block", "part", "choice", "side", "stage", "n"))
        self.words = rows["word"].tolist()
        data, offsets = _encoded(self.words)
        self.lengths = np.diff(offsets)
        self.counts = letter_counts(data, offsets)
        if int(self.lengths.max()) > 2000:  # beyond, squares are not exact in 32 bits
            self.counts = self.counts.astype(np.float64)
        self.square = (self.counts**2).sum(axis=1)


def one_edit(shorter: list[str], longer: list[str]) -> np.ndarray:
    """Of each pair (of one length, or the second longer by one) whether exactly one edit makes it equal."""
    found = np.zeros(len(shorter), bool)
    width = max(map(len, longer), default=0) + 1
    step = max(1, (1 << 22) // width)
    at = np.arange(width - 1)
    for begin in range(0, len(shorter), step):
        part = slice(begin, begin + step)
        a, b = (np.frombuffer(b"".join(w.encode("latin-1").ljust(width, b"\0") for w in side[part]), np.uint8).reshape(-1, width) for side in (shorter, longer))
        lengths = np.array([len(w) for w in shorter[part]])
        differ = a[:, :-1] != b[:, :-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        rest = (a[:, :-1] != b[:, 1:]) & (at >= first[:, None]) & (at < lengths[:, None])
        inserted = ~rest.any(axis=1)
        found[part] = np.where(lengths == [len(w) for w in longer[part]], differ.sum(axis=1) == 1, inserted)
    return found


def near_pairs(x: Tile, y: Tile, group: np.ndarray, choices: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of near words of two tiles (which may be the same), each pair once over all blocks and sides."""
    distance = x.square[:, None] + y.square - 2 * (x.counts @ y.counts.T)
    i, j = np.nonzero(distance <= 2)
    # Home rows among themselves differ by two letter counts, home rows and visitors by one.
    fit = (x.stage[i] == 0) & (x.side[i] == 0) & (x.block[i] == y.block[j]) & (x.part[i] == y.part[j])
    fit &= (x.choice[i] == y.choice[j]) & (x.lengths[i] + y.side[j] == y.lengths[j]) & (distance[i, j] == 2 - y.side[j])
    if x is y:
        fit &= (y.stage[j] > 0) | (y.side[j] > 0) | (i < j)
    i, j = i[fit], j[fit]
    if len(i):
        # The first choice whose groups all agree is the one in which the pair counts.
        agree = np.stack([(x.counts[i][:, group == g] == y.counts[j][:, group == g]).all(axis=1) for g in range(group.max() + 1)], axis=1)
        first = np.stack([agree[:, list(groups)].all(axis=1) for groups in choices], axis=1).argmax(axis=1)
        mine = first == x.choice[i]
        i, j = i[mine], j[mine]
        edit = one_edit([x.words[k] for k in i], [y.words[k] for k in j])
        i, j = i[edit], j[edit]
    return i, j


def _summary(x: Tile, y: Tile, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Of each word: how many near words were found, and the largest."""
    best: dict[str, tuple] = {}
    for a, b, here, there in ((i, j, x, y), (j, i, y, x)):
        for word, n, other in zip([here.words[k] for k in a], there.n[b].tolist(), [there.words[k] for k in b], strict=True):
            near, m, known = best.get(word, (0, 0, ""))
            best[word] = (near + 1, n, other) if not near or (-n, other) < (-m, known) else (near + 1, m, known)
    near, n, other = zip(*best.values(), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(list(best)), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(other)], ["word", "near", "n", "other"])


def _edges(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Where the parts begin, and the end."""
    differ = (rows["block"][1:] != rows["block"][:-1]) | (rows["part"][1:] != rows["part"][:-1])
    return np.concatenate([[0], np.flatnonzero(differ) + 1, [len(rows["n"])]]) if len(rows["n"]) else np.zeros(1, np.int64)


def _compare(group: np.ndarray, choices: list[tuple[int, ...]], size: int):
    """Rows sorted by block, part and stage: 0 for what the part holds, 1 for what passes it. Tiles have ``size`` rows."""
    names = ["block", "part", "stage", "choice", "side", "word", "n"]

    def meet(x: Tile, y: Tile) -> Iterator[pa.RecordBatch]:
        i, j = near_pairs(x, y, group, choices)
        if len(i):
            yield _summary(x, y, i, j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, np.ndarray] | None = None
        held: list[Tile] = []  # of a part larger than a tile, as far as it was read
        key = None  # its block and part
        for batch in chain(batches, [None]):
            if batch is not None:
                new = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
                rows = {k: np.concatenate([rows[k], new[k]]) for k in names} if rows else new
            if not rows or not len(rows["n"]):
                continue
            if held and key != (rows["block"][0], rows["part"][0]):
                held = []
            edges = _edges(rows)
            whole = len(edges) - 1 if batch is None else len(edges) - 2  # parts that are known to have ended
            alone = np.diff(edges) == 1
            alone[whole:] = False
            alone[:1] &= not held
            if alone.any():
                rows = {k: v[np.repeat(~alone, np.diff(edges))] for k, v in rows.items()}
                edges, whole = _edges(rows), whole - int(alone.sum())
            at = 0
            while at < len(edges) - 1:
                begin, end = int(edges[at]), int(edges[at + 1])
                if held or end - begin > size:
                    key = (rows["block"][begin], rows["part"][begin])
                    if at >= whole:
                        end -= (end - begin) % size
                    for cut in range(begin, end, size):
                        piece = Tile({k: v[cut : min(end, cut + size)] for k, v in rows.items()})
                        for other in held:
                            yield from meet(other, piece)
                        if piece.stage[0] == 0:
                            yield from meet(piece, piece)
                            held.append(piece)
                    if at >= whole:
                        begin = end
                        break
                    held, at = [], at + 1
                elif at >= whole:
                    break
                else:
                    at = min(whole, int(np.searchsorted(edges, begin + size, "right")) - 1)
                    piece = Tile({k: v[begin : int(edges[at])] for k, v in rows.items()})
                    yield from meet(piece, piece)
            else:
                begin = len(rows["n"])
            rows = {k: v[begin:] for k, v in rows.items()}

    return run


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near_word) of the words (word, n) that have near words; the largest of them is named."""
    letter = F.explode(F.split("word", ""))
    counted = words.select(letter.alias("letter")).filter("letter <> ''").groupBy(F.ascii("letter").alias("code")).count().collect()
    size = words.count()
    groups = 4 + max(0, max(size, 1).bit_length() - 20) // 4
    group = deal_letters({r["code"]: r["count"] for r in counted}, groups)
    choices = list(combinations(range(groups), groups - 2))
    rows = words.mapInArrow(_blocks(group, choices), "block long, choice int, side int, word string, n long")
    home = keep(rows.filter("side = 0").groupBy("block").count().filter(F.col("count") > PART))
    large = home.count()
    rows = rows.withColumn("part", F.lit(0)).withColumn("stage", F.col("side"))
    if large:
        # Fewer than words * choices / PART blocks are large; their list is broadcast while it takes 16 MB at most.
        parts = home.select("block", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
        joined = rows.join(F.broadcast(parts) if large <= 1 << 20 else parts, "block", "left")
        own = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int")
        upto = F.when(F.col("side") == 1, F.coalesce("parts", F.lit(1)) - 1).otherwise(own)
        dealt = joined.withColumn("own", own).withColumn("part", F.explode(F.sequence(F.lit(0), upto)))
        rows = dealt.withColumn("stage", F.when((F.col("side") == 0) & (F.col("part") == F.col("own")), 0).otherwise(1))
    tasks = rows.repartition("block", "part").sortWithinPartitions("block", "part", "stage", "choice", "side")
    tasks = tasks.select("block", "part", "stage", "choice", "side", "word", "n")
    found = tasks.mapInArrow(_compare(group, choices, TILE), "word string, near long, n long, other string")
    return found.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), F.col("other").alias("w"))).alias("best")
    ).select("word", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.w").alias("near_word"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following (word, form) from each word ends. Forms grow in count, so there are no rings."""
    now = keep(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        after = keep(now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        if not after.filter("moved").limit(1).count():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word (word, n)."""
    words = keep(words)
    known = words.join(near_words(words), "word", "left")
    has = F.col("near_n") >= factor * F.col("n")
    known = keep(known.select(
        "word", F.when(has, F.col("near_word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("near_n")).alias("form_n")
    ))
    ends = roots(known.filter("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, factor: int = 5) -> DataFrame:
    """The words of ``docs`` as they are, with their forms and roots."""
    return variants(vocabulary(runs(docs, least_length).withColumnRenamed("run", "word"), least_length, least_count), factor)
