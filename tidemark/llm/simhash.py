"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked within a Hamming radius.

A text's shingles are all runs of ``size`` words (A-Z lower-cased, repeats included), joined
by one space; with fewer words the whole sequence is the only one. A fingerprint bit is set if
it is set in over half of the shingles' XXH64 (seed 42). Without words the fingerprint is zero
and links like any other.

1. Equal fingerprints are one class; only classes are compared.
2. Bits are dealt to ``m`` blocks. Two fingerprints within the radius agree on ``m - radius``
   blocks at least, so every choice of so many blocks is a table, and a class meets others in
   the cells of these tables only. ``m`` grows with the number of classes, so that cells of
   fingerprints that are spread evenly stay small.
3. A cell with more than ``cell`` classes is dealt again, in the same way, by the bits that its
   members need not share. Each time half of these remain, so that in the end no cell can hold
   more: no pair of parts of a cell is ever compared.
4. In a cell bit planes lie vertically, 64 classes to a word. All members run against all
   words at once: carry-save adders count differing bits, two planes at a time, and a word is
   abandoned once all of its classes are beyond the radius.
5. A cell gives one link a class, to the least class it hangs together with there;
   components are found by joins.

Rows stand for themselves: rows that repeat an id are compared like others. A null text is an
empty one. A row without an id has a fingerprint but neither links nor a component. An empty
table gives an empty result. Only ``doc_id`` and ``text`` are read, so other columns may have
any names. Memory grows with the longest text (its words, and hashes 8 bytes a shingle).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_hot, keep
from tidemark.llm.components import components

BITS = 64
SEED = 42
CELL = 1024  # classes of a cell that one task compares
SHINGLES = 1 << 15  # hashes whose bits are unpacked at once, 64 bytes each
PAIRS = 1 << 15  # (class, word) pairs compared at once, unless one cell has more


def shingle_hashes(text: str, size: int) -> np.ndarray:
    words = text.encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - size + 1)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """One fingerprint for each list of hashes: the bits set in over half of them."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    counts = np.zeros((len(hashes), BITS), np.int64)
    every, owner = np.concatenate([np.zeros(0, np.uint64), *hashes]), np.repeat(np.arange(len(hashes)), sizes)
    for at in range(0, len(every), SHINGLES):
        part = every[at : at + SHINGLES]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owners, begins = np.unique(owner[at : at + SHINGLES], return_index=True)
        counts[owners] += np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fingerprint as a long) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, waiting, held = [], [], 0
            for text in batch.column(1):
                waiting.append(shingle_hashes(text.as_py() or "", size))
                held += len(waiting[-1])
                if held >= SHINGLES:
                    found.append(majority(waiting))
                    waiting, held = [], 0
            found.append(majority(waiting))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found).view(np.int64))], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint long")


def tables(free: int, blocks: int, radius: int) -> list[int]:
    """Masks that keep all bits outside ``free``, and every choice of ``blocks - radius`` of its blocks."""
    bits = [b for b in range(BITS) if free >> b & 1]
    parts = [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(bits, dtype=object), blocks)]
    fixed = (1 << BITS) - 1 - free
    return [fixed | sum(chosen) for chosen in combinations(parts, blocks - radius)]


def first_blocks(classes: int, radius: int) -> int:
    """Blocks to deal all bits to: the fewest that leave an even cell a quarter of what it may hold."""
    blocks = radius + 1
    while blocks < BITS and classes >> (BITS * (blocks - radius) // blocks) > CELL // 4:
        blocks += 1
    return blocks


def _deal(radius: int):
    """Rows (mask, fingerprint) of full cells: the same in the cells of finer tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, prints = (batch.column(k).to_numpy() for k in (0, 1))
            for mask in np.unique(masks):
                members = prints[masks == mask]
                free = (1 << BITS) - 1 - (int(mask) % (1 << BITS))
                for finer in tables(free, 2 * radius, radius):
                    finer = np.full(len(members), finer, np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(finer), pa.array(members)], ["mask", "fingerprint"])

    return run


def _add(mismatch: list[np.ndarray], digits: list[np.ndarray], beyond: np.ndarray) -> None:
    """Carry-save addition of two planes to vertical counters; what the digits can't hold is beyond."""
    x, y = mismatch
    half = digits[0] ^ x
    carry = (digits[0] & x) | (half & y)
    digits[0] = half ^ y
    for k in range(1, len(digits)):
        digits[k], carry = digits[k] ^ carry, digits[k] & carry
    beyond |= carry


def close_pairs(prints: np.ndarray, cells: np.ndarray, radius: int, at_once: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places (i < j) within the radius inside each cell; ``cells`` is sorted."""
    n = len(prints)
    begins = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, n))
    words = -(-sizes // 64)
    first_word = np.concatenate([[0], np.cumsum(words)])
    of = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(n) - begins[of]
    word_of, slot = first_word[of] + inside // 64, (inside % 64).astype(np.uint64)
    planes = np.zeros((BITS, first_word[-1] + 1), np.uint64)
    opening = np.flatnonzero(inside % 64 == 0)
    for b in range(BITS if n else 0):
        planes[b, :-1] = np.bitwise_or.reduceat((prints >> np.uint64(b) & np.uint64(1)) << slot, opening)
    present = np.zeros(first_word[-1] + 1, np.uint64)
    if n:
        present[:-1] = np.bitwise_or.reduceat(np.uint64(1) << slot, opening)
    width = max(1, (radius).bit_length())
    counted = np.concatenate([[0], np.cumsum(sizes * words)])
    cell = 0
    while cell < len(sizes):
        last = max(cell + 1, int(np.searchsorted(counted, counted[cell] + at_once, "right")) - 1)
        rows = np.arange(begins[cell], begins[last - 1] + sizes[last - 1])
        times = words[of[rows]]
        who = np.repeat(rows, times)
        word = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times) + first_word[of[who]]
        # Only the words from one's own on: a pair is met by its lesser place.
        ahead = word >= word_of[who]
        who, word = who[ahead], word[ahead]
        digits = [np.zeros(len(who), np.uint64) for _ in range(width)]
        beyond = ~present[word]
        for b in range(0, BITS, 2):
            mismatch = [planes[k, word] ^ (np.uint64(0) - (prints[who] >> np.uint64(k) & np.uint64(1))) for k in (b, b + 1)]
            _add(mismatch, digits, beyond)
            if b % 8 == 6:
                alive = beyond != np.uint64(0xFFFFFFFFFFFFFFFF)
                if not alive.all():
                    who, word, beyond, digits = who[alive], word[alive], beyond[alive], [d[alive] for d in digits]
        near = ~beyond & ~_over(digits, radius)
        hit = np.flatnonzero(near)
        bits = np.unpackbits(near[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, bit = np.nonzero(bits)
        i, j = who[hit][at], opening[word[hit][at]] + bit
        yield i[i < j], j[i < j]
        cell = last


def _over(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Counters that hold more than the radius, compared digit by digit from the highest."""
    over, equal = np.zeros_like(digits[0]), ~np.zeros_like(digits[0])
    for k in reversed(range(len(digits))):
        if radius >> k & 1:
            equal = equal & digits[k]
        else:
            over, equal = over | (equal & digits[k]), equal & ~digits[k]
    return over


def least_reached(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least place that each place hangs together with."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], least)
        np.minimum.at(label, label[j], least)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            return label


def _compare(radius: int, at_once: int):
    """Rows (mask, value, fingerprint), sorted by cell: links of each class to the least one of its part of the cell."""

    def solve(keys: list[np.ndarray], prints: np.ndarray) -> pa.RecordBatch:
        cells = np.concatenate([[0], np.cumsum((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]))]) if len(prints) else keys[0]
        found = [np.zeros((2, 0), np.int64)]
        for i, j in close_pairs(prints.view(np.uint64), cells, radius, at_once):
            if len(i):
                places, short = np.unique(np.concatenate([i, j]), return_inverse=True)
                label = places[least_reached(len(places), short[: len(i)], short[len(i) :])]
                linked = label != places
                found.append(np.stack([prints[places[linked]], prints[label[linked]]]))
        a, b = np.concatenate(found, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held)]
            # The last cell may go on in the next batch.
            changes = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))
            if len(changes):
                whole = changes[-1] + 1
                yield solve([held[0][:whole], held[1][:whole]], held[2][:whole])
                held = [h[whole:] for h in held]
        yield solve(held[:2], held[2])

    return run


def close_classes(classes: DataFrame, radius: int, count: int, cell: int = CELL) -> DataFrame:
    """Links (a, b) that join all fingerprints within the radius of one another."""
    if cell < 1 << 2 * radius:
        raise ValueError("the last tables leave twice the radius in bits; a cell must hold all their values")
    as_long = [int(np.uint64(mask).view(np.int64)) for mask in tables((1 << BITS) - 1, first_blocks(count, radius), radius)]
    rows = classes.select(F.explode(F.array(*[F.lit(m) for m in as_long])).alias("mask"), "fingerprint")
    links = None
    while True:
        rows = rows.withColumn("value", F.col("mask").bitwiseAND(F.col("fingerprint")))
        full = keep(rows.groupBy("mask", "value").count().filter(F.col("count") > cell).select("mask", "value"))
        full_cells = full.count()
        # At most one cell in CELL rows is full; the marks are broadcast while they are 16 MB at most.
        marks = F.broadcast(full) if full_cells <= 1 << 20 else full
        open_rows = rows.join(marks, ["mask", "value"], "left_anti") if full_cells else rows
        cells = open_rows.select("mask", "value", "fingerprint").repartition("mask", "value").sortWithinPartitions("mask", "value", "fingerprint")
        found = keep(cells.mapInArrow(_compare(radius, PAIRS), "a long, b long").distinct())
        links = found if links is None else links.unionByName(found)
        if not full_cells:
            return links
        again = rows.join(marks, ["mask", "value"], "left_semi").select("mask", "fingerprint")
        rows = keep(again.mapInArrow(_deal(radius), "mask long, fingerprint long"))


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (hexadecimal text) and component_id (the least id reachable by links) of every row."""
    prints = keep(fingerprints(docs, size))
    classes = keep(
        prints.filter("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    )
    total = classes.agg(F.count("*").alias("classes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    links = close_classes(classes.select("fingerprint"), radius, total["classes"])
    groups = components(links).withColumnRenamed("id", "fingerprint")
    named = classes.join(groups, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("classes"))
    named = keep(join_hot(named, keep(least), "component", "classes", total["classes"]).select("fingerprint", "rows", "component_id"))
    every = join_hot(prints, named, "fingerprint", "rows", total["rows"])
    return every.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
