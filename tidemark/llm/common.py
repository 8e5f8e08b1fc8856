"""What the operators share: stored intermediate tables, byte views of text, hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 1 << 19  # text handled at once by the array code; a longer text is a slice of its own

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def keep(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a lost executor costs no recomputation."""
    path = shared_dir(df.sparkSession)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def trimmed(run):
    """``run`` for a task, which then gives back what it leaves behind: Python workers outlive their tasks."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z only; text without other letters takes the faster function."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


SIEVE_BITS = 24


def sieve_bits(spark: SparkSession, ids: DataFrame, name: str = "doc_id"):
    """A hash of the id, and one bit for each of its values: 2 MB to every task, whatever the number of ids."""
    h = F.pmod(F.xxhash64(name), F.lit(1 << SIEVE_BITS))
    bits = ids.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(h % 64 AS INT))")).alias("bits")
    ).toArrow()
    words = np.zeros(1 << (SIEVE_BITS - 6), np.uint64)
    words[bits["word"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return h, spark.sparkContext.broadcast(words)


def passing(words: np.ndarray, hashes: pa.Array) -> pa.Array:
    at = hashes.to_numpy()
    return pa.array((words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool))


def sieve(df: DataFrame, ids: DataFrame, name: str = "doc_id") -> Column:
    """False for rows of ``df`` whose id is surely not in ``ids``.

    With very many ids it lets everything through; it only decides what a join has to move.
    """
    h, shared = sieve_bits(df.sparkSession, ids, name)

    @F.arrow_udf("boolean")
    def passes(hashes: pa.Array) -> pa.Array:
        return passing(shared.value, hashes)

    return passes(h)


def only_in(df: DataFrame, ids: DataFrame, how: str, name: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is (``left_semi``) or is not (``left_anti``) in ``ids``; null is an id like others.

    Only rows that pass the sieve of ``ids`` are joined, so that other texts stay where they are.
    """
    passes = sieve(df, ids, name)
    other = unused(df, "__other_id")
    left, right = df.filter(passes), ids.select(F.col(name).alias(other))
    joined = left.join(right, left[name].eqNullSafe(right[other]), how)
    return joined if how == "left_semi" else df.filter(~passes).unionByName(joined)


HOT = 1024


def join_hot(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``rows`` left joined with ``table``, which says by ``weight`` how many of the ``total`` rows have each key.

    Keys of more than one row in HOT are joined by broadcast: there are fewer than HOT of them,
    whatever the input. No task of the other join gets more than that share from one key.
    """
    is_hot = F.col(weight) * HOT > total
    hot = table.filter(is_hot).withColumn("__hot", F.lit(True))
    others = [c for c in table.columns if c != key]
    marked = rows.join(F.broadcast(hot), key, "left")
    rest = marked.filter("__hot IS NULL").drop("__hot", *others).join(table.filter(~is_hot), key, "left")
    return marked.filter("__hot").drop("__hot").unionByName(rest)


def byte_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """UTF-8 bytes of consecutive texts, and where each begins and the last ends; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        size = max(size, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, from prefix sums of a polynomial."""
    powers, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes that do not cross a text: starts, ends, and the first run of each text."""
    n = len(member)
    before = np.zeros(n, bool)
    before[1:] = member[:-1]
    edge = offsets[:-1]
    before[edge[edge < n]] = False
    starts = np.flatnonzero(member & ~before)
    after = np.zeros(n, bool)
    after[:-1] = member[1:]
    edge = offsets[1:] - 1
    after[edge[edge >= 0]] = False
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents, chosen by a hash of the id among the rows not held out.

    Only ids and labels are chosen and broadcast: ``rows`` bounds their size whatever the input.
    An id that comes several times gives one document, its least text, so the bound holds.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .filter(F.crc32(F.col("doc_id").cast("string")) % modulus != held_out)
        .groupBy("doc_id").agg(F.max(label).alias("__label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = docs.select("doc_id", whole_text().alias("__text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "__label").agg(F.min("__text").alias("__text")).select("doc_id", "__text", "__label")
