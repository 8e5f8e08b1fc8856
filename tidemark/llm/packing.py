"""Harmonic packing of token sequences, by every task for itself.

A length belongs to class k when k documents of it fill a sequence: it is over 1/(k+1) and at
most 1/k of the capacity. Every class fills bins of exactly k pieces. Documents are cut so
that little is lost: whole sequences first, then halves of halves down to ``LEAST``, which
are the classes that fill bins without a gap, and a short tail. What is left in open bins at
the end of a task is put together, and its last sequence is cut at powers of two, which need
no padding.

A document is its ids and an end mark; a null or empty text is the end mark alone. Every
id lies in exactly one piece. A repeated row is a document of its own; an empty table gives
an empty result. Memory: a chunk of texts (``CHUNK`` bytes, or one longer text), the open bins
and the remembered words.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import trimmed
from tidemark.llm.prefix_table import _Memory

CAPACITY = 2048
LEAST = 64  # the shortest piece that a document is cut to, but for its tail
END_ID = 1
CHUNK = 1 << 20  # bytes of text handled at once; a longer text is handled alone
_tokenizers: dict = {}


def byte_letters() -> dict[int, str]:
    """How the model writes the bytes of letters: printable ones as themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordTokenizer:
    """Ids as little-endian 32-bit bytes, by pieces of words whose ids are remembered.

    The model drops white space and splits at it. In ``PLAIN`` text, which is composed already,
    without its special tokens, its other splits are those of ``PIECE``, and a piece of letters takes
    its merges alone. Whatever is not such text goes to the library word by word, or as it is.
    """

    REMEMBERED = 200_000
    LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
    PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\x20\t-\r{LETTERS}0-9]+")
    PLAIN = re.compile("[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
    WORD = re.compile(r"[^\x20\t-\r]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.pieces = _Memory(self._piece, self.REMEMBERED)
        self.words = _Memory(self._word, self.REMEMBERED // 4)

    def _ids(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _library(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        if not piece.isalpha():
            return self._library(piece)
        # Nothing to normalise or split: the merges alone, over bytes.
        written = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return self._ids([t.id for t in self.tokenizer.model.tokenize(written)])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.PIECE.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        return self._plain(word) if self.PLAIN.fullmatch(word) else self._library(word)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._library(text)
        if text.isascii() or self.PLAIN.fullmatch(text):
            return self._plain(text)
        return b"".join(map(self.words.__getitem__, self.WORD.findall(text)))


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def chunks(batch: pa.RecordBatch, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Rows whose texts (the second column) take ``limit`` bytes together, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def cut(length: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of the pieces of a document."""
    found = [capacity] * (length // capacity)
    rest, size = length % capacity, capacity // 2
    while size >= least:
        if rest >= size:
            found.append(size)
            rest -= size
        size //= 2
    return found + [rest] if rest else found


class HarmonicBins:
    """Bins of one task; a full bin comes out as a list of pieces, which end in (start, length)."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.open: dict[int, list[tuple]] = {}

    def add(self, piece: tuple) -> list[tuple] | None:
        k = self.capacity // piece[-1]
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        return self.open.pop(k) if len(bin_) == k else None

    def rest(self) -> Iterator[list[tuple]]:
        """The open bins' pieces, end to end, cut at whole sequences and then at powers of two."""
        pieces = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(p[-1] for p in pieces)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if (total % self.capacity) >> b & 1]
        pieces.reverse()
        for size in sizes:
            bin_: list[tuple] = []
            while size:
                *row, start, length = pieces.pop()
                take = min(size, length)
                bin_.append((*row, start, take))
                if length > take:
                    pieces.append((*row, start + take, length - take))
                size -= take
            yield bin_


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset."""
    mark = np.array([END_ID], "<u4").tobytes()
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, bins = _tokenizer(path), HarmonicBins(capacity)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        id_type = pa.int64()

        def close(bin_: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc_id, tokens, base, ids, start, length in bin_:
                rows.append((doc_id, start, length, ids[4 * (start - base) : 4 * (start - base + length)], tokens, sequence, offset))
                offset += length
            sequence += 1

        def ready() -> pa.RecordBatch:
            doc_id, start, length, ids, tokens, seq, offset = zip(*rows, strict=True) if rows else [()] * 7
            rows.clear()
            longs = [pa.array(x, pa.int64()) for x in (start, length, tokens, seq, offset)]
            arrays = [pa.array(doc_id, id_type), *longs[:2], pa.array(ids, pa.binary()), *longs[2:]]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for part in chunks(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = tokenizer.encode(text or "") + mark
                    tokens, start = len(ids) // 4, 0
                    for length in cut(tokens, capacity):
                        # A piece that waits in an open bin holds its own ids only.
                        full = bins.add((doc_id, tokens, start, ids[4 * start : 4 * (start + length)], start, length))
                        start += length
                        if full:
                            close(full)
                yield ready()
        for bin_ in bins.rest():
            close(bin_)
        yield ready()

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), columns)
