"""Merge-type prefix table for byte-pair encoding with a SentencePiece vocabulary.

A merge joins the neighbours whose union has the best score, the leftmost first. For every
prefix of a text the last token of its encoding is unique: among the pieces that end there
(found by an automaton) it is the one that is compatible with the last token of the prefix
before it, which means that no merge over the seam would have come first. One pass stores
these tokens; the ids are then read backwards.
"""

from __future__ import annotations

import codecs
import re
from itertools import chain

import ahocorasick

GAP = "▁"  # stands for a space

codecs.register_error("each_byte", lambda error: ("\ufffd" * (error.end - error.start), error.end))


class Vocabulary:
    """Pieces, their merge order, and how each comes about; loaded from a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.runs = {len(self.pieces[i]): i for i in plain if len(self.pieces[i]) > 1 and set(self.pieces[i]) == {GAP}}
        plain = [i for i in plain if i not in self.runs.values()]
        self.ids = {self.pieces[i]: i for i in plain}
        order = sorted((i for i in plain if len(self.pieces[i]) > 1), key=lambda i: -model.get_score(i))
        self.rank = {i: 0 for i in plain} | {i: r for r, i in enumerate(order, 1)}  # 0: a character
        self.halves: dict[int, tuple[int, int]] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for i in sorted(plain, key=lambda i: self.rank[i]):
            if len(self.pieces[i]) == 1 or self._build(i):
                self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), i))
        self.automaton.make_automaton()
        self.text_of = [self.pieces[i].replace(GAP, " ") for i in range(size)]
        for byte, i in self.bytes.items():  # a lone surrogate holds the place of a byte above 127
            self.text_of[i] = chr(byte) if byte < 128 else chr(0xDC00 + byte)

    def _build(self, token: int) -> bool:
        """Merge a piece's own characters; its halves are what the last merge joined."""
        parts = [self.ids.get(c, -1) for c in self.pieces[token]]
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                union = self.ids.get(self.pieces[parts[k]] + self.pieces[parts[k + 1]]) if min(parts[k], parts[k + 1]) >= 0 else None
                if union is not None and (best is None or self.rank[union] < self.rank[best[1]]):
                    best = (k, union)
            if best is None:
                return False
            k, union = best
            if len(parts) == 2:
                self.halves[token] = (parts[0], parts[1])
            parts[k : k + 2] = [union]
        return parts == [token]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay apart when they meet; remembered for each pair."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > 1_000_000:
                self.compatible.clear()
            known = self.compatible[left, right] = self._test(left, right)
        return known

    def _test(self, left: int, right: int) -> bool:
        # Undo merges from the latest: a seam merge that ranks before the one undone would have come first.
        bound = len(self.pieces) + 1
        while True:
            union = self.ids.get(self.pieces[left] + self.pieces[right])
            if union is not None and self.rank[union] < bound:
                return False
            a, b = self.rank[left], self.rank[right]
            if not a and not b:
                return True
            if a > b:
                bound, left = a, self.halves[left][1]
            else:  # of equal merges the seam's is further left, so it would win a tie
                bound, right = b + 1, self.halves[right][0]

    def encode(self, chunk: str) -> list[int]:
        """Ids of a chunk without spaces inside; leading gaps are one run."""
        bare = chunk.lstrip(GAP)
        gaps = len(chunk) - len(bare)
        if not bare:
            return self._run(gaps)
        ids = self._table(GAP + bare if gaps else bare)
        if gaps and ids[0] == self.ids[GAP]:  # not joined to the word, so part of the run
            return self._run(gaps) + ids[1:]
        return self._run(gaps - 1) + ids if gaps > 1 else ids

    def _run(self, gaps: int) -> list[int]:
        """Unions of gaps only share the last rank, so they grow from the left as long as pieces allow."""
        most = max(self.runs, default=1)
        ids = [self.runs[most]] * (gaps // most) if most > 1 else []
        rest = gaps - most * len(ids)
        while rest:
            take = next((n for n in range(rest, 1, -1) if n in self.runs), 1)
            ids.append(self.runs[take] if take > 1 else self.ids[GAP])
            rest -= take
        return ids

    def _table(self, text: str) -> list[int]:
        last: list[int] = [-1] * (len(text) + 1)  # id of the last token; -1: a character without a piece
        size = [1] * (len(text) + 1)
        found: list[bool] = [False] * (len(text) + 1)
        for at, (length, token) in self.automaton.iter(text):
            end = at + 1
            if found[end]:
                continue
            begin = end - length
            before = last[begin]
            if before < 0 or begin == 0 or self.fits(before, token):
                last[end], size[end], found[end] = token, length, True
        ids: list[int] = []
        end = len(text)
        while end:
            if last[end] >= 0:
                ids.append(last[end])
            else:
                ids += [self.bytes[b] for b in reversed(text[end - 1].encode())]
            end -= size[end]
        return ids[::-1]

    def decode(self, ids: list[int]) -> str:
        """Pieces put together without the space put in front; bytes that are not UTF-8 become U+FFFD each."""
        text = "".join(map(self.text_of.__getitem__, ids))
        text = text.encode("utf-8", "surrogateescape").decode("utf-8", "each_byte")
        return text[1:] if text.startswith(" ") else text

    def cuts(self) -> set[str]:
        """Pairs of neighbouring characters that some piece holds; no merge crosses any other pair."""
        pieces = [*self.ids, *(GAP * n for n in self.runs)]
        return {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}


class Encoder:
    """Whole texts, by chunks whose ids are remembered (in two generations, so that memory is bounded)."""

    REMEMBERED = 200_000
    # No piece holds a gap after another character; so a text may be cut before each run of gaps.
    CHUNK = re.compile(rf"{GAP}*[^{GAP}\n]+|{GAP}+|\n+")

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.joined = self.vocabulary.cuts()
        if any(pair[1] == GAP and pair[0] != GAP or "\n" in pair for pair in self.joined):
            raise ValueError("a piece goes on after a word's end; chunks can't be told apart")
        self.memory = _Memory(self._chunk, self.REMEMBERED)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        end = len(chunk)
        while end > 2 and not chunk[end - 1].isalnum() and chunk[end - 2 : end] not in self.joined:
            end -= 1
        if end < len(chunk):
            return self.memory[chunk[:end]] + tuple(chain.from_iterable(map(self.memory.__getitem__, chunk[end:])))
        return tuple(self.vocabulary.encode(chunk))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        chunks = self.CHUNK.findall(GAP + text.replace(" ", GAP))
        return list(chain.from_iterable(map(self.memory.__getitem__, chunks)))

    def decode(self, ids: list[int]) -> str:
        return self.vocabulary.decode(ids)


LONGEST = 64  # characters of a key that is remembered, so that the number of keys bounds the memory


class _Memory(dict):
    """Results of ``make`` by key; the older half goes when ``size`` newer ones have come.

    A longer key (text without spaces can be one) is made anew each time.
    """

    def __init__(self, make, size: int):
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST:
                return value
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
