"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def letter_runs(text: str | None) -> list[str]:
    return re.findall(r"[a-z\u00C0-\u00FF]+", (text or "").translate(LOW))


def ngrams(text: str | None, n: int) -> set:
    words = WORD.findall((text or "").translate(LOW))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def jaccard_join(rows: list[tuple], n: int, percent: int) -> dict:
    """id: (size, component, links), of distinct ids."""
    sets = {i: ngrams(t, n) for i, t in rows}
    holders = defaultdict(list)
    for i, members in sets.items():
        for g in members:
            holders[g].append(i)
    group, links = {i: {i} for i in sets}, Counter()
    for i, members in sets.items():
        for j, both in Counter(j for g in members for j in holders[g] if j > i).items():
            if 100 * both >= percent * (len(members) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                if group[i] is not group[j]:
                    group[i] |= group[j]
                    for k in list(group[i]):
                        group[k] = group[i]
    return {i: (len(sets[i]), min(group[i]), links[i]) for i in sets}


def measures(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            repeated |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
        n < 20 or 100 * len(repeated) > 30 * n,
    )


def word_backoff_scores(texts: list[str], order: int) -> list[tuple[int, float]]:
    """Word n-grams and log scores under the counts of the other fold."""
    def grams(x: str) -> list[tuple]:
        words = [("start",)] * (order - 1) + WORD.findall(x) + [("end",)]
        return [tuple(words[i : i + order]) for i in range(len(words) - order + 1)]

    counts, contexts = (Counter(), Counter()), (Counter(), Counter())
    folds = [zlib.crc32(x.encode()) % 2 for x in texts]
    for x, f in zip(texts, folds, strict=True):
        for g in grams(x):
            for k in range(order):
                counts[f][g[k:]] += 1
                contexts[f][g[k:-1], order - k] += 1

    def s(g: tuple, f: int) -> float:
        if not g:
            return math.log(1 / (contexts[f][(), 1] + 1))
        if counts[f][g]:
            return math.log(counts[f][g] / contexts[f][g[:-1], len(g)])
        return math.log(0.4) + s(g[1:], f)

    return [(len(grams(x)), sum(s(g, 1 - f) for g in grams(x))) for x, f in zip(texts, folds, strict=True)]


def best_segments(values: list[float]) -> list[tuple]:
    """All maximal-scoring segments by definition: take the best (shortest, first), then look left and right of it."""
    def take(lo: int, hi: int) -> list[tuple]:
        best = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += values[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-12 or (abs(total - best[2]) <= 1e-12 and j + 1 - i < best[1] - best[0])):
                    best = (i, j + 1, total)
        return [] if best is None else take(lo, best[0]) + [best] + take(best[1], hi)

    return take(0, len(values))
