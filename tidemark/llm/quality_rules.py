"""Line-first cleaning, in DataFrame functions only.

Every line is judged by itself (punctuation, navigation, boilerplate); lines that fail are
taken out, and a document that loses too much of its text is rejected. Before that, a
document is rejected for being too short or too repetitive.

Words are runs of characters other than space and U+0009 to U+000D. A null text has no words;
it and an empty text are rejected for length. Windows of words are told apart by 64-bit
hashes within one text. An empty table gives an empty result; rows are never merged, so
repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text"]
WORD_BREAK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8  # words; a power of two, as hashes of windows are built by doubling
TERMINAL = list(".!?\"'…)]»”’。！？")
SEPARATORS = r"[|•»›·]"
BOILERPLATE = [
    "cookie policy", "use of cookies", "privacy policy", "terms of use", "terms of service",
    "all rights reserved", "enable javascript", "lorem ipsum", "click here to", "skip to content",
]


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; all are shares of words or characters, not caps on what is read."""

    min_words: int = 20  # of a document
    max_repeated: int = 30  # per cent of the words that lie in repeated windows
    short_line: int = 5  # words; a shorter line must end in terminal punctuation
    max_separators: float = 0.2  # per word of a line: beyond it the line is navigation
    max_symbols: float = 0.5  # per word of a line
    max_lost: float = 0.5  # share of the characters that failing lines may hold


def _words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def line_fails(line: Column, rules: LineRules = LineRules()) -> Column:
    """True for a line that is a menu, noise, boilerplate, or short without an end mark; blank lines pass."""
    tidy = F.trim(line)
    words = _words(tidy)
    ends = F.substring(tidy, -1, 1).isin(TERMINAL)
    lower = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | lower.contains(phrase)
    return (tidy != "") & (
        (~ends & (words < rules.short_line))
        | (F.regexp_count(line, F.lit(SEPARATORS)) > words * rules.max_separators)
        | (F.regexp_count(line, F.lit(SYMBOLS)) > words * rules.max_symbols)
        | boilerplate
    )


def judged(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the measures and the verdict added, and under which names.

    The names are new ones, whatever columns ``docs`` has. Arrays are built column by column
    so that each is computed once.
    """
    wanted = ["t", "words", "lines", "h1", "h2", "h4", "h8", "sorted", "at", "n_words", "word_chars", "n_symbols",
              "n_dup_lines", "n_repeat_words", "base_failed", "clean_text", "kept"]
    taken = {c.lower() for c in docs.columns}
    names = {w: "_" * next(k for k in range(2, 99) if "_" * k + "q_" + w.lower() not in taken) + "q_" + w for w in wanted}
    col = {w: F.col(f"`{n}`") for w, n in names.items()}

    def add(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select("*", *[c.alias(names[w]) for w, c in columns.items()])

    df = add(docs, t=whole_text(f"`{text}`"))
    df = add(
        df,
        words=F.array_remove(F.split(col["t"], WORD_BREAK), ""),
        lines=F.filter(F.split(col["t"], "\n"), lambda x: x.rlike(NOT_BLANK)),
        n_symbols=F.regexp_count(col["t"], F.lit(SYMBOLS)).cast("long"),
    )
    df = add(
        df,
        n_words=F.size(col["words"]).cast("long"),
        word_chars=F.length(F.array_join(col["words"], "")).cast("long"),
        n_dup_lines=(F.size(col["lines"]) - F.size(F.array_distinct(col["lines"]))).cast("long"),
        h1=F.transform(col["words"], lambda w: F.xxhash64(w)),
    ).drop(names["words"])
    width = 1
    while width < WINDOW:  # a window of 2w words is two windows of w
        h = col[f"h{width}"]
        left = F.greatest(F.size(h) - width, F.lit(0))
        pairs = F.zip_with(F.slice(h, 1, left), F.slice(h, width + 1, left), lambda a, b: F.xxhash64(a, b))
        df = add(df, **{f"h{2 * width}": pairs}).drop(names[f"h{width}"])
        width *= 2
    h = col["h8"]
    repeats = F.size(h) > F.size(F.array_distinct(h))
    indexed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    df = add(df, sorted=F.when(repeats, F.sort_array(indexed))).drop(names["h8"])
    s = col["sorted"]
    # Equal windows are neighbours after sorting; the places of those that have an equal neighbour, in order.
    twin = F.transform(s, lambda x, i: F.when((x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"]))
    df = add(df, at=F.sort_array(F.filter(twin, lambda x: x.isNotNull()))).drop(names["sorted"])
    at = col["at"]
    steps = F.zip_with(at, F.slice(at, 2, F.size(at)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0), lambda total, x: total + x)
    df = add(df, n_repeat_words=F.coalesce(covered, F.lit(0)).cast("long")).drop(names["at"])
    n = col["n_words"]
    df = add(df, base_failed=(n < rules.min_words) | (100 * col["n_repeat_words"] > rules.max_repeated * n))
    kept_lines = F.filter(F.split(col["t"], "\n"), lambda x: ~line_fails(x, rules))
    df = add(df, clean_text=F.when(~col["base_failed"], F.array_join(kept_lines, "\n")))
    enough = F.length(col["clean_text"]) >= F.length(col["t"]) * (1 - rules.max_lost)
    df = add(df, kept=F.coalesce(~col["base_failed"] & enough, F.lit(False)))
    # A filter on these columns would be pushed below all of the above, with every step written
    # out inside the next, and compute them over and over; none is pushed below a generator.
    told = F.struct(*[F.col(names[w]) for w in MEASURES])
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], F.inline(F.array(told))), names


def measure(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: the measures, whether it is kept, and what is left of its text."""
    df, names = judged(docs.select("doc_id", "text"), rules)
    return df.select("doc_id", *[F.col(names[w]).alias(w) for w in MEASURES])


def clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that are kept, with their cleaned text; ``n_chars``, where there is one, follows it."""
    df, names = judged(docs, rules)
    df, new = df.filter(F.col(names["kept"])), F.col(names["clean_text"])
    changed = {"text": new, "n_chars": F.length(new).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return df.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])
