"""Repair of conversation structure: the cheapest edits that make turns alternate, by IDA*.

A conversation's rows are taken by turn (null first; ties by role, then by a digest of role and
text). A row's first fault counts: blank (no character but white space), duplicate (role and
text seen earlier) or truncated (last such character is not one of ``.!?``). An edit keeps a
row (0), gives it the role user or assistant (2), deletes it (3; all that blank and duplicate
rows allow) or inserts an empty turn of either role (2). A truncated row that stays adds 1. The
initials of the roles that remain must read ``(s?(ua)+)?``. Of the cheapest lists of edits the
one whose initials D, I, K, R come first in ASCII order is the answer.

1. Faults are found by DataFrame functions over narrow rows; copies by a window on digests.
2. Rows of a conversation, one byte each, are searched by iterative deepening: depth first in
   the order D, I, K, R under a bound, which grows to the least cost that went beyond it. A
   failed state (row, what may follow) is remembered with the budget that it failed on. The
   bound on what remains is 3 for each blank or duplicate row, 1 for each truncated one, and 2
   for every two neighbouring pairs of roles that may not follow one another, as no edit mends
   more than two of them.
3. The edits meet the texts in a sort by conversation, where they come first. Texts stream
   through, none is held.

A null role or text is one space. Rows with a null conversation id are one conversation. A
conversation whose rows were all dropped (``dropped``) has counts of zero and no edits. Repeated
rows are duplicates. Texts may be of any length. An empty table gives an empty result. Only
``conv_id``, ``turn``, ``role`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep

SPACES = " \t\n\x0b\x0c\r"
FORCED, TRUNCATED = 4, 8  # flags of a row beside its role: 0 to 2 for s, u and a, 3 for others
NEXT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}  # (state, role) that may follow: the state after
WANTED = (1, 1, 2, 1)  # the role, user or assistant, that each state wants; states: start, after s, after u, after a
ENDS = (True, False, False, True)


def _breaks(rows: list[int]) -> tuple[list[int], list[int]]:
    """For each place: edits that mend all pairs from there on, and the run of bad pairs that begins there.

    The pair at a place is that of the row before it and of itself; the row after the last is the end.
    """
    n = len(rows)
    edits, run = [0] * (n + 2), [0] * (n + 2)
    for at in range(n, 0, -1):
        before = rows[at - 1]
        good = before == 2 if at == n else (before, rows[at]) in ((0, 1), (1, 2), (2, 1))
        run[at] = 0 if good else run[at + 1] + 1
        edits[at] = edits[at + 1] if good else edits[at + 1 + run[at + 1]] + (run[at] + 1) // 2
    return edits, run


class Remaining:
    """The least that what follows a state can cost."""

    def __init__(self, symbols: bytes):
        n = len(symbols)
        free = [s & 3 for s in symbols if not s & FORCED]
        self.edits, self.run = _breaks(free)
        self.free = free
        self.index = [0] * (n + 1)  # of the first row from here on that may stay
        self.faults = [0] * (n + 1)
        index = len(free)
        self.index[n] = index
        for at in range(n - 1, -1, -1):
            index -= not symbols[at] & FORCED
            self.index[at] = index
            self.faults[at] = self.faults[at + 1] + (3 if symbols[at] & FORCED else 1 if symbols[at] & TRUNCATED else 0)

    def __call__(self, at: int, state: int) -> int:
        k = self.index[at]
        good = ENDS[state] if k == len(self.free) else (state, self.free[k]) in NEXT
        if good:
            return self.faults[at] + 2 * self.edits[k + 1]
        run = self.run[k + 1]
        return self.faults[at] + 2 * ((run + 2) // 2 + self.edits[k + 1 + run])


def _options(symbols: bytes, at: int, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, next row, next state), in ASCII order of edits."""
    found = []
    if at < len(symbols):
        found.append(("D", 3, at + 1, state))
    found.append(("I", 2, at, NEXT[state, WANTED[state]]))
    if at < len(symbols) and not symbols[at] & FORCED:
        role, extra = symbols[at] & 3, 1 if symbols[at] & TRUNCATED else 0
        if (state, role) in NEXT:
            found.append(("K", extra, at + 1, NEXT[state, role]))
        found.append(("R", 2 + extra, at + 1, NEXT[state, WANTED[state]]))
    return found


def search(symbols: bytes) -> tuple[int, str]:
    """Least cost, and the first of the cheapest lists of edits."""
    remaining, n = Remaining(symbols), len(symbols)
    bound = remaining(0, 0)
    while n:
        beyond = None  # the least excess over the bound
        failed: dict[int, int] = {}  # 4 * row + state: the largest budget that did not do under this bound
        path: list[str] = []
        stack = [(0, 0, bound, iter(_options(symbols, 0, 0)))]
        while stack:
            at, state, budget, options = stack[-1]
            for edit, cost, to, after in options:
                left = budget - cost
                excess = remaining(to, after) - left
                if excess > 0:
                    beyond = excess if beyond is None or excess < beyond else beyond
                elif failed.get(4 * to + after, -1) < left:
                    path.append(edit)
                    if to == n and ENDS[after]:
                        return bound - left, "".join(path)
                    stack.append((to, after, left, iter(_options(symbols, to, after))))
                    break
            else:
                failed[4 * at + state] = max(failed.get(4 * at + state, -1), budget)
                stack.pop()
                if path:
                    path.pop()
        bound += beyond
    return 0, ""


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): rows damaged by a checksum of their key, one in 20 in each of five ways."""
    number = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(number("conv_id"), F.lit(":"), number("turn"))) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)


def _placed(turns: DataFrame) -> DataFrame:
    """The columns that are read, nulls replaced, with a digest that orders rows of one turn and role."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).withColumn(
        "digest", F.unhex(_digest(F.col("role"), F.col("text")))
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows that come sorted, by their first column."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    return groupby(rows, key=lambda row: row[0])


PLAN = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _plan(rows: Iterator[tuple]) -> tuple:
    """The figures of a conversation, and its edits."""
    faults, symbols = [0] * 4, bytearray()
    first = last = before = None
    distinct = illegal = 0
    for _, turn, role, fault, dropped in rows:
        if dropped:
            continue
        faults[fault] += 1
        symbols.append(role | (FORCED if fault in (1, 2) else TRUNCATED if fault == 3 else 0))
        illegal += before is not None and (before, role) not in ((0, 1), (1, 2), (2, 1))
        before = role
        if turn is not None and turn != last:
            first, last, distinct = turn if first is None else first, turn, distinct + 1
    gaps = 0 if first is None else last - first + 1 - distinct
    return (gaps, *faults[1:], illegal, *search(bytes(symbols)))


def plans(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (initials of the edits).

    Rows whose column ``dropped`` is true only make their conversation appear.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    gone = F.coalesce(F.col(dropped), F.lit(False)) if dropped else F.lit(False)
    placed = _placed(turns.filter(~gone))
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    initial = F.substring("role", 1, 1)
    narrow = placed.select(
        "conv_id", "turn", "role", "digest", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("place"),
    )
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy(F.asc_nulls_first("turn"))) > 1
    fault = F.when(F.col("blank"), 1).when(seen, 2).when(F.col("open"), 3).otherwise(0)
    rows = narrow.select("conv_id", "turn", "place", fault.alias("fault"), F.lit(False).alias("dropped"), "role", "digest")
    if dropped:
        nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "place", "fault")]
        lost = turns.filter(gone).select("conv_id").distinct()
        rows = rows.unionByName(lost.select("conv_id", *nothing, F.lit(True).alias("dropped"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest")))
    # Of rows that are alike the first is no duplicate.
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", F.col("fault") == 2]
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "turn", "place", "fault", "dropped")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        held = 0

        def ready() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [()] * 8
            arrays = [pa.array(columns[0], dealt_type), *(pa.array(c, pa.int64()) for c in columns[1:7]), pa.array(columns[7], pa.string())]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", *PLAN, "audit"])

        dealt_type = None

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal dealt_type
            for batch in batches:
                dealt_type = batch.schema.field(0).type
                yield batch

        for conv_id, rows in _groups(noted()):
            found.append((conv_id, *_plan(rows)))
            held += 64 + len(found[-1][-1])
            if held > 1 << 20:
                yield ready()
                held = 0
        if found:
            yield ready()

    longs = ", ".join(f"{name} long" for name in PLAN)
    return dealt.mapInArrow(run, f"conv_id {kind}, {longs}, audit string")


def repaired(turns: DataFrame, plan: DataFrame, dropped: str | None = None) -> DataFrame:
    """The repaired rows (conv_id, place, edit, role, text), in order inside a partition that holds whole conversations."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    placed = _placed(turns.filter(~F.coalesce(F.col(dropped), F.lit(False))) if dropped else turns)
    texts = placed.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "digest", "text")
    nothing = [F.lit(None).cast(placed.schema[c].dataType).alias(c) for c in ("turn", "role", "digest", "text")]
    edits = plan.select("conv_id", "audit", *nothing)
    order = ["conv_id", F.asc_nulls_last("audit"), F.asc_nulls_first("turn"), "role", "digest"]
    dealt = texts.unionByName(edits).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        held, id_type = 0, None

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        def ready() -> pa.RecordBatch:
            conv_id, place, edit, role, text = zip(*found, strict=True)
            found.clear()
            texts = [pa.array(x, pa.string()) for x in (edit, role, text)]
            return pa.RecordBatch.from_arrays([pa.array(conv_id, id_type), pa.array(place, pa.int64()), *texts], ["conv_id", "place", "edit", "role", "text"])

        for conv_id, rows in _groups(noted()):
            audit = next(rows)[1]
            for place, (edit, role, text) in enumerate(_edited(audit, rows)):
                found.append((conv_id, place, edit, role, text))
                held += 64 + len(text)
                if held > 1 << 20:
                    yield ready()
                    held = 0
        if found:
            yield ready()

    return dealt.mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def _edited(audit: str, rows: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that the edits leave."""
    wanted = "user"
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)[2:]
        if edit == "D":
            continue
        role = role if edit == "K" else wanted
        yield edit, role, text
        wanted = "assistant" if role[:1] == "u" else "user"


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, sha256) of ``role:text`` of the rows of ``repaired``, joined by newlines, as they stream by."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done, id_type = None, None, [], None

        def ready() -> pa.RecordBatch:
            ids, hashes = zip(*done, strict=True)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(hashes, pa.string())], ["conv_id", "sha256"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv_id, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")), strict=True):
                if place == 0:
                    if digest:
                        done.append((now, digest.hexdigest()))
                    now, digest = conv_id, hashlib.sha256()
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            if done:
                yield ready()
        if digest:
            done.append((now, digest.hexdigest()))
            yield ready()

    return rows.mapInArrow(run, f"conv_id {kind}, sha256 string")


def repair(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """One row per conversation: the figures and edits of ``plans``, and repaired_sha256."""
    plan = keep(plans(turns, dropped))
    shas = digests(repaired(turns, plan, dropped)).select(F.col("conv_id").alias("__conv"), "sha256")
    joined = plan.join(shas, plan["conv_id"].eqNullSafe(shas["__conv"]), "left")
    return joined.select(*plan.columns, F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
