"""N-gram Jaccard join: which documents share enough of their word n-grams.

A document's set holds the 64-bit hashes of its distinct n-grams of words (A-Z lower-cased);
with fewer words the whole sequence is its one member; without words the set is empty and
linked with nothing. Two documents link when 100 * |intersection| >= percent * |union|.

1. Equal sets are one class, which is compared once; its copies share the result.
2. Sets are cut into segments by ranges of the hash, as many for all sizes of a band (a power
   of two to the next). Two sets that link differ by so few members that some segment is the
   same in both; of the segments in an order from strong (many n-grams that are not frequent)
   to weak, the strongest such one is among the first of either set, one more than they can
   differ by. Only these are shuffled, as hashes. A set takes part in its own band and in that
   of larger sets it can link with. Classes with a segment in common form a star; connected
   stars are blocks, and no link leaves a block. A segment holds several n-grams, so that
   unlike texts rarely share one, however large the corpus is.
3. All n-grams have one global order: those that are not frequent by hash, then the frequent
   ones by count. Two sets that link share one of their first |x| - ceil(percent * |x| / 100)
   + 1 members, and more if their sizes are near: the larger one, x, loses at most
   |x| - least overlap of them, so they share all the others. Blocks are made anew of the
   classes that share so many; a passage alone joins none. Where segments would be of an
   n-gram or less (small sets, low thresholds), first members take their place in step 2.
4. Inside a block sets are ordered from frequent to rare and walked as a trie: sets with a
   common beginning share its partial overlaps, and a walk ends where no other set can reach
   its threshold with what remains. Steps 3 and 4 walk the same trie, over first members and
   over whole sets. Large blocks are cut into parts, and every pair of parts is a task.

The list of frequent n-grams has a fixed size. It only sets the order, hence the cost, never
the result. A null text is an empty one. Rows that repeat an id are one document: their
classes are joined. A row with a null id is linked with nothing and has no component. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import IS_SPACE, LOWER, byte_slices, keep, mix, only_in, passing, range_hashes, runs, sieve, sieve_bits, trimmed, unused
from tidemark.llm.components import components

FREQUENT = 1 << 18  # n-grams that are ordered by their count: 2 MB to every task
COUNTED = 1 << 21  # n-grams whose repetitions are counted together
PART = 512  # sets of a block that one task holds of either side
FIRST_PART = 4096  # the same where only first members are held
SIGNED = 1 << 17  # n-grams that are cut into segments together
LEAST_BAND = 4  # sets of 2 ** LEAST_BAND members and more are cut into segments
LEAST_PERCENT = 70  # and only for such thresholds; else segments would have few members
SPARE = 4  # one more segment for so many that are needed: the weakest are left out
_MULTIPLIER = np.uint64(0xD1342543DE82EF95)


def ngram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    for data, offsets in byte_slices(texts):
        starts, ends, first = runs(~IS_SPACE[data], offsets)
        words = range_hashes(LOWER[data], starts, ends)
        count = max(0, len(words) - n + 1)
        grams = np.full(count, n, np.uint64)
        for k in range(n):
            grams = mix(grams * _MULTIPLIER + words[k : k + count])
        for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if end - begin >= n:
                yield np.unique(grams[begin : end - n + 1])
            elif end > begin:
                whole = np.full(1, end - begin, np.uint64)
                for word in words[begin:end]:
                    whole = mix(whole * _MULTIPLIER + word)
                yield whole
            else:
                yield np.zeros(0, np.uint64)


def _signature(members: np.ndarray) -> bytes:
    return blake2b(members.tobytes(), digest_size=16).digest()


def _halves(signatures: list[bytes]) -> list[pa.Array]:
    pairs = np.frombuffer(b"".join(signatures), np.int64).reshape(-1, 2)
    return [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]


def _profile(n: int):
    """Rows of two kinds: 0 a document's signature and size, 1 an n-gram that repeats in a task, with its count."""
    names = ["kind", "doc_id", "s1", "s2", "n"]

    def repeated(waiting: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (np.zeros(0, np.uint64),) * 2
        found, counts = found[counts > 2], counts[counts > 2].astype(np.int64)
        nulls, zeros = pa.nulls(len(found), pa.int64()), pa.array(np.zeros(len(found), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.ones(len(found), np.int32)), nulls, pa.array(found.view(np.int64)), zeros, pa.array(counts)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            signatures, sizes = [], []
            for members in ngram_sets(batch.column(1), n):
                signatures.append(_signature(members))
                sizes.append(len(members))
                waiting.append(members)
                held += len(members)
                if held >= COUNTED:
                    yield repeated(waiting)
                    waiting, held = [], 0
            kind = pa.array(np.zeros(len(sizes), np.int32))
            yield pa.RecordBatch.from_arrays([kind, batch.column(0), *_halves(signatures), pa.array(sizes, pa.int64())], names)
        yield repeated(waiting)

    return run


class Order:
    """The global order of n-grams: ``grams``, which are frequent, by hash, and their places by count."""

    def __init__(self, grams: np.ndarray, place: np.ndarray):
        self.grams, self.place = grams, place
        self.known = np.zeros(1 << 22, bool)
        self.known[(grams >> np.uint64(42)).astype(np.int64)] = True

    def frequent(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the members are frequent, and where they stand in the list."""
        maybe = np.flatnonzero(self.known[(members >> np.uint64(42)).astype(np.int64)])
        at = np.searchsorted(self.grams, members[maybe])
        at[at == len(self.grams)] = 0
        same = self.grams[at] == members[maybe] if len(self.grams) else np.zeros(len(maybe), bool)
        return maybe[same], at[same]

    def first(self, members: np.ndarray, percent: int) -> np.ndarray:
        """The first members of a set, one more than it can lose to a set that it links with."""
        length = len(members) - -(-percent * len(members) // 100) + 1
        maybe, at = self.frequent(members)
        chosen = np.delete(members, maybe)[:length]
        if len(chosen) < length:
            common = maybe[np.argsort(self.place[at])]
            chosen = np.concatenate([chosen, members[common[: length - len(chosen)]]])
        return chosen


def _bits(sizes: np.ndarray) -> np.ndarray:
    return np.frexp(sizes.astype(np.float64))[1] - 1


def differing(sizes: np.ndarray, percent: int) -> np.ndarray:
    """At most so many members are in only one of two sets that link and have ``sizes`` members in all."""
    return sizes * (100 - percent) // (100 + percent)


def _segments(members: np.ndarray, of: np.ndarray, rare: np.ndarray, band: np.ndarray, some: np.ndarray, count: np.ndarray):
    """(set, hash) of the strongest segments of sets, ``some`` for each, of ``count`` that it is cut into."""
    place = (members >> np.uint64(32)) * count[of].astype(np.uint64) >> np.uint64(32)
    starts = np.flatnonzero(np.diff(of, prepend=-1).astype(bool) | np.diff(place, prepend=np.uint64(0)).astype(bool))
    set_of, place = of[starts], place[starts]
    key = mix((band[set_of].astype(np.uint64) << np.uint64(32)) + place)
    hashes = mix(np.add.reduceat(members, starts) * _MULTIPLIER + key)
    strength = np.minimum(np.add.reduceat(rare, starts), 255) << 8 | np.minimum(np.diff(starts, append=len(members)), 255)
    order = np.argsort((set_of.astype(np.uint64) << np.uint64(32)) + (65535 - strength).astype(np.uint64), kind="stable")
    begins = np.searchsorted(set_of, np.arange(len(count) + 1))
    rank = np.arange(len(order)) - begins[set_of]  # sets stay in their order
    chosen = order[rank < some[set_of]]
    yield set_of[chosen], hashes[chosen]
    # Empty segments are the weakest, and as good as others in what is proven of them.
    for i in np.flatnonzero(np.diff(begins) < some).tolist():
        empty = np.setdiff1d(np.arange(count[i]), place[begins[i] : begins[i + 1]].astype(np.int64))[: some[i] - (begins[i + 1] - begins[i])]
        yield np.full(len(empty), i), mix(mix((np.uint64(band[i]) << np.uint64(32)) + empty.astype(np.uint64)))


def signatures(sets: list[np.ndarray], percent: int, order: Order) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(set, hash): two sets that link have a hash in common. Sets are not empty."""
    sizes = np.array([len(x) for x in sets])
    largest = sizes * 100 // percent  # that a set can link with
    last = _bits(largest)
    cut = np.full(len(sets), LEAST_BAND if percent >= LEAST_PERCENT else 64)  # from this band on
    for i in np.flatnonzero(_bits(sizes) < cut).tolist():
        chosen = order.first(sets[i], percent)
        yield np.full(len(chosen), i), chosen
    for up in range(int((last - _bits(sizes)).max(initial=-1)) + 1):
        band = _bits(sizes) + up
        at = np.flatnonzero((band <= last) & (band >= cut))
        if not len(at):
            continue
        members, of = np.concatenate([sets[i] for i in at]), np.repeat(np.arange(len(at)), sizes[at])
        rare = np.ones(len(members), np.int64)
        rare[order.frequent(members)[0]] = 0
        limit = (2 << band[at]) - 1
        some = differing(sizes[at] + np.minimum(largest[at], limit), percent) + 1
        most = differing(2 * limit, percent) + 1
        for found, hashes in _segments(members, of, rare, band[at], some, most + most // SPARE):
            yield at[found], hashes


def _signed(n: int, percent: int, frequent):
    """(sig, s1) of every set: hashes of which linked sets share one; of equal sets in a task only the first counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = Order(*frequent.value), set()
        waiting, names, held = [], [], 0

        def signed() -> pa.RecordBatch:
            found, hashes = (np.concatenate(x) for x in zip(*signatures(waiting, percent, order), strict=True))
            columns = [pa.array(hashes.view(np.int64)), pa.array(np.array(names, np.int64)[found])]
            waiting.clear()
            names.clear()
            return pa.RecordBatch.from_arrays(columns, ["sig", "s1"])

        for batch in batches:
            for members in ngram_sets(batch.column(0), n):
                signature = _signature(members)
                if not len(members) or signature in seen:
                    continue
                seen.add(signature)
                waiting.append(members)
                names.append(np.frombuffer(signature, np.int64)[0])
                held += len(members)
                if held >= SIGNED:
                    yield signed()
                    held = 0
        if waiting:
            yield signed()

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sig, s1) sorted by sig: (a, b), every class with one of those that share a hash with it."""
    last, centre = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        sigs, nodes = (batch.column(i).to_numpy() for i in range(2))
        starts = np.flatnonzero(np.append(True, sigs[1:] != sigs[:-1]))
        least = np.minimum.reduceat(nodes, starts)
        if sigs[0] == last:
            least[0] = centre
        last, centre = sigs[-1], least[-1]
        b = np.repeat(least, np.diff(starts, append=len(nodes)))
        pairs = np.flatnonzero(nodes != b)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[pairs]), pa.array(b[pairs])], ["a", "b"])


def _firsts(n: int, percent: int, frequent, wanted):
    """(s1, s2, n, grams) of the sets whose ids pass the sieve: first members; of equal sets in a task only the first counts.

    The sieve is here and not a function of its own, which would be another Python worker of each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = Order(*frequent.value), set()
        for batch in batches:
            found, sizes, chosen = [], [], []
            for members in ngram_sets(batch.column(1).filter(passing(wanted.value, batch.column(0))), n):
                signature = _signature(members)
                if not len(members) or signature in seen:
                    continue
                seen.add(signature)
                found.append(signature)
                sizes.append(len(members))
                chosen.append(order.first(members, percent).view(np.int64))
            if found:
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in chosen])])
                grams = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(chosen)))
                yield pa.RecordBatch.from_arrays([*_halves(found), pa.array(sizes, pa.int64()), grams], ["s1", "s2", "n", "grams"])

    return run


def least_overlap(sizes: np.ndarray, i: int, percent: int) -> np.ndarray:
    """What each set must have in common with set ``i`` to link with it."""
    return -(-percent * (sizes + sizes[i]) // (100 + percent))


def least_first_overlap(sizes: np.ndarray, i: int, percent: int) -> np.ndarray:
    """The same for first members: the larger set's, without those it may lose."""
    larger = np.maximum(sizes, sizes[i])
    needed = np.maximum(1, least_overlap(sizes, i, percent) + percent * -larger // 100 + 1)
    near = 100 * np.minimum(sizes, sizes[i]) >= percent * larger
    return np.where(near, needed, np.iinfo(np.int64).max)


def trie_join(
    sets: list[np.ndarray], needed: Callable[[int], np.ndarray], sides: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray]]:
    """Of each set, the other sets that have at least ``needed`` in common with it (only of
    the other side, where sides are given)."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets])
    members, of = np.concatenate(sets), np.repeat(np.arange(count), sizes)
    _, member, frequency = np.unique(members, return_inverse=True, return_counts=True)
    # A member of one set only can't add to an overlap. The others are numbered from frequent to rare.
    place = np.empty(len(frequency), np.int64)
    place[np.argsort(-frequency, kind="stable")] = np.arange(len(frequency))
    shared = frequency[member] > 1
    places, of = place[member[shared]], of[shared]
    by_place = np.argsort(places, kind="stable")
    lists = of[by_place]  # the sets that hold each member, list after list
    begins = np.searchsorted(places[by_place], np.arange((frequency > 1).sum() + 1))
    by_set = np.lexsort((places, of))
    cuts = np.searchsorted(of[by_set], np.arange(count + 1))
    paths = [places[by_set[cuts[i] : cuts[i + 1]]] for i in range(count)]
    reach = np.diff(cuts)
    stack: list[tuple[int, np.ndarray]] = [(0, np.zeros(count, np.int64))]  # depth in the trie, overlaps up to there
    before = np.zeros(0, np.int64)
    for i in sorted(range(count), key=lambda i: paths[i].tolist()):
        path = paths[i]
        least = min(len(path), len(before))
        differ = np.flatnonzero(path[:least] != before[:least])
        common = int(differ[0]) if len(differ) else least
        while stack[-1][0] > common:
            stack.pop()
        depth, overlap = stack[-1]
        least_common = needed(i)
        other = np.ones(count, bool) if sides is None else sides != sides[i]
        other[i] = False
        step = common if common > depth else len(path)
        while True:
            possible = other & (overlap + np.minimum(len(path) - depth, reach - overlap) >= least_common)
            if depth == len(path) or not possible.any():
                break
            if depth >= common:
                step = min(len(path), depth + 64)
            run = path[depth:step]
            lengths = begins[run + 1] - begins[run]
            at = np.repeat(begins[run] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            overlap = overlap + np.bincount(lists[at], minlength=count)
            depth = step
            stack.append((depth, overlap))
        before = path[:depth]  # beyond, nothing is stored that could be shared
        yield i, np.flatnonzero(possible & (overlap >= least_common))


def _merge(label: np.ndarray, linked: np.ndarray, i: int) -> None:
    near = np.unique(label[np.append(linked, i)])
    if len(near) > 1:
        label[np.isin(label, near)] = near[0]


def _by_task(solve: Callable[[list[dict]], pa.RecordBatch]):
    """Hand the rows of each task (block, left, right), which come sorted, to ``solve``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["block"], row["left"], row["right"])
                if key != group and rows:
                    yield solve(rows)
                    rows = []
                group = key
                rows.append(row)
        if rows:
            yield solve(rows)

    return run


def _sides(rows: list[dict]) -> np.ndarray | None:
    return np.array([r["side"] for r in rows]) if rows and rows[0]["left"] != rows[0]["right"] else None


def _refine(percent: int):
    """Classes with their first members: the least class each hangs together with."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        sizes, ids = np.array([r["n"] for r in rows]), np.array([r["s1"] for r in rows])
        label = ids.copy()
        firsts = [np.unique(np.array(r["grams"], np.int64)) for r in rows]
        for i, linked in trie_join(firsts, lambda i: least_first_overlap(sizes, i, percent), _sides(rows)):
            _merge(label, linked, i)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(label)], ["a", "b"])

    return _by_task(solve)


def _verify(n: int, percent: int):
    """Texts of a block: the links of every class, and the least class it hangs together with."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        sets, kept, seen = [], [], set()
        for row, members in zip(rows, ngram_sets(pa.array([r["text"] for r in rows], pa.large_string()), n), strict=True):
            signature = _signature(members)
            s1, s2 = np.frombuffer(signature, np.int64).tolist()
            # Another text under a repeated id, or a repeated row.
            if (s1, s2) != (row["s1"], row["s2"]) or signature in seen:
                continue
            seen.add(signature)
            sets.append(members)
            kept.append(row)
        sides = _sides(kept)
        weights = np.array([r["size"] for r in kept])
        ids = np.array([r["rep"] for r in kept])
        label, links = ids.copy(), np.zeros(len(kept), np.int64)
        lengths = np.array([len(x) for x in sets])
        for i, linked in trie_join(sets, lambda i: least_overlap(lengths, i, percent), sides) if kept else ():
            links[i] = weights[linked].sum()
            _merge(label, linked, i)
        columns = [[r["s1"] for r in kept], [r["s2"] for r in kept], ids.tolist(), label.tolist(), links.tolist()]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["s1", "s2", "rep", "root", "links"])

    return _by_task(solve)


def _dealt(members: DataFrame, part: int, key: str) -> DataFrame:
    """Members (with a block) as rows of tasks: every pair of a block's parts meets in one."""
    sizes = members.groupBy("block").count().filter("count > 1")
    parts = F.when(F.col("count") > 2 * part, F.ceil(F.col("count") / part)).otherwise(1).cast("int")
    placed = members.join(sizes, "block").withColumn("parts", parts).drop("count")
    return placed.withColumn("side", F.pmod(F.xxhash64(key), F.col("parts")).cast("int"))


def _tasks(placed: DataFrame, *columns: str) -> DataFrame:
    both = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tasks = both.select("block", F.least("side", "with").alias("left"), F.greatest("side", "with").alias("right"), "side", *columns)
    return tasks.repartition("block", "left", "right").sortWithinPartitions("block", "left", "right")


def join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, n_links (documents it links with)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = keep(texts.mapInArrow(trimmed(_profile(n)), "kind int, doc_id long, s1 long, s2 long, n long"), "kind")
    rows = profile.filter("kind = 0").select("doc_id", "s1", "s2", "n")
    classes = keep(
        rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"))
    )
    top = (
        profile.filter("kind = 1").groupBy(F.col("s1").alias("gram")).agg(F.sum("n").alias("count"))
        .orderBy(F.desc("count"), "gram").limit(FREQUENT).toArrow()
    )
    grams, counts = top["gram"].to_numpy().view(np.uint64), top["count"].to_numpy()
    by_hash = np.argsort(grams)
    place = np.empty(len(grams), np.int32)
    place[np.lexsort((grams, counts))] = np.arange(len(grams))
    frequent = spark.sparkContext.broadcast((grams[by_hash], place[by_hash]))

    named = texts.filter("doc_id IS NOT NULL")

    def blocks_of(edges: DataFrame) -> DataFrame:
        """Classes by half of their signature: those that agree in it are only compared together."""
        return components(edges).select(F.col("id").alias("s1"), F.col("component").alias("block"))

    signed = named.select("text").mapInArrow(trimmed(_signed(n, percent, frequent)), "sig long, s1 long")
    met = signed.repartition("sig").sortWithinPartitions("sig").mapInArrow(trimmed(_stars), "a long, b long")
    wide = keep(_dealt(keep(blocks_of(met.distinct()).join(classes.drop("size"), "s1")), FIRST_PART, "s1"))
    h, wanted = sieve_bits(spark, wide.select(F.col("rep").alias("doc_id")))
    firsts = named.select(h, "text").mapInArrow(trimmed(_firsts(n, percent, frequent, wanted)), "s1 long, s2 long, n long, grams array<long>")
    share = _tasks(firsts.join(wide, ["s1", "s2"]), "s1", "n", "grams")
    blocks = blocks_of(share.mapInArrow(trimmed(_refine(percent)), "a long, b long").filter("a <> b").distinct())
    members = blocks.join(classes, "s1")
    placed = keep(_dealt(keep(members), PART, "rep"))
    candidates = named.filter(sieve(named, placed.select(F.col("rep").alias("doc_id"))))
    with_text = candidates.join(placed, candidates["doc_id"] == placed["rep"]).drop("doc_id")
    verified = _tasks(with_text, "s1", "s2", "rep", "size", "text").mapInArrow(
        trimmed(_verify(n, percent)), "s1 long, s2 long, rep long, root long, links long"
    )
    linked = keep(verified)

    # Classes that share a repeated id belong together.
    ids = rows.join(classes, ["s1", "s2"]).groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a"), F.count("*").alias("times"))
    several = ids.filter("a <> b").select("doc_id", "b")
    repeated = rows.join(classes, ["s1", "s2"]).join(several, "doc_id").select(F.col("rep").alias("a"), "b")
    edges = linked.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(repeated)
    named_by = components(edges).select(F.col("id").alias("rep"), "component")
    links = linked.groupBy("s1", "s2").agg(F.sum("links").alias("links"))
    shown = classes.join(links, ["s1", "s2"], "left").join(named_by, "rep", "left").select(
        "s1", "s2", F.coalesce("component", "rep").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
    )
    return rows.join(shown, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
    )


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents that name their component, with all their columns; of rows that repeat an id, the least text."""
    decisions = keep(join(docs, n, percent).select("doc_id", "component_id"))
    # Without words a document is linked with nothing, even with another row of its id.
    dropped = decisions.filter("doc_id <> component_id").select("doc_id")
    repeated = keep(decisions.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    rest = only_in(docs, dropped.unionByName(repeated), "left_anti")
    doubtful = only_in(only_in(docs, repeated, "left_semi"), dropped, "left_anti")
    place, first = unused(docs, "__place"), Window.partitionBy("doc_id").orderBy("text")
    return rest.unionByName(doubtful.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1).drop(place))
