import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tests.oracle import connect, differences
from tidemark.llm import checks, exact_dedup, ngram_join
from tidemark.llm.components import components


def test_exact_dedup_agrees_with_sql(spark, sf_dir):
    assert differences(checks.op6(spark, sf_dir), connect(sf_dir), checks.ORACLES["op6_exact_dedup"]) is None


def test_exact_dedup_of_awkward_rows(awkward):
    rows = awkward.select("doc_id", "text").collect()
    groups: dict = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(brute.LOW), []).append(i)
    expected = sorted(
        (str(i), str(max((x for x in ids if x is not None), default=None)), len(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items() for i in ids
    )
    got = exact_dedup.decide(awkward).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == expected
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_drop_copies_leaves_one_row_of_each_text(awkward, nothing):
    left = exact_dedup.drop_copies(awkward)
    assert left.columns == awkward.columns
    rows = left.collect()
    texts = [(r.text or "").translate(brute.LOW) for r in rows]
    assert sorted(texts) == sorted({(r.text or "").translate(brute.LOW) for r in awkward.collect()})
    assert {r.keep_id for r in rows} == {"own keep_id"}
    assert exact_dedup.drop_copies(nothing).count() == 0 and exact_dedup.decide(nothing).count() == 0


def test_heavy_groups_take_the_other_way(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "COUNTERS", 2)
    df = spark.createDataFrame([(i, "Hot" if i % 3 == 0 else f"t{i // 2}") for i in range(300)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.decide(df).collect()}
    assert got[0] == (297, 100) and got[1] == (1, 1) and got[4] == (5, 2) and len(got) == 300


@given(st.lists(st.integers(0, 30), max_size=400), st.integers(1, 8))
@settings(max_examples=60, deadline=None)
def test_misra_gries_bound(keys, size):
    counters: dict = {}
    for at in range(0, len(keys), 17):
        part = keys[at : at + 17]
        counters = exact_dedup.misra_gries(counters, {k: part.count(k) for k in part}, size)
    assert len(counters) <= size
    for k in set(keys):
        assert keys.count(k) - len(keys) / (size + 1) <= counters.get(k, 0) <= keys.count(k)


@given(st.lists(st.sets(st.integers(0, 25), min_size=1), min_size=1, max_size=14), st.sampled_from([50, 80, 85, 100]), st.booleans())
@settings(max_examples=150, deadline=None)
def test_trie_join_finds_every_link(sets, percent, split):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    sides = np.arange(len(sets)) % 2 if split else None
    sizes = np.array([len(s) for s in sets])
    for i, linked in ngram_join.trie_join(arrays, lambda i: ngram_join.least_overlap(sizes, i, percent), sides):
        wanted = [
            j for j in range(len(sets))
            if j != i and (not split or (i + j) % 2) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
        ]
        assert linked.tolist() == wanted


@given(st.lists(st.sets(st.integers(0, 40), min_size=1), min_size=2, max_size=6), st.sampled_from([50, 80, 85]))
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_enough_first_members(sets, percent):
    sizes = np.array([len(s) for s in sets])
    firsts = [set(sorted(s)[: len(s) - -(-percent * len(s) // 100) + 1]) for s in sets]
    for i in range(len(sets)):
        needed = ngram_join.least_first_overlap(sizes, i, percent)
        for j in range(len(sets)):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                assert len(firsts[i] & firsts[j]) >= needed[j]


@given(st.integers(0, 10**6), st.sampled_from([1, 3, 8, 15, 16, 17, 31, 32, 63, 64, 100, 300]), st.sampled_from([50, 70, 80, 85, 100]))
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_a_signature(seed, size, percent):
    rng = np.random.default_rng(seed)
    base, sets = np.unique(rng.integers(0, 2**64, size, np.uint64)), []
    for _ in range(5):  # members are lost, added, or both
        lost, added = (rng.integers(0, 1 + size * (100 - percent) // x) * rng.integers(0, 2) for x in (100, percent))
        sets.append(np.unique(np.concatenate([rng.permutation(base)[min(lost, len(base) - 1) :], rng.integers(0, 2**64, added, np.uint64)])))
    frequent = np.sort(rng.permutation(base)[: rng.integers(0, len(base) + 1)])
    hashes = [set() for _ in sets]
    for found, some in ngram_join.signatures(sets, percent, ngram_join.Order(frequent, rng.permutation(len(frequent)))):
        for i, h in zip(found.tolist(), some.tolist(), strict=True):
            hashes[i].add(h)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y)):
                assert hashes[i] & hashes[j]


@pytest.mark.parametrize(("n", "percent", "words"), [(4, 85, 20), (5, 80, 10)])
def test_blocks_stay_small_where_ngrams_recur_by_chance(spark, monkeypatch, n, percent, words):
    rng, largest, dealt = random.Random(5), [], ngram_join._dealt

    def measured(members, part, key):
        largest.append(members.groupBy("block").count().agg({"count": "max"}).first()[0] or 0)
        return dealt(members, part, key)

    monkeypatch.setattr(ngram_join, "_dealt", measured)
    rows = [(i, " ".join(f"w{rng.randrange(words)}" for _ in range(150))) for i in range(300)]
    rows += [(1000 + i, f"{t} another end") for i, t in rows[:20]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.join(df, n, percent).collect()}
    assert got == brute.jaccard_join(rows, n, percent)
    assert sum(x[2] for x in got.values()) == 40 and max(largest) <= 10


def test_a_copy_under_a_repeated_id_stays_with_its_near_copies(spark):
    rng = random.Random(6)
    text, other = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(100)) for _ in range(2))
    rows = [(5, text), (9, text), (9, other), (7, f"{text} end"), (1, f"{other} end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    links = sorted((r.doc_id, r.component_id, r.n_links) for r in ngram_join.join(df, 4, 85).collect())
    assert links == [(1, 1, 1), (5, 1, 2), (7, 1, 2), (9, 1, 1), (9, 1, 2)]


@pytest.mark.parametrize(("n", "percent", "part"), [(4, 85, 512), (5, 80, 2)])
def test_join_against_brute_force(spark, docs, monkeypatch, n, percent, part):
    monkeypatch.setattr(ngram_join, "PART", part)
    monkeypatch.setattr(ngram_join, "FIRST_PART", part)
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    near = []
    for i in range(40):  # a large group of near copies, in a chain of small changes
        base[rng.randrange(120)] = f"x{i}"
        near.append((10_000 + i, " ".join(base)))
    extra = spark.createDataFrame([*near, (20_000, near[5][1]), (20_001, near[5][1].upper()), (20_002, "a b"), (20_003, "A  b"), (20_004, None)], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(extra)
    expected = brute.jaccard_join([tuple(r) for r in df.collect()], n, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.join(df, n, percent).collect()}
    assert got == expected
    assert got[20_000][1] == got[20_001][1] < 20_000 and got[20_004] == (0, 20_004, 0)


def test_join_of_awkward_rows(awkward, nothing):
    got = [(r.doc_id, r.component_id, r.n_links) for r in ngram_join.join(awkward).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [
        (None, None, 0), (None, None, 0), (-1, -1, 0), (-2, -2, 0), (-3, -3, 0), (-4, -5, 1), (-5, -5, 1), (-6, -6, 1), (-6, -6, 1),
        (-7, -7, 0), (-7, -7, 0), (-8, -8, 0), (-9, -9, 0),
    ]))
    left = ngram_join.drop_near_copies(awkward)
    assert left.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["None", "None", *map(str, (-1, -2, -3, -5, -6, -7, -8, -9))])
    assert ngram_join.join(nothing).count() == 0 and ngram_join.drop_near_copies(nothing).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(7, x) for x in range(200, 260)] + [(5, 5), (3, 9), (9, 3)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 131)}, **{x: 7 for x in [7, *range(200, 260)]}, 3: 3, 9: 3}
