"""Spelling variants, SimHash and conversation repair against brute force."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tests.oracle import connect, differences
from tidemark.llm import checks, conversation_repair, simhash, spelling
from tidemark.llm.components import components


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_conversation_repair"])
def test_queries_agree_with_sql(spark, sf_dir, name):
    assert differences(checks.QUERIES[name](spark, sf_dir), connect(sf_dir), checks.ORACLES[name]) is None


# Spelling variants


def one_edit_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_of(words: dict, factor: int = 5) -> dict:
    near = {w: [o for o in words if one_edit_apart(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= factor * words[w] else None
    found = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        found[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return found


def got_variants(df) -> dict:
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.fixture(scope="module")
def many_words():
    rng = random.Random(7)
    words = {}
    for _ in range(120):
        base = "".join(rng.choice("abcdeéèñz") for _ in range(rng.randrange(6, 11)))
        words[base] = rng.choice([5, 30, 200, 1200])
        for _ in range(6):
            at, base_now = rng.randrange(len(base)), rng.choice([base, *list(words)[-3:]])
            new = rng.choice([base_now[:at] + base_now[at + 1 :], base_now[:at] + rng.choice("abé") + base_now[at:], base_now[:at] + "x" + base_now[at + 1 :]])
            words.setdefault(new, rng.choice([5, 6, 30, 40]))
        words.setdefault(base[::-1], 9)  # equal letter counts, another word
    words["word" * 3000] = 7
    words["word" * 3000 + "s"] = 70  # squares beyond what 32 bits hold
    return words


@pytest.mark.parametrize(("tile", "part", "groups"), [(256, 1 << 15, 4), (4, 3, 4), (16, 5, 5)])
def test_variants_against_brute_force(spark, many_words, monkeypatch, tile, part, groups):
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "PART", part)
    blocks = spelling.deal_letters
    monkeypatch.setattr(spelling, "deal_letters", lambda counts, g: blocks({}, g) if part == 3 else blocks(counts, g))
    if groups != 4:
        monkeypatch.setattr(spelling, "combinations", lambda all_, size: spelling_combinations(groups))
        monkeypatch.setattr(spelling, "deal_letters", lambda counts, g: blocks(counts, groups))
    df = spark.createDataFrame(list(many_words.items()), "word string, n long").repartition(5)
    assert got_variants(spelling.variants(df)) == variants_of(many_words)


def spelling_combinations(groups: int) -> list:
    return list(combinations(range(groups), groups - 2))


def test_one_block_of_many_words(spark, monkeypatch):
    """Words that share a block in any choice: parts and tiles lose and repeat nothing."""
    monkeypatch.setattr(spelling, "TILE", 8)
    monkeypatch.setattr(spelling, "PART", 10)
    rng = random.Random(2)
    letters = list("aabbccdd")
    words = {"".join(rng.sample(letters, 8)): rng.choice([5, 50, 500]) for _ in range(120)}
    words |= {w[:3] + "z" + w[3:]: 6 for w in list(words)[:30]} | {w[:2] + "z" + w[3:]: 7 for w in list(words)[:30]}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert got_variants(spelling.variants(df)) == variants_of(words)


@given(st.text("abé", min_size=1, max_size=7), st.text("abé", min_size=1, max_size=7))
@settings(max_examples=500, deadline=None)
def test_one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) <= 1:
        assert spelling.one_edit([a], [b]).tolist() == [one_edit_apart(a, b)]


def test_spelling_of_awkward_rows(spark, awkward, nothing):
    words = Counter()
    for i, t in awkward.select("doc_id", "text").collect():
        for run in brute.letter_runs(t):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    found = spelling.runs(awkward, 6).select(spelling.misspelt(awkward["doc_id"], spelling.F.col("run")).alias("word"))
    got = {r.word: r.n for r in spelling.vocabulary(found, 6, 1).collect()}
    assert got == {w: n for w, n in words.items() if len(w) >= 6}
    assert spelling.group_variants(nothing).count() == 0
    odd = spark.createDataFrame([(1, "Ünïcode ünïcode ÜNÏCODE unïcode" + " unïcode" * 30 + " ×÷×÷×÷"), (2, None)], "doc_id long, text string")
    got = got_variants(spelling.group_variants(odd, least_count=1))
    assert got["unïcode"] == (None, "unïcode", 31, 2, None) and got["ünïcode"] == ("unïcode", "unïcode", 1, 3 - 1, 31) and "×÷×÷×÷" in got


# SimHash


def fingerprint(text: str | None) -> int:
    words = brute.WORD.findall((text or "").translate(brute.LOW))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(prints: dict, radius: int = 3) -> dict:
    """id: least id that is reached by links of at most so many bits."""
    label = {i: i for i in prints}
    ids = sorted(prints)
    changed = True
    while changed:
        changed = False
        for i in ids:
            least = min(label[j] for j in ids if (prints[i] ^ prints[j]).bit_count() <= radius)
            if least < label[i]:
                label[i], changed = least, True
    return label


def test_simhash_of_documents(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    prints = {i: fingerprint(t) for i, t in rows}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    label = classes_of(prints)
    assert got == {i: (f"{prints[i]:016x}", label[i]) for i in prints}
    assert len(set(label.values())) < len(label)


@pytest.mark.parametrize(("radius", "cell", "pairs"), [(3, 1024, 1 << 15), (1, 4, 16), (2, 64, 16)])
def test_links_of_crowded_fingerprints(spark, monkeypatch, radius, cell, pairs):
    """Full cells are dealt again, at last to where none can be full; no link is lost."""
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    rng = random.Random(cell)
    centres = [rng.getrandbits(64) for _ in range(2)]
    prints = {0, (1 << 64) - 1}
    for _ in range(260):
        value = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            value ^= 1 << rng.choice([rng.randrange(64), rng.randrange(8)])
        prints.add(value)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fingerprint long").repartition(3)
    links = simhash.close_classes(df, radius, len(prints), cell)
    got = {r.id % (1 << 64): r.component for r in components(links).collect()}
    label = classes_of({p: p for p in prints}, radius)
    groups, wanted = {}, {}
    for p in prints:
        groups.setdefault(got.get(p, p), set()).add(p)
        wanted.setdefault(label[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2**64 - 1)), max_size=150), st.integers(0, 9))
@settings(max_examples=60, deadline=None)
def test_close_pairs(rows, radius):
    rows = sorted((c, p % 64 if p % 3 else p) for c, p in rows)
    cells, prints = np.array([c for c, _ in rows]), np.array([p for _, p in rows], np.uint64)
    found = {(int(a), int(b)) for i, j in simhash.close_pairs(prints, cells, radius) for a, b in zip(i, j, strict=True)}
    assert found == {
        (a, b) for a in range(len(rows)) for b in range(a + 1, len(rows))
        if rows[a][0] == rows[b][0] and (rows[a][1] ^ rows[b][1]).bit_count() <= radius
    }


def test_tables_leave_no_pair_out():
    rng = random.Random(1)
    for blocks in (4, 5, 6):
        masks = simhash.tables((1 << 64) - 1, blocks, 3)
        for _ in range(200):
            flips = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(not flips & m for m in masks)


def test_simhash_of_awkward_rows(spark, awkward, nothing):
    got = simhash.near_duplicates(awkward).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{fingerprint(t):016x}") for i, t in awkward.select("doc_id", "text").collect())
    where = {r.doc_id: r.component_id for r in got if r.fingerprint == "0" * 16}
    assert where == {None: None, -1: -3, -2: -3, -3: -3}
    assert all((r.component_id is None) == (r.doc_id is None) for r in got)
    assert {r.component_id for r in got if r.doc_id in (-4, -5)} == {-5} and simhash.near_duplicates(nothing).count() == 0
    hot = spark.createDataFrame([(i, "the same text here" if i % 3 else f"text {i} of its own {i * i}") for i in range(3000)], "doc_id long, text string")
    assert {r.component_id for r in simhash.near_duplicates(hot.repartition(4)).collect() if r.doc_id % 3} == {1}


# Conversation repair


def cheapest(symbols: bytes) -> tuple[int, str]:
    """Least (cost, edits) from each row and state, from the last one back."""
    states = range(4)
    rest = [(0, "") if conversation_repair.ENDS[s] else (10**9, "~") for s in states]
    for at in range(len(symbols), -1, -1):
        now = list(rest) if at == len(symbols) else [(10**9, "~")] * 4
        for _ in range(4):
            for s in states:
                options = [now[s]]
                for edit, cost, to, after in conversation_repair._options(symbols, at, s):
                    c, e = (now if to == at else rest)[after]
                    options.append((cost + c, edit + e))
                now[s] = min(options)
        rest = now
    return rest[0]


@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from([0, 0, 4, 8])), max_size=14))
@settings(max_examples=400, deadline=None)
def test_search_finds_the_first_of_the_cheapest(rows):
    symbols = bytes(role | flag for role, flag in rows)
    assert conversation_repair.search(symbols) == cheapest(symbols)


def test_bound_never_exceeds_what_remains():
    rng = random.Random(4)
    for _ in range(500):
        symbols = bytes(rng.randrange(4) | rng.choice([0, 0, 4, 8]) for _ in range(rng.randrange(10)))
        assert conversation_repair.Remaining(symbols)(0, 0) <= cheapest(symbols)[0]


def test_search_of_a_long_conversation():
    rng = random.Random(6)
    symbols = bytes((1 + i % 2 if rng.random() > 0.05 else 1) | rng.choice([0] * 8 + [4, 8]) for i in range(30_000) if rng.random() > 0.05)
    assert conversation_repair.search(symbols)[0] == cheapest_cost(symbols)


def cheapest_cost(symbols: bytes) -> int:
    now = {0: 0}
    for at in range(len(symbols) + 1):
        for _ in range(4):
            for s in list(now):
                after = conversation_repair.NEXT[s, conversation_repair.WANTED[s]]
                now[after] = min(now.get(after, 10**9), now[s] + 2)
        if at == len(symbols):
            return min(c for s, c in now.items() if conversation_repair.ENDS[s])
        new: dict = {}
        for s, c in now.items():
            for edit, cost, _, after in conversation_repair._options(symbols, at, s):
                if edit != "I":
                    new[after] = min(new.get(after, 10**9), c + cost)
        now = new


SCHEMA = "conv_id long, turn long, role string, text string"


def repaired(spark, rows: list) -> dict:
    df = spark.createDataFrame([(1, *r) for r in rows], SCHEMA).repartition(2)
    (row,) = conversation_repair.repair(df).collect()
    return row


def sha(*lines: str) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_repairs(spark):
    row = repaired(spark, [(0, "user", "Hi."), (2, "user", "More?"), (3, "assistant", "Yes.")])
    assert (row.gaps, row.illegal, row.cost, row.audit) == (1, 1, 2, "KIKK")
    assert row.repaired_sha256 == sha("user:Hi.", "assistant:", "user:More?", "assistant:Yes.")
    row = repaired(spark, [(0, "tool", "Hi."), (1, "assistant", "no end"), (1, "assistant", "no end"), (2, "user", " \n")])
    assert (row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit) == (1, 1, 1, 2, 9, "RKDD")
    assert row.repaired_sha256 == sha("user:Hi.", "assistant:no end")
    row = repaired(spark, [(None, "system", "S."), (None, None, None), (0, "user", "a\n.")])
    assert (row.gaps, row.blank, row.audit, row.cost) == (0, 1, "DKKI", 5) and row.repaired_sha256 == sha("system:S.", "user:a\n.", "assistant:")


def test_repair_of_awkward_conversations(spark):
    long = "word " * 300_000 + "."
    rows = [(None, 0, "user", "x."), (None, 1, "assistant", "y."), (5, 0, "user", long), (5, 1, "assistant", "É é ß 日本."), (6, 0, "user", "")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'own' AS `{c}`" for c in ("audit", "cost", "digest", "sha256", "fault", "place", "dropped", "copy")])
    got = {r.conv_id: r for r in conversation_repair.repair(df).collect()}
    assert got[None].repaired_sha256 == sha("user:x.", "assistant:y.") and got[5].repaired_sha256 == sha("user:" + long, "assistant:É é ß 日本.")
    assert (got[6].audit, got[6].cost, got[6].repaired_sha256) == ("D", 3, sha()) and len(got) == 3
    assert conversation_repair.repair(df.limit(0)).count() == 0
    gone = df.select("conv_id", "turn", "role", "text").withColumn("dropped", df["conv_id"].isNull())
    (row,) = [r for r in conversation_repair.repair(gone, "dropped").collect() if r.conv_id is None]
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", sha())
    assert [c for c in conversation_repair.damage(df).columns] == ["conv_id", "turn", "role", "text", "dropped"]


def test_damage(spark):
    rows = [(c, t, "assistant", f"Is it? {c} {t}!") for c in range(20) for t in range(10)] + [(3, None, None, None)]
    got = Counter(tuple(r) for r in conversation_repair.damage(spark.createDataFrame(rows, SCHEMA)).collect())
    wanted = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: text.translate({46: None, 33: None, 63: None})}.get(kind, text)
        wanted[c, t, "user" if kind == 4 else role, text, kind == 0] += 2 if kind == 3 else 1
    assert got == wanted


def test_repaired_rows(spark):
    df = spark.createDataFrame([(9, 0, "assistant", "a."), (9, 1, "user", "b"), (9, 1, "user", "c."), (8, 0, "user", "d.")], SCHEMA)
    rows = conversation_repair.repaired(df, conversation_repair.plans(df)).collect()
    assert [(r.place, r.edit, r.role, r.text) for r in rows if r.conv_id == 8] == [(0, "K", "user", "d."), (1, "I", "assistant", "")]
    nine = [(r.role, r.text) for r in rows if r.conv_id == 9]
    assert [x for x, _ in nine] == ["user", "assistant"] * (len(nine) // 2) and nine
