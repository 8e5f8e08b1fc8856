import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_text import check_packing
from tidemark.llm import packing, quality_rules, sharding
from tidemark.llm.common import keep


def check_shards(rows, texts: list):
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    counts, slots = Counter(r.shard for r in rows), defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert max(counts.values()) - (min(counts.values()) if len(counts) == 16 else 0) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(counts) <= set(range(16))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts
    )
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


def test_sharding(spark, docs, awkward, nothing):
    for df in (docs, awkward):
        check_shards(sharding.shard(df).collect(), [tuple(r) for r in df.select("doc_id", "text").collect()])
    assert sharding.shard(nothing).count() == 0


def test_equal_texts_stay_together(spark):
    texts = [(i, "hot" if i % 3 == 0 else f"t{i // 5}" if i % 5 < 3 else f"own {i}") for i in range(1600)]
    rows = sharding.shard(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()
    check_shards(rows, texts)
    where = defaultdict(set)
    for r in rows:
        where[dict(texts)[r.doc_id]].add(r.shard)
    small = [s for t, s in where.items() if t[0] == "t"]
    assert sum(len(s) > 1 for s in small) <= 0.03 * len(small)
    assert len(where["hot"]) < 16  # a third of all rows fills more than five shards


def test_links_are_cut_less_than_by_hash(spark):
    links = [(10 * k + i, 10 * k + i + 1) for k in range(100) for i in range(9)]  # paths of ten
    labels = {r.row: r.label for r in sharding.propagate(spark.createDataFrame(links, "a long, b long"), 1000 / 16 * 2).collect()}
    assert sum(labels[a] != labels[b] for a, b in links) < 0.6 * len(links)


@pytest.fixture(scope="module")
def stages(spark, sf_dir, docs):
    """What each stage of the pipeline got and gave."""
    now, found = docs, []
    for name, stage in corpus_pipeline.STAGES:
        after = keep(stage(spark, now, sf_dir))
        found.append((name, now, after))
        now = after
    return found


def test_stages_keep_columns_and_clean_documents(spark, sf_dir, docs, stages):
    assert [n for n, _, _ in stages] == ["quality classifier", "quality rules", "exact dedup", "n-gram Jaccard join", "packing"]
    assert all(after.columns == docs.columns for _, _, after in stages[:-1])
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()}
    kept = {r.doc_id for r in stages[0][2].collect()}
    there = {r.doc_id for r in docs.collect()} & good
    assert len(there & kept) >= 0.98 * len(there)


def test_rules_stage(stages):
    _, before, after = stages[1]
    wanted = {r.doc_id: r.clean_text for r in quality_rules.measure(before).filter("kept").collect()}
    assert {r.doc_id: r.text for r in after.collect()} == wanted
    assert {r.doc_id for r in before.collect() if brute.measures(r.text)[-1]}.isdisjoint(wanted)


def test_dedup_stages(stages):
    _, before, after = stages[2]
    last: dict = {}
    for r in before.collect():
        key = r.text.translate(brute.LOW)
        last[key] = max(last.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(last.values())
    _, before, after = stages[3]
    groups = brute.jaccard_join([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c, _ in groups.values()})


def test_packing_stage(stages):
    _, before, after = stages[4]
    check_packing(after.collect(), {r.doc_id: r.text for r in before.collect()})
    assert packing.CAPACITY == 2048 and public_tokenizers.path("word_bpe_49k.json")
