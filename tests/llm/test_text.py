import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import brute
from tests.oracle import connect, differences
from tidemark.llm import chat, checks, packing, quality_model, quality_rules, sentencepiece_codec, toxicity, word_scoring
from tidemark.llm.common import labelled_sample
from tidemark.llm.prefix_table import Encoder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = "aabcd  ▁\n\t.,'A1éÉ日🧿\x00</s>[INST]theing|%\\"


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_encoder_agrees_with_the_library(encoder, library):
    rng = random.Random(5)
    pool = [p.replace("▁", " ") for p in encoder.vocabulary.ids]
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(9))) for _ in range(4000)] + [" " * k + "x" for k in range(70)]
    for text in texts:
        ids = library.encode(text)
        assert encoder.encode(text) == ids and encoder.decode(ids) == library.decode(ids), repr(text)


@given(st.lists(st.integers(3, 31_999), max_size=12))
@settings(max_examples=200, deadline=None)
def test_decoder_of_any_ids(encoder, library, ids):
    assert encoder.decode(ids) == library.decode(ids)


def test_codec_query(spark, sf_dir, docs, library, awkward, nothing):
    got = {r.doc_id: r for r in checks.op4(spark, sf_dir).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = library.encode(text)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    coded = sentencepiece_codec.encode_decode(awkward, PIECES).collect()
    texts = {str(r.doc_id): {t or "" for i, t in awkward.select("doc_id", "text").collect() if i == r.doc_id} for r in coded}
    assert len(coded) == awkward.count() and all(r.decoded in texts[str(r.doc_id)] for r in coded)
    assert all((r.ids == []) == (r.decoded == "") for r in coded)
    assert sentencepiece_codec.encode_decode(nothing, PIECES).count() == 0


def check_packing(pieces, texts: dict):
    tokenizer = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(by_doc) == set(texts)
    for doc_id, found in by_doc.items():
        ids = np.array(tokenizer.encode(texts[doc_id], add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(found, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and bytes(p.ids) == ids[at : at + p.length].tobytes()
            at += p.length
        assert at == len(ids)
    padding = 0
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding


def test_packing(spark, docs, awkward, nothing):
    pieces = packing.pack(docs, WORDS).collect()
    padding = check_packing(pieces, dict(tuple(r) for r in docs.select("doc_id", "text").collect()))
    assert padding < 0.005 * sum(p.length for p in pieces)
    single = awkward.filter("doc_id NOT IN (-6, -7)")  # ids that come once
    check_packing(packing.pack(single, WORDS).collect(), {i: t or "" for i, t in single.select("doc_id", "text").collect()})
    assert packing.pack(awkward, WORDS).filter("start = 0").count() == awkward.count()
    assert packing.pack(nothing, WORDS).count() == 0


def test_word_tokenizer_agrees_with_the_library():
    own, library, rng = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS), random.Random(2)
    alphabet = ODD + "'s't'LL\x1c\x85\xa0　İΣς"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(4000)] + ["", None, "<|endoftext|> x", "x" * 5000]
    texts += ["".join(rng.choice("abzÀÉÖØßàéöøÿÞ×÷ºª 1'sS,.") for _ in range(rng.randrange(40))) for _ in range(4000)]
    for text in texts:
        assert np.frombuffer(own.encode(text or ""), "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_memories_are_bounded(encoder):
    """Long words are not remembered, however many come."""
    own = packing.WordTokenizer(WORDS)
    long = [f"{i:06}" * 700 for i in range(50)]
    for text in long:
        own.encode(text), own.encode("日" + text), encoder.encode(text)
    assert max(map(len, [*own.words, *own.pieces]), default=0) <= 64 and max(map(len, encoder.memory), default=0) <= 64
    small = packing._Memory(lambda key: key, 3)
    assert [small[str(i)] for i in range(20)] == [str(i) for i in range(20)] and len(small) + len(small.older) <= 6


@given(st.lists(st.text(max_size=20), max_size=30), st.integers(1, 40))
def test_chunks_are_bounded_by_bytes(texts, limit):
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    parts = list(packing.chunks(batch, limit))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len(t.encode()) for t in p.column(1).to_pylist()) <= limit for p in parts)


@given(st.integers(1, 20_000))
def test_cuts_are_whole_and_short(length):
    parts = packing.cut(length)
    assert sum(parts) == length and max(parts) <= 2048 and len(parts) <= length // 2048 + 6


@given(st.lists(st.integers(1, 2048), max_size=300))
@settings(deadline=None)
def test_bins_hold_a_fixed_count_of_their_class(lengths):
    bins, full = packing.HarmonicBins(), []
    for i, n in enumerate(lengths):
        done = bins.add((i, 0, n))
        if done:
            assert {2048 // p[-1] for p in done} == {len(done)} and sum(p[-1] for p in done) <= 2048
            full += done
    rest = list(bins.rest())
    assert sum(p[-1] for p in full) + sum(p[-1] for b in rest for p in b) == sum(lengths)
    assert all((n := sum(p[-1] for p in b)) & (n - 1) == 0 for b in rest)


def test_quality_measures_against_brute_force(docs, awkward, nothing):
    for df in (docs, awkward):
        got = quality_rules.measure(df).collect()
        assert sorted(
            (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got
        ) == sorted((str(r.doc_id), *brute.measures(r.text)) for r in df.collect())
        assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.measure(nothing).count() == 0 and quality_rules.clean(nothing).count() == 0


def test_quality_rules_agree_with_sql(spark, sf_dir):
    assert differences(checks.op3(spark, sf_dir), connect(sf_dir), checks.ORACLES["op3_quality_rules"]) is None


def test_a_filter_on_the_verdict_computes_nothing_anew(docs):
    plan = quality_rules.measure(docs).filter("kept AND n_words > 30")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 3


def test_lines_that_fail_go_and_bad_documents_with_them(spark):
    good = "This line has quite enough words to be an ordinary sentence of a text."
    other = "Another one goes on about something else, and it ends with a mark as well."
    third = "Nothing in here was said before, so the three of them make a document."
    texts = {
        1: "\n".join([good, other, *(f"Home {i} | About | Contact {i} | Help | Shop | Cart" for i in range(9))]),
        2: "\n".join([good, other, "Menu", "We use cookies, see our Cookie Policy here please.", third]),
        3: "\n".join([good, "", third]), 4: None, 5: good,
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    got = {r.doc_id: r for r in quality_rules.measure(df).collect()}
    assert [got[i].kept for i in texts] == [False, True, True, False, False]  # 1 loses more than half of its text, 5 is short
    assert got[1].clean_text == f"{good}\n{other}" and got[2].clean_text == f"{good}\n{other}\n{third}" and got[3].clean_text == texts[3]
    assert [r.doc_id for r in quality_rules.clean(df, quality_rules.LineRules(max_lost=0.9)).collect()] == [1, 2, 3]


def test_clean_keeps_all_columns(awkward):
    left = quality_rules.clean(awkward.withColumn("text", awkward["text"]), quality_rules.LineRules(min_words=3))
    assert left.schema.names == awkward.columns
    rows = left.collect()
    assert {r.n_words for r in rows} == {"own n_words"} and all(r.n_chars == len(r.text) for r in rows)


def test_chat_agrees_with_sql(spark, sf_dir):
    assert differences(checks.op5(spark, sf_dir), connect(sf_dir), checks.ORACLES["op5_chat_formatting"]) is None


def test_chat_reads_back_awkward_turns(spark):
    marks = [*chat.Template().controls, "\\", "\n", "<", "|", "im_end", ">", "é🧿", " "]
    rng = random.Random(1)
    turns = [(c, t, rng.choice(["user", "assistant", "system", "x\ny<|im_end|>\\", None]), rng.choice([None, *["".join(rng.choices(marks, k=9)) for _ in range(6)]]))
             for c in (1, 2, None) for t in (0, 1, 2, 2, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    rendered = chat.render(df).cache()
    got = {r.conv_id: r for r in chat.read_back(rendered, keep=("valid", "formatted", "segments")).collect()}
    for conv in (1, 2, None):
        own = sorted((t is not None, t or 0, r or "", x or "") for c, t, r, x in turns if c == conv)
        assert [tuple(x) for x in got[conv].turns] == [(r, x) for *_, r, x in own]
        assert got[conv].loss_text == "".join(x for *_, r, x in own if r == "assistant")
        assert "".join(s.text for s in got[conv].segments) == got[conv].formatted
    assert chat.render(df.limit(0)).count() == 0


@pytest.mark.parametrize(("roles", "valid"), [("ua", True), ("sua", True), ("suaua", True), ("u", False), ("au", False), ("uu", False), ("sa", False), ("uas", False)])
def test_turn_order(spark, roles, valid):
    names = {"u": "user", "a": "assistant", "s": "system"}
    df = spark.createDataFrame([(1, i, names[r], "x") for i, r in enumerate(roles)], "conv_id int, turn int, role string, text string")
    assert chat.render(df).first().valid is valid


@pytest.mark.parametrize("block", [20_000, 1 << 24])
def test_word_scores_against_brute_force(spark, docs, awkward, nothing, monkeypatch, block):
    monkeypatch.setattr(word_scoring, "BLOCK_BYTES", block)
    small = awkward.select("doc_id", "text").unionByName(docs.select("doc_id", "text").limit(40)).repartition(3, "text").cache()
    rows = small.collect()
    expected = brute.word_backoff_scores([r.text or "" for r in rows], 3)
    got = word_scoring.score(small).collect()
    assert sorted((str(r.doc_id), r.n_grams, round(r.log_score, 6)) for r in got) == sorted(
        (str(r.doc_id), n, round(s, 6)) for r, (n, s) in zip(rows, expected, strict=True)
    )
    assert word_scoring.score(nothing).count() == 0


def test_a_pass_moves_its_ngrams_once_and_asks_for_few_trigrams(spark, monkeypatch):
    """Pairs of rare words are in one fold alone, so a trigram with one is not asked for; the results are whole."""
    texts = [f"a{i} b{i} c{i} d{i} e{i}" for i in range(400)] + [f"some words that come often {k}" for k in range(20)] + ["", None]
    plans, asked, found_in_both = [], [], word_scoring.found_in_both

    def found(rows):
        asked.append(rows.selectExpr("sum(size(low))").first()[0])
        answers = found_in_both(rows)
        # The join is of what one exchange moved: neither side moves n-grams again.
        plans.append(answers._jdf.queryExecution().executedPlan().toString())
        return answers

    monkeypatch.setattr(word_scoring, "found_in_both", found)
    before = {name: spark.conf.get(name) for name in word_scoring.PASS_SETTINGS}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = word_scoring.score(df).collect()
    expected = brute.word_backoff_scores([t or "" for t in texts], 3)
    assert [(r.n_grams, round(r.log_score, 6)) for r in sorted(got)] == [(n, round(s, 6)) for n, s in expected]
    assert {name: spark.conf.get(name) for name in word_scoring.PASS_SETTINGS} == before
    words, pairs, trigrams = 400 * 5 + 5 + 20 + 1, 400 * 6 + 5 + 2 * 20 + 1, 5
    assert asked == [words + pairs, trigrams]
    moves = [line for plan in plans for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert any("(part#" in line for line in moves) and not any("gram#" in line for line in moves)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_word_scores_of_other_orders(spark, order):
    rng = random.Random(order)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(12))) for _ in range(60)]
    df = spark.createDataFrame([(f"id {i:02d}", t) for i, t in enumerate(texts)], "doc_id string, text string").repartition(2, "doc_id")
    got = sorted((r.doc_id, r.n_grams, round(r.log_score, 6)) for r in word_scoring.score(df, order).collect())
    assert got == [(f"id {i:02d}", n, round(s, 6)) for i, (n, s) in enumerate(brute.word_backoff_scores(texts, order))]


def test_registered_scores_count_words(spark, tmp_path):
    texts = ["the cat sat on the mat", "mat the on sat cat the", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_grams for r in checks.QUERIES["op7_lm_scoring"](spark, str(tmp_path)).collect()}
    assert got == {0: 7, 1: 7, 2: 1, 3: 1}


@given(st.lists(st.integers(-6, 6), max_size=40))
@settings(max_examples=200, deadline=None)
def test_segments_are_the_maximal_ones(values):
    noise = [v + 1e-3 * ((i * 7919) % 31) for i, v in enumerate(values)]  # no ties
    found = toxicity.segments(np.array(noise))
    assert [(b, e) for b, e, _ in found] == [(b, e) for b, e, _ in brute.best_segments(noise)]
    assert all(abs(s - sum(noise[b:e])) < 1e-9 for b, e, s in found)


@pytest.mark.parametrize(("name", "label", "least"), [("op9_quality_classifier", "quality", 0.5), ("op8_toxicity", "toxic", 0.3)])
def test_scores_of_held_out_documents(spark, name, label, least):
    """Accuracy on rows that were not learned from, over the tables of the next size."""
    sf_dir = "/root/testdata/sf0.01"
    rows = checks.QUERIES[name](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    modulus, remainder = (3, 1) if label == "quality" else (4, 2)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= least) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r[label] for r in held) / len(held)
    assert right > (0.97 if label == "quality" else 0.9)


def test_labelled_sample_has_one_row_for_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b"), (3, None), (4, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    sample = lambda rows: sorted(tuple(r) for r in labelled_sample(docs, labels, "toxic", 1, 1, rows).collect())
    assert sample(10) == [(1, "text 0", 1), (2, "b", 0), (3, "", 1)]
    assert len(sample(2)) == 2 and set(sample(2)) < set(sample(10))


@pytest.mark.parametrize(("module", "label"), [(quality_model, "quality"), (toxicity, "toxic")])
def test_models_of_awkward_rows(spark, awkward, nothing, module, label):
    some = [(i, k % 2) for k, i in enumerate((-4, -5, -7, -8, -9))] + [(None, 1), (-1, None)]
    labels = spark.createDataFrame(some, f"doc_id long, {label} int")
    model = module.fit(awkward, labels)
    scores = awkward.select(module.score(spark, model).alias("s")).collect()
    assert len(scores) == awkward.count() and all(0 <= r.s <= 1 for r in scores)
    alone = module.fit(awkward, labels.limit(0))
    assert {round(r.s, 6) for r in awkward.select(module.score(spark, alone).alias("s")).collect()} == {0.5}
    assert nothing.select(module.score(spark, model)).count() == 0 and module.fit(nothing, labels).weights is not None


def test_accepted_documents_keep_their_columns(awkward):
    model = quality_model.train(pa.array([]), np.zeros(0))
    assert quality_model.accepted(awkward, model).columns == awkward.columns
    assert quality_model.accepted(awkward, model, 0.4).count() == awkward.count() and quality_model.accepted(awkward, model, 0.6).count() == 0
