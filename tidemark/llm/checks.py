"""The registered queries of these operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat, conversation_repair, exact_dedup, ngram_join, packing, quality_model, quality_rules, sentencepiece_codec, sharding,
    simhash, spelling, toxicity, word_scoring,
)
from tidemark.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


@query(
    "op6_exact_dedup",
    """WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents)
       SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
       FROM t WINDOW w AS (PARTITION BY text_sha256)""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(documents(spark, sf_dir))


_QUOTED = ", ".join("'" + c.replace("'", "''") + "'" for c in quality_rules.TERMINAL)
_BOILERPLATE = " OR ".join(f"contains(lower(x), '{phrase}')" for phrase in quality_rules.BOILERPLATE)
_TIDY = "trim(x, ' ')"
_LINE_WORDS = f"(length({_TIDY}) - length(replace({_TIDY}, ' ', '')) + 1)"
_LINE_FAILS = f"""{_TIDY} <> '' AND ((right({_TIDY}, 1) NOT IN ({_QUOTED}) AND {_LINE_WORDS} < 5)
    OR len(regexp_extract_all(x, '{quality_rules.SEPARATORS}')) > {_LINE_WORDS} * 0.2
    OR len(regexp_extract_all(x, '{quality_rules.SYMBOLS}')) > {_LINE_WORDS} * 0.5 OR {_BOILERPLATE})"""


@query(
    "op3_quality_rules",
    rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
       w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        array_to_string(list_filter(string_split(t, chr(10)), lambda x: NOT ({_LINE_FAILS})), chr(10)) AS clean FROM t),
       windows AS (SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS seen
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
       twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, seen) AS n FROM windows) WHERE n > 1),
       covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(8) AS r(k) GROUP BY doc_id),
       m AS (SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words, length(clean) >= length(t) * 0.5 AS enough FROM w LEFT JOIN covered USING (doc_id))
       SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND enough AS kept FROM m""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(documents(spark, sf_dir)).drop("clean_text")


def _scored(docs: DataFrame, score, modulus: int, held_out: int, least: float) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % modulus
    return docs.select("doc_id", (remainder == held_out).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= least).cast("int")
    )


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _scored(docs, toxicity.score(spark, toxicity.fit(docs, labels)), 4, 2, 0.3)


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _scored(docs, quality_model.score(spark, quality_model.fit(docs, labels)), 3, 1, 0.5)


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.digests(sentencepiece_codec.encode_decode(documents(spark, sf_dir), path))


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# Lengths of escaped text follow from counting what is escaped.
_ESCAPES = ["<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ESCAPED_CHARS = "length({0}) + length({0}) - length(replace({0}, '\\', ''))" + "".join(
    f" + (length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}" for c in _ESCAPES
)


@query(
    "op5_chat_formatting",
    f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
       c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
        string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, '' ORDER BY turn, role, text) AS roles,
        CAST(sum(24 + {_ESCAPED_CHARS.format("role")} + length(role) - length(replace(role, chr(10), '')) + {_ESCAPED_CHARS.format("text")}) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id)
       SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
        formatted_chars, regexp_full_match(roles, 's?(ua)+') AS valid FROM c""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    both = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -7L AS conv_id, turn, role, '{both}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)")
    rendered = chat.render(turns.unionByName(extra))
    loss = F.col("loss_text")
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chat.read_back(rendered, keep=("valid", "formatted")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


@query(
    "op1_ngram_jaccard_join",
    r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
       grams AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 4
         THEN list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))
         WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS gram FROM w),
       sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
       common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b USING (gram)
         WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
       half AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
         WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
       links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
       reach(doc_id, other) AS (SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
       least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id),
       degree AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
       SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id, coalesce(n_links, 0) AS n_links
       FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id) LEFT JOIN degree USING (doc_id)""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir))


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


@query("op7_lm_scoring")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_scoring.score(documents(spark, sf_dir)).select(
        "doc_id", "fold", "n_grams", F.round("log_score", 6).alias("log_score"),
        F.round(F.exp(-F.col("log_score") / F.col("n_grams")), 6).alias("perplexity"),
    )


# CRC-32 byte by byte: its table by rule, then a fold over the bytes of a text.
_CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table"""


def _crc(text: str) -> str:
    """SQL for the unsigned checksum of a text, beside a column ``crc_table``."""
    byte = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"


@query(
    "op11_spelling_variants",
    rf"""WITH RECURSIVE crc AS ({_CRC_TABLE}),
       found AS (SELECT CAST(doc_id AS VARCHAR) AS d, unnest(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
       counted AS (SELECT coalesce(d, '') || ':' || run AS k, run, count(*) AS times FROM found WHERE length(run) >= 6 GROUP BY d, run),
       hashed AS (SELECT run, times, {_crc("k")} AS h FROM counted, crc),
       damaged AS (SELECT times, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
       words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
       holes AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole, substr(word, 1, i - 1) || substr(word, i + 1) AS less
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
       near AS (SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b USING (hole) WHERE a.word <> b.word
         UNION SELECT w.word, h.word, h.n FROM words w JOIN holes h ON h.less = w.word
         UNION SELECT h.word, w.word, w.n FROM words w JOIN holes h ON h.less = w.word),
       best AS (SELECT word, count(*) AS n_near, min({{'m': -m, 'other': other}}) AS b FROM near GROUP BY word),
       forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 5 * n THEN b.other END AS form,
         CASE WHEN -b.m >= 5 * n THEN -b.m END AS form_n FROM words LEFT JOIN best USING (word)),
       steps(word, pos) AS (SELECT word, form FROM forms WHERE form IS NOT NULL
         UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.pos WHERE f.form IS NOT NULL),
       ends AS (SELECT s.word, s.pos AS root FROM steps s JOIN forms f ON f.word = s.pos WHERE f.form IS NULL)
       SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (word)""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs(documents(spark, sf_dir), 6)
    words = runs.select(spelling.misspelt(F.col("doc_id"), F.col("run")).alias("word"))
    return spelling.variants(spelling.vocabulary(words, 6, 5))


# What follows each row, from the last one back: the least (cost, edits) from each of four states.
_STATES = ("start", "after_s", "after_u", "after_a")
_AFTER_U, _AFTER_A = 2, 3


def _least(options: list[str]) -> str:
    return f"list_aggregate([{', '.join(options)}], 'min')"


def _then(cost: str, edit: str, rest: str) -> str:
    return f"{{'c': {rest}.c + {cost}, 'e': '{edit}' || {rest}.e}}"


def _best_of(keep: dict[int, str], rest: list[str], delete: bool) -> list[str]:
    """For each state the least over edits of a row, whose rest is known, before inserts."""
    found = []
    for state in range(4):
        options = [_then("3", "D", rest[state])] if delete else [rest[state]]
        wanted = _AFTER_A if state == 2 else _AFTER_U
        options += [f"CASE WHEN {keep[k]} THEN {_then('extra', 'K', rest[to])} END" for k, to in {0: [(0, 1), (1, 2)], 1: [(1, 2)], 2: [(2, 3)], 3: [(1, 2)]}[state]]
        options.append(f"CASE WHEN stays THEN {_then('2 + extra', 'R', rest[wanted])} END")
        found.append(_least(options))
    return found


def _with_inserts(at: list[str]) -> list[str]:
    """The same with up to two inserts in front; more never pay."""
    twice = {0: (2, 3), 1: (2, 3), 2: (3, 2), 3: (2, 3)}
    return [_least([at[s], _then("2", "I", at[a]), _then("4", "II", at[b])]) for s, (a, b) in twice.items()]


_ROW = _best_of({0: "stays AND role = 's'", 1: "stays AND role = 'u'", 2: "stays AND role = 'a'"}, [f"b.{s}" for s in _STATES], True)
_NONE = "{'c': 1000000000::BIGINT, 'e': '~'}"
_DONE = "{'c': 0::BIGINT, 'e': ''}"
_END = _with_inserts([_DONE, _NONE, _NONE, _DONE])


@query(
    "op12_conversation_repair",
    rf"""WITH RECURSIVE crc AS ({_CRC_TABLE}),
       keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
       hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc("k")} % 20 AS h FROM keyed, crc),
       damaged AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy
         FROM hashed WHERE h <> 0),
       told AS (SELECT *, sha256(length(role) || ':' || role || text) AS digest, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last FROM damaged),
       placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest, copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, digest ORDER BY turn NULLS FIRST, copy) AS seen FROM told),
       faulty AS (SELECT conv_id, turn, substr(role, 1, 1) AS role, role AS whole_role, text, pos,
         CASE WHEN last = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
       rows AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS extra,
         lag(role) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM faulty),
       counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || role NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id),
       back(conv_id, pos, {", ".join(_STATES)}) AS (
         SELECT conv_id, n + 1, {", ".join(_END)} FROM counts
         UNION ALL
         SELECT conv_id, pos, {", ".join(_with_inserts([f"p.{s}" for s in _STATES]))} FROM (
           SELECT r.conv_id, r.pos, {", ".join(f"{x} AS {s}" for x, s in zip(_ROW, _STATES, strict=True))}
           FROM back b JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.pos = b.pos - 1) p),
       answers AS (SELECT conv_id, start.c AS cost, start.e AS audit FROM back WHERE pos = 1),
       edits AS (SELECT conv_id, i, substr(audit, i, 1) AS edit, i - length(replace(substr(audit, 1, i), 'I', '')) AS inserts
         FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM answers)),
       edited AS (SELECT e.conv_id, e.i, e.edit, CASE WHEN e.edit <> 'I' THEN r.whole_role END AS role, CASE WHEN e.edit = 'I' THEN '' ELSE r.text END AS text
         FROM edits e LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.pos = e.i - e.inserts AND e.edit <> 'I' WHERE e.edit <> 'D'),
       legal AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS place,
         first_value(edit = 'K' AND role[1] = 's') OVER (PARTITION BY conv_id ORDER BY i) AS system FROM edited),
       final AS (SELECT conv_id, i, CASE WHEN edit = 'K' THEN role WHEN (place + CAST(system AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text AS line FROM legal),
       texts AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY i)) AS sha FROM final GROUP BY conv_id),
       every AS (SELECT DISTINCT conv_id FROM conversations)
       SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
         coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
       FROM every e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN answers a ON a.conv_id IS NOT DISTINCT FROM e.conv_id
       LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM e.conv_id""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_repair.repair(turns, dropped="dropped")


@query("op13_simhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))
