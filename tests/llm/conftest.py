from __future__ import annotations

import pytest
from pyspark.sql import functions as F

# Awkward rows: null id, null and empty texts, blanks, a repeated row, a repeated id with another text, a very long text.
SHORT = [
    (None, "a text without an id, long enough to have some words in it"), (None, None), (-1, None), (-2, ""), (-3, " \n\t "),
    (-4, "A Tie"), (-5, "a tie"), (-6, "one two three four five six seven"), (-6, "one two three four five six seven"),
    (-7, "first text of an id that comes twice"), (-7, "second text of it, quite unlike"), (-8, "É é İ ß ǅ 日本 🧿 \x00 </s> <|endoftext|> \\ x"),
]
CLASHING = ["keep_id", "kept", "n_words", "n", "block", "label", "row", "size", "s1", "ids", "Q_words", "__label", "count", "__sha", "__id", "__kept_sha", "__n", "__place", "__other_id", "__hot", "fingerprint", "word"]


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows above, under the columns of documents and others named like the operators' own."""
    rows = [*SHORT, (-9, "word%d " * 5 % (1, 2, 3, 4, 5) + " ".join(f"w{i % 5000}" for i in range(60_000)))]
    df = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING]).repartition(3, F.xxhash64("text")).cache()


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
