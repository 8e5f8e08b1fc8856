"""A corpus pipeline of five operators; each stage reads what the one before it wrote.

1. quality classifier: documents scoring under 0.5 go;
2. quality rules: failing lines go from the text, documents that lose too much go;
3. exact dedup: the document with the largest id of equal texts stays;
4. n-gram Jaccard join (five words, 0.8): the document with the least id of a group stays;
5. packing: what is left becomes pieces of token sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, ngram_join, packing, quality_model, quality_rules
from tidemark.llm.common import documents, keep


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.accepted(docs, quality_model.fit(docs, labels))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_copies(docs, n=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("exact dedup", drop_exact),
    ("n-gram Jaccard join", drop_near),
    ("packing", pack),
]

# A learned model and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
