"""From documents to packed training sequences: five stages, each one of the library's training-data operators."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession

from tapflow.llm import neardup, packing, quality, rules, secrets
from tapflow.session import scratch_path


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good; it is trained on the labels beside the documents."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the rules and bands of tokeniser fertility."""
    return rules.keep_within(docs, public_tokenizers.path("piece_bpe_32k.model"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, similarity 0.8 or more."""
    return neardup.keep_first(docs, width=5, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", classified),
    ("quality rules", ruled),
    ("near-duplicates", deduplicated),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: SQL can express neither the classifier nor the tokenizers' measures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is stored in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
