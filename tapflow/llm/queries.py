"""The registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession

from tapflow.session import scratch_path

from . import bpe, licenses, merkle, neardup, negatives, neighbours, packing, quality, rules, secrets, simhash, tokencounts, urlfilters
from .oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

__all__ = ["ORACLES", "QUERIES"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf, "documents"))


@query
def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf, "documents"))


@query
def op4_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"))


@query
def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return urlfilters.judge(urlfilters.pages_fetched(pages), urlfilters.lists_of(pages))


@query
def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The cache is new in each run of the query; a job names one that it keeps."""
    cache = scratch_path(spark, "token-cache")
    return tokencounts.token_counts(table(spark, sf, "documents"), cache, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return negatives.mined(table(spark, sf, "embeddings"))


@query
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.tampered_documents(table(spark, sf, "documents"))


@query
def op13_simhash_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))
