"""Groups of near copies that weigh too much for one comparison."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from tapflow.llm import neardup
from tests.llm.test_llm import near_copies, plain_components


def result(docs, **over):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, **over).collect()}


@pytest.mark.parametrize("weight", [60, 400, 3000])
def test_chunks_equal_brute_force(spark, monkeypatch, weight):
    """Groups are cut into chunks of one document up to many, and some stay in several components after the first round."""
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", weight)
    draw = random.Random(11)
    rows = [row for k in range(6) for row in near_copies(15, 12, draw, 100 * k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs) == plain_components(rows, 3, 85)
    assert result(docs, width=5, percent=80) == plain_components(rows, 5, 80)


def test_rows_of_a_heavy_group_grow_with_its_documents(spark, monkeypatch):
    """300 near copies of 8,000 words: a row per chunk and one link per document, not one per pair."""
    draw = random.Random(5)
    words = [f"w{k}" for k in range(5000)]
    base = [draw.choice(words) for _ in range(8000)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(20):
            text[draw.randrange(8000)] = draw.choice(words)
        rows.append((i, " ".join(text)))
    seen = {}
    plain = neardup._stored

    def stored(df, label):
        out = plain(df, label)
        seen[label] = seen.get(label, 0) + out.count()
        if label == "sets":
            seen["sent"] = out.select(F.explode("groups")).count()
        return out

    monkeypatch.setattr(neardup, "_stored", stored)
    got = result(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {c for _, c in got.values()} == {0}
    assert seen["groups-of-nodes"] < 100 and seen["sent"] < 10 * 300 and seen["confirmed"] < 10 * 300


def test_a_bit_map_loses_no_id(spark, monkeypatch):
    monkeypatch.setattr(neardup, "MAP_WORDS", 4)
    source = spark.range(2000).withColumn("id", F.when(F.col("id") != 7, F.col("id")))
    for ids in (source.where("id % 50 = 0 OR id IS NULL"), source.where("id > 100"), source.where("false")):
        wanted = {r.id for r in ids.collect()}
        left = {r.id for r in neardup._likely(source, ids).collect()}
        assert wanted <= left and (wanted or not left)
