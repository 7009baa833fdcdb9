"""Hard negatives against brute force over Python's whole numbers."""

from __future__ import annotations

import collections
import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from tapflow.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows) -> collections.Counter:
    """(anchor, positive, rank, negative, scores) by comparing everything with everything."""
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    out = collections.Counter()
    for at, (anchor, label, v) in enumerate(usable):
        if anchor % 100:
            continue
        others = [(sum(a * b for a, b in zip(v, w)), i, other) for k, (i, other, w) in enumerate(usable) if k != at and len(w) == len(v)]
        others.sort(key=lambda s: (-s[0], s[1]))
        for score, positive, _ in [s for s in others if s[2] == label][:5]:
            fit = [s for s in others if s[2] != label and 30 * score <= 100 * s[0] <= 90 * score]
            for rank, (low, negative, _) in enumerate(fit[:10], 1):
                out[anchor, positive, rank, negative, score, low] += 1
    return out


def mixed(n: int, d: int, draw: random.Random) -> list[tuple]:
    centres = [[draw.gauss(0, 0.2) for _ in range(d)] for _ in range(4)]
    rows = []
    for i in range(n):
        centre = draw.choice(centres)
        # Few distinct values: ties abound.
        rows.append((i * 5, [round(c + draw.gauss(0, 0.05), 2) for c in centre], 3 if i % 3 == 0 else draw.randint(0, 9)))
    return rows


def ran(spark, rows, **sizes) -> collections.Counter:
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("row", F.lit(1)).withColumn("tree", F.lit(None).cast("string")).repartition(3)
    got = negatives.mined(df, **sizes).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    return collections.Counter(tuple(r) for r in got)


@pytest.mark.parametrize("sizes", [{"tree": 4, "block": 40}, {}])
def test_equals_brute_force(spark, sizes):
    draw = random.Random(7)
    rows = mixed(240, 6, draw)
    rows += rows[:20]  # repeated rows, anchors among them
    rows += [(100, [0.5] * 6, 3), (None, [0.1] * 6, 1), (7, None, 1), (8, [0.1, None, 0.0, 0.0, 0.0, 0.0], 2), (9, [math.nan] * 6, 2), (11, [math.inf] * 6, 3), (12, [0.3] * 6, None)]
    rows += [(i * 100, [0.1 * i, 0.2], i % 2) for i in range(-3, 9)]  # another length
    rows += [(i, [], 1) for i in (200, 201)] + [(300, [0.0] * 6, 5), (301, [0.0] * 6, 4)]
    assert ran(spark, rows, **sizes) == plain(rows) != collections.Counter()


def test_large_numbers_stay_exact(spark):
    draw = random.Random(2)
    rows = [(i * 20, [draw.choice([1e4, 4e6, 3.3e6, 2.9e6]) * draw.uniform(0.5, 1) for _ in range(3)], i % 3) for i in range(60)]
    assert ran(spark, rows, tree=3, block=25) == plain(rows) != collections.Counter()


def test_nothing(spark):
    assert not ran(spark, [])
    assert not ran(spark, [(1, [0.1], 1), (2, [0.1], 2)])
    assert not ran(spark, [(100, [0.1], 1)])


def test_spanning_tree_is_minimal():
    x = np.random.default_rng(3).normal(size=(7, 3))
    order, parent, edge = negatives.spanning_tree(x)
    assert parent[order[0]] == order[0] and sorted(order) == list(range(7))
    seen = set()
    for k in order:
        assert k == order[0] or parent[k] in seen
        seen.add(k)

    def connected(edges):
        label = list(range(7))
        for a, b in edges:
            old, new = label[a], label[b]
            label = [new if c == old else c for c in label]
        return len(set(label)) == 1

    pairs = list(itertools.combinations(range(7), 2))
    length = {p: float(np.linalg.norm(x[p[0]] - x[p[1]])) for p in pairs}
    best = min(sum(length[p] for p in chosen) for chosen in itertools.combinations(pairs, 6) if connected(chosen))
    assert edge.sum() == pytest.approx(best)


def test_bounds_spare_most_scores():
    """Rows of tight clusters: a child anchor scores only what its windows may hold."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(12, 16)) * 200
    x = np.floor(centres[draw.integers(0, 12, 3000)] + draw.normal(size=(3000, 16)) * 4).astype(np.int64)
    rows = pa.table({"row": pa.array(np.arange(3000)), "id": pa.array(np.arange(3000)), "label": pa.array(draw.integers(0, 10, 3000)), "v": pa.array(list(x), pa.list_(pa.int64()))})
    few = rows.slice(0, 40)
    order, parent, edge = negatives.spanning_tree(x[:40].astype(float))
    turn = np.empty(40, np.int64)
    turn[order] = np.arange(40)
    windows = [[{"request": 0, "low": -(2**62), "high": 2**62}]] * 40
    few = few.append_column("turn", pa.array(turn)).append_column("under", pa.array(turn[parent])).append_column("edge", pa.array(edge)).append_column("windows", pa.array(windows))
    got, scored = negatives.search(rows, few, 5, True)
    assert got.num_rows == 200
    assert scored < 0.2 * 40 * 3000
