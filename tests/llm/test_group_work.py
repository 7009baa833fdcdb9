"""Groups of many documents that few links connect: what comparing them costs, and that it finds the same."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from tapflow.llm import neardup
from tests.llm.test_llm import near_copies, plain_components


def plain_linked(sets, percent):
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return label


def family(n, draw):
    """Sets that come one from another by some changes, often more than a link allows."""
    sets = [set(draw.sample(range(1000), 40))]
    while len(sets) <= n:
        one = set(draw.choice(sets))
        for _ in range(draw.choice([0, 1, 2, 3, 4, 6, 20])):
            one.discard(draw.choice([*one, 0]))
            one.add(draw.randrange(-50, 1000))
        sets.append(one)
    return sets[1:]


def flat(sets):
    return np.array([v for s in sets for v in sorted(s)], np.int64), np.array([len(s) for s in sets])


@pytest.mark.parametrize(("scans", "few", "cells"), [(0, 16, 1 << 20), (3, 1, 200), (1, 1000, 200), (8, 4, 1)])
def test_links_of_a_group_equal_brute_force(monkeypatch, scans, few, cells):
    monkeypatch.setattr(neardup, "SCANS", scans)
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "CELLS", cells)
    draw = random.Random(scans)
    for n in [*range(1, 12), 40, 70]:
        sets = family(n, draw)
        for percent in (50, 80, 85, 100):
            assert neardup._linked(*flat(sets), percent).tolist() == plain_linked(sets, percent)


def test_a_chain_is_one_component():
    sets = [set(range(k, k + 20)) for k in range(400)]
    assert not neardup._linked(*flat(sets), 85).any()
    assert len(set(neardup._linked(*flat(sets), 95).tolist())) == 400


def test_documents_that_nothing_links_are_not_scanned_one_by_one():
    """1200 documents, each with four fifths of a text's shingles and some of its own: no pair reaches 85 percent."""
    draw = np.random.default_rng(7)
    n = 1200
    values = np.concatenate([np.sort(np.append(draw.choice(300, 240, replace=False), 1000 * (k + 1) + np.arange(60))) for k in range(n)])
    size = np.full(n, 300)
    row, mark, took = np.repeat(np.arange(n, dtype=np.int32), 300), np.zeros(values.max() + 1, bool), []
    for _ in range(5):
        began = time.perf_counter()
        np.bincount(row, mark[values], n)
        took.append(time.perf_counter() - began)
    began = time.perf_counter()
    found = neardup._linked(values, size, 85)
    assert time.perf_counter() - began < 300 * min(took)
    assert found.tolist() == list(range(n))


def test_large_nodes_find_the_pairs_of_small_ones():
    draw = np.random.default_rng(3)
    sig = draw.integers(-(2**31), 2**31, (90, neardup.SIGNATURE)).astype(np.int32)
    for k in range(1, 90):
        sig[k] = np.where(draw.random(neardup.SIGNATURE) < draw.random(), sig[draw.integers(k)], sig[k])
    held = draw.integers(0, 4, 90)
    names = draw.integers(0, 30, held.sum())
    near = neardup._alike(sig[None], 0.6)[0]
    assert near.any() and (neardup._alike_one(sig, 0.6) == near).all()
    own = np.split(names, np.cumsum(held)[:-1])
    meet = [[bool(set(a) & set(b)) for b in own] for a in own]
    assert (neardup._equal(*flat([set(x.tolist()) for x in own]), 1) == meet).all()
    assert (neardup._reached(near) == neardup._components(near[None])[0]).all()


def test_components_of_large_groups_equal_brute_force(spark):
    """More documents a group than are compared along with others; many have more edits than a link allows."""
    draw = random.Random(21)
    rows = near_copies(110, 24, draw, 0) + near_copies(80, 9, draw, 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == plain_components(rows, 3, 85)
    assert len({c for _, c in got.values()}) > 10
