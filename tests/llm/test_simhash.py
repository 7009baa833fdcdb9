"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import functions as F

from tapflow.llm import simhash


def plain_print(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius: int = 4) -> set[tuple]:
    prints = [plain_print(t) for _, t in rows]
    label = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius and label[a] != label[b]:
            old, new = label[b], label[a]
            label = [new if c == old else c for c in label]
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(((i if i is not None else -1), f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, prints, label))


def close_texts() -> list[tuple]:
    draw = random.Random(9)
    words = [f"w{k}" for k in range(300)]
    rows, base = [], [draw.choice(words) for _ in range(400)]
    for i in range(60):
        text = list(base)
        for _ in range(draw.randint(0, 12)):
            text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((i * 3, " ".join(text)))
    for i in range(60):
        rows.append((1000 + i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 60)))))
    odd = [None, "", " \n", "One two", "one TWO", "a b c d", "a b c d e", "É é", "x\x0by\x0cz\x1cq w", "the the the the " * 4000, "É" * 3000, "\x85 a\xa0b c d"]
    rows += [(2000 + i, t) for i, t in enumerate(odd)]
    return rows + rows[:3] + [(None, base[0]), (None, "  "), (5, "another text of the same id 5")]


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumn("id", F.lit("x")).withColumn("fp", F.lit(1)).withColumn("key", F.lit(None).cast("int")).repartition(3)


def ran(df, **sizes):
    got = simhash.near_duplicates(df, **sizes).select("doc_id", "fingerprint", "component_id").collect()
    return sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in got)


def test_components_equal_brute_force(spark):
    rows = close_texts()
    want = plain_components(rows)
    assert len({c for *_, c in want}) < len({p for _, p, _ in want})  # links between different fingerprints
    assert ran(table(spark, rows)) == want
    # Every bucket of three or more is taken apart.
    assert ran(table(spark, rows), small=2) == want


def test_prints_of_many_hashes():
    draw = random.Random(1)
    texts = [" ".join(draw.choice("abcdefgh") for _ in range(n)) for n in (3, 4, 258, 259, 5000)]
    got = simhash.majority(*simhash.shingle_hashes(pa.array(texts, pa.large_string())))
    assert [int(p) for p in got] == [plain_print(t) for t in texts]


def test_some_mask_misses_any_four_positions():
    masks = simhash.covering(list(range(64)))
    assert len(masks) == 31 and all(28 <= m.bit_count() <= 36 for m in masks)
    kept = np.array([[m >> p & 1 for p in range(64)] for m in masks], bool)
    four = np.array(list(itertools.combinations(range(64), 4)))
    assert (~kept[:, four].any(2)).any(0).all()
    for m in masks:
        left = [p for p in range(64) if not m >> p & 1]
        finer = simhash.covering(left)
        own = np.array([[f >> p & 1 for p in left] for f in finer], bool)
        some = np.array(list(itertools.combinations(range(len(left)), 4)))
        assert (~own[:, some].any(2)).any(0).all()
        # What neither mask keeps bounds a bucket that is taken apart.
        assert all((m | f).bit_count() >= 64 - 17 for f in finer)


def test_links_within_a_bucket_are_linear():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**62, 40)
    values = np.unique(np.concatenate([base ^ (1 << draw.integers(0, 62, 40)) ^ (1 << draw.integers(0, 62, 40)) for _ in range(50)]))
    a, b = simhash.near_links(values)
    assert len(a) < len(values)
    label = {int(v): int(v) for v in values}
    for x, y in zip(a.tolist(), b.tolist()):
        old, new = label[y], label[x]
        label = {k: new if c == old else c for k, c in label.items()}
    for x, y in itertools.combinations(values.tolist(), 2):
        assert (x ^ y).bit_count() > 4 or label[x] == label[y]


def test_nothing(spark):
    assert ran(table(spark, [])) == []
    assert ran(table(spark, [(1, None)])) == [(1, "0" * 16, 1)]
