"""The Merkle manifest against a tree built row by row."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest

from pyspark.sql import functions as F

from tapflow.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values) -> str:
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def proofs(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """(root, each leaf's siblings on the left and on the right, level by level)."""
    if len(nodes) == 1:
        return nodes[0], [[]]
    above, rest = proofs([H("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)], fanout)
    out = []
    for i in range(len(nodes)):
        a = i - i % fanout
        out.append([("".join(nodes[a:i]), "".join(nodes[i + 1 : a + fanout])), *rest[i // fanout]])
    return above, out


def plain(rows, fanout: int) -> collections.Counter:
    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        first = leaf([doc_id, source, lang, n_chars, text])
        other = first
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            other = leaf([doc_id, source, lang, n_chars, text and text.replace("\n", "")])
        groups[source].append((doc_id is not None, doc_id or 0, first, other, doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found = [(sorted(groups[s], key=lambda r: r[:3])) for s in names]
    trees = [proofs([r[2] for r in g], fanout) for g in found]
    root, over = proofs([t[0] for t in trees], fanout) if trees else ("", [])
    out = collections.Counter()
    for g, (subroot, own), above in zip(found, trees, over):
        for (_, _, first, other, doc_id), steps in zip(g, own):
            node = other
            for left, right in steps + above:
                node = H(left + node + right)
            out[doc_id, first, subroot, root, H("".join(a + b for a, b in steps + above)), node, node == root] += 1
    return out


def ran(docs) -> collections.Counter:
    got = merkle.tampered_documents(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return collections.Counter(tuple(r) for r in got.collect())


def rows_of(sizes: dict[str | None, int]) -> list[tuple]:
    draw = random.Random(1)
    out = []
    for source, n in sizes.items():
        for _ in range(n):
            text = draw.choice([None, "", "\n", "ä\nb", "é" * 50, "line\nline", "x" * 70_000, "𝒳 a"])
            out.append((draw.choice([None, *range(-5, 400)]), text, draw.choice([None, "en"]), source, draw.choice([None, 3])))
    return out + out[:5]


MIXED = {None: 1, "": 2, "b": 3, "é": 4, "a": 10, "Z": 82}


@pytest.mark.parametrize(("height", "sizes"), [(0, MIXED), (2, MIXED), (7, MIXED), (1, {"only": 28}), (0, {"one": 1})])
def test_equals_a_tree_built_row_by_row(spark, monkeypatch, height, sizes):
    """Blocks of 1 to 2187 leaves: up to five rounds of the exchange, incomplete subtrees in all of them."""
    monkeypatch.setattr(merkle.manifest, "__defaults__", (None, 3, height))
    rows = rows_of(sizes)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit(1)).withColumn("p", F.lit("x")).withColumn("digest", F.lit("y")).repartition(3)
    assert ran(docs) == plain(rows, 3)


def test_other_fanout_and_what_a_row_carries(spark):
    rows = rows_of({"a": 23, "b": 1})
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), merkle.COLUMNS, "source", "doc_id", {"seen": F.col("n_chars")}, fanout=2, height=1)
    good = got.withColumn("back", merkle.folded(F.col("leaf"), F.col("proof")))
    assert good.where("back <> root").count() == 0
    assert good.count() == len(rows)
    assert {r["root"] for r in good.collect()} == {root for *_, root, _, _, _ in plain(rows, 2)}
    assert {r["seen"] for r in good.collect()} <= {None, 3}


def test_every_partner_sends_once(spark):
    """A round: whatever the number of blocks, each gets one digest from every sibling subtree that exists."""
    for n in (1, 2, 3, 4, 7, 10, 28):
        blocks = spark.createDataFrame([("t", p, H(str(p))) for p in range(n)], "tree string, p long, digest string")
        got = merkle.butterfly(blocks, 3).collect()
        root, steps = proofs([H(str(p)) for p in range(n)], 3)
        assert {r["digest"] for r in got} == {root}
        assert {r["p"]: [tuple(s) for s in r["proof"]] for r in got} == dict(enumerate(steps))


def test_nothing(spark):
    assert not ran(spark.createDataFrame([], SCHEMA))
