"""Merkle manifest of a table, with each row's proof, by a butterfly exchange.

A row's leaf is the SHA-256 of its columns. Leaves of a group stand in order and are hashed in runs of ``fanout`` up to
the group's subroot; subroots, in order of their groups, up to the root.

Leaves are dealt into blocks of ``fanout ** height`` that begin at multiples of that size, so a block is a whole subtree
and hashes itself. Then blocks swap: in each round, a block gets the roots of its ``fanout - 1`` sibling subtrees, one
from each, and hashes their common parent itself, as all blocks below that parent do. After a round for each level every
block holds its whole upper proof and the subroot; nothing is handed down from the root. Where a subtree has fewer blocks
than its siblings, its blocks serve several partners each.

Null columns are ``-`` in a leaf; a null group is a group, the first one; null order values come first. Rows with equal
order values stand in order of their leaves, so repeated rows are neighbours with proofs of their own. One row's leaf is its
group's subroot. Other columns are ignored whatever their names; an empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa

from pyspark.sql import Column, DataFrame, functions as F

from tapflow.session import scratch_path

from .packing import ranked

FANOUT = 3
#: Levels that a block hashes by itself: it holds 3 ** 7 = 2187 leaves.
HEIGHT = 7
#: Siblings of each level, those on the left and those on the right as one string each.
PROOF = "array<struct<left: string, right: string>>"
_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def leaf(columns: list[Column]) -> Column:
    """SHA-256 of the values, each as its UTF-8 byte count, ``:`` and the value; ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def folded(start: Column, proof: Column) -> Column:
    """The root that ``start`` and its siblings give."""
    return F.aggregate(proof, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes: list[str], first: bool, fanout: int, height: int) -> list[list[str]]:
    """The levels of a block from its leaves up to its root.

    The first block of a group that isn't full is its only one and ends at its root; any other has ``height`` levels,
    however few nodes are left.
    """
    out = [nodes]
    alone = first and len(nodes) < fanout**height
    while len(out[-1]) > 1 if alone else len(out) <= height:
        below = out[-1]
        out.append([_hash("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return out


def _ordered(block: pa.Table) -> pa.Table:
    return block.sort_by("i")


def block_roots(rows: DataFrame, fanout: int, height: int) -> DataFrame:
    """(tree, p, digest): the root of each block of rows (tree, p, i, digest)."""

    def run(block: pa.Table) -> pa.Table:
        nodes = _ordered(block).column("digest").to_pylist()
        tree, p = block.column("tree")[0].as_py(), block.column("p")[0].as_py()
        return pa.table({"tree": [tree], "p": [p], "digest": levels(nodes, p == 0, fanout, height)[-1]})

    return rows.select("tree", "p", "i", "digest").groupBy("tree", "p").applyInArrow(run, "tree string, p bigint, digest string")


def swapped(state: DataFrame, size: int, fanout: int) -> DataFrame:
    """One round: blocks (tree, p, n, digest, proof) that stand for subtrees of ``size`` blocks go up a level."""
    at = F.floor(F.col("p") / size)
    own, place = at % fanout, F.col("p") % size
    parent = at - own
    members = F.least(F.lit(size), F.col("n") - at * size)
    # What this block sends its digest to: itself, and its partners in the sibling subtrees.
    partners = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(fanout - 1)),
            lambda c: F.when(c != own, F.transform(F.sequence(place, F.lit(size - 1).cast("long"), members), lambda j: (parent + c) * size + j)).otherwise(F.array().cast("array<bigint>")),
        )
    )
    partners = F.filter(partners, lambda to: to < F.col("n"))
    to = F.when(F.col("n") > size, F.concat(F.array("p"), partners)).otherwise(F.array("p"))
    sent = state.select("tree", "p", "n", "proof", F.struct(own.alias("child"), "digest").alias("node"), F.explode(to).alias("to"))
    mine = F.col("to") == F.col("p")
    met = sent.groupBy("tree", F.col("to").alias("p")).agg(
        F.max("n").alias("n"),
        F.max(F.when(mine, F.col("node"))).alias("own"),
        F.first(F.when(mine, F.col("proof")), ignorenulls=True).alias("proof"),
        F.sort_array(F.collect_list("node")).alias("nodes"),
    )

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("nodes", keep), lambda x: x["digest"]), "")

    step = F.struct(joined(lambda x: x["child"] < F.col("own.child")).alias("left"), joined(lambda x: x["child"] > F.col("own.child")).alias("right"))
    up = F.col("n") > size
    return met.select(
        "tree", "p", "n",
        F.when(up, F.sha2(joined(lambda x: F.lit(True)), 256)).otherwise(F.col("own.digest")).alias("digest"),
        F.when(up, F.concat("proof", F.array(step))).otherwise(F.col("proof")).alias("proof"),
    )


def butterfly(blocks: DataFrame, fanout: int) -> DataFrame:
    """(tree, p, n, digest, proof): each block with the proof above it and its tree's root."""
    size = blocks.groupBy("tree").agg((F.max("p") + 1).alias("n"))
    state = _stored(blocks.join(size, "tree").withColumn("proof", F.array().cast(PROOF)), "merkle-blocks")
    most = state.agg(F.max("n")).first()[0] or 0
    reach = 1
    while reach < most:
        state = _stored(swapped(state, reach, fanout), "merkle-round")
        reach *= fanout
    return state


def attached(rows: DataFrame, upper: DataFrame, fanout: int, height: int) -> DataFrame:
    """``rows`` of blocks with their block's columns of ``upper``; ``proof`` begins with the levels within the block."""
    own, more = rows.columns, [c for c in upper.columns if c not in ("tree", "p", "proof")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in [*rows.schema, *(upper.schema[c] for c in more)]), f"proof {PROOF}"])

    def run(block: pa.Table, above: pa.Table) -> pa.Table:
        block = _ordered(block)
        tree = levels(block.column("digest").to_pylist(), block.column("p")[0].as_py() == 0, fanout, height)
        top = above.column("proof")[0].as_py()
        proofs = []
        for i in range(block.num_rows):
            steps = []
            for below in tree[:-1]:
                first = i - i % fanout
                steps.append({"left": "".join(below[first:i]), "right": "".join(below[i + 1 : first + fanout])})
                i //= fanout
            proofs.append(steps + top)
        out = {c: block.column(c) for c in own}
        out |= {c: pa.array(above.column(c).to_pylist() * block.num_rows, above.schema.field(c).type) for c in more}
        return pa.table(out | {"proof": pa.array(proofs, _STEPS)})

    return rows.groupBy("tree", "p").cogroup(upper.groupBy("tree", "p")).applyInArrow(run, schema)


def _numbered(rows: DataFrame, order: list[str], fanout: int, height: int) -> DataFrame:
    """Rows with their number ``i`` in their tree and the block ``p`` that it falls into."""
    numbered = ranked(rows.withColumnRenamed("tree", "length"), order).withColumnRenamed("length", "tree").withColumnRenamed("rank", "i")
    return _stored(numbered.withColumn("p", F.floor(F.col("i") / fanout**height)), "merkle-leaves")


def manifest(
    docs: DataFrame,
    columns: list[str],
    group: str,
    order: str,
    carried: dict[str, Column] | None = None,
    fanout: int = FANOUT,
    height: int = HEIGHT,
) -> DataFrame:
    """(``order``, leaf, ``carried``…, subroot, root, proof): one row per row of ``docs``.

    ``carried`` are expressions over ``docs`` that a row keeps, such as the leaf of another state of it.
    """
    carried = carried or {}
    tree = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows = docs.select(tree.alias("tree"), F.col(order).alias("at"), leaf([F.col(c) for c in columns]).alias("digest"), *[e.alias(f"c_{name}") for name, e in carried.items()])
    # Stored: texts are hashed once, while dealing by ranges reads its input twice.
    rows = _numbered(_stored(rows, "merkle-hashed"), ["at", "digest"], fanout, height)
    blocks = butterfly(block_roots(rows, fanout, height), fanout)

    tops = blocks.where("p = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = _numbered(_stored(tops, "merkle-subroots"), ["name"], fanout, height)
    over = attached(tops, butterfly(block_roots(tops, fanout, height), fanout).withColumnRenamed("digest", "root").drop("n"), fanout, height)
    over = _stored(over.select(F.col("name").alias("tree"), "root", F.col("proof").alias("above")), "merkle-groups")

    upper = blocks.withColumnRenamed("digest", "subroot").join(over, "tree").select("tree", "p", "subroot", "root", F.concat("proof", "above").alias("proof"))
    full = attached(rows, upper, fanout, height)
    return full.select(F.col("at").alias(order), F.col("digest").alias("leaf"), *[F.col(f"c_{name}").alias(name) for name in carried], "subroot", "root", "proof")


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, checked against rows of which half lost the line breaks of their text."""
    broken = leaf([F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in COLUMNS])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, broken)
    rows = manifest(docs, COLUMNS, "source", "doc_id", {"tampered": tampered})
    seen = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), seen.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle() -> str:
    """Level by level: each node hashes the run below it; a leaf's ancestor at a level names its siblings there."""
    parts = "||".join(f"coalesce(strlen({c}::VARCHAR)||':'||{c}::VARCHAR, '-')" for c in COLUMNS)
    bit = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda c, b: {bit}))"

    def climb(name: str, leaves: str) -> str:
        return f"""
  {name} AS (
    SELECT * FROM ({leaves})
    UNION ALL
    SELECT tree, level + 1, i // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' ORDER BY i))
    FROM {name} WHERE n > 1 GROUP BY tree, level, i // {FANOUT}, n)"""

    def sides(rows: str, nodes: str) -> str:
        return f"""
    SELECT r.id, b.level, coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < b.i), '') AS l, coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > b.i), '') AS g
    FROM {rows} r JOIN {nodes} b ON b.tree = r.tree AND b.n > 1 AND b.i = r.i // pow({FANOUT}, b.level)::BIGINT
    JOIN {nodes} s ON s.tree = b.tree AND s.level = b.level AND s.i // {FANOUT} = b.i // {FANOUT}
    GROUP BY r.id, b.level"""

    return f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, coalesce('1'||source, '0') AS tree, sha256({parts}) AS leaf,
           CASE WHEN {crc} % 2 = 0 THEN sha256({parts.replace("text::VARCHAR", "replace(text, chr(10), '')")}) END AS tampered
    FROM documents),
  leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n,
           row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS id
    FROM hashed),{climb("low", "SELECT tree, 0::BIGINT AS level, i::BIGINT AS i, n::BIGINT AS n, leaf AS h FROM leaves")},
  groups AS (
    SELECT tree AS name, h, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) AS id
    FROM low WHERE n = 1),{climb("high", "SELECT tree, 0::BIGINT AS level, i::BIGINT AS i, n::BIGINT AS n, h FROM groups")},
  low_steps AS ({sides("leaves", "low")}),
  high_steps AS ({sides("groups", "high")}),
  steps AS (
    SELECT id, row_number() OVER (PARTITION BY id ORDER BY part, level) AS step, count(*) OVER (PARTITION BY id) AS steps, l, g
    FROM (SELECT id, 0 AS part, level, l, g FROM low_steps
          UNION ALL
          SELECT r.id, 1, h.level, h.l, h.g FROM leaves r JOIN groups t ON t.name = r.tree JOIN high_steps h ON h.id = t.id)),
  fold AS (
    SELECT id, 0::BIGINT AS step, coalesce(tampered, leaf) AS h FROM leaves
    UNION ALL
    SELECT f.id, s.step, sha256(s.l||f.h||s.g) FROM fold f JOIN steps s ON s.id = f.id AND s.step = f.step + 1),
  ended AS (SELECT id, max_by(h, step) AS folded_root FROM fold GROUP BY id),
  shown AS (SELECT id, string_agg(l||g, '' ORDER BY step) AS siblings FROM steps GROUP BY id)
SELECT r.doc_id, r.leaf, t.h AS subroot, top.h AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256, e.folded_root, e.folded_root = top.h AS verified
FROM leaves r JOIN groups t ON t.name = r.tree JOIN ended e ON e.id = r.id LEFT JOIN shown p ON p.id = r.id CROSS JOIN (SELECT h FROM high WHERE n = 1) top
"""
