"""Approximate nearest neighbours by largest inner product: NN-descent, then greedy search of the graph.

Equal vectors are one node. Random-projection cells give every node first neighbours; a cell that holds too many
nodes is split by further planes, each through the middle of that cell, until it is small. Rounds of NN-descent improve
the neighbours by Spark joins: each node brings its neighbours, old and new, in both directions together, and those
neighbours of neighbours that are nearer than what a node has take their place, until few new ones are left. A query starts at its own node and
expands the nearest nodes that it has seen until none of its best ``BEAM`` is left to expand. Building and searching
use vectors of one byte a component; the nearest ``BEAM`` are then scored in double precision on the originals.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window, functions as F

from tapflow.session import scratch_path

NEIGHBOURS = 24
TREES = 6
#: Cells beside its own, across the nearest planes, that a node joins in each tree.
BESIDE = 2
LEAF = 512
#: New and old neighbours each that a node brings together in a round, in each direction.
SAMPLE = 8
#: NN-descent ends when no more than this share of all neighbours is still new.
SETTLED = 0.02
#: Sets of planes a tree has for a further split; a cell takes one of them.
SETS = 16
BEAM = 120
GRAPH = "id bigint, near array<bigint>, score array<float>, fresh array<boolean>"


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): rows that take part; of rows with one id the one with the smallest vector."""
    v = F.col(vector_col)
    plain = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < math.inf)) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(id_col).isNotNull() & F.coalesce(plain, F.lit(False))).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(v).alias("v"))
    rows = _stored(rows, "vectors")
    # Vectors of the most common length can be compared with each other.
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return rows.join(F.broadcast(common.select("d")), F.size("v") == F.col("d"), "left_semi")


def coded(nodes: DataFrame) -> DataFrame:
    """(id, c, s): each vector as whole numbers of one byte, times ``s``."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
            scale = np.abs(x).max(1) / 127
            c = np.rint(x / scale[:, None]).astype(np.int8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in c], pa.binary()), pa.array(scale.astype(np.float32))], names=["id", "c", "s"])

    return nodes.select("id", "v").mapInArrow(run, "id bigint, c binary, s float")


def _matrix(c: pa.Array, s: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
    raw = np.frombuffer(c.buffers()[2], np.int8)[offsets[0] : offsets[-1]]
    return raw.reshape(len(c), -1) * s.to_numpy()[:, None]


def _best(owner: np.ndarray, near: np.ndarray, score: np.ndarray, fresh: np.ndarray, most: int):
    """The ``most`` best distinct neighbours of each owner; of equal entries the one that isn't fresh."""
    order = np.lexsort((fresh, near, owner))
    owner, near, score, fresh = owner[order], near[order], score[order], fresh[order]
    one = np.ones(len(owner), bool)
    one[1:] = (owner[1:] != owner[:-1]) | (near[1:] != near[:-1])
    owner, near, score, fresh = owner[one], near[one], score[one], fresh[one]
    order = np.lexsort((near, -score, owner))
    owner, near, score, fresh = owner[order], near[order], score[order], fresh[order]
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(owner)))
    keep = np.arange(len(owner)) - np.repeat(first, size) < most
    return owner[keep], near[keep], score[keep], fresh[keep]


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, kind))


def merged(parts: DataFrame, most: int) -> DataFrame:
    """The graph of each node's ``most`` best over all its rows in ``parts`` (rows of GRAPH)."""
    gathered = parts.groupBy("id").agg(F.collect_list(F.struct("near", "score", "fresh")).alias("rows"))

    def run(batches):
        for batch in batches:
            rows = batch.column(1)
            flat = rows.flatten()
            of = np.repeat(np.arange(batch.num_rows), rows.value_lengths().to_numpy())
            lists = flat.field("near")
            of = np.repeat(of, lists.value_lengths().to_numpy())
            owner, near, score, fresh = _best(of, lists.flatten().to_numpy(), flat.field("score").flatten().to_numpy(), flat.field("fresh").flatten().to_numpy(zero_copy_only=False), most)
            size = np.bincount(owner, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(near, size, pa.int64()), _lists(score, size, pa.float32()), _lists(fresh, size, pa.bool_())], names=["id", "near", "score", "fresh"])

    return gathered.mapInArrow(run, GRAPH)


def _emit(ids: np.ndarray, owner: np.ndarray, near: np.ndarray, score: np.ndarray, most: int) -> pa.RecordBatch:
    owner, near, score, _ = _best(owner, near, score, np.ones(len(near), bool), most)
    size = np.bincount(owner, minlength=len(ids))
    some = size > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[some]), _lists(ids[near], size[some], pa.int64()), _lists(score, size[some], pa.float32()), _lists(np.ones(len(near), bool), size[some], pa.bool_())],
        names=["id", "near", "score", "fresh"],
    )


def split_cells(placed: DataFrame, nodes: DataFrame, leaf: int = LEAF) -> DataFrame:
    """``placed`` (tree, cell, id) with cells of more than ``2 * leaf`` nodes split until they are small.

    A plane goes through the median of its cell, so that it divides a tight cluster as well as any other. Only a cell
    whose nodes all have one code is left large: no plane divides it.
    """
    done, left, turn = [], placed, 0
    own = ["tree", "cell"]
    while True:
        large = _stored(left.groupBy(*own).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * leaf), "large")
        most = large.agg(F.max("n")).first()[0]
        done.append(left.join(large, own, "left_anti"))
        if most is None:
            return functools.reduce(DataFrame.union, done)
        bits = int(math.log2(most / leaf))

        def sides(batches, bits=bits, turn=turn):
            planes = {}
            for batch in batches:
                x = _matrix(batch.column(3), batch.column(4)).astype(np.float32)
                tree, cell = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                of = tree * SETS + cell % SETS
                side = np.empty((len(x), bits), np.float32)
                for k in np.unique(of).tolist():
                    if k not in planes:
                        planes[k] = np.random.default_rng([turn, k]).normal(size=(x.shape[1], bits)).astype(np.float32)
                    side[of == k] = x[of == k] @ planes[k]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], batch.column(5), _lists(side.ravel(), np.full(len(x), bits), pa.float32())], names=["tree", "cell", "id", "n", "side"]
                )

        within = left.join(large, own).join(nodes.select("id", "c", "s"), "id").select(*own, "id", "c", "s", "n")
        within = _stored(within.mapInArrow(sides, "tree bigint, cell bigint, id bigint, n bigint, side array<float>"), "sides")
        each = [F.col("side")[b] for b in range(bits)]
        middle = within.groupBy(*own).agg(
            F.array(*[F.percentile_approx(p, 0.5) for p in each]).alias("middle"), F.array(*[F.max(p) for p in each]).alias("high"), F.array(*[F.min(p) for p in each]).alias("low")
        )
        # Each bit: above the middle; where nothing is above it, at the middle.
        over = [F.when(F.col("middle")[b] < F.col("high")[b], p > F.col("middle")[b]).otherwise(p == F.col("high")[b]) for b, p in enumerate(each)]
        # A cell takes as many planes as its size asks for.
        code = F.concat_ws("", *[F.when(F.col("n") >= (leaf << (b + 1)), o.cast("int").cast("string")) for b, o in enumerate(over)])
        met = within.join(middle, own).withColumn("flat", F.col("low") == F.col("high"))
        met = _stored(met.select(*own, "id", "flat", F.xxhash64("cell", F.lit(turn), code).alias("to")), "split")
        done.append(met.where("flat").select(*own, "id"))
        left, turn = met.where("NOT flat").select("tree", F.col("to").alias("cell"), "id"), turn + 1


def first_graph(nodes: DataFrame, n: int, most: int = NEIGHBOURS, trees: int = TREES, beside: int = BESIDE, leaf: int = LEAF) -> DataFrame:
    """Neighbours within random-projection cells, each of up to ``2 * leaf`` nodes and compared exhaustively."""
    bits = max(0, math.ceil(math.log2(max(1, n / leaf))))

    def cells(batches):
        for batch in batches:
            x = _matrix(batch.column(1), batch.column(2))
            draw = np.random.default_rng(5)
            for tree in range(trees):
                side = x @ draw.normal(size=(x.shape[1], bits))
                code = (side > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                close = np.argsort(np.abs(side), 1)[:, :beside]
                for extra in [code, *[code ^ (1 << close[:, k]) for k in range(close.shape[1])]]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), tree)), pa.array(extra.astype(np.int64)), batch.column(0)], names=["tree", "cell", "id"])

    placed = nodes.select("id", "c", "s").mapInArrow(cells, "tree bigint, cell bigint, id bigint")
    placed = _stored(split_cells(_stored(placed, "cells"), nodes, leaf), "cells")
    # Only nodes of one code are still more than that in a cell; all are equally near each other, whatever their part.
    sizes = placed.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("n"))
    part = F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("n") / (2 * leaf)))
    dealt = placed.join(sizes, ["tree", "cell"]).select("tree", "cell", part.alias("part"), "id")
    gathered = dealt.join(nodes.select("id", "c", "s"), "id").groupBy("tree", "cell", "part").agg(F.collect_list(F.struct("id", "c", "s")).alias("rows"))

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column(3)[i].values
                ids, x = rows.field("id").to_numpy(), _matrix(rows.field("c"), rows.field("s")).astype(np.float32)
                few = min(most, len(ids) - 1)
                if few < 1:
                    continue
                score = x @ x.T
                np.fill_diagonal(score, -np.inf)
                near = np.argpartition(-score, few - 1, 1)[:, :few]
                yield _emit(ids, np.repeat(np.arange(len(ids)), few), near.ravel(), np.take_along_axis(score, near, 1).ravel(), most)

    return merged(gathered.mapInArrow(compare, GRAPH), most)


def descend(graph: DataFrame, nodes: DataFrame, most: int = NEIGHBOURS, sample: int = SAMPLE, seed: int = 0) -> DataFrame:
    """One round of NN-descent over a stored graph."""
    edges = graph.select("id", F.posexplode(F.arrays_zip("near", "fresh")).alias("k", "e")).select("id", "k", F.col("e.near").alias("near"), F.col("e.fresh").alias("fresh"))
    chance = F.xxhash64("id", "near", F.lit(seed))
    own = edges.withColumn("r", F.row_number().over(Window.partitionBy("id", "fresh").orderBy(chance))).where(F.col("r") <= sample).drop("r")
    own = _stored(own, "edges")
    back = own.select(F.col("near").alias("id"), F.col("id").alias("near"), "fresh")
    back = back.withColumn("r", F.row_number().over(Window.partitionBy("id", "fresh").orderBy(chance))).where(F.col("r") <= sample).drop("r")
    around = own.select("id", "near", "fresh").union(back).groupBy("id", "near").agg(F.max("fresh").alias("fresh"))
    # What a newcomer must beat.
    worst = graph.select("id", F.when(F.size("near") >= most, F.array_min("score")).otherwise(F.lit(float("-inf"))).cast("float").alias("worst"))
    known = nodes.select("id", "c", "s").join(worst, "id").withColumnRenamed("id", "near")
    gathered = around.join(known, "near").groupBy("id").agg(F.collect_list(F.struct("near", "c", "s", "fresh", "worst")).alias("rows"))

    def meet(batches):
        for batch in batches:
            for rows in batch.column(1):
                rows = rows.values
                fresh = rows.field("fresh").to_numpy(zero_copy_only=False)
                if len(rows) < 2 or not fresh.any():
                    continue
                ids, x, worst = rows.field("near").to_numpy(), _matrix(rows.field("c"), rows.field("s")).astype(np.float32), rows.field("worst").to_numpy()
                score = x @ x.T
                np.fill_diagonal(score, -np.inf)
                owner, near = np.nonzero((fresh[:, None] | fresh[None, :]) & (score > worst[:, None]))
                if len(owner):
                    yield _emit(ids, owner, near, score[owner, near], most)

    found = gathered.mapInArrow(meet, GRAPH)
    # Those brought together now are new no longer.
    used = own.where("fresh").groupBy("id").agg(F.collect_set("near").alias("used"))
    kept = graph.join(used, "id", "left").select(
        "id", "near", "score", F.zip_with("near", "fresh", lambda w, f: f & ~F.coalesce(F.array_contains(F.col("used"), w), F.lit(False))).alias("fresh")
    )
    return merged(kept.union(found), most)


def unsettled(graph: DataFrame) -> float:
    """Share of all neighbours that are new: not yet brought together with the others of their node."""
    new = F.size(F.filter("fresh", lambda f: f))
    return graph.agg(F.sum(new) / F.greatest(F.sum(F.size("near")), F.lit(1))).first()[0] or 0.0


def search(starts: DataFrame, links: DataFrame, nodes: DataFrame, beam: int = BEAM) -> DataFrame:
    """(q, near): the best ``beam`` nodes that greedy search from each start (id) meets, the start among them."""
    begin = starts.join(nodes.select("id", "c", "s"), "id").select(F.col("id").alias("q"), "c", "s")
    state = begin.select("q", "c", "s", F.array("q").alias("near"), F.array(F.lit(3.0e38).cast("float")).alias("score"), F.array(F.lit(True)).alias("fresh"))
    state = _stored(state, "beams")

    def run(batches):
        for batch in batches:
            own = _matrix(batch.column(1), batch.column(2))
            had, got = batch.column(3), batch.column(6)
            sizes = had.value_lengths().to_numpy()
            owner, near = np.repeat(np.arange(batch.num_rows), sizes), had.flatten().to_numpy()
            score = batch.column(4).flatten().to_numpy()
            new_owner = np.repeat(np.arange(batch.num_rows), got.fill_null([]).value_lengths().to_numpy() if got.null_count else got.value_lengths().to_numpy())
            rows = got.flatten()
            fresh = np.zeros(len(near), bool)
            if len(rows):
                fresh_score = np.empty(len(rows), np.float32)
                for low in range(0, len(rows), 65_536):
                    few = rows.slice(low, 65_536)
                    x = _matrix(few.field("c"), few.field("s"))
                    fresh_score[low : low + 65_536] = np.einsum("ij,ij->i", x, own[new_owner[low : low + 65_536]])
                owner = np.append(owner, new_owner)
                near, score = np.append(near, rows.field("id").to_numpy()), np.append(score, fresh_score)
                fresh = np.append(fresh, np.ones(len(rows), bool))
            owner, near, score, fresh = _best(owner, near, score, fresh, beam)
            size = np.bincount(owner, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _lists(near, size, pa.int64()), _lists(score, size, pa.float32()), _lists(fresh, size, pa.bool_())],
                names=["q", "c", "s", "near", "score", "fresh"],
            )

    while True:
        front = state.select("q", F.explode(F.filter(F.arrays_zip("near", "fresh"), lambda e: e["fresh"])).alias("e")).select("q", F.col("e.near").alias("id"))
        if front.isEmpty():
            return state.select("q", F.explode("near").alias("near"))
        met = front.join(links, "id").select("q", F.col("near").alias("id")).distinct()
        scored = met.join(nodes.select("id", "c", "s"), "id").groupBy("q").agg(F.collect_list(F.struct("id", "c", "s")).alias("rows"))
        state = _stored(state.join(scored, "q", "left").mapInArrow(run, "q bigint, c binary, s float, near array<bigint>, score array<float>, fresh array<boolean>"), "beams")


def nearest(vectors: DataFrame, every: int = 20, top: int = 20, beam: int = BEAM, rounds: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (id divisible by ``every``) its ``top`` nearest found.

    Nearest first, ties to the smaller id; fewer where there are fewer rows. Null, empty and zero vectors, vectors with
    a null or non-finite component, vectors of an uncommon length and null ids take no part. Rows with one id count
    once. Equal vectors are one node of the graph and all stand in the results. ``rounds`` of NN-descent are made, as
    many as it takes where none are given. Other columns are ignored whatever
    their names; an empty table gives an empty table.
    """
    rows = usable(vectors, id_col, vector_col)
    classes = rows.groupBy("v").agg(F.min("id").alias("node"))
    members = _stored(rows.join(classes, "v").select("id", "node"), "members")
    nodes = _stored(coded(classes.select(F.col("node").alias("id"), "v")), "nodes")
    graph = _stored(first_graph(nodes, nodes.count()), "graph")
    k = 0
    while (unsettled(graph) > SETTLED) if rounds is None else (k < rounds):
        graph = _stored(descend(graph, nodes, seed=k), "graph")
        k += 1
    edges = graph.select("id", F.explode(F.arrays_zip("near", "score")).alias("e")).select("id", F.col("e.near").alias("near"), F.col("e.score").alias("score"))
    # Of the nodes that have a node among their neighbours, its nearest.
    back = edges.select(F.col("near").alias("id"), F.col("id").alias("near"), "score")
    back = back.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "near"))).where(F.col("r") <= 2 * NEIGHBOURS)
    links = _stored(edges.select("id", "near").union(back.select("id", "near")).distinct(), "links")
    queries = members.where(F.pmod("id", F.lit(every)) == 0).select(F.col("id").alias("query_id"), "node")
    found = search(queries.select(F.col("node").alias("id")).distinct(), links, nodes, beam)
    originals = rows.select("id", "v")
    pair = found.join(originals.select(F.col("id").alias("q"), F.col("v").alias("a")), "q").join(originals.select(F.col("id").alias("near"), F.col("v").alias("b")), "near")
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)
    scored = _stored(pair.select("q", "near", product.alias("score")), "scored")
    # A node's results can't reach beyond its first top + 1 nodes nor beyond that many of one node's rows.
    best = scored.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "near"))).where(F.col("r") <= top + 1)
    few = members.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("r") <= top + 1)
    spelled = best.select("q", "near", "score").join(few.select(F.col("node").alias("near"), "id"), "near")
    short = spelled.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("r") <= top + 1).select("q", "id", "score")
    out = queries.join(short, queries["node"] == short["q"]).where(F.col("id") != F.col("query_id"))
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= top).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
