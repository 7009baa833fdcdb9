"""Hard negatives by bounds along a spanning tree of anchors.

Anchors that lie close together (one cell of random planes) share a minimum spanning tree. Rows are dealt into blocks, and
every block meets every tree. The tree's root is scored against all rows of the block; from there on, the score of a child
anchor is known to within its edge's length times the row's norm of the parent's score, or of the parent's own bounds.
Only rows whose bounds overlap what an anchor asks for are scored again: at least the k-th best lower bound, and inside
the window. Scores are whole numbers and bounds are widened by more than their rounding, so nothing is lost.

The search runs twice: for the best rows of the anchor's own label, then for those of other labels in the windows that these
positives open. Each block returns the first few per request, and the best of all blocks remain. Anchors are a stated set
of rows; a tree holds at most ``TREE`` and a block about ``BLOCK``, whatever the label or the cell that a third of all rows are in.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow.session import scratch_path

TREE = 512
BLOCK = 8192
#: Length from which a scaled vector takes no part: no long holds its products.
LONGEST = 2.0**31
FOUND = "anchor bigint, request int, row bigint, id bigint, score bigint"


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scaled_rows(vectors: DataFrame, label: Column, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(row, id, label, d, v): rows that take part, components as ``floor(scale * x)``; ``row`` numbers them.

    No part take rows with a null id or label, a null vector, a null or non-finite component, or a scaled length of 2 ** 31.
    """
    v = F.col(vector_col)
    plain = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < math.inf))
    some = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.when(plain, v).alias("x")).where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    x = F.transform("x", lambda e: F.floor(e.cast("double") * scale).cast("double"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))
    rows = some.select("id", "label", F.size("x").alias("d"), x.alias("v")).where(length < LONGEST)
    rows = rows.withColumn("v", F.transform("v", lambda e: e.cast("long")))
    return _stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "d", "v"), "negative-rows")


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree by distance; the root, first, is its own parent."""
    n = len(x)
    parent, edge = np.zeros(n, np.int64), np.full(n, np.inf)
    order, out = np.zeros(n, np.int64), np.ones(n, bool)
    at = 0
    for k in range(n):
        order[k], out[at] = at, False
        off = np.sqrt(((x - x[at]) ** 2).sum(1))
        nearer = out & (off < edge)
        parent[nearer], edge[nearer] = at, off[nearer]
        if k + 1 < n:
            at = int(np.argmin(np.where(out, edge, np.inf)))
    edge[order[0]] = 0
    return order, parent, edge


def _matrix(table: pa.Table) -> np.ndarray:
    values = table.column("v").combine_chunks()
    return values.flatten().to_numpy().reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 0), np.int64)


def trees(anchors: DataFrame, by: list[str], most: int) -> DataFrame:
    """``anchors`` with their ``tree``, place in it (``turn``), parent's place (``under``) and edge to it.

    Anchors of equal ``by`` are dealt into cells of planes through the origin, and cells of more than ``most`` by hash:
    whatever holds so many in one cell, they are close to each other.
    """
    largest = anchors.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, largest / most))))

    def cells(batches):
        for batch in batches:
            d, v = batch.column(1).to_numpy(), batch.column(2)
            cell = np.zeros(batch.num_rows, np.int64)
            for size in np.unique(d).tolist():
                rows = np.flatnonzero(d == size)
                x = v.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1)
                planes = np.random.default_rng(size).normal(size=(size, bits))
                cell[rows] = (x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell)], names=["row", "cell"])

    placed = anchors.withColumn("cell", F.lit(0))
    if bits:
        placed = anchors.join(anchors.select("row", "d", "v").mapInArrow(cells, "row bigint, cell bigint"), "row")
    sizes = placed.groupBy(*by, "cell").agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    dealt = placed.join(sizes, [*by, "cell"]).withColumn("tree", F.xxhash64(*by, "cell", part)).select(*by, "tree", *[c for c in anchors.columns if c not in by])
    names = [f.name for f in dealt.schema]

    def run(group: pa.Table) -> pa.Table:
        order, parent, edge = spanning_tree(_matrix(group).astype(np.float64))
        turn = np.empty(len(order), np.int64)
        turn[order] = np.arange(len(order))
        out = {name: group.column(name) for name in names}
        return pa.table(out | {"turn": pa.array(turn), "under": pa.array(turn[parent]), "edge": pa.array(edge)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return _stored(dealt.groupBy(*by, "tree").applyInArrow(run, f"{schema}, turn bigint, under bigint, edge double"), "anchor-trees")


def _products(x: np.ndarray, a: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as whole numbers: by doubles where these hold every sum, by longs elsewhere."""
    return (x @ a).astype(np.int64) if exact else (x.astype(np.int64) * a.astype(np.int64)).sum(1)


def search(rows: pa.Table, anchors: pa.Table, most: int, same: bool) -> tuple[pa.Table, int]:
    """(the first ``most`` rows of a block for each request of a tree's anchors, how many scores were worked out).

    A request is a window (low, high) of scores; ``same`` asks for rows of the anchor's label but itself, else for others.
    """
    anchors = anchors.sort_by("turn")
    # By id: of equal scores, the first is the one of the smaller id.
    rows = rows.sort_by([("id", "ascending"), ("row", "ascending")])
    x, a = _matrix(rows).astype(np.float64), _matrix(anchors).astype(np.float64)
    norm, own = np.sqrt((x * x).sum(1)), np.sqrt((a * a).sum(1))
    exact = not len(norm) or norm.max() * own.max() < 2**52
    number, label = rows.column("row").to_numpy(), rows.column("label").to_numpy()
    of, labels = anchors.column("row").to_numpy(), anchors.column("label").to_numpy()
    under, edge = anchors.column("under").to_numpy(), anchors.column("edge").to_numpy()
    windows = anchors.column("windows").to_pylist()
    children = np.bincount(under[1:], minlength=len(of))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    out: list[tuple[np.ndarray, ...]] = []
    scored = 0
    for k in range(len(of)):
        if k == 0:
            low = high = _products(x, a[0], exact).astype(np.float64)
            scored += len(x)
        else:
            low, high = bounds[int(under[k])]
            slack = edge[k] * norm + 1e-9 * own[k] * norm + 1
            low, high = low - slack, high + slack
            children[under[k]] -= 1
            if not children[under[k]]:
                del bounds[int(under[k])]
        asked = (label == labels[k]) & (number != of[k]) if same else label != labels[k]
        over = np.zeros(len(x), bool)
        for w in windows[k]:
            sure = low[asked & (low >= w["low"]) & (high <= w["high"])]
            least = max(w["low"], np.partition(sure, len(sure) - most)[len(sure) - most]) if len(sure) >= most else w["low"]
            # Bounds of whole numbers near 2 ** 62 are rounded themselves.
            over |= asked & (high >= least - 1e-9 * abs(least) - 1) & (low <= w["high"])
        if k == 0:
            score = _products(x[over], a[0], exact)
        else:
            score = _products(x[over], a[k], exact)
            scored += len(score)
            low[over] = high[over] = score
        at = np.flatnonzero(over)
        for w in windows[k]:
            inside = np.flatnonzero((score >= w["low"]) & (score <= w["high"]))
            best = inside[np.argsort(-score[inside], kind="stable")[:most]]
            out.append((np.full(len(best), of[k]), np.full(len(best), w["request"]), at[best], score[best]))
        if children[k]:
            bounds[k] = low, high
    parts = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(4)]
    at = parts[2].astype(np.int64)
    columns = [pa.array(parts[0], pa.int64()), pa.array(parts[1], pa.int32()), pa.array(number[at]), pa.array(rows.column("id").to_numpy()[at]), pa.array(parts[3], pa.int64())]
    return pa.table(columns, names=["anchor", "request", "row", "id", "score"]), scored


def found(rows: DataFrame, anchors: DataFrame, windows: DataFrame, by: list[str], most: int, same: bool, tree: int, block: int) -> DataFrame:
    """FOUND: over all rows of equal ``by``, the first ``most`` for every request (row, windows) of an anchor."""
    planted = trees(anchors.join(windows.select("row"), "row", "left_semi"), by, tree)
    # One row per value of ``by``: how many blocks its rows make, and the names of its trees.
    blocks = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    names = planted.groupBy(*by).agg(F.collect_set("tree").alias("trees"))
    plan = _stored(blocks.join(names, by), "negative-blocks")
    each = rows.join(plan, by).select(*by, F.pmod(F.xxhash64("row", F.lit(7)), F.col("blocks")).alias("block"), F.explode("trees").alias("tree"), *[c for c in rows.columns if c not in by])
    asking = planted.join(windows, "row").join(plan.drop("trees"), by).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    keys = [*by, "block", "tree"]

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("anchor", pa.int64()), ("request", pa.int32()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64()))})
        return search(mine, theirs, most, same)[0]

    several = each.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(run, FOUND)
    first = Window.partitionBy("anchor", "request").orderBy(F.desc("score"), "id", "row")
    return _stored(several.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most), "negatives-found")


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    tree: int = TREE,
    block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``rows`` as of ``scaled_rows``.

    An anchor's positives are its first ``positives`` other rows of its label, by score and then the smaller id; the
    negatives of a positive are the first ``negatives`` rows of other labels whose score is between ``window`` percent of
    the positive's. A negative or zero positive score opens the window that these bounds give, mostly none. Every row
    stands for itself: repeated rows and other rows of the same id are rows of their own. Vectors of different lengths have
    no product and don't meet. An anchor without positives, or a positive without negatives, has no row; an empty table
    gives an empty table.
    """
    anchors = _stored(rows.where(is_anchor), "anchors")
    any_score = F.array(F.struct(F.lit(0).alias("request"), F.lit(-(2**62)).cast("long").alias("low"), F.lit(2**62).cast("long").alias("high")))
    near = found(rows, anchors, anchors.select("row", any_score.alias("windows")), ["d", "label"], positives, True, tree, block)
    # Percent of whole numbers as whole numbers: windows are exact.
    share = F.col("score").cast("decimal(20,0)")
    low, high = (f((share * F.lit(p).cast("decimal(3,0)")) / F.lit(100).cast("decimal(3,0)")).cast("long") for f, p in ((F.ceil, window[0]), (F.floor, window[1])))
    asked = near.select(F.col("anchor").alias("row"), F.struct((F.col("rank") - 1).alias("request"), low.alias("low"), high.alias("high")).alias("w")).where("w.low <= w.high")
    windows = asked.groupBy("row").agg(F.collect_list("w").alias("windows"))
    far = found(rows, anchors, windows, ["d"], negatives, False, tree, block)
    positive = near.select("anchor", (F.col("rank") - 1).alias("request"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    out = far.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score").join(positive, ["anchor", "request"]).join(named, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tree: int = TREE, block: int = BLOCK) -> DataFrame:
    """Negatives for every hundredth id; labels of every seventh id are moved to the next of ten first."""
    label = F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))
    return hard_negatives(scaled_rows(vectors, label, 256, id_col, vector_col), F.col("id") % 100 == 0, tree=tree, block=block)


def oracle() -> str:
    """All rows beside all anchors."""
    return """
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scores AS (
    SELECT a.r AS ar, a.id AS anchor_id, b.r AS br, b.id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.id % 100 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)),
  positives AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) AS k FROM scores WHERE same) WHERE k <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
    SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.ar, p.k ORDER BY n.score DESC, n.id, n.br) AS rank
    FROM positives p JOIN scores n ON n.ar = p.ar AND NOT n.same AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score)
WHERE rank <= 10
"""
