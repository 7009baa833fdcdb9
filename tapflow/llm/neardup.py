"""MinHash near-duplicates by chosen paths.

A document is its set of word shingles. Every document walks down several independent trees: at each node it follows
``BRANCHES`` chosen coordinates of its MinHash signature, so its child node is named by the minwise tokens chosen so
far. Two documents with similarity s stay together at a step with probability 1 - (1 - s) ** BRANCHES. Nodes of up to
``SMALL`` documents are compared exhaustively; larger ones are first compared with a few of their documents (the
pivots), lose nothing but what is already known to be one component, and branch again. Links are confirmed on whole sets.

Documents with equal sets are one class from the start. Signatures only choose what is compared. A pair at the threshold
of 85 (80) percent has too few equal coordinates for ``MARGIN`` with a chance of 6.3e-7 (4.2e-6), and no tree of one level
brings it together with one of 2.6e-7 (2.6e-6): together below one in 10^5.

What is found alike is a group, whose whole sets meet once. A group of more than ``GROUP_SHINGLES`` is cut into chunks of
documents, each with one document of the first beside its own; only where these leave a group in several components, its
chunks meet pair by pair. So groups cost rows in proportion to their documents, whatever they weigh.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapflow.session import scratch_path

from .bpe import spread
from .words import slices, split

WIDTH = 3
PERCENT = 85
SIGNATURE = 64
TREES = 4
BRANCHES = 2
SMALL = 3000
PIVOTS = 4
LEVELS = 12
#: A pair isn't looked at when its share of equal signature coordinates is this much below the threshold.
MARGIN = 0.25
#: Shingles of a group beyond which it is compared chunk by chunk; a chunk has half as many, or one document.
GROUP_SHINGLES = 2_000_000
#: Documents of a group that meet the others one at a time; most groups are one component by then.
SCANS = 8
#: Values that one set in ``FEW`` holds are counted by matrix products, which take about ``CELLS`` numbers at once.
FEW = 16
CELLS = 1 << 20
#: Nodes of up to so many documents are compared along with others of their size.
TOGETHER = 64
#: Words of 64 bits of the map that tells most texts apart from those whose sets are wanted: the map has 16 MB at most.
MAP_WORDS = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit shingle hashes of all texts, sorted within each, where each text's begin)."""
    words, n = split(texts, lower=True), len(texts)
    code, distinct = words.codes()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))[code]
    size = np.bincount(words.row, minlength=n)
    begin = np.cumsum(size) - size
    with np.errstate(over="ignore"):
        few = np.flatnonzero((size > 0) & (size < width))
        short = np.array([_chain(hashed[begin[i] : begin[i] + size[i]])[0] for i in few], np.uint64)
        m = max(0, len(hashed) - width + 1)
        whole = np.flatnonzero(words.row[:m] == words.row[width - 1 :]) if m else np.zeros(0, np.int64)
        runs = _chain(*[hashed[i : i + m][whole] for i in range(width)]) if len(whole) else np.zeros(0, np.uint64)
    row = np.concatenate([words.row[whole], few])
    value = np.concatenate([runs, short])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return value[first], np.append(0, np.cumsum(np.bincount(row[first], minlength=n)))


def _chain(*parts: np.ndarray) -> np.ndarray:
    if len(parts) == 1:  # the words of one short text
        parts = tuple(parts[0].reshape(-1, 1))
    out = np.full(parts[0].shape, len(parts), np.uint64)
    for p in parts:
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + p)
    return out


def signatures(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(texts, SIGNATURE) minima of independent hashes; zeros for empty sets."""
    draw = np.random.default_rng(1_187)
    odd = draw.integers(0, 2**63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(begin) - 1, SIGNATURE), np.int32)
    some = np.flatnonzero(np.diff(begin))
    if len(some):
        with np.errstate(over="ignore"):
            for k in range(SIGNATURE):
                mixed = values * odd[k]
                mixed ^= mixed >> np.uint64(32)
                mixed *= odd[-1 - k]
                out[some, k] = (np.minimum.reduceat(mixed, begin[some]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def described(docs: DataFrame, width: int) -> DataFrame:
    """(id, n_shingles, key, sig) of rows (id, text): ``key`` names the set (16 bytes), null for an empty one."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                values, begin = shingle_sets(texts, width)
                sig = signatures(values, begin)
                keys = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in itertools.pairwise(begin)]
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1) * SIGNATURE, pa.int32()), pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(begin)), pa.array(keys, pa.binary()), rows], names=["id", "n_shingles", "key", "sig"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n_shingles bigint, key binary, sig array<int>")


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    """(key, hashes, groups, large) of rows (text, groups, large)."""

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                values, begin = shingle_sets(texts, width)
                keys = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in itertools.pairwise(begin)]
                rows = pa.LargeListArray.from_arrays(pa.array(begin), pa.array(values.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), rows, part.column(1), part.column(2)], names=["key", "hashes", "groups", "large"])

    found = docs.select("text", "groups", "large").mapInArrow(run, "key binary, hashes array<bigint>, groups array<bigint>, large boolean")
    return found.where(F.col("key").isNotNull())


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: no lineage, nothing kept on an executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _branches(rows: DataFrame, level: int, times: int) -> DataFrame:
    """Children (path, key, label) of rows (path, key, label, sig): ``times`` coordinates chosen by the node's path."""
    chosen = [F.pmod(F.xxhash64("path", F.lit(level), F.lit(k)), F.lit(SIGNATURE)) for k in range(times)]
    child = F.array(*[F.xxhash64("path", F.lit(k), c, F.element_at("sig", (c + 1).cast("int"))) for k, c in enumerate(chosen)])
    return rows.select(F.explode(child).alias("path"), "key", "label")


def _nodes(rows: DataFrame) -> DataFrame:
    """Rows (path, key, label) whose node holds two labels or more, with the node's size and pivots."""
    stats = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.array_distinct(F.array(*[F.min_by("key", F.xxhash64("key", F.lit(i))) for i in range(PIVOTS)])).alias("pivots"), F.min("label").alias("low"), F.max("label").alias("high"))
    return rows.join(stats.where("n > 1 AND low < high").drop("low", "high"), "path")


def _components(near: np.ndarray) -> np.ndarray:
    """Of each graph in (graphs, n, n), every vertex's smallest connected vertex."""
    n = near.shape[1]
    near = near | np.eye(n, dtype=bool)
    label = np.broadcast_to(np.arange(n, dtype=np.int32), near.shape[:2])
    while True:
        now = np.where(near, label[:, None, :], np.int32(n)).min(2)
        if (now == label).all():
            return now
        label = now


def _alike(sig: np.ndarray, least: float) -> np.ndarray:
    """(nodes, n, n): pairs of documents with enough equal coordinates, for nodes (nodes, n, SIGNATURE) of one size."""
    same = np.zeros((len(sig), sig.shape[1], sig.shape[1]), np.uint8)
    for k in range(SIGNATURE):
        same += sig[:, :, None, k] == sig[:, None, :, k]
    near = same >= least * SIGNATURE
    near[:, np.arange(sig.shape[1]), np.arange(sig.shape[1])] = False
    return near


def met_in(groups_: DataFrame) -> DataFrame:
    """(key, met): the groups that each document is in, as names of 8 bytes; chunks of a group count as the group."""
    name = F.coalesce("heavy", F.xxhash64("members"))
    return groups_.select(name.alias("g"), F.explode("members").alias("key")).groupBy("key").agg(F.collect_set("g").alias("met"))


def _chunks(members: np.ndarray, weight: np.ndarray) -> list[list[bytes]]:
    """``members`` in runs of about ``GROUP_SHINGLES / 2``, the first member in each."""
    run = np.cumsum(weight) // max(1, GROUP_SHINGLES // 2)
    parts = [list(members[run == r]) for r in np.unique(run)]
    return [parts[0], *[[members[0], *p] for p in parts[1:]]]


def _share(groups_of: np.ndarray) -> np.ndarray:
    """(nodes, n, n): pairs of documents with a group in common, for group names (nodes, n, names)."""
    out = np.zeros((*groups_of.shape[:2], groups_of.shape[1]), bool)
    for i in range(groups_of.shape[2]):
        for j in range(groups_of.shape[2]):
            out |= groups_of[:, :, None, i] == groups_of[:, None, :, j]
    return out


def _equal(values: np.ndarray, size: np.ndarray, least: float) -> np.ndarray:
    """(n, n): pairs of sets with ``least`` values in common."""
    out = np.zeros((len(size), len(size)), bool)
    for some, both in _common(*_holders(values, size), size, np.flatnonzero(size)):
        out[some] = both >= least
    return out


def _alike_one(sig: np.ndarray, least: float) -> np.ndarray:
    """``_alike`` for one node (n, SIGNATURE), whose coordinates count as values of sets."""
    numbered = sig.astype(np.int64) + (np.arange(SIGNATURE) << 32)
    near = _equal(numbered.ravel(), np.full(len(sig), SIGNATURE), least * SIGNATURE)
    np.fill_diagonal(near, False)
    return near


def groups(nodes: DataFrame, classes: DataFrame, percent: int, met: DataFrame | None = None) -> DataFrame:
    """(members, heavy): in each small node, the documents that pairs with alike signatures connect.

    A group that is too heavy for one comparison is several rows, its chunks, with the group's name as ``heavy``. Pairs that
    stand in a group of ``met`` together are compared there, and don't count again.
    """
    whole = nodes.join(classes.select("key", "n_shingles", "sig"), "key")
    whole = whole.join(met, "key", "left") if met is not None else whole.withColumn("met", F.lit(None).cast("array<bigint>"))
    whole = whole.withColumn("met", F.coalesce("met", F.array().cast("array<bigint>")))
    least = percent / 100 - MARGIN
    gathered = whole.groupBy("path").agg(F.collect_list(F.struct("key", "label", "n_shingles", "sig", "met")).alias("rows"))

    def parts_of(place: np.ndarray, sig: np.ndarray, names: np.ndarray, first: np.ndarray, held: np.ndarray):
        """(a node's documents, of each its smallest connected one) of the nodes with alike pairs, for documents (nodes, n)."""
        n = place.shape[1]
        if n > TOGETHER:
            for node in place:
                near = _alike_one(sig[node], least)
                if near.any():
                    near &= ~_equal(names[spread(first[node], held[node])], held[node], 1)
                    yield node, _reached(near)
            return
        near = _alike(sig[place], least)
        hit = np.flatnonzero(near.any((1, 2)))
        place, near = place[hit], near[hit]
        most = held[place].max(initial=0)
        if most**2 > SIGNATURE:
            for node, own in zip(place, near):
                own &= ~_equal(names[spread(first[node], held[node])], held[node], 1)
        elif most:
            # Each document's groups in a row, filled up with numbers of its own.
            groups_of = np.broadcast_to(-1 - np.arange(place.size).reshape(*place.shape, 1), (*place.shape, most)).copy()
            own = np.arange(most) < held[place][:, :, None]
            groups_of[own] = names[(first[place][:, :, None] + np.arange(most))[own]]
            near &= ~_share(groups_of)
        yield from zip(place, _components(near))

    def run(batches):
        for batch in batches:
            rows = batch.column(1)
            sizes, flat = rows.value_lengths().to_numpy(), rows.flatten()
            if not len(flat):
                continue
            key, label = np.array(flat.field("key").to_pylist(), object), np.array(flat.field("label").to_pylist(), object)
            weight, sig = flat.field("n_shingles").to_numpy(), flat.field("sig").flatten().to_numpy().reshape(-1, SIGNATURE)
            seen = flat.field("met")
            held, names = seen.value_lengths().to_numpy(), seen.flatten().to_numpy()
            first = np.cumsum(held) - held
            begin = np.cumsum(sizes) - sizes
            out: list[list[bytes]] = []
            heavy: list[int | None] = []
            for n in np.unique(sizes[sizes > 1]):
                at = begin[sizes == n]
                step = max(1, CELLS // n**2)
                for lot in (at[i : i + step] for i in range(0, len(at), step)):
                    for node, part in parts_of(lot[:, None] + np.arange(n), sig, names, first, held):
                        for c in np.unique(part):
                            members = node[part == c]
                            if len(members) < 2 or len(set(label[members])) < 2:
                                continue
                            members = members[np.argsort(key[members])]
                            if weight[members].sum() <= GROUP_SHINGLES:
                                out.append(list(key[members]))
                                heavy.append(None)
                            else:
                                parts = _chunks(key[members], weight[members])
                                name = xxhash.xxh64_intdigest(b"".join(key[members])) - (1 << 63)
                                out += parts
                                heavy += [name] * len(parts)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.binary())), pa.array(heavy, pa.int64())], names=["members", "heavy"])

    return gathered.mapInArrow(run, "members array<binary>, heavy bigint")


def _holders(values: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each value of all sets its number among the distinct ones; which sets hold number 0, then 1, and so on; how many hold each."""
    by = np.argsort(values, kind="stable")
    new = np.ones(len(by), bool)
    new[1:] = values[by[1:]] != values[by[:-1]]
    place = np.empty(len(by), np.int32)
    place[by] = np.cumsum(new) - 1
    row = np.repeat(np.arange(len(size), dtype=np.int32), size)
    return place, row[by], np.diff(np.append(np.flatnonzero(new), len(by)))


def _common(place: np.ndarray, holder: np.ndarray, held: np.ndarray, size: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(some of ``rows``, how many values each has in common with every set), for the sets of ``_holders``.

    Values that many sets hold are multiplied as matrices of 0 and 1; of others each holder meets the other ones.
    """
    n = len(size)
    begin, at = np.cumsum(size) - size, np.cumsum(held) - held
    many, few = np.flatnonzero((held > 1) & (held * FEW >= n)), (held > 1) & (held * FEW < n)
    step = max(1, CELLS // n)
    for some in (rows[i : i + step] for i in range(0, len(rows), step)):
        both = np.zeros((len(some), n), np.int64)
        for k in range(0, len(many), step):
            own = many[k : k + step]
            has = np.zeros((n, len(own)), np.float32)
            has[holder[spread(at[own], held[own])], np.repeat(np.arange(len(own)), held[own])] = 1
            both += (has[some] @ has.T).astype(np.int64)
        of, value = np.repeat(np.arange(len(some)), size[some]), place[spread(begin[some], size[some])]
        of, value = of[few[value]], value[few[value]]
        lots = np.cumsum(held[value]) // CELLS
        for i, j in itertools.pairwise(np.searchsorted(lots, np.arange(lots[-1] + 2 if len(lots) else 1))):
            cell = np.repeat(of[i:j], held[value[i:j]]) * n + holder[spread(at[value[i:j]], held[value[i:j]])]
            both += np.bincount(cell, minlength=both.size).reshape(both.shape)
        yield some, both


def _reached(near: np.ndarray) -> np.ndarray:
    """Of the graph (n, n) every vertex's smallest connected vertex; each row is read once, however long the ways are."""
    label = np.full(len(near), -1)
    for one in range(len(near)):
        if label[one] < 0:
            edge = np.array([one])
            while len(edge):
                label[edge] = one
                edge = np.flatnonzero(near[edge].any(0) & (label < 0))
    return label


def _linked(values: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Of each set its component's smallest member, by whole sets.

    The documents whose shingles most others share are compared with all, one after another. Once the documents not yet
    taken are one component, no pair is left that could join two. After ``SCANS`` of them, all documents outside the
    largest component are compared with all at once.
    """
    n = len(size)
    place, holder, held = _holders(values, size)
    row = np.repeat(np.arange(n, dtype=np.int32), size)
    begin = np.append(0, np.cumsum(size))
    common = np.bincount(row, held[place], n) / size
    label = np.arange(n)
    order = np.argsort(-common, kind="stable")
    for at, one in enumerate(order):
        rest = label[order[at:]]
        if (rest == rest[0]).all():
            return label
        if at == SCANS:
            break
        mark = np.zeros(len(held), bool)
        mark[place[begin[one] : begin[one + 1]]] = True
        both = np.bincount(row, mark[place], n)
        near = 100 * both >= percent * (size + size[one] - both)
        joined = np.unique(label[near])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    largest = label == np.bincount(label).argmax()
    left = np.flatnonzero(~largest)
    # The largest component is vertex 0, the documents left are the others.
    graph = np.zeros((len(left) + 1, len(left) + 1), bool)
    at = 1
    for some, both in _common(place, holder, held, size, left):
        near = 100 * both >= percent * (size[some, None] + size - both)
        graph[at : at + len(some), 1:] = near[:, left]
        graph[at : at + len(some), 0] = near[:, largest].any(1)
        at += len(some)
    graph[0] = graph[:, 0]
    vertex = np.zeros(n, np.int64)
    vertex[left] = np.arange(1, len(left) + 1)
    part = _reached(graph)[vertex]
    least = np.full(len(graph), n)
    np.minimum.at(least, part, np.arange(n))
    return least[part]


def links_of_groups(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) for documents that confirmed links connect within a group, of rows (group, key, hashes); one row per document at most."""

    def run(group: pa.Table) -> pa.Table:
        # One group at a time: a task holds no more than its heaviest group.
        key, lists = group.column("key").combine_chunks(), group.column("hashes").combine_chunks()
        root = _linked(lists.flatten().to_numpy(), lists.value_lengths().to_numpy(), percent)
        other = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": key.take(pa.array(root[other])), "b": key.take(pa.array(other))})

    return rows.groupBy("group").applyInArrow(run, "a binary, b binary")


def links_within(groups_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``links_of_groups`` for groups (members), with their documents' sets looked up."""
    # The same group from several trees is compared once.
    rows = groups_.select(F.xxhash64("members").alias("group"), F.explode("members").alias("key")).distinct()
    return links_of_groups(rows.join(sets.select("key", "hashes"), "key").select("group", "key", "hashes"), percent)


def links_between_chunks(groups_: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links that chunks of heavy groups have with each other, where ``roots`` (key, root) leave a group in several components."""
    chunks = groups_.where("heavy IS NOT NULL").select("heavy", "members").distinct()
    if chunks.isEmpty():
        return None
    label = F.coalesce("root", "key")
    seen = chunks.withColumn("key", F.explode("members")).join(roots, "key", "left").groupBy("heavy", "members").agg(F.min(label).alias("low"), F.max(label).alias("high"))
    seen = _stored(seen, "chunks")
    one, other = (seen.select("heavy", F.col("members").alias(m), F.col("low").alias(f"low_{m}"), F.col("high").alias(f"high_{m}")) for m in ("m", "o"))
    apart = (F.col("low_m") != F.col("high_o")) | (F.col("low_o") != F.col("high_m"))
    # Chunks and not documents: a node has SMALL documents at most, and a chunk is one or half of GROUP_SHINGLES.
    pairs = one.join(other, "heavy").where((F.col("m") < F.col("o")) & apart).select(F.array_union("m", "o").alias("members"))
    return links_within(pairs, sets, percent)


def pivot_links(nodes: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) for documents of large nodes that are linked with a pivot of their node."""
    pairs = nodes.select(F.explode("pivots").alias("pivot"), "key").where(F.col("key") != F.col("pivot")).distinct()
    own, other = classes.select("key", "sig"), classes.select(F.col("key").alias("pivot"), F.col("sig").alias("other"))
    same = F.size(F.filter(F.zip_with("sig", "other", lambda x, y: x == y), lambda e: e))
    alike = pairs.join(own, "key").join(other, "pivot").where(same >= (percent / 100 - MARGIN) * SIGNATURE).select("pivot", "key")
    mine, theirs = sets.select("key", "hashes"), sets.select(F.col("key").alias("pivot"), F.col("hashes").alias("others"))
    both = F.size(F.array_intersect("hashes", "others"))
    union = F.size("hashes") + F.size("others") - both
    return alike.join(mine, "key").join(theirs, "pivot").where(100 * both >= percent * union).select(F.col("pivot").alias("a"), F.col("key").alias("b"))


def _leftover(nodes: DataFrame) -> DataFrame:
    """Large nodes that no level could split, as small nodes: each pair of chunks is one, so every pair of documents meets."""
    chunks = F.ceil(F.col("n") / (SMALL / 4))
    cut = nodes.withColumn("chunk", F.pmod(F.xxhash64("key"), chunks)).withColumn("chunks", chunks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    paired = cut.withColumn("other", other)
    return paired.select(
        F.xxhash64("path", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("path"), "key", "label"
    ).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(key, root): every linked document with the smallest key that links reach. Rounds of least labels with shortcuts."""
    both = _stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("m")).select("key", F.least("key", "m").alias("root"))
    labels = _stored(labels, "roots")
    while True:
        over = both.join(labels.select(F.col("key").alias("b"), "root"), "b").groupBy(F.col("a").alias("key")).agg(F.min("root").alias("m"))
        near = labels.join(over, "key").select("key", "root", F.least("root", "m").alias("new"))
        # Then the root's own root, if it has a smaller one.
        jump = labels.select(F.col("key").alias("new"), F.col("root").alias("far"))
        now = _stored(near.join(jump, "new", "left").select("key", "root", F.least("new", F.coalesce("far", "new")).alias("new")), "roots")
        changed = now.where(F.col("root") != F.col("new")).limit(1).count()
        labels = now.select("key", F.col("new").alias("root"))
        if not changed:
            return labels


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.union(more)
    return out


def _likely(source: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``source`` whose id may be among ``ids``: all that are, and few others while ids are fewer than bits.

    A map of ``MAP_WORDS`` words of 64 bits, one bit per id by its hash, is all that is broadcast, however many ids there are.
    """

    def place(of: str) -> tuple[Column, Column]:
        h = F.xxhash64(of)
        bit = F.lit(1).cast("bigint")
        return F.pmod(h, F.lit(MAP_WORDS)).alias("word"), F.call_function("shiftleft", bit, F.pmod(F.shiftright(h, 20), F.lit(64)).cast("int")).alias("bit")

    marks = ids.select(*place("id")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    placed = source.select("*", *place("id")).join(F.broadcast(marks), "word")
    return placed.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).drop("word", "bit", "bits")


def _descend(large: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, found: list[DataFrame]) -> list[DataFrame]:
    """Take large nodes apart level by level: pivots' links are returned, groups of small nodes are added to ``found``."""
    links: list[DataFrame] = []
    if large.isEmpty():
        return links
    # Levels read what these nodes hold, not the whole tables again.
    own = large.select("key").distinct()
    classes = _stored(classes.join(own, "key", "left_semi").select("key", "n_shingles", "sig"), "classes-of-nodes")
    for level in range(1, LEVELS + 1):
        if large.isEmpty():
            break
        near = _stored(pivot_links(large, classes, sets, percent), "pivot-links")
        links.append(near)
        # A label is a document that a confirmed link reaches: of equal labels nothing is left to find.
        known = large.select("key", "label").union(near.select("b", "a")).groupBy("key").agg(F.min("label").alias("label"))
        over = near.join(known, near["a"] == known["key"]).select(F.col("b").alias("key"), "label")
        known = known.union(over).groupBy("key").agg(F.min("label").alias("label"))
        labelled = large.select("path", "key").join(known, "key")
        met = met_in(_union(found))
        if level == LEVELS:
            found.append(_stored(groups(_leftover(_nodes(labelled)), classes, percent, met), "groups-of-nodes"))
            break
        open_ = _nodes(labelled).select("path", "key", "label").join(classes.select("key", "sig"), "key")
        nodes = _stored(_nodes(_branches(open_, level, BRANCHES)), "nodes")
        found.append(_stored(groups(nodes.where(F.col("n") <= SMALL), classes, percent, met), "groups-of-nodes"))
        large = nodes.where(F.col("n") > SMALL)
    return links


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``docs``; ``component_id`` is the smallest id reachable.

    A null or empty text, or one without words, has no shingles and is alone. A text of fewer than ``width`` words is
    one shingle. Repeated rows are copies of each other and all get their row. A null id is no one's component id:
    a component without other ids has a null one, and such rows are not ``kept`` (null). Other columns are ignored
    whatever their names; an empty table gives an empty table.
    """
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = _stored(described(source, width), "described")
    classes = _stored(
        rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("id").alias("least_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")),
        "classes",
    )
    roots = classes.select(F.explode(F.sequence(F.lit(1), F.lit(TREES))).alias("path"), "key", F.col("key").alias("label"), "sig")
    roots = roots.withColumn("path", F.col("path").cast("long"))
    # The first tree finds most; what it has brought together the others need not compare again.
    nodes = [_stored(_nodes(_branches(roots.where(tree), 0, BRANCHES)), "nodes") for tree in ("path = 1", "path > 1")]
    found = [_stored(groups(nodes[0].where(F.col("n") <= SMALL), classes, percent), "groups-of-nodes")]
    found.append(_stored(groups(nodes[1].where(F.col("n") <= SMALL), classes, percent, met_in(found[0])), "groups-of-nodes"))
    large = _union(nodes).where(F.col("n") > SMALL)
    every = _union(found)
    # Each document's groups go with its text, so that its set goes to them once, straight from where it is made.
    of_key = every.select(F.explode("members").alias("key"), F.xxhash64("members").alias("g"), F.lit(False).alias("large"))
    of_key = of_key.unionByName(large.select("key", F.lit(True).alias("large")).distinct(), allowMissingColumns=True)
    of_key = of_key.groupBy("key").agg(F.collect_set("g").alias("groups"), F.max("large").alias("large"))
    ids = of_key.join(classes.select("key", "least_id"), "key").groupBy(F.col("least_id").alias("id"))
    # Rows of one id with other sets are compared along with it: they get links that they have, no others.
    ids = _stored(ids.agg(F.array_distinct(F.flatten(F.collect_list("groups"))).alias("groups"), F.max("large").alias("large")), "wanted")
    texts = _likely(source, ids).join(ids.withColumnRenamed("id", "wanted").hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("wanted")))
    sets = _stored(sets_of(texts, width), "sets")

    links = [links_of_groups(sets.select(F.explode("groups").alias("group"), "key", "hashes"), percent)]
    early = len(found)
    links += _descend(large, classes, sets.where("large").select("key", "hashes"), percent, found)
    if found[early:]:
        links.append(links_within(_union(found[early:]), sets.where("large"), percent))
    all_links = _stored(_union(links), "confirmed")
    roots_of = connected(all_links)
    more = links_between_chunks(_union(found), roots_of, sets, percent)
    if more is not None:
        roots_of = connected(all_links.union(_stored(more, "confirmed")))
    joined = classes.select("key", "least_id").join(roots_of, "key", "left").select("key", "least_id", F.coalesce("root", "key").alias("root"))
    least = joined.groupBy("root").agg(F.min("least_id").alias("component"))
    of_class = joined.join(least, "root").select("key", "component")
    out = rows.select("id", "n_shingles", "key").join(of_class, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (F.col("id") == component).alias("kept"))


def keep_first(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the one of the smallest id (a null id is the smallest).

    Rows with the same id and text are copies, of which one stays; rows with the same id and other texts are
    documents of their own.
    """
    own = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.xxhash64(F.lit(1), text_col).alias("g"))
    keyed = docs.withColumn("__id", own)
    first = near_duplicates(keyed.select("__id", F.col(text_col).alias("text")), width, percent, "__id", "text")
    good = first.where("kept").select("__id").distinct()
    return keyed.join(good.hint("shuffle_hash"), "__id", "left_semi").dropDuplicates(["__id"]).select(*docs.columns)
