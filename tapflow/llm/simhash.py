"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a vector of ``radius + 1`` bits, none of them zero; each of the ``2 ** (radius + 1) - 1`` tables has
such a vector too, and its mask keeps the positions whose vector has an odd product with it. The vectors of up to ``radius``
positions leave some table's vector orthogonal to them all, and that table's mask keeps none of these positions: two
fingerprints that differ there and nowhere else agree under it. So every pair within the radius collides in some table, and
no chance is involved.

Equal fingerprints are one class. Buckets of up to ``SMALL`` classes are compared in one task and give one link per class;
larger ones are taken apart by the same construction over the bits that their mask leaves open, which loses no pair either.
After that at most 2 ** 17 fingerprints agree on all bits that both masks keep, so a bucket's size is bounded by its bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import DataFrame, functions as F

from tapflow.session import scratch_path

from .neardup import connected
from .words import slices, split

WIDTH = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Classes of a bucket that one task compares; larger buckets are taken apart first.
SMALL = 4096
_SPREAD = np.array([int.from_bytes(bytes(b >> k & 1 for k in range(8)), "little") for b in range(256)], np.uint64)
_COUNT = np.array([bin(b).count("1") for b in range(1 << 16)], np.uint8)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shingle_hashes(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle of all texts, how many each text has); words A-Z in lower case, one space between."""
    words, n = split(texts, lower=True), len(texts)
    size = np.bincount(words.row, minlength=n)
    length = np.diff(np.frombuffer(words.word.buffers()[1], np.int64)[: len(words.word) + 1]) if len(words.word) else np.zeros(0, np.int64)
    # All words again with one space after each.
    begin = np.cumsum(length + 1) - (length + 1)
    spaced = np.full(int((length + 1).sum()), 32, np.uint8)
    if len(length):
        inside = np.ones(len(spaced), bool)
        inside[begin + length] = False
        spaced[inside] = np.frombuffer(words.word.buffers()[2], np.uint8)[: int(length.sum())]
    line, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    # A text of fewer words is one shingle.
    taken = np.where(size >= width, size - width + 1, np.minimum(size, 1))
    first = np.cumsum(size) - size
    start = np.repeat(first - (np.cumsum(taken) - taken), taken) + np.arange(taken.sum())
    last = start + np.repeat(np.minimum(size, width), taken) - 1
    ends = begin[last] + length[last]
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(begin[start].tolist(), ends.tolist())), np.uint64, len(start))
    return hashes, taken


def majority(hashes: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Per text the bits that over half of its hashes have; zero without any."""
    out = np.zeros(len(taken), np.uint64)
    text = np.repeat(np.arange(len(taken)), taken)
    # Runs of up to 255 hashes of a text: their sums fit the eight one-byte counters of a word.
    first = np.cumsum(taken) - taken
    cut = np.flatnonzero((np.arange(len(hashes)) - first[text]) % 255 == 0)
    if not len(cut):
        return out
    of = text[cut]
    begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    some = of[begins]
    data = hashes.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        runs = np.add.reduceat(_SPREAD[data[:, byte]], cut).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(runs.astype(np.int64), begins)
        bits = 2 * counts > taken[some][:, None]
        out[some] |= (bits @ (1 << np.arange(8))).astype(np.uint64) << np.uint64(8 * byte)
    return out


def fingerprints(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): each text's fingerprint as a signed long; 0 for one without words."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                prints = majority(*shingle_hashes(texts, width))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])

    return source.mapInArrow(run, f"id {kind}, fp bigint")


def covering(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``positions`` of which, for any ``radius`` of them, at least one keeps none."""
    vectors = (1 << radius + 1) - 1
    given = {p: k % vectors + 1 for k, p in enumerate(positions)}
    return [sum(1 << p for p, v in given.items() if (v & table).bit_count() & 1) for table in range(1, vectors + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): a link from each fingerprint, but one of each component, to one within ``radius``."""
    left, a, b = values.copy(), [], []
    queue: list[np.ndarray] = []
    while len(left):
        if queue:
            one = queue.pop()
        else:
            one, left = left[0], left[1:]
        off = (left ^ one).view(np.uint16).reshape(-1, 4)
        near = _COUNT[off].sum(1, dtype=np.int64) <= radius
        if near.any():
            met = left[near]
            left = left[~near]
            queue += list(met)
            a.append(np.full(len(met), one)), b.append(met)
    none = np.zeros(0, values.dtype)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _compared(buckets: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Links (a, b) within buckets: rows (keys…, fp)."""
    gathered = buckets.groupBy(*keys).agg(F.collect_list("fp").alias("fps")).select("fps")

    def run(batches):
        for batch in batches:
            found = [near_links(row.values.to_numpy(), radius) for row in batch.column(0)]
            a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return gathered.mapInArrow(run, "a bigint, b bigint")


def _tables(rows: DataFrame, masks: list[int]) -> DataFrame:
    """(t, key, fp): each fingerprint under each mask."""
    under = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)]
    return rows.select(F.explode(F.array(*under)).alias("x"), "fp").select("x.t", "x.key", "fp")


def links(classes: DataFrame, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """Links (a, b) that connect all fingerprints (fp, distinct) within ``radius`` of each other."""
    masks = covering(list(range(BITS)), radius)
    every = _tables(classes, masks)
    sizes = _stored(every.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bucket-sizes")
    found = _compared(every.join(sizes.where(F.col("n") <= small).drop("n"), ["t", "key"]), ["t", "key"], radius)
    large = _stored(every.join(sizes.where(F.col("n") > small).drop("n"), ["t", "key"]), "large-buckets")
    # The bits that a table's mask leaves open are covered once more, by masks of that table.
    open_ = [covering([p for p in range(BITS) if not m >> p & 1], radius) for m in masks]
    finer = F.array(*[F.array(*[F.lit(_signed(m)) for m in ms]) for ms in open_])
    deeper = large.select("t", "key", "fp", F.posexplode(F.get(finer, F.col("t"))).alias("u", "mask")).select("t", "key", "u", F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "fp")
    keys = ["t", "key", "u", "part"]
    more = deeper.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return found.union(_compared(deeper.join(more, keys), keys, radius))


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, small: int = SMALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id), one row per row of ``docs``; ``component_id`` is the smallest id reachable.

    A null or empty text, or one without words, has fingerprint zero and links like any other. A text of fewer than
    ``width`` words is one shingle, and repeated shingles count each time. Repeated rows are copies of each other and all
    get their row. A null id is no one's component id: a component without other ids has a null one. Other columns are
    ignored whatever their names; an empty table gives an empty table.
    """
    prints = _stored(fingerprints(docs, width, id_col, text_col), "fingerprints")
    classes = _stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes")
    roots = connected(_stored(links(classes, radius, small), "fingerprint-links")).select(F.col("key").alias("fp"), "root")
    joined = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    component = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = joined.join(component, "root").select("fp", "component_id")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(of_class, "fp").select(F.col("id").alias(id_col), shown, "component_id")
