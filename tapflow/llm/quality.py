"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing: every word form has a fixed sparse vector of a few +1 and -1, its own *index vector*, which comes from
its hash and needs no table; its *context vector* is the sum of the index vectors of its neighbours over the whole corpus.
Context vectors are kept in a number of rows that is a parameter (``buckets``) and not the corpus's: forms of one row
share their contexts, never their index vectors. A document is what its words' vectors pool to: their sums, the means
of both and the spread of the context vectors. Nothing else enters a score. The network is fitted in numpy on a
bounded sample of labelled rows and its probabilities are calibrated by a temperature on rows it was not fitted on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import Column, DataFrame, functions as F

from tapflow.session import scratch_path

from .words import SPACE, bytes_of, packed, slices

BUCKETS = 8192
DIMENSIONS = 64
NONZERO = 4
#: Neighbours on each side.
REACH = 2
#: Most labelled rows that the network is fitted on.
FIT_ROWS = 30_000
THRESHOLD = 0.3
#: Words whose vectors are added up at once.
STEP = 1 << 16

#: 1 upper-case letter, 2 other letter, 3 digit, 4 anything else.
_KIND = np.full(256, 4, np.uint8)
_KIND[65:91] = 1
_KIND[97:123] = 2
_KIND[128:] = 2
_KIND[48:58] = 3


def index_vectors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs), each (forms, NONZERO): the nonzero entries of each form's index vector, from its 64-bit hash."""
    k = np.arange(NONZERO, dtype=np.uint64)
    places = (hashes[:, None] >> (k * np.uint64(8))) % np.uint64(DIMENSIONS)
    signs = (hashes[:, None] >> (k + np.uint64(8 * NONZERO))) & np.uint64(1)
    return places.astype(np.int64), 1 - 2 * signs.astype(np.int64)


def rows_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The row of each form's context vector, from bits that its index vector leaves alone."""
    return ((hashes >> np.uint64(9 * NONZERO)) % np.uint64(buckets)).astype(np.int64)


def forms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters, digits or signs: (text of each, number of each among the distinct forms, the forms' hashes). Case is kept."""
    data, offsets = bytes_of(texts)
    kind = _KIND[data]
    inside = ~SPACE[data]
    change = np.ones(len(data), bool)
    # A capital and the small letters after it are one form.
    change[1:] = (kind[1:] != kind[:-1]) & ~((kind[1:] == 2) & (kind[:-1] == 1)) | ~inside[:-1]
    change[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    start = np.flatnonzero(change & inside)
    kept = np.cumsum(inside, dtype=np.int64)
    ends = np.append(kept[start] - 1, kept[-1] if len(kept) else 0)
    coded = packed(data[inside], ends).dictionary_encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return np.searchsorted(offsets, start, "right") - 1, coded.indices.to_numpy(), hashes


def context_vectors(docs: DataFrame, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """Context vectors of all rows over all texts, whole numbers.

    A task adds up its own texts; what is shuffled is one row per bucket and task, and what comes to the driver
    is one row per bucket.
    """
    columns = [f"c{i}" for i in range(DIMENSIONS)]

    def add(batches):
        total = np.zeros(buckets * DIMENSIONS)
        for batch in batches:
            for _, texts in slices(batch, "text"):
                row, code, hashes = forms(texts)
                places, signs = index_vectors(hashes)
                base = rows_of(hashes, buckets) * DIMENSIONS
                for step in range(1, REACH + 1):
                    near = np.flatnonzero(row[step:] == row[:-step])
                    for a, b in ((code[near], code[near + step]), (code[near + step], code[near])):
                        for k in range(NONZERO):
                            total += np.bincount(base[a] + places[b, k], signs[b, k], buckets * DIMENSIONS)
        table = total.astype(np.int64).reshape(buckets, DIMENSIONS)
        used = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(table[used, i]) for i in range(DIMENSIONS)]], names=["bucket", *columns])

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(add, ", ".join(["bucket bigint", *[f"{c} bigint" for c in columns]]))
    sums = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    out = np.zeros((buckets, DIMENSIONS))
    out[sums["bucket"].to_numpy()] = np.stack([sums[c].to_numpy() for c in columns], 1)
    return out


def word_vectors(context: np.ndarray) -> np.ndarray:
    """(buckets, dimensions): the direction of each context vector, as it differs from the others'."""
    centred = context / np.maximum(np.abs(context).sum(1, keepdims=True), 1)
    centred = centred - centred.mean(0)
    return (centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Per text: its number of words, the sums of their context and of their index vectors, the sum of squares of the former."""
    row, code, hashes = forms(texts)
    n, d = len(texts), DIMENSIONS
    places, signs = index_vectors(hashes)
    own = np.zeros(n * d)
    for k in range(NONZERO):
        own += np.bincount(row * d + places[code, k], signs[code, k], n * d)
    place = rows_of(hashes, len(vectors))
    sums, squares = np.zeros((n, d)), np.zeros((n, d))
    for at in range(0, len(code), STEP):
        within, v = row[at : at + STEP], vectors[place[code[at : at + STEP]]]
        first = np.flatnonzero(np.append(True, within[1:] != within[:-1]))
        sums[within[first]] += np.add.reduceat(v, first, axis=0)
        squares[within[first]] += np.add.reduceat(v * v, first, axis=0)
    return np.hstack([np.bincount(row, minlength=n)[:, None], sums, own.reshape(n, d), squares]).astype(np.float32)


def features(pools: np.ndarray) -> np.ndarray:
    """What the network sees of rows of ``pooled``: means, spread and sums (on a logarithmic scale) of word vectors."""
    size, sums, own, squares = np.split(pools.astype(np.float64), [1, 1 + DIMENSIONS, 1 + 2 * DIMENSIONS], axis=1)
    size = np.maximum(size, 1)
    mean = sums / size
    spread = np.sqrt(np.maximum(squares / size - mean**2, 0))
    long = np.log1p(np.abs(sums))
    return np.hstack([mean, own / size / NONZERO**0.5, spread, np.sign(sums) * long, long, np.sign(own) * np.log1p(np.abs(own))])


def document_vectors(docs: DataFrame, vectors: np.ndarray, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` of each row and ``v``, its row of ``pooled``. No shuffle."""
    source = docs.select(*keys, F.col(text_col).cast("string").alias("__text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[: len(keys)]]

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "__text"):
                got = pooled(texts, vectors)
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * got.shape[1], pa.int32()), pa.array(got.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], rows], names=[*keys, "v"])

    return source.mapInArrow(run, ", ".join([*kinds, "v array<float>"]))


@dataclass
class Network:
    """Standardised inputs, one hidden layer, one logit, a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits)) if len(y) else 0.0


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature at which the loss is least.

    Labels count as Platt's targets, a little within 0 and 1, so that there is such a temperature also where the logits
    part the labels without a fault. The loss is convex in 1 / temperature: its slope is bisected.
    """
    good = int(y.sum())
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    low, high = np.log(1e-3), np.log(1e3)
    for _ in range(60):
        middle = (low + high) / 2
        p = 1 / (1 + np.exp(-np.clip(logits * np.exp(middle), -30, 30)))
        low, high = (low, middle) if float(((p - target) * logits).sum()) > 0 else (middle, high)
    return float(np.exp(-(low + high) / 2))


def fit(x: np.ndarray, y: np.ndarray, aside: np.ndarray, hidden: int = 32, epochs: int = 60, decay: float = 1e-3, rate: float = 3e-3) -> Network:
    """Adam on the cross-entropy; the epoch and the temperature that suit the rows set ``aside`` best are kept.

    Without rows, or with one label only, every probability is the labels' mean (0.5 without any).
    """
    draw = np.random.default_rng(7)
    width = x.shape[1]
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(width), np.ones(width))
    flat = Network(mean, scale, np.zeros((width, hidden)), np.zeros(hidden), np.zeros(hidden), 0.0)
    if len(np.unique(y)) < 2:
        rate_of = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        flat.b2 = float(np.log(rate_of / (1 - rate_of)))
        return flat
    own, other = ~aside, aside if aside.any() and not aside.all() else ~aside
    if aside.all():
        own = aside
    z, t = ((x - mean) / scale)[own], y[own].astype(float)
    params = [draw.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), draw.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    best, kept, step = np.inf, params, 0
    for _ in range(epochs):
        order = draw.permutation(len(z))
        for at in range(0, len(z), 256):
            rows = order[at : at + 256]
            h = np.tanh(z[rows] @ params[0] + params[1])
            error = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30))) - t[rows]
            back = np.outer(error, params[2]) * (1 - h * h)
            grads = [z[rows].T @ back / len(rows) + decay * params[0], back.mean(0), h.T @ error / len(rows) + decay * params[2], np.array([error.mean()])]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        now = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
        if (loss := _loss(now.logits(x[other]), y[other])) < best:
            best, kept = loss, [p.copy() for p in params]
    out = Network(mean, scale, kept[0], kept[1], kept[2], float(kept[3][0]))
    out.temperature = temperature(out.logits(x[other]), y[other])
    return out


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def learnt_from(ids: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(key, q): at most ``fit_rows`` labelled ids that aren't held out, chosen by a hash of the id, with their mean label.

    Only ids are joined. A share of all hashes that holds about twice as many ids as wanted is put in order, however many
    there are.
    """
    marks = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("key"), "quality").where(~held_out(F.col("key")))
    marks = marks.groupBy("key").agg(F.avg("quality").alias("q"))
    known = marks.join(ids.select(F.col("id").alias("key")), "key", "left_semi").withColumn("h", F.xxhash64("key"))
    n = known.count()
    below = (1 << 63) - 1 if n <= 2 * fit_rows else int((2 * fit_rows / n - 0.5) * 2**64)
    return known.where(F.col("h") <= below).orderBy("h", "key").limit(fit_rows).select("key", "q")


def trained(docs: DataFrame, labels: DataFrame, fit_rows: int, buckets: int) -> tuple[np.ndarray, Network]:
    """Word vectors, and the network fitted on at most ``fit_rows`` labelled rows of (id, text); every fifth is set aside."""
    vectors = word_vectors(context_vectors(docs, buckets))
    path = scratch_path(docs.sparkSession, "learnt-from")
    learnt_from(docs, labels, fit_rows).write.parquet(path)
    # No more than ``fit_rows`` rows.
    chosen = F.broadcast(docs.sparkSession.read.parquet(path))
    rows = docs.join(chosen, docs["id"] == chosen["key"]).select("id", "q", "text")
    learn = document_vectors(rows, vectors, ["id", "q"])
    # Rows of one id count each, so that there may be more than ids.
    got = learn.select(F.xxhash64("id").alias("h"), F.hash("v").alias("g"), "v", "q").orderBy("h", "g").limit(fit_rows).toArrow()
    x = features(got["v"].combine_chunks().flatten().to_numpy().reshape(len(got), -1) if len(got) else np.zeros((0, 1 + 3 * DIMENSIONS)))
    y = (got["q"].to_numpy() >= 0.5).astype(int) if len(got) else np.zeros(0, int)
    return vectors, fit(x, y, np.arange(len(y)) % 5 == 0)


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts as good, with all their columns. Texts are read, never shuffled."""
    vectors, network = trained(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), labels, fit_rows, buckets)

    def keep(batches):
        for batch in batches:
            for part, texts in slices(batch, text_col):
                yield part.filter(pa.array(network.probabilities(features(pooled(texts, vectors))) >= threshold))

    return docs.mapInArrow(keep, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted), one row per row of ``docs``.

    ``labels`` (doc_id, quality): several labels of one document count as their mean; null ones don't count. A null
    text is the empty text and is scored like any other (a vector of zeros); a null id is never learnt from and
    counts as held out; repeated rows keep their rows; other columns are ignored whatever their names; an empty table
    gives an empty table, and without labels every score is 0.5.

    Texts are read for the context vectors and for the scores, and never shuffled nor stored.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    vectors, network = trained(source, labels, fit_rows, buckets)
    kind = source.schema["id"].dataType.simpleString()

    def score(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(network.probabilities(features(pooled(texts, vectors))))], names=["id", "score"])

    scored = source.select("id", F.col("text").cast("string").alias("text")).mapInArrow(score, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(held_out(F.col("id")), F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
