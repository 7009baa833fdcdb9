"""Best-fit packing planned on the histogram of lengths.

Documents longer than a sequence are cut; every piece then has a length from 1 to the sequence's. Only how many
pieces have each length decides the packing, so best-fit runs over those counts (a table of at most
``size`` rows, whatever the corpus): whole batches of equal sequences are filled at a time. The plan is a list of
*slots*: ranks of a length that take an offset in a run of sequences. Pieces get their rank within their
length from Spark and find their slot by joining on length and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window, functions as F

from tapflow.session import scratch_path

from .bpe import encoder
from .words import slices

SIZE = 2048
SLOTS = "length bigint, rank_from bigint, rank_to bigint, sequence_from bigint, at bigint"


def token_pieces(docs: DataFrame, path: str, end_id: int = 0, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's ids, then ``end_id``, cut at ``size``: (id, piece, start, length, ids_crc32)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def cut(batches):
        tool = encoder(path)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                ids, begin = tool.texts(texts)
                whole = np.insert(ids, begin[1:], end_id).astype("<u4")
                begin = begin + np.arange(len(begin))
                total = np.diff(begin)
                n = -(-total // size)
                row = np.repeat(np.arange(len(texts)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * size
                length = np.minimum(size, total[row] - start)
                raw, at = memoryview(whole.tobytes()), begin[row] + start
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at + length)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["id", "piece", "start", "length", "ids_crc32"],
                )

    return source.mapInArrow(cut, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, rank after the last, first sequence, offset) for ``counts`` pieces of each length.

    Lengths go from the longest down, each piece to the sequence with the least room that it fits in, a new one if
    there is none. Sequences with equal room are kept as runs and filled a run at a time, so the work depends on
    how many lengths there are, not on how many pieces.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, how many)
    rooms: list[int] = []  # keys of runs, in order
    fresh = 0

    def put(room: int, first: int, many: int) -> None:
        if room and many:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, many))

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            k = bisect_left(rooms, length)
            new = k == len(rooms)
            room = size if new else rooms[k]
            each = room // length
            full, rest = divmod(total - rank, each)
            if new:
                first, many = fresh, full + bool(rest)
                fresh += many
            else:
                first, many = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[k]
            full = min(full, many)
            last = 1 if rest and full < many else 0
            # ``full`` sequences take as many pieces as they hold, one more what is left over.
            for sequence, use, pieces in ((first, full, each), (first + full, last, rest)):
                for j in range(pieces if use else 0):
                    slots.append((length, rank, rank + use, sequence, size - room + j * length))
                    rank += use
                put(room - pieces * length, sequence, use)
            put(room, first + full + last, many - full - last)
    return slots


def ranked(items: DataFrame, order: list[str]) -> DataFrame:
    """``items`` with ``rank``: their place (from 0) among rows of their length, in ``order``.

    Rows are dealt by ranges of (length, order), so a length that a third of all rows have is spread
    over many tasks; a task ranks its part and counts of the parts before it are added.
    """
    spark = items.sparkSession
    path = scratch_path(spark, "pieces")
    items.repartitionByRange("length", *order).withColumn("part", F.spark_partition_id()).write.parquet(path)
    parts = spark.read.parquet(path)
    counts = parts.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    within = parts.withColumn("local", F.row_number().over(Window.partitionBy("length", "part").orderBy(*order)) - 1)
    return within.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("local")).drop("before", "local", "part")


def place(items: DataFrame, order: list[str], size: int = SIZE) -> DataFrame:
    """``items`` (with ``length`` from 1 to ``size``) with ``sequence_id`` and ``offset``."""
    spark = items.sparkSession
    numbered = ranked(items, order)
    # At most ``size`` rows: one for each length.
    counts = {int(r["length"]): int(r["n"]) for r in numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.createDataFrame(best_fit(counts, size), SLOTS)
    slot = F.broadcast(slots).alias("s")
    inside = (F.col("i.length") == F.col("s.length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    return numbered.alias("i").join(slot, inside).select(
        *[F.col(f"i.{c}") for c in items.columns], (F.col("sequence_from") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), F.col("at").alias("offset")
    )


def pack(docs: DataFrame, path: str, end_id: int = 0, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A null text is the empty text: one piece of length 1 (``end_id``). Null ids and repeated rows are packed like
    others. Other columns are ignored whatever their names. An empty table gives an empty table.
    """
    # Stored: dealing by ranges reads its input twice, and texts are to be encoded once.
    stored = scratch_path(docs.sparkSession, "token-pieces")
    token_pieces(docs, path, end_id, size, id_col, text_col).write.parquet(stored)
    items = docs.sparkSession.read.parquet(stored)
    return place(items, ["id", "piece", "ids_crc32"], size).withColumnRenamed("id", id_col)
