"""Words of whole Arrow text columns, found in the bytes of the column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once: bounds a Python worker's memory, whatever the batch holds. Numbers made of a slice take
# some thirty times its bytes, and a reused worker keeps what it once took.
SLICE_BYTES = 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """``row``: the text each word is in; ``start``: its first byte in ``data``; ``word``: the words themselves."""

    row: np.ndarray
    start: np.ndarray
    word: pa.Array
    offsets: np.ndarray
    data: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        coded = self.word.dictionary_encode()
        return coded.indices.to_numpy(), coded.dictionary


def plain_texts(column) -> pa.Array:
    """The column as one array of large strings; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of whole rows that hold about ``most`` bytes of text, one row at least."""
    texts = plain_texts(batch.column(batch.schema.get_field_index(column)))
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    at, done = 0, 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        done, at = int(ends[to - 1]), to


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins."""
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def packed(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )


def split(texts: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text; ``lower`` turns A-Z into a-z."""
    data, offsets = bytes_of(texts)
    if lower:
        data = _LOWER[data]
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    start = np.flatnonzero(first)
    kept = np.cumsum(inside, dtype=np.int64)
    ends = np.append(kept[start] - 1, kept[-1] if len(kept) else 0)
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(row, start, packed(data[inside], ends), offsets, data)


def pieces(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each text cut before every run of white space that follows a word: (text of each piece, the pieces)."""
    data, offsets = bytes_of(texts)
    space = SPACE[data]
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    start = np.flatnonzero(first)
    row = np.searchsorted(offsets, start, "right") - 1
    return row, packed(data, np.append(start, len(data)))
