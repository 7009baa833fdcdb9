"""Token counts through a digest cache.

A text is known by the SHA-256 of its normalised content, a tokenizer by the SHA-256 of its file. The cache is a
Parquet table (version, digest, n_tokens). Only distinct digests that it lacks are encoded, then appended.
"""

from __future__ import annotations

import functools
import hashlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from tokenizers import Tokenizer

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .words import pieces, plain_texts, slices

CACHE = "version string, digest string, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def normalised(text: Column) -> Column:
    """What two texts must share to have one count: these byte-level vocabularies change nothing, so all of it; null is empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


class Counter:
    """Counts a file's tokens; a text is cut where no token can cross, and each distinct piece is encoded once."""

    def __init__(self, path: str):
        self.whole = path.endswith(".model")
        if self.whole:
            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        # White space and separators beyond ASCII's six may join a token with its neighbours: such texts aren't cut.
        self.odd = regex.compile(r"[^\S\x20\x09-\x0D]|[\x1c-\x1f\x85]")

    def _sizes(self, texts: list[str]) -> np.ndarray:
        if self.whole:
            return np.array([len(x) for x in self.model.encode(texts, num_threads=1)], np.int64)
        return np.array([len(x.ids) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)], np.int64)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if self.whole:
            return self._sizes(texts.to_pylist())
        ascii_only = pc.string_is_ascii(texts).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, "[\\x1c-\\x1f]").to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(~ascii_only & ~odd):
            odd[i] = self.odd.search(texts[i].as_py()) is not None
        cut = np.flatnonzero(~odd)
        row, found = pieces(texts.take(pa.array(cut)))
        coded = found.dictionary_encode()
        sizes = np.zeros(len(coded.dictionary), np.int64)
        for at in range(0, len(sizes), 20_000):
            sizes[at : at + 20_000] = self._sizes(coded.dictionary[at : at + 20_000].to_pylist())
        out = np.zeros(len(texts), np.int64)
        out[cut] = np.bincount(row, sizes[coded.indices.to_numpy()], len(cut))
        if odd.any():
            out[odd] = self._sizes(texts.filter(pa.array(odd)).to_pylist())
        return out


@functools.lru_cache(4)
def counter(path: str) -> Counter:
    """One per Python worker and file."""
    return Counter(path)


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; a digest that two runs appended counts once."""
    spark.createDataFrame([], CACHE).write.mode("ignore").parquet(cache)
    known = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version)
    return known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(texts: DataFrame, cache: str, path: str) -> None:
    """Encode the distinct texts of ``texts`` (digest, text) that the cache lacks, and append their counts.

    Copies are dropped before the shuffle (one row per digest and task), so a text that a third of all rows
    repeat is sent once per task.
    """
    version = tokenizer_version(path)
    distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))
    missing = distinct.join(read_cache(texts.sparkSession, cache, version).select("digest"), "digest", "left_anti")

    def count(batches):
        tool = counter(path)
        for batch in batches:
            for part, found in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array([version] * len(found)), part.column(0), pa.array(tool(found))], names=["version", "digest", "n_tokens"])

    missing.select("digest", "text").mapInArrow(count, CACHE).write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, cache: str, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    A null text is the empty text (0 bytes, 0 tokens); a null id stays null; repeated rows each get their row; other
    columns are ignored whatever their names; an empty table gives an empty table and leaves the cache as it is.
    """
    text = normalised(F.col(text_col))
    base = docs.select(F.col(id_col).alias("id"), F.sha2(text.cast("binary"), 256).alias("digest"), text.alias("text"))
    fill_cache(base.select("digest", "text"), cache, path)
    known = read_cache(docs.sparkSession, cache, tokenizer_version(path))
    sized = base.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sized.join(known, "digest").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
