"""Quality rules from tokeniser fertility, beside counts of words, symbols and repetition.

A public vocabulary with byte fallback is measured on each text: characters per token, the share of byte-fallback
tokens and the entropy (bits) of its tokens. A text is rejected when a measure lies outside the band of its
language (of its script, where no language is given). Bands come from all texts of the group: the quartiles,
widened by ``WIDTH`` times their distance, a source with very many of the texts counting as ``SOURCE_SHARE`` of them.
A language of few texts takes the band of their script, a script of few texts that of all. No band reaches beyond the
fixed limits of the text's script, so a group that is largely bad does not set its own measure.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import sentencepiece

from pyspark.sql import DataFrame, Window, functions as F

from tapflow.session import scratch_path

from .bpe import spread
from .words import SPACE, packed, slices, split

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: Quartile distances that a measure may lie beyond its quartiles.
WIDTH = 4.0
#: Narrowest band on each side, so that groups of near-equal texts reject no ordinary one.
LEAST = {"chars_per_token": 0.15, "byte_share": 0.02, "token_entropy": 1.0}
#: Texts that a language or script needs for a band of its own.
MIN_GROUP = 50
#: A source's texts count as this share of its group's at most; shares are of the group before any is bounded.
SOURCE_SHARE = 0.1
#: Steps in which quartiles are taken, and the largest value told apart.
STEP = {"chars_per_token": (0.01, 100.0), "byte_share": (0.001, 1.0), "token_entropy": (0.01, 20.0)}
#: Lowest and highest value of each measure in any band, by script; the last for scripts not named.
LIMITS = {
    "latin": {"chars_per_token": (1.2, 8.0), "byte_share": (0.0, 0.3), "token_entropy": (2.0, 15.0)},
    **dict.fromkeys(("greek", "cyrillic", "hebrew", "arabic"), {"chars_per_token": (0.6, 8.0), "byte_share": (0.0, 0.5), "token_entropy": (2.0, 15.0)}),
    "": {"chars_per_token": (0.25, 8.0), "byte_share": (0.0, 0.9), "token_entropy": (2.0, 15.0)},
}
MEASURES = (
    "group string, script string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_tokens bigint, chars_per_token double, byte_share double, token_entropy double"
)
SCRIPTS = ["none", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "east_asian", "hangul", "other"]
#: Script by the first byte of a word.
_SCRIPT = np.zeros(256, np.uint8)
for _to, _bytes in enumerate(
    [[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)], [0xCE, 0xCF], range(0xD0, 0xD4), [0xD7], range(0xD8, 0xDC), [0xE0], range(0xE3, 0xEA), range(0xEA, 0xEE), [0xE1, 0xF0]], 1
):
    _SCRIPT[list(_bytes)] = _to
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@functools.lru_cache(4)
def model(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    """The vocabulary and which of its tokens are byte fallbacks; one per Python worker and file."""
    tool = sentencepiece.SentencePieceProcessor(model_file=path)
    return tool, np.array([tool.IsByte(i) for i in range(tool.GetPieceSize())])


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(mask, dtype=np.int64))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(row: np.ndarray, code: np.ndarray, texts: int, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text, the words in windows of ``width`` words that it holds twice or more (64-bit window keys)."""
    n = len(code) - width + 1
    if n <= 0:
        return np.zeros(texts, np.int64)
    with np.errstate(over="ignore"):
        mixed = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        key = np.zeros(n, np.uint64)
        for i in range(width):
            key = key * np.uint64(0xD6E8FEB86659FD93) + mixed[i : i + n]
            key ^= key >> np.uint64(32)
        key += row[:n].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    inside = np.flatnonzero(row[:n] == row[width - 1 :])
    order = inside[np.argsort(key[inside], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = order[twice]
    step = np.bincount(at, minlength=len(code) + 1) - np.bincount(at + width, minlength=len(code) + 1)
    return np.bincount(row[np.cumsum(step[:-1]) > 0], minlength=texts)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, word_start: np.ndarray, texts: int) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line of it."""
    breaks = np.flatnonzero(data == 10)
    # A line begins with each text and after each line feed; its feed, if any, stays out.
    begin = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], breaks[breaks + 1 < len(data)] + 1]))
    if not len(begin):
        return np.zeros(texts, np.int64)
    worded = np.unique(np.searchsorted(begin, word_start, "right") - 1)
    start = begin[worded]
    ends = np.append(begin[1:], len(data))[worded]
    ends = ends - (data[ends - 1] == 10)
    row = np.searchsorted(offsets, start, "right") - 1
    keep = spread(start, ends - start)
    code = packed(data[keep], np.append(0, np.cumsum(ends - start))).dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.unique(row * (len(code) + 1) + code) // (len(code) + 1)
    return np.bincount(row, minlength=texts) - np.bincount(first, minlength=texts)


def measure_slice(texts: pa.Array, path: str) -> dict[str, np.ndarray]:
    """All measures of each text but its group."""
    words, n = split(texts), len(texts)
    code, distinct = words.codes()
    data, offsets = words.data, words.offsets
    inside = ~SPACE[data]
    chars = _per_text(inside & ((data & 0xC0) != 0x80), offsets)
    tool, is_byte = model(path)
    lists: list[list[int]] = []
    listed = distinct.to_pylist()
    for at in range(0, len(listed), 20_000):
        lists += tool.encode(listed[at : at + 20_000], num_threads=1)
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    ids = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum()))
    del lists, listed
    begin = np.cumsum(sizes) - sizes
    used = sizes[code]
    token = ids[spread(begin[code], used)]
    row = np.repeat(words.row, used)
    total = np.bincount(row, minlength=n)
    falls = np.bincount(row[is_byte[token]], minlength=n)
    held, times = np.unique(row * len(is_byte) + token, return_counts=True)
    of = held // len(is_byte)
    share = times / total[of]
    kinds = len(SCRIPTS)
    script = np.bincount(words.row * kinds + _SCRIPT[data[words.start]], minlength=n * kinds).reshape(n, kinds)
    script[:, 0] = 0
    with np.errstate(invalid="ignore", divide="ignore"):
        return {
            "script": np.array(SCRIPTS)[np.where(script.any(1), script.argmax(1), 0)],
            "n_words": np.bincount(words.row, minlength=n),
            "word_chars": chars,
            "n_symbols": _per_text(_SYMBOL[data], offsets),
            "n_dup_lines": duplicate_lines(data, offsets, words.start, n),
            "n_repeat_words": repeated_words(words.row, code, n),
            "n_tokens": total,
            "chars_per_token": np.where(total > 0, chars / np.maximum(total, 1), 0.0),
            "byte_share": np.where(total > 0, falls / np.maximum(total, 1), 0.0),
            "token_entropy": np.bincount(of, -share * np.log2(share), n),
        }


def measures(docs: DataFrame, path: str, keys: list[str], lang_col: str | None = "lang", text_col: str = "text") -> DataFrame:
    """``keys`` of each row of ``docs`` with its measures; ``group`` is the language, else the script. No shuffle."""
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    source = docs.select(*keys, lang.alias("__lang"), F.col(text_col).cast("string").alias("__text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[: len(keys)]]

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "__text"):
                got = measure_slice(texts, path)
                langs = part.column(len(keys)).to_pylist()
                group = [x if x is not None else s for x, s in zip(langs, got["script"].tolist())]
                columns = [part.column(i) for i in range(len(keys))] + [pa.array(group, pa.string())]
                columns += [pa.array(v.tolist(), pa.string()) if k == "script" else pa.array(v) for k, v in got.items()]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "group", *got])

    return source.mapInArrow(run, ", ".join([*kinds, MEASURES]))


def _limit(measure: str, side: int):
    """The fixed limit of a row's script."""
    out = F.lit(LIMITS[""][measure][side])
    for script, limits in LIMITS.items():
        if script:
            out = F.when(F.col("script") == script, F.lit(limits[measure][side])).otherwise(out)
    return out


def quartiles(measured: DataFrame) -> DataFrame:
    """(key, n, low_x, high_x for each measure x): n texts with enough words and their quartiles, in steps of ``STEP``.

    ``key`` is 'l:' with a language, 's:' with a script, or 'all'. All is combined before a shuffle; what is ordered
    are the steps of one key, of which there are few thousand.
    """
    keys = F.array(F.concat(F.lit("l:"), "group"), F.concat(F.lit("s:"), "script"), F.lit("all"))
    steps = F.array(*[F.struct(F.lit(m).alias("m"), F.round(F.least(F.col(m), F.lit(most)) / step).cast("long").alias("at")) for m, (step, most) in STEP.items()])
    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    texts = measured.where(F.col("n_words") >= MIN_WORDS).select(F.explode(keys).alias("key"), source.alias("source"), steps.alias("steps"))
    per_source = texts.groupBy("key", "source").agg(F.count(F.lit(1)).alias("own"))
    per_key = per_source.groupBy("key").agg(F.sum("own").alias("n"))
    weight = per_source.join(per_key, "key").select("key", "source", F.least(F.lit(1.0), SOURCE_SHARE * F.col("n") / F.col("own")).alias("weight"))
    counted = texts.select("key", "source", F.inline("steps")).groupBy("key", "source", "m", "at").agg(F.count(F.lit(1)).alias("times"))
    total = counted.join(weight, ["key", "source"]).groupBy("key", "m", "at").agg(F.sum(F.col("times") * F.col("weight")).alias("w"))
    each = Window.partitionBy("key", "m")
    ranked = total.select("key", "m", "at", F.sum("w").over(each.orderBy("at")).alias("below"), F.sum("w").over(each).alias("whole"))
    out = []
    for m, (step, _) in STEP.items():
        for name, share in (("low", 0.25), ("high", 0.75)):
            out.append((F.min(F.when((F.col("m") == m) & (F.col("below") >= share * F.col("whole") - 1e-9), F.col("at"))) * step).alias(f"{name}_{m}"))
    return ranked.groupBy("key").agg(*out).join(per_key, "key")


def bands(measured: DataFrame) -> DataFrame:
    """(group, script, low_x, high_x for each measure x), from all texts with enough words."""
    # Three joins read these few rows; as a plan each would count all texts again, and the driver would hold it all.
    path = scratch_path(measured.sparkSession, "quartiles")
    quartiles(measured).write.parquet(path)
    found = measured.sparkSession.read.parquet(path)
    names = [c for c in found.columns if c not in ("key", "n")]
    pairs = measured.where(F.col("n_words") >= MIN_WORDS).select("group", "script").distinct()
    for level, key in (("l", F.concat(F.lit("l:"), "group")), ("s", F.concat(F.lit("s:"), "script")), ("a", F.lit("all"))):
        band = F.struct(*names).alias(level)
        enough = F.lit(True) if level == "a" else F.col("n") >= MIN_GROUP
        pairs = pairs.withColumn("key", key).join(found.where(enough).select("key", band), "key", "left").drop("key")
    pairs = pairs.select("group", "script", F.coalesce("l", "s", "a").alias("b"))
    out = [F.col("group"), F.col("script")]
    for m, least in LEAST.items():
        low, high = F.col(f"b.low_{m}"), F.col(f"b.high_{m}")
        room = F.greatest((high - low) * WIDTH, F.lit(least))
        out += [F.greatest(low - room, _limit(m, 0)).alias(f"low_{m}"), F.least(high + room, _limit(m, 1)).alias(f"high_{m}")]
    return pairs.select(*out)


def judged(measured: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``.

    ``measured`` is read several times (bands, verdict): hand over a stored table. A group without a text of
    ``MIN_WORDS`` words has no band; all its texts fail the base rule anyway.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    inside = F.lit(True)
    for m in LEAST:
        inside = inside & F.col(m).between(F.col(f"low_{m}"), F.col(f"high_{m}"))
    joined = measured.join(bands(measured), ["group", "script"], "left")
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(inside, F.lit(True)))


def _source(docs: DataFrame, source_col: str | None):
    """The source, null where the table has none."""
    return (F.col(source_col).cast("string") if source_col in docs.columns else F.lit(None).cast("string")).alias("source")


def quality_rules(docs: DataFrame, path: str, id_col: str = "doc_id", lang_col: str | None = "lang", text_col: str = "text", source_col: str | None = "source") -> DataFrame:
    """(id, measures, base_failed, kept), one row per row of ``docs``.

    A null text has no words and fails the base rule, as the empty text does. A null language is replaced by the
    text's script. ``source_col`` bounds a source's weight in the bands, where the table has it. Null ids and repeated rows keep their rows; other columns are ignored whatever their names; an
    empty table gives an empty table. The measures, a few numbers per text, are stored once in the shared folder.
    """
    spark = docs.sparkSession
    stored = scratch_path(spark, "measures")
    measures(docs.select(F.col(id_col).alias("__id"), _source(docs, source_col), *([F.col(lang_col).alias("__l")] if lang_col else []), F.col(text_col).alias("__t")), path, ["__id", "source"], "__l" if lang_col else None, "__t").write.parquet(stored)
    done = judged(spark.read.parquet(stored))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return done.select(F.col("__id").alias(id_col), *base, "script", "n_tokens", *LEAST)


def keep_within(docs: DataFrame, path: str, lang_col: str = "lang", text_col: str = "text", source_col: str | None = "source") -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns.

    A verdict depends on language and text alone, so rows meet it by digests of both; the row's other columns only
    spread copies over the tasks of that join.
    """
    own = [F.xxhash64(F.lit(seed), F.col(lang_col), F.col(text_col)).alias(f"__h{seed}") for seed in (1, 2)]
    spread_by = F.xxhash64(*[c for c in docs.columns if c not in (lang_col, text_col)]).alias("__s")
    keyed = docs.select("*", *own, spread_by)
    stored = scratch_path(docs.sparkSession, "measures")
    measures(keyed.select("__h1", "__h2", "__s", _source(docs, source_col), F.col(lang_col).alias("__l"), F.col(text_col).alias("__t")), path, ["__h1", "__h2", "__s", "source"], "__l", "__t").write.parquet(stored)
    good = judged(docs.sparkSession.read.parquet(stored)).where("kept").select("__h1", "__h2", "__s")
    return keyed.join(good.hint("shuffle_hash"), ["__h1", "__h2", "__s"], "left_semi").select(*docs.columns)
