"""Licence scans as an exact set-similarity join of text blocks with licence templates.

A block is a run of ``2 * step`` words, one beginning every ``step`` words, so that a passage of up to ``step``
words lies whole in some block; a template of more words has blocks of so many steps that it fits. A block meets a template when it holds at least ``threshold`` of the template's
distinct words. Words are ordered by how often the corpus has them, rarest first. A block that meets a template
of n words with an overlap of a must hold one of the template's n - a + 1 rarest words (prefix filter), at
least a of the templates' words at all (length filter), and enough of them on either side of the shared word
(positional filter); what passes is counted exactly. Words that no template has take no part, so a text is
reduced to the places of template words before anything else happens. They are kept step by step and a block puts its own
steps together: no block sees the rest of its text, and the work grows with a text's length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tapflow.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STEP = 48
THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    """``phrase``: its words must also stand one after another; each such place is reported."""

    label: str
    text: str
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return "".join(c if c.isascii() and c.isalnum() else " " for c in self.text.lower()).split()


# Phrases, opening sentences and one whole text of public licences.
TEMPLATES = [
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("public-domain", "This is free and unencumbered software released into the public domain"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
]
INDEX = "word string, template int, label string, phrase array<string>, words array<string>, size int, need int, place int, rank int"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _index(templates: list[Template], order: list[str], threshold: float) -> list[tuple]:
    """One row per template and word of its prefix."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, t in enumerate(templates):
        own = sorted(set(t.words), key=rank.__getitem__)
        need = math.ceil(round(threshold * len(own), 9))
        for place, word in enumerate(own[: len(own) - need + 1]):
            rows.append((word, number, t.label, t.words if t.phrase else None, own, len(own), need, place, rank[word]))
    return rows


def reduced(docs: DataFrame, vocabulary: list[str], step: int, id_col: str, text_col: str) -> DataFrame:
    """Each row as (row, id, n_words, steps): the places of template words in every ``step`` words."""
    split = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    n = F.size("words")

    def places(begin: Column) -> Column:
        own = F.transform(F.slice("words", begin + 1, step), lambda w, i: F.struct((begin + i).alias("at"), w.alias("word")))
        return F.filter(own, lambda h: h["word"].isin(vocabulary))

    steps = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1, F.lit(step)), places))
    return split.select(F.monotonically_increasing_id().alias("row"), "id", n.cast("long").alias("n_words"), steps.alias("steps"))


def blocks_of(texts: DataFrame, times: int) -> DataFrame:
    """(row, block, inside) of rows (row, steps): each run of ``2 * times`` steps that holds a template word."""
    last = F.ceil(F.size("steps") / times).cast("int") - 1
    runs = F.transform(F.sequence(F.lit(0), last), lambda b: F.struct(b.alias("block"), F.flatten(F.slice("steps", b * times + 1, 2 * times)).alias("inside")))
    some = F.filter(F.when(F.size("steps") > 0, runs), lambda r: F.size(r["inside"]) > 0)
    return texts.select("row", F.inline(some))


def met_by(blocks: DataFrame, index: list[tuple], order: list[str], width: int) -> DataFrame:
    """(row, template, label, phrase, starts, share) for blocks (row, block, inside), one every ``width`` words, and templates that meet."""
    by_word = blocks.sparkSession.createDataFrame(index, INDEX)
    probes = sorted({r[0] for r in index})
    own = blocks.withColumn("own", F.array_distinct("inside.word"))
    found = own.withColumn("word", F.explode(F.filter("own", lambda w: w.isin(probes)))).join(F.broadcast(by_word), "word")
    have = F.size("own")
    found = found.where(have >= F.col("need"))
    # A block's words as ranks, so that smaller means rarer.
    by_rank = F.create_map(*[x for i, w in enumerate(order) for x in (F.lit(w), F.lit(i))])
    before = F.size(F.filter("own", lambda w: by_rank[w] < F.col("rank")))
    most = F.least("place", before) + 1 + F.least(F.col("size") - F.col("place") - 1, have - before - 1)
    found = found.where(most >= F.col("need"))
    overlap = F.size(F.array_intersect("own", "words"))
    met = found.withColumn("overlap", overlap).where(F.col("overlap") >= F.col("need"))
    # A phrase's place belongs to the block in whose first half it begins.
    starts = F.filter(
        F.transform("inside", lambda h: h["at"]),
        lambda a: (F.floor(a / width) == F.col("block"))
        & F.forall(
            F.sequence(F.lit(0), F.size("phrase") - 1),
            lambda k: F.exists("inside", lambda h: (h["at"] == a + k) & (h["word"] == F.col("phrase")[k])),
        ),
    )
    # Words of a template that a block shares meet it several times.
    return (
        met.withColumn("starts", F.when(F.col("phrase").isNotNull(), starts))
        .groupBy("row", "template", "block")
        .agg(F.first("label").alias("label"), F.first("starts").alias("starts"), F.first("phrase").alias("phrase"), F.first(F.col("overlap") / F.col("size")).alias("share"))
    )


def steps_of(template: Template, step: int) -> int:
    return max(1, math.ceil(len(template.words) / step))


def license_scan(
    docs: DataFrame,
    templates: list[Template] = TEMPLATES,
    threshold: float = THRESHOLD,
    step: int = STEP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per row of ``docs``.

    ``n_base`` counts the places of phrases; ``first_word`` and ``last_word`` are the first and last of their starts
    (null without any). ``score`` is the largest share of a met template (0 without any). A null or empty text has
    no words and no labels; null ids and repeated rows keep their rows; other columns are ignored whatever their
    names; an empty table gives an empty table.

    One pass over the texts, no text is shuffled. The index holds a row per template and prefix word, so its size
    is the templates', not the data's; the same bounds the one table that comes to the driver (a count per word).
    """
    if any(t.phrase and threshold * len(set(t.words)) <= len(set(t.words)) - 1 for t in templates):
        raise ValueError("a phrase must be held whole: raise the threshold")
    spark = docs.sparkSession
    vocabulary = sorted({w for t in templates for w in t.words})
    path = scratch_path(spark, "license-words")
    reduced(docs, vocabulary, step, id_col, text_col).write.parquet(path)
    texts = spark.read.parquet(path)
    counted = texts.select(F.explode(F.flatten("steps").getField("word")).alias("word")).groupBy("word").count().collect()
    times = {r["word"]: r["count"] for r in counted}
    order = sorted(vocabulary, key=lambda w: (times.get(w, 0), w))
    index = _index(templates, order, threshold)
    # One pass per length of blocks: most templates fit in a step, whole licences in a few.
    single = None
    for n in sorted({steps_of(t, step) for t in templates}):
        fitting = [row for row in index if steps_of(templates[row[1]], step) == n]
        more = met_by(blocks_of(texts, n), fitting, order, n * step)
        single = more if single is None else single.unionByName(more)
    # A phrase labels a text only where its words stand one after another.
    single = single.where(F.col("phrase").isNull() | (F.size("starts") > 0))
    per_row = single.groupBy("row").agg(
        F.sum(F.when(F.col("phrase").isNotNull(), F.size("starts")).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.array_min("starts")).cast("long").alias("first_word"),
        F.max(F.array_max("starts")).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("phrase").isNotNull(), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    out = texts.select("row", "id", "n_words").join(per_row, "row", "left")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def oracle() -> str:
    """Every block against every template, without any filter."""
    rows = ", ".join(f"({i}, '{t.label}', {t.phrase}, {STEP * steps_of(t, STEP)}, {t.words!r})" for i, t in enumerate(TEMPLATES))
    return f"""
WITH templates(template, label, phrase, width, words) AS (VALUES {rows}),
texts AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
widths AS (SELECT DISTINCT width FROM templates WHERE NOT phrase),
blocks AS (SELECT row, width, list_distinct(w[width * b + 1 : width * (b + 2)]) AS own FROM (SELECT row, w, width, unnest(range(0, (len(w) + width - 1) // width)) AS b FROM texts, widths)),
shares AS (SELECT row, template, label, max(len(list_intersect(own, words)) / len(list_distinct(words))) AS share
  FROM blocks JOIN templates USING (width) WHERE NOT phrase GROUP BY ALL HAVING share >= {THRESHOLD}),
places AS (SELECT row, template, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1 : i + len(words)] = words)) AS spot FROM texts, templates WHERE phrase),
phrases AS (SELECT row, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY row),
labels AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT row, label, share FROM shares UNION ALL SELECT row, label, 1.0 FROM places) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM texts LEFT JOIN phrases USING (row) LEFT JOIN labels USING (row)"""
