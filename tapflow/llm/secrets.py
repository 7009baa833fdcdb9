"""Secret scans over a trigram inverted index.

Each rule's pattern says which trigrams every match must hold: ``required`` turns it into alternatives, each a set of
trigrams that stand together. The index lists, for every trigram that some rule asks for, the texts that have it
(in lower case). Intersecting the lists of an alternative gives a rule's candidates, the union of its alternatives
all of them, and only these are searched with the pattern. A rule whose pattern has no mandatory trigram (a bare
character class) is searched everywhere.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from re import _constants as op, _parser as parser

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow.session import scratch_path

from .licenses import LOWER, UPPER


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    base: bool = False


# What the contract names, then the forms of well-known keys.
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16, 0, True),
    Rule("hex", r"[0-9a-f]+", 32, 0, True),
    Rule("github", r"gh[opusr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
#: Character classes up to this size are spelled out when trigrams are derived; larger ones end a literal run.
SPELLED = 8


def required(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams (lower case) that a match must hold, None if some match may hold none."""

    def letters(item) -> list[str] | None:
        kind, value = item
        if kind is op.LITERAL:
            return [chr(value).lower()]
        if kind is op.IN and len(value) <= SPELLED and all(k is op.LITERAL for k, _ in value):
            return sorted({chr(v).lower() for _, v in value})
        return None

    def both(a: set[frozenset[str]], b: set[frozenset[str]]) -> set[frozenset[str]]:
        return {x | y for x in a for y in b}

    def alternatives(items) -> set[frozenset[str]]:
        found: set[frozenset[str]] = {frozenset()}
        run = [""]

        def close() -> None:
            nonlocal found, run
            found = both(found, {frozenset(r[i : i + 3] for i in range(len(r) - 2)) for r in run})
            run = [""]

        for item in items:
            kind, value = item
            if (chars := letters(item)) is not None:
                run = [r + c for r in run for c in chars]
                continue
            close()
            if kind is op.SUBPATTERN:
                found = both(found, alternatives(value[-1]))
            elif kind is op.BRANCH:
                found = both(found, set().union(*(alternatives(x) for x in value[1])))
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
                found = both(found, alternatives(value[2]))
        close()
        return found

    out = alternatives(parser.parse(pattern))
    # An alternative that holds all of another's trigrams adds nothing.
    least = {a for a in out if not any(b < a for b in out)}
    return None if frozenset() in least else sorted(least, key=sorted)


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, key): which texts of (key, text) have which trigrams; a text's copies are posted once."""
    folded = F.translate("text", UPPER, LOWER)
    have = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("folded"), t))
    return texts.select("key", folded.alias("folded")).select("key", F.explode(have).alias("trigram")).distinct()


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """(key, kinds): per text, the rules of which it holds all trigrams of an alternative."""
    terms = [
        (r.kind, n, len(a), t) for r in rules for n, a in enumerate(required(r.pattern) or []) for t in sorted(a)
    ]
    queries = index.sparkSession.createDataFrame(terms, "kind string, alternative int, needed int, trigram string")
    # One row per rule and trigram: as many as the rules' patterns have.
    held = index.join(F.broadcast(queries), "trigram").groupBy("key", "kind", "alternative", "needed").count()
    return held.where(F.col("count") == F.col("needed")).groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _matches(rule: Rule) -> Column:
    """Per match: characters from the last one to it (``gap``), its own (``size``), and whether it is long enough (``ok``)."""
    hit = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split("text", rule.pattern, -1)
    zipped = F.arrays_zip(hit.alias("hit"), part.alias("part"), gaps.alias("gap"))
    measured = F.transform(
        zipped, lambda z: F.struct(F.length(z["gap"]).alias("gap"), F.length(z["hit"]).alias("size"), (F.length(z["part"]) >= rule.least).alias("ok"))
    )
    return F.filter(measured, lambda m: m["size"].isNotNull())


def searched(rule: Rule) -> Column:
    """The matches of a rule in ``text``; a bare class needs no look at what is too short."""
    if re.fullmatch(r"\[[^]]*\]\+", rule.pattern):
        rule = Rule(rule.kind, f"{rule.pattern[:-1]}{{{rule.least},}}", rule.least)
    return F.when(F.col("text").rlike(rule.pattern), _matches(rule))


def secret_scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_<kind> of each base rule, base_sha256, spans, n_spans), one row per row of ``docs``.

    Spans are kind:start:end in code points, end exclusive, by start and then as the rules are listed. A null
    text is the empty text and has none; null ids and repeated rows keep their rows; other columns are ignored whatever
    their names; an empty table gives an empty table.

    Texts are read once for the index and once for the search; the search sends each text once, to meet its
    candidate rules. Only lengths of matches are kept after that, in the shared folder.
    """
    spark = docs.sparkSession
    wanted = {r.kind: required(r.pattern) for r in rules}
    trigrams = sorted({t for a in wanted.values() if a for x in a for t in x})
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # Rows with the same key may share candidates: each is verified against its own text.
    texts = base.withColumn("key", F.xxhash64("id", "text"))
    kinds = candidates(postings(texts, trigrams), [r for r in rules if wanted[r.kind]])
    joined = texts.join(kinds.hint("shuffle_hash"), "key", "left")
    path = scratch_path(spark, "secret-matches")
    joined.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        *[(searched(r) if not wanted[r.kind] else F.when(F.array_contains("kinds", r.kind), searched(r))).alias(r.kind) for r in rules],
    ).write.parquet(path)
    matched = spark.read.parquet(path)
    every = F.array(*[F.struct(F.lit(i).alias("rule"), F.col(r.kind).alias("list")) for i, r in enumerate(rules)])
    listed = (
        matched.where(F.coalesce(*[F.col(r.kind) for r in rules]).isNotNull())
        .select("row", F.explode(every).alias("by"))
        .select("row", "by.rule", F.posexplode("by.list").alias("i", "m"))
    )
    to = F.sum(F.col("m.gap") + F.col("m.size")).over(Window.partitionBy("row", "rule").orderBy("i"))
    spans = listed.withColumn("to", to).where("m.ok").select("row", "rule", (F.col("to") - F.col("m.size")).alias("from"), "to")
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule") + 1)
    spans = spans.withColumn("span", F.struct("from", "rule", F.concat_ws(":", kind, "from", "to").alias("shown")))
    is_base = F.col("rule").isin([i for i, r in enumerate(rules) if r.base])

    def shown(items: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(items), lambda s: s["shown"]), ",")

    per_row = spans.groupBy("row").agg(
        *[F.count(F.when(F.col("rule") == i, 1)).alias(f"n_{r.kind}") for i, r in enumerate(rules) if r.base],
        shown(F.collect_list(F.when(is_base, F.col("span")))).alias("base"),
        shown(F.collect_list("span")).alias("spans"),
        F.count(F.lit(1)).alias("n_spans"),
    )
    counts = [f"n_{r.kind}" for r in rules if r.base] + ["n_spans"]
    return matched.select("row", "id").join(per_row, "row", "left").select(
        F.col("id").alias(id_col),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redacted(docs: DataFrame, rules: list[Rule] = RULES, mask: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``mask`` in place of every span that ``secret_scan`` finds; overlapping spans share one.

    A column ``n_chars`` is brought up to date. Texts without a span, null ones among them, stay as they are.
    """
    own = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.xxhash64(F.lit(1), text_col).alias("g"))
    keyed = docs.withColumn("__id", own)
    found = secret_scan(keyed.select("__id", F.col(text_col).alias("text")), rules, "__id", "text").where("n_spans > 0")
    # Rows with one key have one text, so one list of spans.
    found = found.groupBy("__id").agg(F.first("spans").alias("__spans"))
    joined = keyed.join(found.hint("shuffle_hash"), "__id", "left")
    place = F.transform(F.split("__spans", ","), lambda s: F.struct(F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("a"), F.split_part(s, F.lit(":"), F.lit(3)).cast("int").alias("b")))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(done: Column, span: Column) -> Column:
        before = F.substr(F.col(text_col), done["at"] + 1, F.greatest(span["a"] - done["at"], F.lit(0)))
        new = F.concat(done["out"], F.array(before, F.lit(mask)))
        # A span that begins inside the last one only makes it longer.
        inside = (span["a"] < done["at"]) & (F.size(done["out"]) > 0)
        return F.struct(F.greatest(done["at"], span["b"]).alias("at"), F.when(inside, done["out"]).otherwise(new).alias("out"))

    whole = F.aggregate(place, nothing, step, lambda d: F.concat(F.array_join(d["out"], ""), F.substr(F.col(text_col), d["at"] + 1, F.length(F.col(text_col)))))
    out = joined.withColumn(text_col, F.when(F.col("__spans").isNotNull(), whole).otherwise(F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNotNull(), F.length(text_col).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def oracle() -> str:
    """Every rule over every text."""
    parts = []
    for i, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""SELECT row, {i} AS rule, '{r.kind}' AS kind, {r.base} AS base, unnest(list_transform(range(0, len(hit)), lambda i: {{
  'f': list_sum(list_transform(gap[1 : i + 1], lambda g: length(g))) + coalesce(list_sum(list_transform(hit[1 : i], lambda h: length(h))), 0),
  'n': length(hit[i + 1]), 'ok': length(part[i + 1]) >= {r.least}}})) AS m
  FROM (SELECT row, regexp_extract_all(text, '{p}') AS hit, regexp_extract_all(text, '{p}', {r.group}) AS part, string_split_regex(text, '{p}') AS gap FROM texts)""")
    listed = "\nUNION ALL ".join(parts)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT row, rule, kind, base, m.f AS f, concat(kind, ':', CAST(m.f AS BIGINT), ':', CAST(m.f + m.n AS BIGINT)) AS shown FROM ({listed}) WHERE m.ok),
per_row AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  count(*) AS n_spans, string_agg(shown, ',' ORDER BY f, rule) FILTER (base) AS base, string_agg(shown, ',' ORDER BY f, rule) AS spans FROM found GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_spans, 0) AS n_spans,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per_row USING (row)"""
