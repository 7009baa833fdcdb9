"""The training-data operators against brute force, and their edge cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from pyspark.sql import functions as F

import corpus_pipeline
from registry.compare import difference, oracle_connection
from tapflow.llm import bpe, licenses, neardup, neighbours, packing, quality, rules, secrets, tokencounts, urlfilters
from tapflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "\n\n", "it's I'LL <|endoftext|> x<|startoftext|>y <|endoftext", "İstanbul ΣΑΣ ΟΔΟΣ. é é ́ a", " foo bar　baz x\u0085y",
    "日本語テキスト 12345 ½ ²", "😀😀 !!!???...", "a" * 5000, "the" * 400, "\x1c\x1d a\x1fb  c \t\r\n d ", "ﬁ ǅ ß ẞ", "don't's 're", "aaaa" * 3 + "!" * 400,
    "The the THE tHe", "a b", "a", "a b c", "x\n x\nx\n x\n", "a  b   c", "!\x1c!", "word " * 3000,
]


def texts(n: int = 200) -> list[str | None]:
    draw = random.Random(1)
    out = list(ODD)
    for _ in range(n):
        out.append("".join(draw.choice("abcdehinorst '!.0Ω\n字É") for _ in range(draw.randint(0, 60))))
        out.append("".join(chr(draw.choice([draw.randint(1, 0x2FF), draw.randint(0x3000, 0xD7FF), draw.randint(0x1F300, 0x1F9FF)])) for _ in range(draw.randint(0, 30))))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, with repeated rows, a null id and columns whose names clash with the operators' own."""
    rows = [(i, t, "en" if i % 3 else None, i) for i, t in enumerate(texts())] + [(3, ODD[3], "en", 3), (4, ODD[4], "en", 4), (4, ODD[4], "en", 4), (None, "no id here", None, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words long").withColumn("id", F.lit("x")).withColumn("rank", F.lit(1)).repartition(3)


def empty(docs):
    return docs.where("false")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_sql(spark, name):
    rows, note = difference(spark, oracle_connection(SF), QUERIES[name], ORACLES[name], SF)
    assert note is None, note
    assert rows > 0


def test_all_ten_are_registered():
    import __spark_entry__ as driver

    for n in range(1, 11):
        assert [q for q in driver.queries() if q.startswith(f"op{n}_")]
    assert "pipeline" in driver.queries()


# 7: encoding and decoding


def test_round_trip_equals_the_library(docs):
    tool = Tokenizer.from_file(WORD_BPE)
    got = bpe.round_trip(docs, WORD_BPE).collect()
    assert sorted(r["doc_id"] is None for r in got) == sorted(r["doc_id"] is None for r in docs.collect())
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]))
    for r in docs.collect():
        ids = tool.encode(r["text"] or "", add_special_tokens=False).ids
        shown = tool.decode(ids, skip_special_tokens=False)
        want = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()
        assert by_id[r["doc_id"]] == {want}, r
    assert bpe.round_trip(empty(docs), WORD_BPE).count() == 0


def test_long_words_take_the_single_path():
    draw = random.Random(5)
    words = ["".join(draw.choice("abcthern") for _ in range(n)) for n in (191, 192, 193, 2000)]
    tool, own = Tokenizer.from_file(WORD_BPE), bpe.Encoder(WORD_BPE)
    ids, begin = own.texts(pa.array(words, pa.large_string()))
    for i, w in enumerate(words):
        assert list(ids[begin[i] : begin[i + 1]]) == tool.encode(w, add_special_tokens=False).ids


# 9: token counts


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library_and_only_misses_are_encoded(spark, docs, tmp_path, name):
    path, cache = public_tokenizers.path(name), str(tmp_path / "cache")
    if name.endswith(".json"):
        count = lambda t: len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids)
        tool = Tokenizer.from_file(path)
        count = lambda t: len(tool.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece

        tool = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(tool.encode(t))
    got = {(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokencounts.token_counts(docs, cache, path).collect()}
    want = {(r["doc_id"], len((r["text"] or "").encode()), (n := count(r["text"] or "")), n > 1024) for r in docs.collect()}
    assert got == want
    stored = spark.read.parquet(cache)
    distinct = docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert stored.count() == distinct
    assert tokencounts.token_counts(docs, cache, path).count() == docs.count()
    more = docs.limit(0).union(spark.createDataFrame([(9999, "only this is new", "en", 1)], "doc_id long, text string, lang string, n_words long").withColumn("id", F.lit("x")).withColumn("rank", F.lit(1)))
    tokencounts.token_counts(docs.union(more), cache, path).count()
    assert spark.read.parquet(cache).count() == distinct + 1
    assert tokencounts.token_counts(empty(docs), cache, path).count() == 0


# 5: packing


def test_best_fit_equals_best_fit_over_single_items():
    import bisect

    draw = random.Random(3)
    for _ in range(100):
        size = draw.choice([10, 50, 2048])
        counts = {draw.randint(1, size): draw.randint(1, 60) for _ in range(draw.randint(0, 30))}
        sequences, placed = collections.defaultdict(list), collections.Counter()
        for length, a, b, first, at in packing.best_fit(counts, size):
            placed[length] += b - a
            for i in range(b - a):
                sequences[first + i].append((at, length))
        assert dict(placed) == counts
        for items in sequences.values():
            end = 0
            for at, length in sorted(items):
                assert at == end
                end += length
            assert end <= size
        rooms, single = [], 0
        for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            k = bisect.bisect_left(rooms, length)
            room = rooms.pop(k) if k < len(rooms) else size
            single += room == size
            if room > length:
                bisect.insort(rooms, room - length)
        assert len(sequences) == single


def test_packing_keeps_every_id(docs):
    tool = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack(docs, WORD_BPE).collect()
    want = collections.Counter()
    for r in docs.collect():
        ids = [*tool.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            want[r["doc_id"], piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    ends = collections.defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048
    total = sum(ends.values())
    assert len(ends) <= -(-total // 2048) + 1
    assert packing.pack(empty(docs), WORD_BPE).count() == 0


# 6: quality rules


def plain_rules(text: str | None) -> tuple:
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    runs = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    marked = {j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(marked) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed


def test_rules_equal_brute_force(spark, docs):
    got = collections.Counter()
    for r in rules.quality_rules(docs, PIECES).collect():
        got[r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]] += 1
        assert not (r["base_failed"] and r["kept"])
    assert got == collections.Counter((r["doc_id"], *plain_rules(r["text"])) for r in docs.collect())
    real = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: tuple(r)[1:7] for r in rules.quality_rules(real, PIECES).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()}
    assert rows == {r["doc_id"]: plain_rules(r["text"]) for r in real.collect()}
    assert rules.quality_rules(empty(docs), PIECES).count() == 0


def test_fertility_bands_reject_another_script(spark):
    draw = random.Random(2)
    words = ["water", "house", "people", "little", "between", "another", "example", "country"]
    rows = [(i, " ".join(draw.choice(words) + draw.choice(words) for _ in range(60)), "en") for i in range(200)]
    rows += [(1000, " ".join("".join(chr(draw.randint(0x12000, 0x12300)) for _ in range(5)) for _ in range(60)), "en")]
    kept = {r["doc_id"]: r["kept"] for r in rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES).collect()}
    assert not kept[1000]
    assert all(kept[i] for i in range(200))


def test_a_hot_bad_source_and_lone_languages_do_not_set_their_own_bands(spark):
    draw = random.Random(3)
    words = ["water", "house", "people", "little", "between", "another", "example", "country"]

    def junk():
        return " ".join("".join(chr(draw.randint(0x12000, 0x12300)) for _ in range(5)) for _ in range(60))

    def letters():
        return " ".join("".join(draw.choice("bcdfghjklmnpqrstvwxz") for _ in range(12)) for _ in range(60))

    rows = [(i, " ".join(draw.choice(words) + draw.choice(words) for _ in range(60)), "en", f"s{i % 20}") for i in range(400)]
    rows += [(1000 + i, junk() if i % 2 else letters(), "en", "hot") for i in range(200)]
    rows += [(2000, junk(), "xx", "s1"), (2001, junk(), None, "s1"), (2002, letters(), "yy", "s1"), (2003, rows[0][1], "zz", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    kept = {r["doc_id"] for r in rules.quality_rules(docs, PIECES).where("kept").collect()}
    assert kept == {*range(400), 2003}
    assert {r["doc_id"] for r in rules.keep_within(docs, PIECES).collect()} == kept
    # Without sources the limits alone still reject the other script.
    kept = {r["doc_id"] for r in rules.quality_rules(docs.drop("source"), PIECES).where("kept").collect()}
    assert kept >= {*range(400), 2003} and not kept & {2000, 2001, *range(1001, 1200, 2)}


# 1: licences


def test_license_places_and_templates(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files"
    rows = [
        (1, "The MIT-License; mit license MIT\nlicense"), (2, "gnu general public"), (3, "x " * 95 + "GNU General Public License v3 apache license"), (4, notice), (5, None), (5, None), (6, ""), (None, "CC BY"), (7, "mitlicense"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("word", F.lit("w"))
    got = [tuple(r) for r in licenses.license_scan(docs).collect()]
    assert len(got) == len(rows)
    by_id = {g[0]: g[1:] for g in got}
    assert by_id[1][:4] == (7, 3, 1, 5)
    assert by_id[1][4] == "mit"
    assert by_id[2][:5] == (3, 0, None, None, "")
    assert by_id[3][1:5] == (2, 95, 100, "apache,gpl")
    assert by_id[4][1:6] == (0, None, None, "", "mit")
    assert 0.8 <= by_id[4][6] < 1
    assert by_id[5] == by_id[6] == (0, 0, None, None, "", "", 0.0)
    assert by_id[None][4] == "cc-by"
    assert licenses.license_scan(docs.where("false")).count() == 0


def test_whole_licence_and_long_texts(spark):
    whole = max(licenses.TEMPLATES, key=lambda t: len(t.words))
    assert len(whole.words) > 150
    # Without its beginning, which is a template of its own; across any place of a block; with every tenth word another.
    late = " ".join(whole.words[25:])
    changed = " ".join("x" if i % 10 == 0 else w for i, w in enumerate(whole.words))
    rows = [(i, "z " * (i * 37) + late + " y" * i) for i in range(12)] + [(12, changed), (13, " ".join(whole.words[:12])), (14, "mit license " * 16_000), (15, "mit " * 20_000)]
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["labels"] == "mit" and got[i]["score"] >= 0.8 and got[i]["n_base"] == 0 for i in range(13))
    assert got[13]["labels"] == got[15]["labels"] == ""
    assert tuple(got[14])[1:4] == (32_000, 16_000, 0) and got[14]["last_word"] == 31_998 and got[14]["labels"] == "mit"


# 3: secrets


def plain_secrets(text: str | None) -> list[tuple[int, int, str, int]]:
    found = []
    for i, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), i, rule.kind, m.end()))
    return sorted(found)


def test_trigram_queries():
    assert secrets.required(r"[0-9a-f]+") is None
    assert secrets.required(r"AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert secrets.required(r"ab|cde") is None
    assert secrets.required(r"(x?abcd)+e*") == [frozenset({"abc", "bcd"})]


def test_secrets_equal_brute_force(spark):
    draw = random.Random(4)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", " ", "=", ":", "'", '"', "abc", "AKIA", "AKIA" + "Z" * 12, "0f" * 16, "é", "\n", "xoxb-" + "1" * 12, "ghp_" + "a" * 36, "==", "12345678", "😀", "_-."]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))) for i in range(400)] + [(400, None), (401, ""), (402, "token=secret: abcdefghij"), (402, "token=secret: abcdefghij"), (None, "token=12345678")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("row", F.lit(2)).withColumn("kinds", F.lit("k"))
    got = collections.Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], r["spans"]) for r in secrets.secret_scan(docs).collect())
    want = collections.Counter()
    for i, t in rows:
        spans = plain_secrets(t)
        base = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans if k in ("assign", "access", "hex"))
        n = collections.Counter(k for _, _, k, _ in spans)
        want[i, n["assign"], n["access"], n["hex"], hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)] += 1
    assert got == want
    masked = {r["doc_id"]: r["text"] for r in secrets.redacted(docs).collect()}
    for i, t in rows:
        if i is not None:
            out, at = "", 0
            for a, _, _, b in plain_secrets(t):
                if a >= at or not at:
                    out += (t[at:a]) + "[SECRET]"
                at = max(at, b)
            assert masked[i] == (None if t is None else out + t[at:])
    assert secrets.secret_scan(docs.where("false")).count() == 0


# 10: near-duplicates


def plain_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


def near_copies(n: int, edits: int, draw: random.Random, first: int) -> list[tuple[int, str]]:
    base = [draw.choice("abcdefghij") * draw.randint(1, 3) + str(draw.randint(0, 300)) for _ in range(120)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(draw.randint(0, edits)):
            w[draw.randrange(len(w))] = f"edit{draw.randint(0, 10**6)}"
        out.append((first + i, " ".join(w)))
    return out


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, width, percent):
    draw = random.Random(6)
    rows = [row for k in range(8) for row in near_copies(12, 8, draw, 100 * k)]
    rows += [(2000 + i, t) for i, t in enumerate(ODD)] + [(3000 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("id", F.lit(1))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, width, percent).collect()}
    assert got == plain_components(rows, width, percent)
    left = [r["doc_id"] for r in neardup.keep_first(docs, width, percent).collect()]
    assert sorted(left) == sorted({c for _, c in got.values()})


def test_large_nodes_branch_and_leftovers_meet(spark, monkeypatch):
    draw = random.Random(8)
    rows = near_copies(60, 14, draw, 0) + near_copies(40, 3, draw, 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for levels in (12, 2):
        monkeypatch.setattr(neardup, "SMALL", 8)
        monkeypatch.setattr(neardup, "LEVELS", levels)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
        assert got == plain_components(rows, 3, 85)


def test_near_duplicates_of_repeated_rows_and_nothing(spark):
    docs = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (7, "A B C D"), (None, "a b c d"), (8, None), (9, "")], "doc_id long, text string")
    rows = [tuple(r) for r in neardup.near_duplicates(docs).collect()]
    assert sorted(r[:3] for r in rows if r[0] is not None) == [(5, 2, 5), (5, 2, 5), (7, 2, 5), (8, 0, 8), (9, 0, 9)]
    assert neardup.near_duplicates(docs.where("false")).count() == 0
    assert neardup.keep_first(docs).count() == 3


# 4: nearest neighbours


def test_neighbours_are_found(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 24))
    vectors = centres[draw.integers(0, 12, 1500)] + 0.6 * draw.normal(size=(1500, 24))
    vectors[700:900] = vectors[700]  # copies
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [1.0] * 3), (5080, [None] * 24), (None, [1.0] * 24), (5100, [])]
    docs = spark.createDataFrame(rows + rows[:3] + odd, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("q", F.lit(1))
    got = collections.defaultdict(list)
    for r in neighbours.nearest(docs).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    x = np.array([v for _, v in rows], np.float32).astype(float)
    hits = 0
    assert sorted(got) == list(range(0, 1500, 20))
    for q, found in got.items():
        score = x @ x[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -np.round(score, 9)))[:20]
        assert [k for _, _, k in found] == list(range(1, 21))
        np.testing.assert_allclose([s for _, s, _ in found], score[[v for v, _, _ in found]], rtol=1e-12)
        hits += len(set(best) & {v for v, _, _ in found})
    assert hits >= 0.95 * 20 * len(got)
    assert neighbours.nearest(docs.where("false")).count() == 0
    few = neighbours.nearest(spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")).collect()
    assert [(r["query_id"], r["rank"]) for r in few] == [(0, 1), (0, 2)]


def test_a_hot_cluster_gets_near_neighbours(spark, monkeypatch):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(5000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:3000] = np.eye(24)[0] + 0.1 * x[:3000]  # nearly one cell of any planes through the origin
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[3000:3300] = x[3000] + 1e-6 * draw.normal(size=(300, 24))  # one code
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    nodes = neighbours.coded(vectors.toDF("id", "v"))
    graph = {r["id"]: set(r["near"]) for r in neighbours.first_graph(nodes, 5000, leaf=32).collect()}
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    true = [set(row) for row in np.argsort(-score[:3000], 1)[:, :10].tolist()]
    assert sum(len(t & graph[i]) for i, t in enumerate(true)) >= 0.5 * 10 * 3000
    rounds, real = [], neighbours.descend

    def spied(*args, **kw):
        rounds.append(real(*args, **kw))
        return rounds[-1]

    monkeypatch.setattr(neighbours, "descend", spied)
    got = collections.defaultdict(set)
    for r in neighbours.nearest(vectors, top=10).collect():
        got[r["query_id"]].add(r["vec_id"])
    fresh = [f for r in rounds[-1].collect() for f in r["fresh"]]
    assert np.mean(fresh) <= 0.02
    assert sum(len(true[i] & got[i]) for i in range(0, 3000, 20)) >= 0.9 * 10 * 150


# 2: quality classifier


def test_classifier_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    unseen = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in unseen]) >= 0.9
    assert {r["doc_id"] for r in quality.keep_good(docs, labels).collect()} == {r["doc_id"] for r in quality.classify(docs, labels).where("predicted = 1").collect()}


def test_classifier_from_word_vectors_is_calibrated(spark):
    """Held-out rows: area under the curve, calibration, and a temperature that no limit of its search sets."""
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = [r for r in quality.classify(docs, labels).join(labels, "doc_id").collect() if r["held_out"]]
    score, good = np.array([r["score"] for r in rows]), np.array([r["quality"] for r in rows]) == 1
    assert (score[good][:, None] > score[~good][None, :]).mean() >= 0.97
    bins = np.minimum((score * 10).astype(int), 9)
    assert sum(abs(score[bins == b].sum() - good[bins == b].sum()) for b in range(10)) / len(score) <= 0.06
    _, network = quality.trained(docs.select(F.col("doc_id").alias("id"), "text"), labels, quality.FIT_ROWS, quality.BUCKETS)
    assert 0.05 < network.temperature < 20
    apart = np.array([-5.0, -4.0, 3.0, 6.0])
    assert 1e-2 < quality.temperature(apart, np.array([0, 0, 1, 1])) < 1e2


def test_word_vectors_equal_brute_force(spark):
    """Index vectors from the forms' hashes, context sums and pools, word by word; the network sees nothing else."""
    rows = [t for t in texts(60) if t is None or "\x00" not in t] + ["The cat sat on the mat, 12 cats!", "The cat sat"] * 2
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id long, text string").repartition(3)
    runs = re.compile(rb"[A-Z]+[a-z\x80-\xff]*|[a-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]+")
    buckets = 50

    def own(form: bytes) -> np.ndarray:
        h, out = xxhash.xxh64_intdigest(form), np.zeros(quality.DIMENSIONS)
        for k in range(4):
            out[(h >> 8 * k) % quality.DIMENSIONS] += -1 if h >> 32 + k & 1 else 1
        return out

    def row_of(form: bytes) -> int:
        return (xxhash.xxh64_intdigest(form) >> 36) % buckets

    split = [runs.findall((t or "").encode()) for t in rows]
    context = np.zeros((buckets, quality.DIMENSIONS))
    for words in split:
        for i, w in enumerate(words):
            for other in words[max(0, i - 2) : i] + words[i + 1 : i + 3]:
                context[row_of(w)] += own(other)
    assert (quality.context_vectors(frame, buckets) == context).all()
    vectors = quality.word_vectors(context)
    got = {r["id"]: np.array(r["v"]) for r in quality.document_vectors(frame, vectors, ["id"]).collect()}
    for i, words in enumerate(split):
        v = np.array([vectors[row_of(w)] for w in words], float).reshape(-1, quality.DIMENSIONS)
        index = np.array([own(w) for w in words]).reshape(-1, quality.DIMENSIONS)
        want = np.concatenate([[len(words)], v.sum(0), index.sum(0), (v * v).sum(0)])
        assert np.allclose(got[i], want, rtol=1e-4, atol=1e-3), rows[i]
    assert (quality.features(got[0][None, :]) == 0).all()


def test_classifier_edge_cases(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    assert quality.classify(docs, labels).count() == docs.count()
    assert {r["score"] for r in quality.classify(docs, labels.where("false")).collect()} == {0.5}
    many = spark.range(40_000).withColumn("quality", F.lit(1))
    for most in (1, 3_000, 30_000, 40_000):
        got = quality.learnt_from(spark.range(40_000).union(spark.range(9)), many.withColumnRenamed("id", "doc_id"), most).collect()
        learnable = sorted(r["id"] for r in many.where("crc32(cast(cast(id as string) as binary)) % 5 <> 0").select("id", F.xxhash64("id").alias("h")).orderBy("h").limit(most).collect())
        assert sorted(r["key"] for r in got) == learnable
    assert quality.classify(empty(docs), labels).count() == 0


# 8: URL filters


def test_entries_count_only_while_active(spark):
    edits = spark.createDataFrame(
        [("l", "block", "bad.example", "2024-01-10 00:00:00", True), ("l", "block", "bad.example", "2024-02-10 00:00:00", False), ("l", "block", "bad.example", "2024-04-01 00:00:00", True),
         ("l", "block", "bad.example", "2024-04-01 00:00:00", True), ("a", "allow", "bad.example/ok/", "2024-01-01 00:00:00", True), ("l", "block", None, "2024-01-01 00:00:00", True)],
        "list string, action string, entry string, at string, added boolean",
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    rows = [
        (1, "http://bad.example/x", "2024-01-09 23:59:59", "none"), (2, "http://Www.Bad.Example:80/x?y", "2024-01-10 00:00:00", "block"), (3, "http://bad.example", "2024-02-10 00:00:00", "none"),
        (4, "http://bad.example/ok/page", "2024-01-20 00:00:00", "allow"), (5, "http://notbad.example/", "2024-01-20 00:00:00", "none"), (6, "https://bad.example/z", "2025-01-01 00:00:00", "block"),
        (7, None, "2024-01-20 00:00:00", "none"), (8, "http://bad.example/", None, "none"), (9, "nonsense", "2024-01-20 00:00:00", "none"), (None, "http://a.b.bad.example/", "2024-05-01 00:00:00", "block"), (2, "http://Www.Bad.Example:80/x?y", "2024-01-10 00:00:00", "block"),
    ]
    captures = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, fetched_at string").withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz")).withColumn("entry", F.lit(0)).withColumn("month", F.lit(0))
    got = collections.Counter((r["page_id"], r["verdict"]) for r in urlfilters.judge(captures, edits).collect())
    assert got == collections.Counter((r[0], r[3]) for r in rows)
    assert urlfilters.judge(captures.where("false"), edits).count() == 0
    assert {r["verdict"] for r in urlfilters.judge(captures, edits.where("false")).collect()} == {"none"}


def test_entries_within_a_segment_and_in_capitals(spark):
    entries = ["bad.example/ab", "Caps.Example", "deep.example/a/b/c", "x.y.z.example/", "bad.example/ab/cd/", None, ""]
    edits = spark.createDataFrame([("l", "block", e, True) for e in entries], "list string, action string, entry string, added boolean").withColumn("at", F.lit("2024-01-01").cast("timestamp_ntz"))
    urls = ["http://bad.example/abc", "http://bad.example/ab", "http://bad.example/a", "http://bad.example", "http://WWW.caps.EXAMPLE/q", "http://deep.example/a/b/cde/f", "http://deep.example/a/b/", "http://w.x.y.z.example/q?r", "http://x.y.z.example",
            "http://y.z.example/", "http://bad.example/ab/cd/e", "http://deep.example/" + "a/" * 20_000, "http://" + "a." * 20_000 + "caps.example/", "http://example/", "http:///x"]
    captures = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("fetched_at", F.lit("2024-03-05").cast("timestamp_ntz"))

    def meets(url: str, entry: str) -> bool:
        host, _, path = url.removeprefix("http://").partition("/")
        domain, _, rest = entry.partition("/")
        path, rest = "/" * ("/" in url.removeprefix("http://")) + path.split("?")[0], "/" * ("/" in entry) + rest
        return ("." + host.lower()).endswith("." + domain.lower()) and path.startswith(rest)

    for row in urlfilters.judge(captures, edits).collect():
        met = sorted((e for e in entries if e and meets(row["url"], e)), key=len)
        assert (row["n_active"], row["entry"]) == (len(met), met[-1].lower() if met else None), row["url"][:60]


# the pipeline


def test_pipeline_stages(spark):
    sf = SF
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    odd = spark.createDataFrame([(-1, None, None, None, None), (None, "", "en", "s", 0)], docs.schema)
    docs = docs.union(docs.limit(5)).union(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        before, after = docs.count(), out.count()
        assert 0 < after <= before
        assert stage(spark, docs.where("false"), sf).count() == 0, name
        docs = out
    assert docs.select("doc_id").distinct().count() == docs.count()
    assert not docs.where(F.col("text").rlike("[0-9a-f]{32,}")).count()
    packed = corpus_pipeline.run(spark, sf)
    assert packed.select("doc_id").distinct().count() <= spark.read.parquet(f"{sf}/documents.parquet").count()
