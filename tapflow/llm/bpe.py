"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

``Vocabulary`` holds what a BPE file says: each token as a run of base symbols, the two tokens it was
merged from, the longest shorter token it begins with, and a trie of all tokens for longest matches.
``Encoder.words`` encodes many distinct words side by side: each step takes the longest token that starts
where a word stands, asks whether the token before it and this one are *compatible* (BPE over both would
leave them as they are), tries the next shorter token if not, and steps back when none is left. A place
proven dead is never entered again, so the work is linear in the word; the result equals the merges.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from pyspark.sql import DataFrame, functions as F

from .words import bytes_of, packed, slices, split

# Symbols of a word beyond which it is encoded on its own instead of beside others.
LONG = 192
_NONE = np.int64(-1)
#: Of bytes: 1 letter, 2 digit, 3 other ASCII, 0 beyond ASCII.
_KIND = np.repeat(np.array([3, 0], np.uint8), 128)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2


class Table:
    """Whole numbers to whole numbers, looked up for many keys at once (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, _NONE)
        self.values = np.full(1 << bits, _NONE)
        left = np.arange(len(keys))
        at = self._place(keys)
        while len(left):
            free = self.keys[at[left]] == _NONE
            go, slot = left[free], at[left[free]]
            _, one = np.unique(slot, return_index=True)
            self.keys[slot[one]], self.values[slot[one]] = keys[go[one]], values[go[one]]
            done = np.zeros(len(keys), bool)
            done[go[one]] = True
            left = left[~done[left]]
            clash = self.keys[at[left]] != _NONE
            at[left[clash]] = (at[left[clash]] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        at = self._place(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], _NONE)
        left = np.flatnonzero((found != keys) & (found != _NONE))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found != _NONE)]
        return out


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level BPE file whose last symbol of a word carries a suffix."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text("utf-8"))
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        letters = byte_letters()
        symbols: list[tuple[int, ...]] = [()] * size
        for token, i in ids.items():
            ended = token.endswith(self.suffix) and len(token) > len(self.suffix)
            body = [letters[c] for c in (token[: -len(self.suffix)] if ended else token)]
            symbols[i] = (*body[:-1], body[-1] + 256 * ended)
        self.base = np.full(512, _NONE)
        for i, run in enumerate(symbols):
            if len(run) == 1:
                self.base[run[0]] = i
        self.length = np.array([len(s) for s in symbols])
        #: A merge's number; tokens that no merge makes come first.
        self.rank = np.full(size, -1)
        self.left, self.right = np.arange(size), np.arange(size)
        first, second, made = [], [], []
        for n, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            i = ids[a + b]
            if self.rank[i] < 0:
                self.rank[i], self.left[i], self.right[i] = n, ids[a], ids[b]
            first.append(ids[a]), second.append(ids[b]), made.append(i)
        self.size = size
        self.pairs = Table(np.array(first) * size + np.array(second), np.array(made))
        self._trie(symbols)
        names = {i: t for t, i in (ids | self.special).items()}
        shown = [names.get(i, "").encode() for i in range(size)]
        #: Offset table: token i is blob[offset[i]:offset[i + 1]], with a blank after it.
        self.blob = np.frombuffer(b"".join(s + b" " for s in shown), np.uint8)
        self.offset = np.cumsum([0, *(len(s) + 1 for s in shown)])

    def _trie(self, symbols: list[tuple[int, ...]]) -> None:
        steps: dict[int, int] = {}
        token, count = [-1], 1
        self.shorter = np.full(self.size, _NONE)
        for i in sorted((i for i, s in enumerate(symbols) if s), key=lambda i: len(symbols[i])):
            node = 0
            for symbol in symbols[i]:
                if token[node] >= 0:
                    self.shorter[i] = token[node]
                key = node * 512 + symbol
                if key not in steps:
                    steps[key] = count
                    token.append(-1)
                    count += 1
                node = steps[key]
            token[node] = i
        self.steps = Table(np.fromiter(steps.keys(), np.int64), np.fromiter(steps.values(), np.int64))
        self.token_at = np.array(token)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of neighbours: BPE over both keeps them apart.

        Undo merges, the latest first, on the two sides of the border; a merge across the border that
        would have come before the merge just undone makes the pair impossible.
        """
        out = np.ones(len(a), bool)
        left, a, b = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(left):
            across = self.pairs(a * self.size + b)
            when = np.where(across >= 0, self.rank[across], np.iinfo(np.int64).max)
            bad = when < limit
            out[left[bad]] = False
            go = ~bad & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            left, a, b = left[go], a[go], b[go]
            undo = self.rank[a] > self.rank[b]
            # Of two equal merges the left one comes first.
            limit = np.where(undo, self.rank[a], self.rank[b] + 1)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return out

    def matches(self, symbols: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The longest token that starts at each symbol and stays inside its word (``end``: the word's end)."""
        best = self.base[symbols].copy()
        at = np.arange(len(symbols))
        node = np.zeros(len(symbols), np.int64)
        depth = 0
        while len(at):
            node = self.steps(node * 512 + symbols[at + depth])
            go = node >= 0
            at, node = at[go], node[go]
            token = self.token_at[node]
            best[at[token >= 0]] = token[token >= 0]
            depth += 1
            inside = at + depth < end[at]
            at, node = at[inside], node[inside]
        return best


class Encoder:
    """Encodes words as the file's library does: normalised, split, then merged."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        # Fixed value: the pattern of the vocabulary file.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.marks = regex.compile("|".join(map(regex.escape, self.vocabulary.special)))
        #: Scripts beyond Latin: their case, composition and classes are those of the library's Unicode tables.
        self.beyond = regex.compile(r"[^\x00-\u024F]")
        rules = Tokenizer.from_file(path)
        self.rules = rules.normalizer, rules.pre_tokenizer
        self.letters = byte_letters()

    def _split(self, word: str) -> list[bytes]:
        """A word's pieces as the file's normaliser and splitter give them."""
        if not self.beyond.search(word):
            return [p.encode() for p in self.pattern.findall(unicodedata.normalize("NFC", word.lower()))]
        normal, split = self.rules
        return [bytes(map(self.letters.__getitem__, p)) for p, _ in split.pre_tokenize_str(normal.normalize_str(word))]

    def _parts(self, word: str) -> list[bytes | int]:
        """What a word consists of: pieces to encode, and ids of special tokens."""
        special, out, at = self.vocabulary.special, [], 0
        for m in self.marks.finditer(word):
            out += [*self._split(word[at : m.start()]), special[m[0]]]
            at = m.end()
        return out + self._split(word[at:])

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, where each word's ids begin)."""
        data, offsets = bytes_of(words)
        size = np.diff(offsets)
        kind = _KIND[data]
        lead, trail = data == 0xC3, np.append(False, (data == 0xC3)[:-1]) & (data >= 0x80)
        # Latin-1 letters but for the signs of multiplication and division; the rest of Unicode goes word by word.
        latin = trail & (data != 0x97) & (data != 0xB7)
        kind[lead | latin] = 1
        odd = (kind == 0) | (data == 0x27)
        if len(data) > 1:
            odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
        word_of = np.repeat(np.arange(len(words)), size)
        slow = np.zeros(len(words), bool)
        slow[word_of[odd]] = True
        plain = data + 32 * ((kind == 1) & ((data >= 65) & (data <= 90) | latin & (data <= 0x9E))).astype(np.uint8)
        first = np.ones(len(data), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        first[offsets[:-1]] = True
        first &= ~slow[word_of]
        start = np.flatnonzero(first)
        ends = np.append(start[1:], len(data))
        if slow.any():
            # A piece ends with its word, also where a word that is left out follows.
            ends = np.minimum(ends, offsets[word_of[start] + 1])
        count = np.bincount(word_of[start], minlength=len(words))
        keep = ~slow[word_of]
        coded = packed(plain[keep], np.append(0, np.cumsum(ends - start))).cast(pa.large_binary()).dictionary_encode()
        rest: dict[bytes | int, int] = {}
        more: list[int] = []
        for i in np.flatnonzero(slow):
            word = words[i].as_py()
            parts = self._parts(word) if "<|" in word else self._split(word)
            more.extend([rest.setdefault(p, len(rest)) for p in parts])
            count[i] = len(parts)
        ids, begin = self._distinct(*bytes_of(coded.dictionary), list(rest))
        at = np.cumsum(count) - count
        use = np.empty(count.sum(), np.int64)
        use[spread(at[~slow], count[~slow])] = coded.indices.to_numpy()
        use[spread(at[slow], count[slow])] = np.array(more, np.int64) + len(coded.dictionary)
        size = np.diff(begin)[use]
        per_word = np.append(0, np.cumsum(size))[np.append(at, len(use))]
        return ids[spread(begin[use], size)], per_word

    def _distinct(self, data: np.ndarray, begin: np.ndarray, rest: list[bytes | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces: those in ``data``, then ``rest``."""
        added = [b"" if isinstance(p, int) else p for p in rest]
        begin = np.append(begin, begin[-1] + np.cumsum(list(map(len, added)), dtype=np.int64))
        symbols = np.append(data, np.frombuffer(b"".join(added), np.uint8)).astype(np.int64)
        size = np.diff(begin)
        symbols[begin[1:][size > 0] - 1] += 256
        found = np.zeros(len(symbols), np.int64)
        depth = np.zeros(len(size), np.int64)
        together = np.flatnonzero((size > 0) & (size <= LONG))
        for rows in [*np.flatnonzero(size > LONG)[:, None], together]:
            depth[rows] = self._walk(symbols, begin[rows], begin[rows + 1], found)
        ids = found[spread(begin[:-1], depth)]
        marks = [len(size) - len(rest) + i for i, p in enumerate(rest) if isinstance(p, int)]
        if marks:
            ids = np.insert(ids, np.cumsum(depth)[marks], [p for p in rest if isinstance(p, int)])
            depth[marks] = 1
        return ids, np.append(0, np.cumsum(depth))

    def _walk(self, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Encode the words ``symbols[begin:end]`` into ``found`` from ``begin`` on; how many tokens each has."""
        if not len(begin):
            return np.zeros(0, np.int64)
        if len(begin) == 1:
            return np.array([self._walk_one(symbols[begin[0] : end[0]], found[begin[0] : end[0]])])
        v = self.vocabulary
        length, shorter = v.length, v.shorter
        spot = spread(begin, end - begin)
        local = symbols[spot]
        size = end - begin
        base = np.cumsum(size) - size
        best = v.matches(local, np.repeat(base + size, size))
        stack = np.empty(len(local), np.int64)
        alive = np.ones(len(local) + 1, bool)
        at, last = base.copy(), base + size
        top = base.copy()  # where the next token goes
        token = best[base]
        live = np.arange(len(begin))
        while len(live):
            here, t, high = at[live], token[live], top[live]
            to = here + length[t]
            fits = alive[to] | (to == last[live])
            ask = np.flatnonzero(fits & (high > base[live]))
            if len(ask):
                fits[ask] = v.compatible(stack[high[ask] - 1], t[ask])
            on = live[fits]
            stack[high[fits]] = t[fits]
            top[on] += 1
            at[on] = to[fits]
            more = at[on] < last[on]
            token[on[more]] = best[at[on[more]]]
            off, cut = live[~fits], shorter[t[~fits]]
            token[off] = cut
            back = off[cut < 0]
            if len(back):
                alive[at[back]] = False
                top[back] -= 1
                token[back] = stack[top[back]]
                at[back] -= length[token[back]]
            live = live[at[live] < last[live]]
        used = top - base
        found[spread(begin, used)] = stack[spread(base, used)]
        return used

    def _walk_one(self, symbols: np.ndarray, out: np.ndarray) -> int:
        """The same for one long word; pairs already judged are remembered."""
        v = self.vocabulary
        n = len(symbols)
        best = v.matches(symbols, np.full(n, n)).tolist()
        judged: dict[tuple[int, int], bool] = {}
        alive, stack, at, token = [True] * (n + 1), [], 0, best[0]
        while at < n:
            to = at + int(v.length[token])
            fits = alive[to]
            if fits and stack:
                pair = stack[-1], token
                if pair not in judged:
                    judged[pair] = bool(v.compatible(np.array([pair[0]]), np.array([pair[1]]))[0])
                fits = judged[pair]
            if fits:
                stack.append(token)
                at = to
                token = best[at] if at < n else -1
            elif v.shorter[token] >= 0:
                token = int(v.shorter[token])
            else:
                alive[at] = False
                token = stack.pop()
                at -= int(v.length[token])
        out[: len(stack)] = stack
        return len(stack)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text's ids begin)."""
        found = split(texts)
        codes, distinct = found.codes()
        ids, begin = self.words(distinct)
        size = np.diff(begin)[codes]
        per_text = np.bincount(found.row, size, len(texts)).astype(np.int64)
        return ids[spread(begin[codes], size)], np.append(0, np.cumsum(per_text))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens, a blank after each."""
        v = self.vocabulary
        return v.blob[spread(v.offset[ids], v.offset[ids + 1] - v.offset[ids])]


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each run, one run after another."""
    if not len(size):
        return np.zeros(0, np.int64)
    before = np.cumsum(size) - size
    return np.repeat(begin - before, size) + np.arange(before[-1] + size[-1])


@functools.lru_cache(4)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: (id, n_tokens, ids_sha256, decoded_sha256), one row per row of ``docs``.

    A null text is the empty text (no ids, empty decoded text); a null id stays null; repeated rows each
    get their row; other columns are ignored whatever their names; an empty table gives an empty table.
    No shuffle: rows stay where they were read.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def digests(batches):
        tool = encoder(path)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                ids, begin = tool.texts(texts)
                raw = ids.astype("<u4").tobytes()
                widths = tool.vocabulary.offset[ids + 1] - tool.vocabulary.offset[ids]
                place = np.append(0, np.cumsum(widths))[begin]
                shown = memoryview(tool.decode(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(begin)),
                        pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(begin, begin[1:])]),
                        # Blanks stand between tokens only.
                        pa.array([hashlib.sha256(shown[a : max(a, b - 1)]).hexdigest() for a, b in zip(place, place[1:])]),
                    ],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return source.mapInArrow(digests, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
