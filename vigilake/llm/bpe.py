"""BPE encoding and decoding with a contiguous rank array per word.

A word is one text with an array of part boundaries and an array with the rank of each pair of neighbouring
parts. The array is scanned for its minimum, that boundary is deleted and the ranks left and right of it are
looked up again, until no pair has a rank. For short words this beats any heap; words above `LONG` symbols
(unbroken runs, not prose) use a heap with the same order of merges so that no word costs quadratic time.

Texts are cut at white space first. What the vocabulary's own rules do (NFC, lower case, split pattern, byte
symbols) never looks across white space, so a chunk's ids are cached per worker; `CACHE` bounds that memory.
When a generation is full it becomes the old one, from which what is met again moves on, and the older one goes.

Defined cases: null counts as empty, an empty text has no ids, special tokens in a text become their ids (as
in the library the vocabulary comes from), ids outside the vocabulary are left out when decoding. Letters and
digits are told by this Python's Unicode tables; code points that none of them assigns may be cut differently.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG = 256
CACHE = 120_000  # chunks, and words, of a generation; a worker keeps two, about 100 MB
PART = 800  # texts looked up together
NONE = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next one from 256 up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    later = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(later)) for b in range(256)]


class Vocabulary:
    """A word-end BPE vocabulary file: ids, ranks of pairs, special tokens and the split pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks: dict[tuple[str, str], int] = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.texts: list[str | None] = [None] * size
        for text, i in [*self.ids.items(), *self.special.items()]:
            self.texts[i] = text
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.symbols = dict(enumerate(byte_symbols()))
        self.latin = {c: "".join(self.symbols[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}

    def merge(self, text: str) -> list[int]:
        """Ids of one word, given as byte symbols."""
        whole = text + self.suffix
        n = len(text)
        if n > LONG:
            return self._merge_long(text)
        cuts = [*range(n), len(whole)]  # part i is whole[cuts[i]:cuts[i + 1]]
        rank = self.ranks.get

        def at(i: int) -> int:
            return rank((whole[cuts[i] : cuts[i + 1]], whole[cuts[i + 1] : cuts[i + 2]]), NONE)

        ranks = [at(i) for i in range(n - 1)]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            del cuts[i + 1]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = at(i)
            if i:
                ranks[i - 1] = at(i - 1)
        ids = self.ids
        return [ids[whole[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, text: str) -> list[int]:
        parts: list[str | None] = [*text[:-1], text[-1] + self.suffix]
        n = len(parts)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        rank = self.ranks.get
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]), NONE)) < NONE]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue  # one of the two has changed since
            parts[i], parts[j] = left + right, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank((parts[i], parts[k]), NONE)) < NONE:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (r := rank((parts[h], parts[i]), NONE)) < NONE:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return [self.ids[p] for p in parts if p is not None]

    def pieces(self, chunk: str) -> list[str]:
        """The words of a chunk in byte symbols."""
        # plain letters, perhaps with a mark of punctuation behind them, need no rules
        if chunk and chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
            if chunk[-1] in MARKS and chunk[:-1].isalpha():
                return [chunk[:-1].lower(), chunk[-1]]
        # per character, so a sigma at the end of a word is lowered like any other
        low = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        symbols = self.symbols
        return [
            w if w.isascii() and w.isprintable() else "".join(symbols[b] for b in w.encode())
            for w in self.words.findall(low)
        ]

    def chunk(self, chunk: str, merge: Callable[[str], list[int]]) -> list[int]:
        """Ids of a text without white space."""
        if self.cut is None or "<" not in chunk and not self.cut.search(chunk):
            return [i for w in self.pieces(chunk) for i in merge(w)]
        out, at = [], 0
        for m in self.cut.finditer(chunk):
            out += [i for w in self.pieces(chunk[at : m.start()]) for i in merge(w)]
            out.append(self.special[m[0]])
            at = m.end()
        return out + [i for w in self.pieces(chunk[at:]) for i in merge(w)]


MARKS = frozenset(".,;:!?")
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]?$"  # as in `Vocabulary.pieces`, and letters that NFC leaves and that have one lower case
ODD = regex.compile("[\x1c-\x1f]")  # str.split() takes these for white space, the split pattern does not
SOLID = regex.compile(r"[^\p{White_Space}]+")


def chunks(text: str) -> list[str]:
    return SOLID.findall(text) if ODD.search(text) else text.split()


class Encoder:
    """Encodes Arrow arrays of texts; keeps the ids of chunks and words it has seen."""

    def __init__(self, path: str, merge: Callable[[str], list[int]] | None = None, cache: int = CACHE):
        self.vocabulary = v = Vocabulary(path)
        self.merge, self.cache = merge or v.merge, cache
        self.seen: dict[str, bytes] = {}
        self.words: dict[str, list[int]] = {}
        self.old_seen: dict[str, bytes] = {}
        self.old_words: dict[str, list[int]] = {}

    def _word(self, word: str) -> list[int]:
        found = self.words.get(word)
        if found is None:
            found = self.old_words.get(word) or self.merge(word)
            if len(word) < LONG:
                self.words[word] = found
        return found

    def _new(self, chunk: str) -> bytes:
        ids = self.old_seen.get(chunk)
        if ids is None:
            ids = array("i", self.vocabulary.chunk(chunk, self._word)).tobytes()
        if len(chunk) < LONG:
            self.seen[chunk] = ids
        return ids

    def one(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        return b"".join(self.distinct(chunks(text or "")))

    def _age(self) -> None:
        if len(self.seen) > self.cache:
            self.old_seen, self.seen = self.seen, {}
        if len(self.words) > self.cache:
            self.old_words, self.words = self.words, {}

    def array(self, texts: pa.Array) -> pa.Array:
        """list<int32> of a string array, some texts at a time."""
        parts = [self._part(texts.slice(a, PART)) for a in range(0, max(1, len(texts)), PART)]
        ends = np.concatenate([[0], np.cumsum(np.concatenate([n for n, _ in parts]))]).astype(np.int64)
        values = pa.array(np.concatenate([ids for _, ids in parts]))
        if ends[-1] < 2**31:
            return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
        return pa.LargeListArray.from_arrays(pa.array(ends), values)

    def _part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids). Each distinct chunk of the texts is looked up once."""
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
            each = [self.one(t) for t in texts.to_pylist()]
            return np.array([len(x) // 4 for x in each], np.int64), np.frombuffer(b"".join(each), dtype="<i4")
        cut = pc.utf8_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        words = cut.flatten().dictionary_encode()
        flat, starts, sizes = self._looked_up(words.dictionary)
        index = np.asarray(words.indices)
        n = sizes[index]  # ids of each occurrence
        total = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(int(total[-1]), dtype=np.int64) + np.repeat(starts[index] - total[:-1], n)
        return np.diff(total[np.asarray(cut.offsets) - cut.offsets[0].as_py()]), flat[at]

    def _looked_up(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, number of ids) of distinct chunks; plain letters are looked up once in lower case and without the mark behind them."""
        plain = np.asarray(pc.match_substring_regex(chunks, PLAIN).cast(pa.uint8())).view(bool)
        mine = chunks.filter(pa.array(plain))
        marked = np.asarray(pc.match_substring_regex(mine, "[.,;:!?]$").cast(pa.uint8())).view(bool)
        ends = np.zeros(len(mine), np.uint8)
        if marked.any():
            raw, offsets = np.frombuffer(mine.buffers()[2], np.uint8), np.frombuffer(mine.buffers()[1], np.int64)[mine.offset :][: len(mine) + 1]
            ends[marked] = raw[offsets[1:][marked] - 1]
        stems = pc.utf8_lower(pc.utf8_rtrim(mine, characters=".,;:!?")).dictionary_encode()
        marks = np.unique(ends[marked])
        others = chunks.filter(pa.array(~plain)).to_pylist()
        ids = [*self._stems(stems.dictionary.to_pylist()), *self.distinct([chr(m) for m in marks]), *self.distinct(others)]
        found = np.frombuffer(b"".join(ids), dtype="<i4")
        n = np.array([len(x) // 4 for x in ids], np.int64)
        first = np.cumsum(n) - n
        k = len(stems.dictionary)
        # where a chunk's ids are: those of its stem and then of its mark, or its own
        stem, mark = np.zeros(len(chunks), np.int64), np.full(len(chunks), -1, np.int64)
        stem[plain] = np.asarray(stems.indices)
        stem[~plain] = k + len(marks) + np.arange(len(others))
        mark[plain] = np.where(marked, k + np.searchsorted(marks, ends), -1)
        sizes = n[stem] + np.where(mark < 0, 0, n[mark])
        starts = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), "<i4")
        for part, to in ((stem, starts), (mark[mark >= 0], (starts + n[stem])[mark >= 0])):
            many = n[part]
            step = np.arange(int(many.sum()), dtype=np.int64) - np.repeat(np.cumsum(many) - many, many)
            out[np.repeat(to, many) + step] = found[np.repeat(first[part], many) + step]
        return out, starts, sizes

    def _stems(self, words: list[str]) -> list[bytes]:
        """Ids of words of lower-case letters, which hold no special token and are not cut."""
        seen, old, merge, latin, out = self.seen, self.old_seen, self.merge, self.vocabulary.latin, []
        for word in words:
            ids = seen.get(word)
            if ids is None:
                ids = old.get(word) or array("i", merge(word if word.isascii() else word.translate(latin))).tobytes()
                if len(word) < LONG:
                    seen[word] = ids
            out.append(ids)
        self._age()
        return out

    def distinct(self, chunks: list[str]) -> list[bytes]:
        out = [b"" if not c else self.seen.get(c) or self._new(c) for c in chunks]
        self._age()
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=4)
def texts_of(path: str) -> pa.Array:
    return pa.array(encoder(path).vocabulary.texts, type=pa.large_string())


def decode_array(ids: pa.Array, path: str) -> pa.Array:
    """The tokens of each id list, joined by one space; the vocabulary names no decoder, so none is applied."""
    texts = texts_of(path)
    ids = ids.cast(pa.large_list(pa.int32()))
    flat = np.asarray(ids.values.fill_null(-1).slice(ids.offsets[0].as_py(), ids.offsets[-1].as_py() - ids.offsets[0].as_py()))
    ends = np.asarray(ids.offsets) - ids.offsets[0].as_py()
    known = (flat >= 0) & (flat < len(texts))
    if not known.all():
        ends = np.concatenate([[0], np.cumsum(known)])[ends]
        flat = flat[known]
    tokens = pc.take(texts, pa.array(flat))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends.astype(np.int64)), tokens), pa.scalar(" ", pa.large_string()))
    return joined.cast(pa.large_string())


def encode(text: Column, path: str) -> Column:
    """Column of the ids of `text`: array<int>, empty for null and empty texts."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        return encoder(path).array(texts)

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """Column of the text the vocabulary's tokens of `ids` spell; null ids give an empty text."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        return decode_array(lists, path)

    return run(F.coalesce(ids, F.array().cast("array<int>")))


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`df` with the ids of its texts and their decoding; columns of those names are replaced."""
    return df.withColumn(ids, encode(F.col(text), path)).withColumn(decoded, decode(F.col(ids), path))
