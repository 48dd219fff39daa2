"""Removing repeated passages with suffix arrays built by linear grouping.

The suffix array of a byte string is made in two passes. The first keeps suffixes in groups by their Lyndon
prefix, starting with the first byte, and takes the groups in descending order: every member's pointer to the
nearest smaller suffix on its left is followed over what is done already, and the suffixes pointed at are
extended by the group's prefix (as often as members share the pointer) and split off behind the rest of their
group. The second pass emits the suffixes in ascending order: each one places those it ends the Lyndon prefix
of at the head of their group. Nothing is renamed and no smaller problem is solved on the way.

To spread the work, every window of `width` bytes belongs to the bucket of its smallest 16-byte hash (the leftmost of
equal ones is its anchor), which equal windows share. They also share a key of the bytes that all windows with the anchor
on that side of their middle hold around it (33 or 34 of 50). Only windows whose key several documents have are gathered;
the keys travel as packed arrays, a row per range of keys. Neighbouring windows of one anchor travel as one segment, equal
segments of a document as one row; they are combined before and after the shuffle. In a bucket, segments
whose bytes around the common ones are nobody else's share no window and are set apart. The
suffix array of the others brings equal windows together, and each learns the smallest document that has it.
A bucket of a single segment has one owner and nothing to order. Buckets are many and small: those of a block
take their groups in the same steps, each a few array operations for all.

A bucket whose distinct segments have more than MOST bytes together is not ordered in one task: the task
hands its segments on, their windows are dealt anew by their next-smallest hash as well, which equal windows
share too, and each of those buckets is ordered for itself. What is still above MOST is dealt by the whole
window; there a bucket is one window. What is learnt of the pieces goes back to the segments they come from.

Defined cases: null and empty texts have no bytes and lose nothing; whole copies of a text with a smaller id
are known by digest (all their windows start there) and take no part; rows of one id never remove each other;
rows with a null id neither lose nor take; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.llm.parity import BYTE, PIECE, R, R_INV, mix, powers
from vigilake.plans.sieve import hashed, maybe_among
from vigilake.session import freeing, materialise

GRAM = 16
MOST = 1 << 20  # bytes of a bucket ordered at once; the lists of its suffix array take a few hundred bytes for each
BLOCK = 1 << 21  # bytes of segments brought together to be ordered in the same steps
PARTS = 9  # ranges of the places of a bucket's bytes in a window
JOINED = 1 << 17  # bytes of short texts whose windows are hashed together
LOW = np.uint64((1 << 21) - 1)  # of a hash and its place in one number, the place: it is below PIECE and a window's width
CHUNK = 500_000  # keys of a task combined at once


def suffix_array(text: bytes | list[int]) -> list[int]:
    """Suffix array of `text` by Lyndon grouping."""
    n = len(text)
    sa = sorted(range(n), key=text.__getitem__)
    at = [0] * n  # where a suffix stands in sa
    head = [0] * n  # where its group begins
    size = [0] * n  # of the group that begins there
    start = 0
    for r, i in enumerate(sa):
        if text[i] != text[sa[start]]:
            start = r
        at[i], head[i] = r, start
        size[start] += 1
    length = [1] * n
    group(sa, at, head, size, [-1] * n, length, bytearray(n), n)
    return emit(head, length)


def group(sa: list[int], at: list[int], head: list[int], size: list[int], before: list[int], length: list[int], done: bytearray, end: int) -> None:
    """The first pass, from the groups before place `end` on."""
    while end:
        start = head[sa[end - 1]]
        members = sorted(sa[start:end])
        prefix = length[members[0]]
        for m in members:
            done[m] = 1
        times: dict[int, int] = {}
        for m in members:
            p = m - 1
            while p >= 0 and done[p]:
                p = before[p]
            before[m] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        end = start
        if not times:
            continue
        # by group and repeats; the extended ones take the last places of their group, most repeats last
        moved = sorted(times, key=lambda p: (head[p], times[p]))
        i = len(moved)
        while i:
            g = head[moved[i - 1]]
            tail = g + size[g]
            while i and head[moved[i - 1]] == g:
                count, stop = times[moved[i - 1]], tail
                fresh = []
                while i and head[moved[i - 1]] == g and times[moved[i - 1]] == count:
                    i -= 1
                    p = moved[i]
                    tail -= 1
                    q, a = sa[tail], at[p]
                    sa[a], at[q] = q, a
                    sa[tail], at[p] = p, tail
                    length[p] += count * prefix
                    fresh.append(p)
                size[g] = tail - g
                for p in fresh:
                    head[p] = tail if tail > g else -1 - g
                if tail > g:
                    size[tail] = stop - tail
                else:  # the whole group has moved: its lowest part keeps the head, which only now may be named again
                    size[g] = stop - g
                    for p in fresh:
                        head[p] = g
                    break


def emit(head: list[int], length: list[int]) -> list[int]:
    """The suffixes in order: each places, at the head of their groups, those whose Lyndon prefix it ends."""
    n = len(head)
    first, following = [-1] * (n + 1), [-1] * n
    for i in range(n):
        e = i + length[i]
        following[i] = first[e]
        first[e] = i
    free = list(range(n))
    out = [0] * n
    s = n
    for r in range(n + 1):
        i = first[s]
        while i >= 0:
            h = head[i]
            out[free[h]] = i
            free[h] += 1
            i = following[i]
        if r < n:
            s = out[r]
    return out


def heads(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new.nonzero()[0]


def counting(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (n numbers) of each, one after the other."""
    ends = np.cumsum(n)
    return np.repeat(start - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


def suffix_arrays(text: np.ndarray, ends: np.ndarray, few: int = 12, long: int = 32) -> np.ndarray:
    """Suffix arrays of the strings that end at `ends` of `text`, one behind the other.

    As `suffix_array`, but every string takes its next group in the same step, so that a step is a few array
    operations for all. The last `few` strings with groups left, and the `long` longest ones when suffixes are
    emitted, go on for themselves.
    """
    n = len(text)
    starts = np.concatenate([[0], ends[:-1]])
    key = np.repeat(np.arange(len(ends)), ends - starts) * (int(text.max(initial=0)) + 1) + text
    sa = np.argsort(key)
    at = np.empty(n, np.int64)
    at[sa] = np.arange(n)
    lead = heads(key[sa])
    size = np.zeros(n, np.int64)
    size[lead] = np.diff(np.append(lead, n))
    head = np.repeat(lead, size[lead])[at]
    del key
    before, length, done, mark = np.arange(-1, n - 1), np.ones(n, np.int64), np.zeros(n + 1, bool), np.zeros(n, bool)
    before[starts[ends > starts]] = -1  # where done has a place that stays free
    end, live = ends.copy(), np.flatnonzero(ends > starts)
    while len(live) > few:
        start = head[sa[end[live] - 1]]
        count = end[live] - start
        members = sa[counting(start, count)]
        prefix = np.repeat(length[members[np.cumsum(count) - count]], count)
        end[live] = start
        live = live[start > starts[live]]
        done[members] = True
        p = before[members]
        on = np.flatnonzero(done[p])
        while len(on):
            p[on] = before[members[on]] = before[p[on]]
            on = on[done[p[on]]]
        some = p >= 0
        p, prefix = p[some], prefix[some]
        if not len(p):
            continue
        order = np.argsort(p)
        p, prefix = p[order], prefix[order]
        lead = heads(p)
        p, prefix, times = p[lead], prefix[lead], np.diff(np.append(lead, len(p)))
        g = head[p]
        order = np.argsort(g * (n + 1) + times)
        p, prefix, times, g = p[order], prefix[order], times[order], g[order]
        lead = heads(g)
        moved, lowest = np.diff(np.append(lead, len(p))), g[lead]
        place = np.arange(len(p)) + np.repeat(lowest + size[lowest] - moved - lead, moved)
        # who stands there and has not moved takes the places left
        old = at[p]
        mark[place] = True
        left = np.sort(old[~mark[old]])
        mark[place] = False
        mark[old] = True
        other = sa[place[~mark[place]]]
        mark[old] = False
        sa[left], at[other] = other, left
        sa[place], at[p] = p, place
        part = heads(g, times)
        n_part = np.diff(np.append(part, len(p)))
        size[lowest] -= moved
        size[place[part]] = n_part
        head[p] = np.repeat(place[part], n_part)
        length[p] += times * prefix
    for a, b, e in zip(starts[live].tolist(), ends[live].tolist(), end[live].tolist()):
        lists = [x.tolist() for x in (sa[a:b] - a, at[a:b] - a, head[a:b] - a, size[a:b], np.maximum(before[a:b] - a, -1), length[a:b])]
        group(*lists, bytearray(done[a:b]), e - a)
        head[a:b], length[a:b] = np.array(lists[2]) + a, lists[5]
    return emit_all(head, length, starts, ends, long)


def emit_all(head: np.ndarray, length: np.ndarray, starts: np.ndarray, ends: np.ndarray, long: int) -> np.ndarray:
    out, free = np.empty(len(head), np.int64), np.arange(len(head))
    by_size = np.argsort(starts - ends)  # the longest ones first, empty ones left out
    by_size = by_size[: np.count_nonzero(ends > starts)]
    for a, b in zip(starts[by_size[:long]].tolist(), ends[by_size[:long]].tolist()):
        out[a:b] = np.array(emit((head[a:b] - a).tolist(), length[a:b].tolist()), np.int64) + a
    begin, n = starts[by_size[long:]], (ends - starts)[by_size[long:]]
    # every string has a place more, behind its last suffix
    shift = np.repeat(np.arange(len(ends)), ends - starts)
    until = np.arange(len(head)) + length + shift
    order, many = np.argsort(until), np.bincount(until, minlength=len(head) + len(ends))
    first = np.cumsum(many) - many
    s = begin + n + by_size[long:]
    for r in range(int(n.max(initial=-1)) + 1):
        ended = order[counting(first[s], many[s])]
        h = head[ended]  # of those one suffix ends no two are of one group
        out[free[h]] = ended
        free[h] += 1
        s = out[begin[: np.searchsorted(-n, -r)] + r]
        s = s + shift[s]
    return out


def smallest(raw: np.ndarray, first: np.ndarray, n_bytes: np.ndarray, windows: np.ndarray, docs: np.ndarray, bucket: np.ndarray, width: int):
    """(number of runs per segment, first window, last window, smallest document) of runs of the windows of segments.

    Segment i is the `n_bytes[i]` bytes of `raw` from `first[i]` on, starts `windows[i]` windows and is found first
    in document `docs[i]`; segments of a bucket stand together. A zero, which no segment holds after all bytes
    are shifted by one, closes each of them.
    """
    flat = raw[np.minimum(counting(first, n_bytes + 1), len(raw) - 1)]
    stop = np.cumsum(n_bytes + 1)
    of = np.repeat(np.arange(len(first)), n_bytes + 1)
    offset = np.arange(len(flat)) - (stop - n_bytes - 1)[of]
    text = flat.astype(np.int16) + 1
    text[stop - 1] = 0
    lead = heads(bucket)
    order = suffix_arrays(text, stop[np.append(lead[1:], len(first)) - 1])
    # between suffixes that begin with equal windows only those stand in which no whole window begins
    whole = offset < windows[of]
    order = order[whole[order]]
    new = np.ones(len(order), bool)
    views = np.lib.stride_tricks.sliding_window_view(flat, width)
    for a in range(0, len(order) - 1, 100_000):
        some = views[order[a : a + 100_001]]
        new[a + 1 : a + len(some)] = (some[1:] != some[:-1]).any(axis=1)
    new[1:] |= bucket[of[order[1:]]] != bucket[of[order[:-1]]]
    begin = np.flatnonzero(new)
    owner = np.zeros(len(flat), np.int64)
    owner[order] = np.repeat(np.minimum.reduceat(docs[of[order]], begin), np.diff(np.append(begin, len(order))))
    at = np.flatnonzero(whole)
    cut = heads(of[at], owner[at])
    last = np.append(cut[1:], len(at)) - 1
    return np.bincount(of[at[cut]], minlength=len(first)), offset[at[cut]], offset[at[last]], owner[at[cut]]


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(BYTE[raw] * powers("up", R, len(raw)), dtype=np.uint64)])
    return mix((total[GRAM:] - total[:-GRAM]) * powers("down", R_INV, len(raw) + 1)[: len(raw) - GRAM + 1])


def least(h: np.ndarray, span: int) -> np.ndarray:
    """The smallest of each `span` neighbours."""
    step, low = 1, h
    while step * 2 <= span:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    return np.minimum(low[: len(low) - (span - step)], low[span - step :]) if span > step else low


def runs(raw: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, first window, number of windows) of the runs of windows of one bucket, a piece of the text at a time."""
    n = len(raw) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = []
    for a in range(0, n, PIECE):
        parts.append(least(gram_hashes(raw[a : min(a + PIECE, n) + width - 1]), width - GRAM + 1))
    return same_runs(np.concatenate(parts))


def anchored_runs(raw: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As `runs`, and where in each run its smallest hash stands, counted from the run's first byte; -1 if its windows differ in that."""
    bucket, first, n = runs(raw, width)
    place = np.full(len(raw), -1, np.int32)  # of each window, the leftmost of equal hashes
    for a in range(0, max(0, len(raw) - width + 1), PIECE):
        h = gram_hashes(raw[a : min(a + PIECE, len(raw) - width + 1) + width - 1])
        at, step, span = np.arange(len(h), dtype=np.int32), 1, width - GRAM + 1
        while step < span:
            by = min(step, span - step)  # the last step overlaps
            later = h[by:] < h[: len(h) - by]
            at = np.where(later, at[by:], at[: len(at) - by])
            h = np.where(later, h[by:], h[: len(h) - by])
            step += by
        place[a : a + len(at)] = at + a
    last = first + n - 1
    return bucket, first, n, np.where(place[first] == place[last], place[first] - first, -1)


def joined_runs(raws: Iterable[bytes], width: int, anchored: bool = False, sided: bool = False):
    """(number of the first text, texts, text, bucket, first window, number of windows, anchor) for some texts after the
    other: runs as `anchored_runs` finds them (without anchors as `runs` does; `sided` as `sided_runs` does, with their keys),
    `text` counted from that first one.

    Short texts are put together, since each array operation costs more than their few bytes.
    """
    def found(held: list[bytes]):
        return sided_runs(held, width) if sided else runs_together(held, width, anchored)

    a, held, size = 0, [], 0
    for raw in raws:
        if held and size + len(raw) > JOINED:
            yield a, held, *found(held)
            a, held, size = a + len(held), [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield a, held, *found(held)


def sided_runs(raws: list[bytes], width: int):
    """(text, bucket, first window, number of windows, anchor, key) of the runs of windows with one anchor on one side of their middle.

    The anchor is the leftmost of a window's smallest hashes (without their LOW bits), the key one of the bytes around
    it that all such windows hold: of those with it on the left more bytes on the right, of the others more on the left.
    """
    n_bytes = np.array([len(r) for r in raws])
    starts = np.cumsum(n_bytes) - n_bytes
    n_windows = np.maximum(n_bytes - width + 1, 0)
    window, of = counting(starts, n_windows), np.repeat(np.arange(len(raws)), n_windows)
    joined = np.frombuffer(b"".join(raws), np.uint8)
    half, parts = (width - GRAM + 1) // 2, []
    for a in range(0, len(window), PIECE):
        some, text = window[a : a + PIECE], of[a : a + PIECE]
        begin = int(some[0])
        raw, some = joined[begin : int(some[-1]) + width], some - begin
        total = np.concatenate([[np.uint64(0)], np.cumsum(BYTE[raw] * powers("up", R, len(raw)), dtype=np.uint64)])
        down = powers("down", R_INV, len(raw) + 1)
        h = mix((total[GRAM:] - total[:-GRAM]) * down[: len(raw) - GRAM + 1])  # as gram_hashes
        place = (least((h & ~LOW) | np.arange(len(h), dtype=np.uint64), width - GRAM + 1)[some] & LOW).astype(np.int64)
        right = place - some >= half
        cut = heads(text, place, right)
        at, side = place[cut], right[cut]
        lo, hi = at - half * side, np.where(side, at + GRAM, at + width - half + 1)
        key = mix((total[hi] - total[lo]) * down[lo] ^ side.astype(np.uint64))
        first = some[cut]
        parts.append((text[cut], h[at], first + begin - starts[text[cut]], np.diff(np.append(cut, len(some))), at - first, key))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none, none, none, none.view(np.uint64)
    return tuple(map(np.concatenate, zip(*parts)))


def runs_together(raws: list[bytes], width: int, anchored: bool):
    if len(raws) == 1:
        raw = np.frombuffer(raws[0], np.uint8)
        bucket, first, n, *at = anchored_runs(raw, width) if anchored else runs(raw, width)
        return np.zeros(len(bucket), np.int64), bucket, first, n, at[0] if at else first
    n_bytes = np.array([len(r) for r in raws])
    starts = np.cumsum(n_bytes) - n_bytes
    n_windows = np.maximum(n_bytes - width + 1, 0)
    if not n_windows.any():
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none, none, none
    h = gram_hashes(np.frombuffer(b"".join(raws), np.uint8))
    window, of = counting(starts, n_windows), np.repeat(np.arange(len(raws)), n_windows)
    keys = least(h, width - GRAM + 1)[window]
    cut = heads(keys, of)
    n, first, of, bucket = np.diff(np.append(cut, len(window))), window[cut], of[cut], keys[cut]
    at = first
    if anchored:
        views = np.lib.stride_tricks.sliding_window_view(h, width - GRAM + 1)
        place, last = ((views[w] == bucket[:, None]).argmax(axis=1) + w for w in (first, first + n - 1))
        at = np.where(place == last, place - first, -1)
    return of, bucket, first - starts[of], n, at


def same_runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], first, np.diff(np.append(first, len(keys)))


def next_keys(part: bytes, width: int) -> np.ndarray:
    """For each window of a segment a key of its smallest and its next-smallest hash."""
    raw, span, out = np.frombuffer(part, np.uint8), width - GRAM + 1, []
    n = len(raw) - width + 1
    for a in range(0, n, PIECE):
        h = gram_hashes(raw[a : min(a + PIECE, n) + width - 1]) & ~LOW
        low = least(h, span)  # the same for all windows of a segment
        out.append(mix(low ^ mix(least(np.where(h == low[0], ~np.uint64(0), h), span))))
    return np.concatenate(out)


def window_keys(part: bytes, width: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(part[a : a + width]) for a in range(len(part) - width + 1)], np.uint64)


def pack(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def text_key(raw: bytes) -> bytes:
    """128 bits that tell texts apart; together with the length they name a copy."""
    return xxhash.xxh3_128_digest(raw)


def described(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """doc_id, same (digest), n_bytes, whole_sha256 of every row."""

    def run(batches):
        for b in batches:
            raws = [(t or "").encode() for t in b["text"].to_pylist()]
            columns = [pa.array([text_key(r) for r in raws], pa.binary()), pa.array([len(r) for r in raws], pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raws])]
            yield pa.RecordBatch.from_arrays([b["doc_id"], *columns], names=["doc_id", "same", "n_bytes", "whole_sha256"])

    narrow = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, same binary, n_bytes long, whole_sha256 string")


def packed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """doc_id, same, z: the texts as compressed bytes, which is what the shuffles by document carry."""

    def run(batches):
        for b in batches:
            raws = [(t or "").encode() for t in b["text"].to_pylist()]
            columns = [pa.array([text_key(r) for r in raws], pa.binary()), pa.array([pack(r) for r in raws], pa.binary())]
            yield pa.RecordBatch.from_arrays([b["doc_id"], *columns], names=["doc_id", "same", "z"])

    narrow = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    return narrow.mapInArrow(run, "doc_id long, same binary, z binary")


KEY_COLUMNS = ["part", "keys", "docs", "sure", "others", "their_docs"]
KEYS = "part int, keys binary, docs binary, sure binary, others binary, their_docs binary"


def buckets_of(docs: DataFrame, width: int, doc: str, text: str, parts: int) -> DataFrame:
    """The keys of each text's windows, packed for each of `parts` ranges of them as `packed_keys` does."""

    def run(batches):
        def keyed():
            for b in batches:
                docs_of = b["doc_id"].to_numpy()
                for a, _, of, *_, key in joined_runs(((t or "").encode() for t in b["text"].to_pylist()), width, sided=True):
                    yield key, docs_of[a + of]

        held, n = [], 0
        for found in keyed():
            held.append(found)
            n += len(found[0])
            if n >= CHUNK:
                yield packed_keys(*map(np.concatenate, zip(*held)), parts)
                held, n = [], 0
        if n:
            yield packed_keys(*map(np.concatenate, zip(*held)), parts)

    narrow = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    return narrow.mapInArrow(run, KEYS)


def met_in(key: np.ndarray, doc: np.ndarray):
    """The order by key, where each key begins there, its number of entries, smallest document and whether it has several."""
    order = np.argsort(key)
    lead = heads(key[order])
    least_doc = np.minimum.reduceat(doc[order], lead)
    return order, lead, np.diff(np.append(lead, len(key))), least_doc, least_doc != np.maximum.reduceat(doc[order], lead)


def packed_keys(key: np.ndarray, doc: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row per range of keys: its keys, each with one document and whether it is `sure` that others have it.

    The other documents of a key are known to meet it here. They are spread over the rows (others, their_docs), so a
    key of very many documents is an entry per chunk wherever keys are brought together.
    """
    order, lead, n, least_doc, several = met_in(key, doc)
    key, doc = key[order], doc[order]
    more = np.repeat(several, n) & (doc != np.repeat(least_doc, n))
    others, their_docs, key = key[more], doc[more], key[lead]
    bounds = (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
    edges = np.concatenate([[0], np.searchsorted(key, bounds), [len(key)]])
    spread = np.arange(parts + 1) * len(others) // parts

    def binary(x: np.ndarray, at: np.ndarray) -> pa.Array:
        return pa.BinaryArray.from_buffers(pa.binary(), parts, [None, pa.py_buffer((at * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])

    columns = [pa.array(np.arange(parts, dtype=np.int32)), binary(key, edges), binary(least_doc, edges), binary(several, edges), binary(others, spread), binary(their_docs, spread)]
    return pa.RecordBatch.from_arrays(columns, names=KEY_COLUMNS)


def met_keys(rows: DataFrame) -> DataFrame:
    """(key, doc_id) of every document under a key that several have, from rows of `packed_keys`."""

    def settled(held: list[tuple[bytes, ...]]) -> pa.RecordBatch:
        keys, docs, sure, others, their_docs = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*held), (np.uint64, np.int64, bool, np.int64, np.int64)))
        if len(keys):
            order, lead, n, _, several = met_in(keys, docs)
            stay = order[np.repeat(several | np.logical_or.reduceat(sure[order], lead), n)]
            others, their_docs = np.concatenate([others, keys[stay].view(np.int64)]), np.concatenate([their_docs, docs[stay]])
        return pa.RecordBatch.from_arrays([pa.array(others), pa.array(their_docs)], names=["key", "doc_id"])

    def run(batches):
        held, now = [], None
        for b in batches:
            for part, *row in zip(*(b[c].to_pylist() for c in KEY_COLUMNS)):
                if part != now and held:
                    yield settled(held)
                    held = []
                now = part
                held.append(row)
        if held:
            yield settled(held)

    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(run, "key long, doc_id long")


SEGMENT = "bucket long, segment binary, bytes binary, windows int, anchor int, doc_id long, same binary, first_windows array<int>"


def segments_of(texts: DataFrame, width: int) -> DataFrame:
    """From (doc_id, same, z, keys) the segments of the named windows; a task gives a segment's `bytes` again only for a smaller document."""

    def run(batches):
        seen: dict[bytes, int] = {}  # of this task's partition
        for b in batches:
            docs_of = b["doc_id"].to_numpy()
            keys, n_keys = b["keys"].flatten().to_numpy().view(np.uint64), b["keys"].value_lengths().to_numpy()
            begin = np.concatenate([[0], np.cumsum(n_keys)])
            for a, raws, of, bucket, first, n, at, key in joined_runs(map(unpack, b["z"].to_pylist()), width, sided=True):
                row = np.arange(len(raws), dtype=np.uint64)
                # a run more by chance would do no harm
                named = mix(keys[begin[a] : begin[a + len(raws)]] ^ mix(np.repeat(row, n_keys[a : a + len(raws)])))
                chosen = np.flatnonzero(np.isin(mix(key ^ mix(row[of])), named))
                # both sides of an anchor go together
                lead = heads(of[chosen], (first + at)[chosen], chosen - np.arange(len(chosen)))
                if not len(lead):
                    continue
                n = np.add.reduceat(n[chosen], lead)
                of, bucket, first, at = (x[chosen[lead]] for x in (of, bucket, first, at))
                lead, order = same_segments(raws, of, bucket, first, n, at, width)
                firsts = pa.ListArray.from_arrays(pa.array(np.append(lead, len(order)), pa.int32()), pa.array(first[order], pa.int32()))
                of, bucket, first, n, at = (x[order[lead]] for x in (of, bucket, first, n, at))
                docs, parts, segments = docs_of[a + of], [], []
                for i, start, stop, d in zip(of.tolist(), first.tolist(), (first + n + width - 1).tolist(), docs.tolist()):
                    part = raws[i][start:stop]
                    segment = xxhash.xxh3_128_digest(part)
                    segments.append(segment)
                    # the smallest document so far stands for the segment; the others only take part in the marking
                    if seen.get(segment, d + 1) > d:
                        seen[segment] = d
                        parts.append(part)
                    else:
                        parts.append(None)
                columns = [bucket.view(np.int64), pa.array(segments, pa.binary()), pa.array(parts, pa.binary()), n, at, docs, b["same"].take(pa.array(a + of)), firsts]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
    names = ["bucket", "segment", "bytes", "windows", "anchor", "doc_id", "same", "first_windows"]

    return texts.mapInArrow(run, SEGMENT)


def same_segments(raws: list[bytes], of: np.ndarray, bucket: np.ndarray, first: np.ndarray, n: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the segments of some texts and where in it a new one begins: those of one text with the same bytes stand together.

    Told by their bytes; where different ones of a text alternate under one number, equal ones may stay apart.
    """
    code = mix(bucket ^ mix(((of * width + n) * width + at).astype(np.uint64)))
    order = np.argsort(code, kind="stable")
    code = code[order]
    new = np.ones(len(order), bool)
    new[1:] = code[1:] != code[:-1]
    again = np.flatnonzero(~new)
    if len(again):
        n_bytes = np.array([len(r) for r in raws])
        views = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b"".join(raws), np.uint8), width)
        one, two = order[again - 1], order[again]
        begin = (np.cumsum(n_bytes) - n_bytes)[of] + first
        # the first and the last window hold all bytes of a segment, as all its windows hold its anchor
        same = (of[one] == of[two]) & (n[one] == n[two]) & (at[one] == at[two]) & (views[begin[one]] == views[begin[two]]).all(axis=1)
        more = np.flatnonzero(same)
        last = begin + n - 1
        same[more] = (views[last[one[more]]] == views[last[two[more]]]).all(axis=1)
        new[again] = ~same
    return np.flatnonzero(new), order


def apart(parts: list[tuple[bytes, int, int, int]], width: int) -> list[bool]:
    """Which segments (bytes, windows, document, anchor) of a bucket cannot share a window with another one of it."""
    n_bytes = np.array([len(p[0]) for p in parts])
    raw = np.frombuffer(b"".join(p[0] for p in parts), np.uint8)
    return apart_of(raw, np.cumsum(n_bytes) - n_bytes, n_bytes, np.array([p[3] for p in parts]), np.zeros(len(parts), np.int64), width).tolist()


def apart_of(raw: np.ndarray, first: np.ndarray, n_bytes: np.ndarray, anchor: np.ndarray, bucket: np.ndarray, width: int) -> np.ndarray:
    """Which segments cannot share a window with another one of their bucket (numbered from 0).

    A window holds the bucket's bytes and `width - GRAM` more. Where these are at least `lo` and at most `hi` on
    the left, who shares it has the same `lo` bytes on the left and `width - GRAM - hi` on the right. All places are
    gone through in PARTS such ranges (in two at first). The bytes are told by a hash, which may only keep more
    together. Where the bucket's bytes stand is not known of all segments, nobody is set apart.
    """
    more = width - GRAM

    def met(some: np.ndarray, lo: int, hi: int) -> np.ndarray:
        span = width - hi + lo
        has = some[(anchor[some] >= lo) & (anchor[some] + width - hi <= n_bytes[some])]
        h = (BYTE[raw[(first + anchor - lo)[has][:, None] + np.arange(span)]] * powers("up", R, span)).sum(axis=1, dtype=np.uint64)
        _, which, n = np.unique(mix(h ^ mix(bucket[has].astype(np.uint64))), return_inverse=True, return_counts=True)
        return has[n[which] > 1]

    unknown = np.zeros(int(bucket.max(initial=-1)) + 1, bool)
    unknown[bucket[anchor < 0]] = True
    some = np.flatnonzero(~unknown[bucket])
    for parts in (2, PARTS):
        edges = np.linspace(0, more + 1, min(parts, more + 1) + 1).astype(int).tolist()
        some = np.unique(np.concatenate([met(some, lo, hi - 1) for lo, hi in zip(edges, edges[1:])]))
    alone = ~unknown[bucket]
    alone[some] = False
    return alone


OWNERS = pa.schema([("segment", pa.binary()), ("owners", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("doc", pa.int64())]))), ("bytes", pa.binary()), ("doc_id", pa.int64())])


def once(rows: pa.Table) -> pa.Table:
    """Each segment of a bucket once, with its smallest document, in the order of buckets."""
    bucket, doc = rows["bucket"].to_numpy(), rows["doc_id"].to_numpy()
    code = rows["segment"].combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.lexsort((doc, code, bucket))
    return rows.take(pa.array(order[heads(bucket[order], code[order])]))


def handed_on(rows: pa.Table) -> pa.RecordBatch:
    columns = [rows["segment"].combine_chunks(), pa.nulls(len(rows), OWNERS.field("owners").type), rows["bytes"].combine_chunks(), rows["doc_id"].combine_chunks()]
    return pa.RecordBatch.from_arrays(columns, schema=OWNERS)


def solved(rows: pa.Table, width: int, most: int | None):
    """Batches of OWNERS from the rows of whole buckets."""
    rows = once(rows)
    keys, windows, anchor, docs = (rows[c].to_numpy() for c in ("bucket", "windows", "anchor", "doc_id"))
    packed_bytes = rows["bytes"].combine_chunks()
    edges = np.frombuffer(packed_bytes.buffers()[1], np.int32)[packed_bytes.offset :][: len(rows) + 1].astype(np.int64)
    raw = np.frombuffer(packed_bytes.buffers()[2], np.uint8)
    first, n_bytes = edges[:-1], np.diff(edges)
    lead = heads(keys)
    n = np.diff(np.append(lead, len(keys)))
    bucket = np.repeat(np.arange(len(lead)), n)
    large = ((np.add.reduceat(n_bytes + 1, lead) > most) & (n > 1))[bucket] if most is not None else np.zeros(len(keys), bool)
    if large.any():
        yield handed_on(rows.filter(pa.array(large)))
    # a run of all windows, unless the windows are ordered
    runs_of, a, b, doc = np.ones(len(keys), np.int64), np.zeros(len(keys), np.int64), windows - 1, docs
    some = np.flatnonzero((n > 1)[bucket] & ~large)
    if len(some):
        some = some[~apart_of(raw, first[some], n_bytes[some], anchor[some], bucket[some], width)]
        some = some[np.bincount(bucket[some], minlength=len(lead))[bucket[some]] > 1]
    if len(some):
        n_runs, *found = smallest(raw, first[some], n_bytes[some], windows[some], docs[some], bucket[some], width)
        runs_of[some] = n_runs
        ordered = np.zeros(len(keys), bool)
        ordered[some] = True
        into = np.repeat(ordered, runs_of)
        plain = [a, b, doc]
        a, b, doc = (np.empty(len(into), np.int64) for _ in range(3))
        for to, whole, ran in zip((a, b, doc), plain, found):
            to[into], to[~into] = ran, whole[~ordered]
    ends = np.concatenate([[0], np.cumsum(runs_of)])
    spans = pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(doc, pa.int64())], names=["a", "b", "doc"])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)
    columns = [rows["segment"].combine_chunks(), lists, pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.int64())]
    made = pa.RecordBatch.from_arrays(columns, schema=OWNERS)
    yield made.filter(pa.array(~large)) if large.any() else made


def owned(segments: DataFrame, width: int, most: int | None) -> DataFrame:
    """(segment, owners) with owners as runs (first, last window, smallest document), whole buckets of sorted partitions at a time.

    Segments of a bucket with more than `most` bytes are handed on instead: bytes and doc_id, no owners.
    """

    def run(batches):
        held, size, over = [], 0, None

        def settled(rows: pa.Table, last: bool):
            """What of the rows ends here; the others are held."""
            nonlocal held, size, over
            bucket = rows["bucket"].to_numpy()
            if over is not None:  # more of a bucket that was too large before
                k = int(np.searchsorted(bucket, over, "right"))
                if k:
                    yield handed_on(once(rows[:k]))
                rows, bucket = rows[k:], bucket[k:]
            k = len(rows) if last or not len(rows) else int(np.searchsorted(bucket, bucket[-1]))
            if k:
                yield from solved(rows[:k], width, most)
            rows = rows[k:]
            if rows["bytes"].nbytes >= BLOCK:
                rows = once(rows)
                if most is not None and rows["bytes"].nbytes > most and len(rows) > 1:
                    yield handed_on(rows)
                    over, rows = rows["bucket"][0].as_py(), rows[:0]
            held = rows.to_batches()
            size = rows["bytes"].nbytes

        for b in batches:
            held.append(b)
            size += b["bytes"].nbytes
            if size >= BLOCK:
                yield from settled(pa.Table.from_batches(held), False)
        if held:
            yield from settled(pa.Table.from_batches(held), True)

    whole = segments.filter("bytes IS NOT NULL").select("bucket", "segment", "bytes", "windows", "anchor", "doc_id")
    shape = "segment binary, owners array<struct<a: int, b: int, doc: long>>, bytes binary, doc_id long"
    return whole.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, shape)


def pieces_of(large: DataFrame, width: int, last: bool) -> DataFrame:
    """The segments handed on, dealt anew: `segment` is a piece of `root` from window `start` on; of the last ones each stands for `times` windows."""

    def run(batches):
        seen: dict[bytes, int] = {}
        for b in batches:
            rows = []
            for root, raw, d in zip(*(b[c].to_pylist() for c in ("segment", "bytes", "doc_id"))):
                bucket, first, n = same_runs((window_keys if last else next_keys)(raw, width))
                for k, a, w in zip(bucket.view(np.int64).tolist(), first.tolist(), n.tolist()):
                    times, w = (w, 1) if last else (1, w)
                    part = raw[a : a + w + width - 1]
                    segment = xxhash.xxh3_128_digest(part)
                    fresh = seen.get(segment, d + 1) > d
                    if fresh:
                        seen[segment] = d
                    rows.append((root, a, times, k, segment, part if fresh else None, w, -1, d))
                if len(rows) > 50_000:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)

    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]
    names = ["root", "start", "times", "bucket", "segment", "bytes", "windows", "anchor", "doc_id"]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return large.repartition("segment").mapInArrow(run, "root binary, start int, times int, bucket long, segment binary, bytes binary, windows int, anchor int, doc_id long")


def all_owned(segments: DataFrame, width: int, most: int = MOST, level: int = 0) -> DataFrame:
    """(segment, owners) of all segments, one row each, in buckets of at most `most` bytes."""
    table = materialise(owned(segments, width, most if level < 2 else None), "owners", free=True)
    known, large = table.filter("owners IS NOT NULL").select("segment", "owners"), table.filter("owners IS NULL")
    if level == 2 or large.isEmpty():
        return known
    pieces = materialise(pieces_of(large.select("segment", "bytes", "doc_id"), width, level == 1), "pieces", free=True)
    below = all_owned(pieces, width, most, level + 1).select("segment", F.explode("owners").alias("o"))
    back = pieces.select("root", "start", "times", "segment").distinct().join(below, "segment")
    span = F.struct((F.col("start") + F.col("o.a")).alias("a"), (F.col("start") + F.col("o.b") + F.col("times") - 1).alias("b"), F.col("o.doc").alias("doc"))
    return known.unionByName(back.groupBy(F.col("root").alias("segment")).agg(F.collect_list(span).alias("owners")))


def cut(texts: DataFrame) -> DataFrame:
    """From (doc_id, same, z, spans) the number of bytes and runs removed, and the digest of the rest."""

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            spans, n = b["spans"].flatten(), b["spans"].value_lengths().to_numpy()
            a, e = (spans.field(k).to_numpy().astype(np.int64) for k in (0, 1))
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((a, row))
            # as rows of their own, so that what overlaps or touches is joined within a text only
            shift = int(e.max(initial=0)) + 1
            a, e, row = a[order] + row * shift, np.maximum.accumulate(e[order] + row * shift), row[order]
            fresh = np.ones(len(a), bool)
            fresh[1:] = a[1:] > e[:-1]
            lead = np.flatnonzero(fresh)
            of = row[lead]
            a, e = a[lead] - of * shift, e[np.append(lead[1:], len(row)) - 1] - of * shift
            removed, n = (np.bincount(of, w, len(n)).astype(np.int64) for w in (e - a, None))
            ends, a, e, kept = np.cumsum(n).tolist(), a.tolist(), e.tolist(), []
            for i, z in enumerate(b["z"].to_pylist()):
                raw, to = unpack(z), slice(ends[i - 1] if i else 0, ends[i])
                kept.append(hashlib.sha256(b"".join([raw[x:y] for x, y in zip([0, *e[to]], [*a[to], len(raw)])])).hexdigest())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["same"], pa.array(removed), pa.array(n), pa.array(kept, pa.string())], names=["doc_id", "same", "n_removed", "n_spans", "kept_sha256"])

    return texts.mapInArrow(run, "doc_id long, same binary, n_removed long, n_spans long, kept_sha256 string")


def repeats(docs: DataFrame, width: int = 50, doc: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row: bytes of windows that a smaller document has go."""
    base = materialise(described(docs, doc, text), "described", free=True)
    firsts = materialise(base.filter("doc_id IS NOT NULL").groupBy("same", "n_bytes").agg(F.min("doc_id").alias("rep")), "firsts", free=True)
    reps = firsts.filter(f"n_bytes >= {width}").select(F.col("rep").alias("doc_id"), "same")

    # whole copies stay out; the few that the bitmap lets through go in the joins with `reps`
    with freeing(docs.sparkSession):
        among = maybe_among(reps.select(hashed("doc_id").alias("id")), F.col("id"), reps.count())
    docs = docs.filter(among(hashed(F.col(doc).cast("long"))))
    # keys that at least two texts have; twice as many ranges of keys as partitions, as some of these get several
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = met_keys(buckets_of(docs, width, doc, text, parts)).groupBy("doc_id").agg(F.collect_list("key").alias("keys"))

    texts = packed(docs, doc, text)
    chosen = reps.join(keys, "doc_id")
    segments = materialise(segments_of(texts.join(chosen, ["doc_id", "same"]).dropDuplicates(["doc_id", "same"]), width), "segments", free=True)
    known = all_owned(segments, width, most)
    met = segments.select("segment", "doc_id", "same", "first_windows").join(known, "segment")
    # windows a to b cover the bytes a to b + width - 1
    mine = F.expr(f"flatten(transform(filter(owners, o -> o.doc < doc_id), o -> transform(first_windows, f -> struct(f + o.a AS a, f + o.b + {width} AS b))))")
    marks = met.select("doc_id", "same", mine.alias("s")).filter("size(s) > 0")
    spans = materialise(marks.groupBy("doc_id", "same").agg(F.flatten(F.collect_list("s")).alias("spans")), "spans", free=True)
    changed = cut(texts.join(spans, ["doc_id", "same"]).dropDuplicates(["doc_id", "same"]))

    all_rows = base.join(firsts, ["same", "n_bytes"], "left")
    gone = (F.col("rep") < F.col("doc_id")) & (F.col("n_bytes") >= width)
    met = all_rows.join(changed, ["doc_id", "same"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return met.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(gone, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )
