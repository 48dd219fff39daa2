"""Repeated passages of words by seed and extend.

Seeds are winnowed anchors: of the 16-word sequences in a window of `width` words the one with the smallest
hash (the leftmost of equals) is the window's anchor, so equal windows have equal anchors at the same place,
and any repeat of at least `width` words shares one. Neighbouring windows with the same anchor are one
segment. Documents are joined on the anchors that two or more of them have.

In an anchor's bucket all segments are laid over each other at the anchor and extended together, one word to
the left and one to the right at a time: members that still agree share a class, and the smallest document of
a class stands for it. Where a left and a right extension together reach `width` words the members of both
classes share a window; runs of windows with one owner are the maximal repeats that are kept. The work is
linear in the members, however many share a passage; no pairs are made. Words are compared as they are; hashes only choose buckets.

Equal segments travel to their bucket once per task, and what is learnt comes back to all documents that have
them by a join on the segment. Buckets are counted first; one of more than `most` segments is not brought to one
task: its windows are grouped by their own digest (128 bits) over all tasks.

Defined cases: null and empty texts have no words; whole copies (the same words in order) of a smaller
document are known by their sha256 and take no part; rows of one id never remove each other, and of several
rows with equal id and text one is looked at for all; rows with a null id neither lose nor take; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.llm.parity import IS_SPACE, PIECE, WIDTHS, mix, word_hashes
from vigilake.session import materialise

GRAM = 16
MOST = 20_000  # segments of a bucket that one task extends
NOTHING = hashlib.sha256(b"").hexdigest()


def normal(raw: bytes) -> bytes:
    """The words of a text joined by one space."""
    if not raw:
        return raw
    x = np.frombuffer(raw, np.uint8)
    space = IS_SPACE[x]
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first space after a word stays
    out = np.where(space, np.uint8(32), x)[keep].tobytes()
    return out.strip(b" ")


def hashed_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the words of a normal text, a piece of it at a time."""
    hashes, starts, at = [], [], 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE:
            cut = text.rfind(b" ", at, at + PIECE)
            cut = text.find(b" ", at + PIECE) if cut < 0 else cut
            end = cut + 1 if cut >= 0 else end
        h, s = word_hashes(np.frombuffer(text, np.uint8)[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def anchors(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, its place, first window, number of windows) of each segment of a text's word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), *[np.zeros(0, np.int64)] * 3
    low = np.ones(len(words) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        low = mix(low * WIDTHS[i] + words[i : len(words) - GRAM + 1 + i])
    values, place = low, np.arange(len(low))
    step, span = 1, width - GRAM + 1
    while step < span:
        by = min(step, span - step)  # the last step overlaps
        later = low[by:] < low[: len(low) - by]
        place = np.where(later, place[by:], place[: len(place) - by])
        low = np.where(later, low[by:], low[: len(low) - by])
        step += by
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return values[place[first]].view(np.int64), place[first], first, np.diff(np.append(first, n))


def sources(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """doc_id, same (digest of the text), text."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.md5(whole.cast("binary")).alias("same"), whole.alias("text"))


def raw_texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def described(texts: DataFrame, width: int) -> DataFrame:
    """doc_id, same, n_words, whole (sha256 of the words), seeds (distinct anchors) of every row."""

    def run(batches):
        for b in batches:
            n, whole, seeds = [], [], []
            for raw in raw_texts(b["text"]):
                text = normal(raw)
                h, _ = hashed_words(text)
                n.append(len(h))
                whole.append(hashlib.sha256(text).hexdigest())
                seeds.append(np.unique(anchors(h, width)[0]))
            columns = [b["doc_id"], b["same"], pa.array(n, pa.int64()), pa.array(whole, pa.string()), pa.array(seeds, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "same", "n_words", "whole", "seeds"])

    return texts.mapInArrow(run, "doc_id long, same string, n_words long, whole string, seeds array<long>")


SEGMENT = "anchor long, segment binary, words binary, at int, windows int, doc_id long, same string, first int"
_segment = pa.schema(
    [("anchor", pa.int64()), ("segment", pa.binary()), ("words", pa.binary()), ("at", pa.int32()), ("windows", pa.int32()), ("doc_id", pa.int64()), ("same", pa.string()), ("first", pa.int32())]
)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def segments_of(texts: DataFrame, width: int) -> DataFrame:
    """From (doc_id, same, text, keys) the segments of the named anchors; a task gives a segment's `words` again only for a smaller document."""

    def run(batches):
        seen: dict[bytes, int] = {}
        for b in batches:
            rows: list[tuple] = []
            for d, same, raw, keys in zip(b["doc_id"].to_pylist(), b["same"].to_pylist(), raw_texts(b["text"]), b["keys"]):
                text = normal(raw)
                h, starts = hashed_words(text)
                ends = np.append(starts[1:] - 1, len(text))
                found, place, first, n = anchors(h, width)
                for i in np.flatnonzero(np.isin(found, np.asarray(keys.values))).tolist():
                    a, w, at = int(first[i]), int(n[i]), int(place[i] - first[i])
                    part = text[starts[a] : ends[a + w + width - 2]]
                    name = xxhash.xxh3_128_digest(part + at.to_bytes(4, "little"))
                    fresh = seen.get(name, d + 1) > d
                    if fresh:
                        if len(seen) >= 500_000:  # forgetting costs a repeated text, no more
                            seen.clear()
                        seen[name] = d
                    rows.append((int(found[i]), name, part if fresh else None, at, w, d, same, a))
                if len(rows) > 20_000:
                    yield batch_of(rows, _segment)
                    rows = []
            if rows:
                yield batch_of(rows, _segment)

    return texts.mapInArrow(run, SEGMENT)


def extended(members: list[tuple[list, int, int, int]], width: int) -> list[list[int | None]]:
    """For each window of each member the smallest document that has it, all members laid over each other at their anchors.

    A member is (words, place of the anchor, number of windows, document), members by ascending document.
    """
    owners: list[list[int | None]] = [[None] * windows for _, _, windows, _ in members]
    reach = width - GRAM  # words a window has beside its anchor
    ids: list[dict] = [{} for _ in range(2 * reach + 1)]

    def class_of(level: int, key) -> int:
        return ids[level].setdefault(key, len(ids[level]))

    shared: list[dict] = [{} for _ in range(reach + 1)]
    for m, (words, at, windows, doc) in enumerate(members):
        right = [class_of(0, tuple(words[at : at + GRAM]))]
        for i, word in enumerate(words[at + GRAM : at + width]):
            right.append(class_of(1 + i, (right[-1], word)))
        left = right[0]
        for i in range(min(at, reach) + 1):
            if i:
                left = class_of(reach + i, (left, words[at - i]))
            if at - i < windows and reach - i < len(right):
                owners[m][at - i] = shared[i].setdefault((left, right[reach - i]), doc)
    return owners


def runs_of(own: list[int]) -> list[dict]:
    """Runs of windows with one owner."""
    out, first = [], 0
    for i in range(1, len(own) + 1):
        if i == len(own) or own[i] != own[first]:
            out.append({"a": first, "b": i - 1, "doc": own[first]})
            first = i
    return out


_repeat = pa.schema([("segment", pa.binary()), ("repeats", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("doc", pa.int64())])))])


def bucketed(whole: DataFrame, width: int) -> DataFrame:
    """(segment, repeats) of the segments, bucket by bucket in sorted partitions."""

    def run(batches):
        now, held, rows = None, {}, []

        def solved():
            parts = sorted(held.items(), key=lambda x: x[1][3])
            for (name, _), own in zip(parts, extended([p for _, p in parts], width)):
                rows.append((name, runs_of(own)))

        for b in batches:
            for anchor, name, words, at, windows, doc in zip(*(b[c].to_pylist() for c in ("anchor", "segment", "words", "at", "windows", "doc_id"))):
                if anchor != now:
                    solved()
                    now, held = anchor, {}
                    if len(rows) > 20_000:
                        yield batch_of(rows, _repeat)
                        rows.clear()
                if name not in held:  # rows come by ascending document
                    held[name] = (words.split(b" "), at, windows, doc)
        solved()
        if rows:
            yield batch_of(rows, _repeat)

    return whole.repartition("anchor").sortWithinPartitions("anchor", "doc_id").mapInArrow(run, "segment binary, repeats array<struct<a: int, b: int, doc: long>>")


_window = pa.schema([("digest", pa.binary()), ("segment", pa.binary()), ("i", pa.int32()), ("doc_id", pa.int64())])


def by_window(large: DataFrame, width: int) -> DataFrame:
    """(segment, repeats) of the segments of large buckets: the smallest document of each of their windows, by its digest."""

    def run(batches):
        for b in batches:
            rows = []
            for name, raw, windows, doc in zip(*(b[c].to_pylist() for c in ("segment", "words", "windows", "doc_id"))):
                words = raw.split(b" ")
                rows += [(xxhash.xxh3_128_digest(b" ".join(words[i : i + width])), name, i, doc) for i in range(windows)]
                if len(rows) > 50_000:
                    yield batch_of(rows, _window)
                    rows = []
            if rows:
                yield batch_of(rows, _window)

    # the smallest document of a segment counts: equal segments come from several tasks
    lone = large.groupBy("segment").agg(F.min("doc_id").alias("doc_id"), F.first("words").alias("words"), F.first("windows").alias("windows"))
    windows = materialise(lone.mapInArrow(run, "digest binary, segment binary, i int, doc_id long"), "windows")
    least = windows.groupBy("digest").agg(F.min("doc_id").alias("doc"))
    back = windows.select("digest", "segment", "i").join(least, "digest")
    return back.groupBy("segment").agg(F.collect_list(F.struct(F.col("i").alias("a"), F.col("i").alias("b"), "doc")).alias("repeats"))


def cut(texts: DataFrame) -> DataFrame:
    """From (doc_id, whole, text, spans) the number of words removed and the digest of the rest; spans are first and last word."""

    def run(batches):
        for b in batches:
            removed, kept = [], []
            for raw, spans in zip(raw_texts(b["text"]), b["spans"].to_pylist()):
                text = normal(raw)
                _, starts = hashed_words(text)
                change = np.zeros(len(starts) + 1, np.int64)
                np.add.at(change, [s["a"] for s in spans], 1)
                np.add.at(change, [s["b"] + 1 for s in spans], -1)
                stay = np.cumsum(change)[:-1] == 0
                edge = np.diff(stay.astype(np.int8), prepend=0, append=0)
                ends = np.append(starts[1:] - 1, len(text))
                parts = [text[starts[a] : ends[z - 1]] for a, z in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
                removed.append(len(starts) - int(stay.sum()))
                kept.append(hashlib.sha256(b" ".join(parts)).hexdigest())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["whole"], pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "whole", "n_removed", "kept_sha256"])

    return texts.mapInArrow(run, "doc_id long, whole string, n_removed long, kept_sha256 string")


def repeats(docs: DataFrame, width: int = 50, doc: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row: words of windows that a smaller document has go."""
    if width < GRAM:
        raise ValueError(f"windows are of at least {GRAM} words")
    texts = sources(docs, doc, text)
    base = materialise(described(texts, width), "described")
    firsts = base.filter("doc_id IS NOT NULL").groupBy("whole").agg(F.min("doc_id").alias("rep"))

    # of whole copies the first takes part, once; anchors that two documents have
    apart = base.filter(f"doc_id IS NOT NULL AND n_words >= {width}").join(firsts, "whole").filter("doc_id = rep")
    own = materialise(apart.groupBy("whole").agg(F.min(F.struct("doc_id", "same", "seeds")).alias("r")).select("whole", "r.*"), "apart")
    seeds = own.select("doc_id", "same", "whole", F.explode("seeds").alias("anchor"))
    shared = seeds.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("anchor")
    keys = seeds.join(shared, "anchor").groupBy("doc_id", "same", "whole").agg(F.collect_list("anchor").alias("keys"))
    near = materialise(texts.join(keys, ["doc_id", "same"]).dropDuplicates(["doc_id", "same"]), "near")

    segments = materialise(segments_of(near, width), "segments")
    whole = segments.filter("words IS NOT NULL").select("anchor", "segment", "words", "at", "windows", "doc_id")
    hot = materialise(whole.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("anchor"), "hot")
    if hot.isEmpty():
        known = bucketed(whole, width)
    else:
        known = bucketed(whole.join(hot, "anchor", "left_anti"), width).unionByName(by_window(whole.join(hot, "anchor", "left_semi"), width))
    met = segments.select("segment", "doc_id", "same", "first").join(known, "segment")
    # windows a to b cover the words a to b + width - 1
    mine = F.expr(f"transform(filter(repeats, r -> r.doc < doc_id), r -> struct(first + r.a AS a, first + r.b + {width - 1} AS b))")
    marks = met.select("doc_id", "same", mine.alias("s")).filter("size(s) > 0")
    spans = marks.groupBy("doc_id", "same").agg(F.flatten(F.collect_list("s")).alias("spans"))
    changed = cut(near.select("doc_id", "same", "whole", "text").join(spans, ["doc_id", "same"]))

    gone = (F.col("rep") < F.col("doc_id")) & (F.col("n_words") >= width)
    rows = base.drop("seeds").join(firsts, "whole", "left").join(changed, ["doc_id", "whole"], "left")
    return rows.select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
