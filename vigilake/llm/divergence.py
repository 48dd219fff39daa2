"""Divergence of sources from each other and from their language, recounted over minimal perfect hashes.

The first pass counts exactly in how many documents of a language each term stands, and keeps the terms that
reach a minimum. Kept terms are dealt into shards by a hash; each shard gets a minimal perfect hash (buckets
of about three terms, largest first, each displaced until its terms fall on free slots; lone terms are told
their slot outright) with its terms stored in the order of their slots, so that a term that was not kept is
known by comparing. The second pass counts again: each occurrence becomes a slot, and the dense slots of its
(language, source) group are incremented. What follows works on a shard's slots of all sources as a matrix.

How the second pass meets the hashes depends on their size, which is added up first: up to `most` bytes they
are broadcast and the texts' tasks look terms up themselves; beyond it those tasks send their counts to the
shards, each of which is looked up in the task it is in. Both give the same cells.

Memory: a task holds at most TERMS distinct terms and CELLS slots at a time and hands on what it has then.
A shard has about 4,096 terms, fewer where a language has very many sources. Partial cells of one group and
shard are added in `fan` tasks first, then in one.

All arithmetic is in whole numbers. Defined cases: null text, language and source are ''; texts without terms
still make their group; a language without kept terms has its pairs with value 0; equal rows count each; an
empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilake.llm.parity import mix
from vigilake.session import materialise

SCALE = 10**9
PIECE = 1 << 20
TERMS, CELLS = 200_000, 1 << 22
PER_SHARD = 4096
STEP = np.uint64(0x9E3779B97F4A7C15)
TRIES = 1 << 18
#: ASCII letters in lower case and all bytes of other characters; everything else parts terms
LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    flat = raw.translate(LETTERS)
    at = 0
    while len(flat) - at > PIECE:
        end = flat.rfind(b" ", at, at + PIECE)
        if end < 0:
            end = flat.find(b" ", at + PIECE)
        if end < 0:
            break
        yield flat[at:end].split()
        at = end
    yield flat[at:].split()


def strings(values) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def raw_texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def narrowed(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term) of the terms in at least `least` documents of their language."""

    def run(batches):
        seen: dict[str, Counter] = {}

        def counted():
            for lang, found in seen.items():
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), strings(list(found)), pa.array(list(found.values()), pa.int64())], names=["lang", "term", "n"]
                    )
            seen.clear()

        for b in batches:
            for lang, raw in zip(b["lang"].to_pylist(), raw_texts(b["text"])):
                own: set[bytes] = set()
                for part in terms_of(raw):
                    own.update(part)
                seen.setdefault(lang, Counter()).update(own)
            if sum(map(len, seen.values())) > TERMS:
                yield from counted()
        yield from counted()

    found = docs.select("lang", "text").mapInArrow(run, "lang string, term string, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("lang", "term")


def halves(terms: list[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each term; the first one has 63 bits, so that the JVM reads it alike."""
    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(t, seed) for t in terms]), "<u8").reshape(-1, 2)
    return both[:, 0] >> np.uint64(1), both[:, 1]


def place(hi: np.ndarray, shift: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (mix(hi + shift * STEP) % size).astype(np.int64)


def displaced(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(shift per bucket, slot per key), or None where no shift parts the keys of a bucket. A lone key has -1 - its slot."""
    n = len(lo)
    buckets = n // 3 + 1
    of = (mix(lo) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=buckets)
    starts = np.cumsum(sizes) - sizes
    shifts, slots, free = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[b])
        if size < 2:
            break
        keys = order[starts[b] : starts[b] + size]
        for first in range(0, TRIES, 64):
            tried = place(hi[keys][None, :], np.arange(first, first + 64, dtype=np.uint64)[:, None], np.uint64(n))
            good = free[tried].all(1)
            if good.any():
                apart = np.sort(tried, 1)
                good &= (apart[:, 1:] != apart[:, :-1]).all(1)
            if good.any():
                pick = int(np.argmax(good))
                shifts[b], slots[keys] = first + pick, tried[pick]
                free[tried[pick]] = False
                break
        else:
            return None
    lone = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(free)
    slots[order[starts[lone]]] = left
    shifts[lone] = -1 - left
    return shifts, slots


def perfect(terms: list[bytes]) -> tuple[int, np.ndarray, list[bytes]]:
    """(seed, shifts, terms by slot) of a minimal perfect hash of distinct terms."""
    for seed in count():
        made = displaced(*halves(terms, seed))
        if made is not None:
            by_slot = [b""] * len(terms)
            for t, s in zip(terms, made[1].tolist()):
                by_slot[s] = t
            return seed, made[0], by_slot


HASHES = "lang string, shard long, seed int, shifts array<int>, terms array<string>, n_bytes long"


def hashes_of(kept: DataFrame, plan: DataFrame) -> DataFrame:
    """A row for each shard of the kept terms; `plan` has the number of shards of each language."""

    def dealt(batches):
        for b in batches:
            lo, _ = halves(raw_texts(b["term"])) if b.num_rows else (np.zeros(0, np.uint64), None)
            shard = (lo % np.asarray(b["shards"]).astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b["lang"], pa.array(shard, pa.int64()), b["term"]], names=["lang", "shard", "term"])

    def run(batches):
        now, held = None, []

        def solved():
            seed, shifts, terms = perfect(held)
            row = {"lang": now[0], "shard": now[1], "seed": seed, "shifts": shifts, "terms": [t.decode() for t in terms], "n_bytes": sum(map(len, terms)) + 8 * len(terms) + 4 * len(shifts)}
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([row[c]], k) for c, k in zip(row, kinds)], names=list(row))

        for b in batches:
            for lang, shard, term in zip(b["lang"].to_pylist(), b["shard"].to_pylist(), raw_texts(b["term"])):
                if (lang, shard) != now:
                    if held:
                        yield solved()
                    now, held = (lang, shard), []
                held.append(term)
        if held:
            yield solved()

    placed = kept.join(plan.select("lang", "shards"), "lang").select("lang", "term", "shards").mapInArrow(dealt, "lang string, shard long, term string")
    return placed.repartition("lang", "shard").sortWithinPartitions("lang", "shard", "term").mapInArrow(run, HASHES)


class Lookup:
    """The hashes of some shards of one language, laid behind each other; shards without a row hold no term."""

    def __init__(self, shards: int, rows: list[dict]):
        self.shards = np.uint64(max(1, shards))
        self.size, self.first = np.zeros(shards, np.int64), np.zeros(shards, np.int64)
        self.buckets, self.offset = np.ones(shards, np.int64), np.zeros(shards, np.int64)
        self.seeds: dict[int, int] = {}
        shifts, terms, n, m = [], [], 0, 0
        for r in rows:
            s = r["shard"]
            self.size[s], self.first[s], self.buckets[s], self.offset[s] = len(r["terms"]), n, len(r["shifts"]), m
            n, m = n + len(r["terms"]), m + len(r["shifts"])
            shifts.append(np.asarray(r["shifts"], np.int64))
            terms.append(strings([t.encode() for t in r["terms"]]))
            if r["seed"]:
                self.seeds[s] = r["seed"]
        self.shifts = np.concatenate([*shifts, np.zeros(1, np.int64)])
        self.terms = pa.concat_arrays([*terms, strings([b""])])

    def find(self, terms: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of the terms are kept, shard, slot) of those that are."""
        lo, hi = halves(terms)
        shard = (lo % self.shards).astype(np.int64)
        for i in np.flatnonzero(np.isin(shard, list(self.seeds))).tolist() if self.seeds else ():
            lo, hi = lo.copy(), hi.copy()
            (lo[i],), (hi[i],) = halves([terms[i]], self.seeds[int(shard[i])])
        size = self.size[shard]
        bucket = self.offset[shard] + (mix(lo) % self.buckets[shard].astype(np.uint64)).astype(np.int64)
        shift = np.where(size > 0, self.shifts[np.minimum(bucket, len(self.shifts) - 1)], 0)
        slot = np.where(shift < 0, -1 - shift, place(hi, np.maximum(shift, 0).astype(np.uint64), np.maximum(size, 1).astype(np.uint64)))
        held = self.terms.take(pa.array(np.where(size > 0, self.first[shard] + slot, len(self.terms) - 1)))
        good = np.flatnonzero(np.asarray(pc.equal(held, strings(terms))) & (size > 0))
        return good, shard[good], slot[good]


CELL = "lang string, shard long, source string, salt int, slots array<int>, counts array<long>"
_kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64())]


def cell_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["lang", "shard", "source", "salt", "slots", "counts"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _kinds)], names=names)


class Slots:
    """Dense slots per (lang, source, shard), emptied into rows of CELL."""

    def __init__(self, salt: int):
        self.salt, self.dense, self.cells = salt, {}, 0

    def add(self, lang: str, source: str, shard: np.ndarray, slot: np.ndarray, times: np.ndarray, size: np.ndarray) -> None:
        order = np.argsort(shard, kind="stable")
        shard, slot, times = shard[order], slot[order], times[order]
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(shard)]):
            s = int(shard[a])
            own = self.dense.get((lang, s, source))
            if own is None:
                own = self.dense[lang, s, source] = np.zeros(int(size[s]), np.int64)
                self.cells += len(own)
            own[slot[a:b]] += times[a:b]  # terms are distinct, and so are their slots

    def emptied(self) -> Iterator[pa.RecordBatch]:
        rows, n = [], 0
        for (lang, shard, source), own in self.dense.items():
            used = np.flatnonzero(own)
            rows.append((lang, shard, source, self.salt, used, own[used]))
            n += len(used)
            if n > 1_000_000:
                yield cell_batch(rows)
                rows, n = [], 0
        if rows:
            yield cell_batch(rows)
        self.dense, self.cells = {}, 0


def salt_of(fan: int) -> int:
    return TaskContext.get().partitionId() % fan


def counters(batches) -> Iterator[dict[tuple[str, str], Counter]]:
    """The occurrences per group of a task's texts, handed on when there are many distinct terms."""
    held: dict[tuple[str, str], Counter] = {}
    for b in batches:
        size = 0
        for lang, source, raw in zip(b["lang"].to_pylist(), b["source"].to_pylist(), raw_texts(b["text"])):
            own = held.setdefault((lang, source), Counter())
            for part in terms_of(raw):
                own.update(part)
        size = sum(map(len, held.values()))
        if size > TERMS:
            yield held
            held = {}
    if held:
        yield held


def cells_by_broadcast(docs: DataFrame, hashes: DataFrame, plan: DataFrame, fan: int) -> DataFrame:
    """Partial cells: the hashes come to the texts."""
    session = docs.sparkSession
    rows = hashes.select("lang", "shard", "seed", "shifts", "terms").toArrow()
    shards = {r["lang"]: r["shards"] for r in plan.select("lang", "shards").toArrow().to_pylist()}
    held = session.sparkContext.broadcast((rows, shards))

    def run(batches):
        rows, shards = held.value
        by_lang: dict[str, list] = {}
        for r in rows.to_pylist():
            by_lang.setdefault(r["lang"], []).append(r)
        lookups = {lang: Lookup(shards[lang], own) for lang, own in by_lang.items()}
        del rows, by_lang
        out = Slots(salt_of(fan))
        for groups in counters(batches):
            for (lang, source), own in groups.items():
                if lang not in lookups or not own:
                    continue
                good, shard, slot = lookups[lang].find(list(own))
                out.add(lang, source, shard, slot, np.fromiter(own.values(), np.int64, len(own))[good], lookups[lang].size)
                if out.cells > CELLS:
                    yield from out.emptied()
        yield from out.emptied()

    return docs.mapInArrow(run, CELL)


def cells_by_shuffle(docs: DataFrame, hashes: DataFrame, plan: DataFrame, fan: int) -> DataFrame:
    """Partial cells: the counts come to the hashes."""

    def emit(batches):
        salt = salt_of(fan)
        for groups in counters(batches):
            for (lang, source), own in groups.items():
                if own:
                    n = len(own)
                    columns = [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array([salt] * n, pa.int32())]
                    terms = list(own)
                    columns += [strings(terms), pa.array(halves(terms)[0].astype(np.int64)), pa.array(list(own.values()), pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "salt", "term", "lo", "n"])

    def run(batches):
        now, lookup, out, held, source = None, None, Slots(0), {}, None

        def added():
            if held:
                good, _, slot = lookup.find(list(held))
                times = np.fromiter(held.values(), np.int64, len(held))[good]
                out.add(now[0], source, np.full(len(good), now[1]), slot, times, {now[1]: len(lookup.terms) - 1})
                held.clear()

        for b in batches:
            hashes = b.select(["seed", "shifts", "terms"])
            for i, (lang, shard, salt, of, term, n) in enumerate(zip(*(b[c].to_pylist() for c in ("lang", "shard", "salt", "source", "term", "n")))):
                if term is None:  # the hash of the shard, ahead of its counts
                    added()
                    yield from out.emptied()
                    now, source, out = (lang, shard, salt), None, Slots(salt)
                    lookup = Lookup(1, [{**{c: hashes[c][i].as_py() for c in ("seed", "shifts", "terms")}, "shard": 0}])
                elif now == (lang, shard, salt):  # else no term of the shard is kept
                    if of != source or len(held) >= TERMS:
                        added()
                        source = of
                        if out.cells > CELLS:
                            yield from out.emptied()
                    raw = term.encode()
                    held[raw] = held.get(raw, 0) + n
        added()
        yield from out.emptied()

    counts = docs.mapInArrow(emit, "lang string, source string, salt int, term string, lo long, n long")
    counts = counts.join(plan.select("lang", "shards"), "lang").withColumn("shard", F.col("lo") % F.col("shards")).drop("lo", "shards")
    salts = F.explode(F.sequence(F.lit(0), F.lit(fan - 1))).alias("salt")
    both = counts.unionByName(hashes.select("lang", "shard", "seed", "shifts", "terms", salts), allowMissingColumns=True)
    keys = ["lang", "shard", "salt"]
    return both.repartition(*keys).sortWithinPartitions(*keys, F.col("terms").isNull(), "source").mapInArrow(run, CELL)


def merged(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of equal keys added up, in sorted partitions."""

    def run(batches):
        now, total, rows, n = None, np.zeros(0, np.int64), [], 0

        def close():
            used = np.flatnonzero(total)
            rows.append((*now, used, total[used]))
            return len(used)

        for b in batches:
            for lang, shard, source, salt, slots, counts in zip(*(b[c].to_pylist() for c in ("lang", "shard", "source", "salt")), b["slots"], b["counts"]):
                key = (lang, shard, source, salt if "salt" in keys else 0)
                if key != now:
                    if now is not None:
                        n += close()
                    if n > 500_000:
                        yield cell_batch(rows)
                        rows, n = [], 0
                    now, total = key, np.zeros(0, np.int64)
                slots = np.asarray(slots.values)
                if len(slots) and slots[-1] >= len(total):  # slots ascend
                    total = np.concatenate([total, np.zeros(int(slots[-1]) + 1 - len(total), np.int64)])
                total[slots] += np.asarray(counts.values)
        if now is not None:
            close()
            yield cell_batch(rows)

    # a shard's sources stay together in the end, as they are compared there
    by = keys if "salt" in keys else ["lang", "shard"]
    return cells.repartition(*by).sortWithinPartitions(*keys).mapInArrow(run, CELL)


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + terms)), three digits at a time, so that nothing overflows."""
    whole = total + terms
    left = counts + 1
    out, left = left // whole, left % whole
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + left // whole, left % whole
    return out + 1


def surprise(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


RESULT = "lang string, source string, part string, item string, value long"


def scored(shards: DataFrame, top: int) -> DataFrame:
    """Each shard's part of the pair sums, and for each group its best `top` terms of the shard."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b[c][i].as_py() for c in ("lang", "v", "facts", "terms")}
                sources, v, terms = [f["source"] for f in r["facts"]], r["v"], r["terms"]
                found = b["cells"][i].values
                cells = {s: (np.asarray(x.values), np.asarray(c.values)) for s, x, c in zip(found.field("source").to_pylist(), found.field("slots"), found.field("counts"))}
                n = len(terms)
                raw = [t.encode() for t in terms]
                place_of = np.empty(n, np.int64)
                place_of[sorted(range(n), key=raw.__getitem__)] = np.arange(n)
                totals = [f["total"] for f in r["facts"]]
                wide = max(1, (1 << 21) // max(1, len(sources)))  # slots of all sources at once
                sums = np.zeros((len(sources), len(sources)), np.int64)
                best: dict[int, list] = {}
                for a in range(0, n, wide):
                    z = min(n, a + wide)
                    counts = np.zeros((len(sources), z - a), np.int64)
                    for g, s in enumerate(sources):
                        slots, times = cells.get(s, (np.zeros(0, np.int32), np.zeros(0, np.int64)))
                        here = (slots >= a) & (slots < z)
                        counts[g, slots[here] - a] = times[here]
                    p = np.stack([shares(counts[g], totals[g], v) for g in range(len(sources))])
                    q = shares(counts.sum(0), sum(totals), v)
                    for g in range(len(sources)):
                        sums[g] += surprise(p[g][None, :], p).sum(1)
                        over = np.flatnonzero((counts[g] > 0) & (p[g] > q))
                        value = surprise(p[g][over], q[over])
                        first = np.lexsort((place_of[over + a], -value))[:top]
                        best.setdefault(g, []).extend(zip(value[first].tolist(), (over[first] + a).tolist()))
                rows = [(r["lang"], s, "pair", t, int(sums[g, h])) for g, s in enumerate(sources) for h, t in enumerate(sources) if g != h]
                for g, found in best.items():
                    found.sort(key=lambda x: (-x[0], place_of[x[1]]))
                    rows += [(r["lang"], sources[g], "term", terms[k], value) for value, k in found[:top]]
                if rows:
                    kinds = [pa.string()] * 4 + [pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["lang", "source", "part", "item", "value"])

    return shards.mapInArrow(run, RESULT)


def recounted(docs: DataFrame, least: int = 3, most: int = 64 << 20, fan: int = 16) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan, hashes, cells) of (lang, source, text) rows: sizes per language, a perfect hash per shard, counts per group and shard."""
    kept = materialise(kept_terms(docs, least), "kept")
    groups = materialise(docs.select("lang", "source").distinct(), "groups")
    plan = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups")).join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left")
    per = F.greatest(F.lit(16), F.least(F.lit(PER_SHARD), F.expr(f"{CELLS} div groups")))
    plan = materialise(plan.select("lang", "groups", F.coalesce("v", F.lit(0)).alias("v"), F.ceil(F.coalesce("v", F.lit(0)) / per).cast("long").alias("shards")), "plan")
    hashes = materialise(hashes_of(kept, plan), "hashes")
    small = (hashes.agg(F.sum("n_bytes")).first()[0] or 0) <= most
    partial = (cells_by_broadcast if small else cells_by_shuffle)(docs, hashes, plan.filter("shards > 0"), fan)
    cells = materialise(merged(merged(partial, ["lang", "shard", "source", "salt"]), ["lang", "shard", "source"]), "cells")
    return groups.join(plan, "lang"), hashes, cells


def audit(
    docs: DataFrame, least: int = 3, top: int = 200, lang: str = "lang", source: str = "source", text: str = "text", most: int = 64 << 20
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language, and its telling terms."""
    groups, hashes, cells = recounted(narrowed(docs, lang, source, text), least, most)
    totals = cells.groupBy("lang", "source").agg(F.sum(F.expr("aggregate(counts, 0L, (a, x) -> a + x)")).alias("total"))
    known = groups.join(totals, ["lang", "source"], "left").select("lang", "v", "source", F.coalesce("total", F.lit(0)).alias("total"))
    facts = materialise(known.groupBy("lang", "v").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("facts")), "facts")
    by_shard = cells.groupBy("lang", "shard").agg(F.collect_list(F.struct("source", "slots", "counts")).alias("cells"))
    shards = hashes.select("lang", "shard", "terms").join(by_shard, ["lang", "shard"]).join(facts, "lang").select("lang", "v", "facts", "terms", "cells")
    parts = materialise(scored(shards, top), "scores")

    here, there = F.explode("facts.source").alias("source"), F.explode("facts.source").alias("item")
    empty = facts.filter("v = 0").select("lang", "facts", here).select("lang", "source", there).filter("source <> item")
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(empty.withColumn("value", F.lit(0).cast("long")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = parts.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)


def sql(least: int = 3, top: int = 200) -> str:
    """The same in DuckDB's SQL, over `documents`."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    p = f"1 + ({SCALE}::HUGEINT * (c + 1)) // (n + v)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {lower} AS text FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= {least}),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, source, w.term, count(*) AS c FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, v.v FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
y AS (SELECT lang, source, term, c, v, sum(c) OVER (PARTITION BY lang, source) AS n FROM x),
p AS (SELECT lang, source, term, c, {p} AS p FROM y),
z AS (SELECT lang, term, sum(c) AS c, any_value(v) AS v FROM x GROUP BY lang, term),
q AS (SELECT lang, term, {p} AS q FROM (SELECT lang, term, c, v, sum(c) OVER (PARTITION BY lang) AS n FROM z)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.c > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
WHERE part = 'pair' OR rank <= {top}"""
