"""Similarity join on word n-grams with parity sketches.

A document is the set of its n-grams' 64-bit hashes. Each hash flips one bit of a sketch (XOR), so two
sketches differ in at most as many bits as the sets differ in elements. Documents whose sets reach the
similarity t differ in at most `d = (1 - t) / t * smaller set`; sizes are cut into bands, and in a band the
sketch has `d + 1 + 2 s` wide, sparse blocks for its largest d. By the pigeonhole principle such two sketches
agree in `1 + 2 s` blocks; each document leaves out its own `s` emptiest blocks (those say the least), so at least one common block
is left to meet in. Every pair that meets is verified on the sets themselves.

Equal sets are one node from the start, told by a hash of the set; the few sets whose hashes collide are found
and named anew. In a block with many members each first meets the smallest node only, and of all smallest nodes a
member has the one with the most members first: the other pairs count only while their ends lie in different
components. After the verified links have been joined up, members of one star that still lie in different components are compared by sketches of
their whole sets, whose Hamming distance bounds the difference from below, and only close ones go on to be
verified. So no link between components is missed. For verifying, the text behind each node is read once; a
star's centre is sent once per tile of its members.

Defined cases: null and empty texts, and texts of white space only, have an empty set and link with nothing;
with fewer words than n the whole sequence is the one element; rows of one document id are separate texts
that share their component; null document ids take part, as a text of their own, only in the result; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilake.llm.components import components
from vigilake.plans.sieve import hashed, maybe_among
from vigilake.session import discard, materialise

PIECE = 1 << 20  # bytes hashed at once
_rng = np.random.Generator(np.random.PCG64(20_240_229))
BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)  # a random number per byte value
R = np.uint64(0x9E3779B97F4A7C15)  # odd, so invertible modulo 2**64
R_INV = np.uint64(pow(int(R), -1, 2**64))
WIDTHS = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WIDE = 1 << 20  # bits of a block; few are set, so a block is held as the digest of its set bits
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
_powers: dict[str, np.ndarray] = {}


def powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        _powers[name] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, PIECE) + 8, base, np.uint64)]), dtype=np.uint64)
    return _powers[name][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of a byte array."""
    solid = ~IS_SPACE[raw]
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(BYTE[raw] * powers("up", R, len(raw)), dtype=np.uint64)])
    return mix((total[ends] - total[starts]) * powers("down", R_INV, len(raw) + 1)[starts] + (ends - starts).astype(np.uint64)), starts


def hashes_of(text: str) -> np.ndarray:
    """Word hashes of one text of any length, a piece at a time."""
    raw = np.frombuffer(text.encode().lower(), np.uint8)
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        if end < len(raw):
            spaces = np.flatnonzero(IS_SPACE[raw[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:  # one word longer than a piece
                after = np.flatnonzero(IS_SPACE[raw[end:]])
                end = end + int(after[0]) + 1 if len(after) else len(raw)
        out.append(word_hashes(raw[at:end])[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text's words."""
    if not len(words):
        return words
    n = min(width, len(words))
    out = np.full(len(words) - n + 1, np.uint64(n), np.uint64)
    for i in range(n):
        out = mix(out * WIDTHS[i] + words[i : len(words) - n + 1 + i])
    return np.unique(out)


def sets_of(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The n-gram sets of texts; short texts are hashed together."""
    found: list[np.ndarray | None] = [None] * len(texts)
    waiting, size = [], 0

    def flush() -> None:
        joined = b" ".join(t for _, t in waiting)
        h, starts = word_hashes(np.frombuffer(joined, np.uint8))
        ends = np.cumsum([len(t) + 1 for _, t in waiting])
        cuts = np.searchsorted(starts, ends)
        before = 0
        for (i, _), cut in zip(waiting, cuts):
            found[i] = grams(h[before:cut], width)
            before = cut

    for i, t in enumerate(texts):
        if len(t or "") > PIECE // 4:
            found[i] = grams(hashes_of(t), width)
            continue
        raw = (t or "").encode().lower()
        waiting.append((i, raw))
        size += len(raw)
        if size > PIECE // 2:
            flush()
            waiting, size = [], 0
    if waiting:
        flush()
    return found


class Bands:
    """Bands of set sizes for a similarity of num / den: band j holds the sizes from edge j up to edge j+1 * den / num."""

    def __init__(self, num: int, den: int = 100, growth: float = 1.5):
        self.num, self.den = num, den
        self.edges = [1]
        while self.edges[-1] < 2**40:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * growth)))
        self.low = np.array(self.edges)

    def of(self, n: int) -> list[int]:
        own = int(np.searchsorted(self.low, n, "right")) - 1
        return [own, own - 1] if own and n * self.num <= (self.edges[own] - 1) * self.den else [own]

    def errors(self, band: int) -> int:
        """The most elements two linked sets of this band can differ in."""
        return (self.edges[band + 1] - 1) * (self.den - self.num) // self.num


def block_keys(elements: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys under which a set is found: one per kept block of its sketch in each of its bands."""
    out = []
    for band in bands.of(len(elements)) if len(elements) else ():
        d = bands.errors(band)
        if not d:
            continue  # sets this small link only when they are equal
        s = (d + 1) // 8
        blocks = d + 1 + 2 * s
        place = mix(elements + WIDTHS[42]) % np.uint64(blocks * WIDE)
        block = (place // np.uint64(WIDE)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        fill = np.bincount(block, minlength=blocks)
        content = np.zeros(blocks, np.uint64)
        used = np.flatnonzero(fill)
        # an element that meets another one on its bit takes it back: XOR of the set bits' hashes is the block's digest
        content[used] = np.bitwise_xor.reduceat(mix(place[order] + WIDTHS[43]), np.cumsum(fill)[used] - fill[used])
        kept = np.argsort(fill, kind="stable")[s:]
        out.append(mix(mix(content[kept] + np.array([band], np.uint64) * WIDTHS[40]) + kept.astype(np.uint64) * WIDTHS[41]))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def sketch_bits(elements: np.ndarray) -> bytes:
    """The whole set in one sketch of two to four bits an element; halves fold onto each other to compare sizes."""
    size = 1 << min(17, max(7, int(2 * max(1, len(elements)) - 1).bit_length()))
    place = (mix(elements + WIDTHS[44]) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=size) & 1).astype(np.uint8)).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A sketch of `size` bytes as 64-bit words."""
    x = np.frombuffer(bits, np.uint64)
    while len(x) * 8 > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def narrowed(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row (digest of the text), text."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.md5(whole.cast("binary")).alias("row"), whole.alias("text"))


def node_of(same: bytes, renamed: dict[bytes, int], bits: int) -> int:
    """The number of a set, from the digest of its elements."""
    return renamed[same] if same in renamed else int.from_bytes(same[:8], "little") >> (64 - bits)


def sketches(docs: DataFrame, width: int, bands: Bands, doc: str = "doc_id", text: str = "text", bits: int = 63) -> DataFrame:
    """doc_id, row, n (set size), same (digest of the set, null for an empty one), node (its number), bits (the whole sketch)."""

    def run(batches):
        for b in batches:
            found = sets_of(b["text"].to_pylist(), width)
            same = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"], b["row"], pa.array([len(s) for s in found], pa.int64()), pa.array(same, pa.binary()),
                    pa.array([None if x is None else node_of(x, {}, bits) for x in same], pa.int64()), pa.array([sketch_bits(s) for s in found], pa.binary()),
                ],
                names=["doc_id", "row", "n", "same", "node", "bits"],
            )

    return narrowed(docs, doc, text).mapInArrow(run, "doc_id long, row string, n long, same binary, node long, bits binary")


def keyed_entries(texts: DataFrame, width: int, bands: Bands, renamed: dict[bytes, int], bits: int = 63) -> DataFrame:
    """The nodes under each key, of all texts with a set.

    Made from the texts again, as the keys are many times what is kept of them, and put together in the same worker.
    """

    def run(batches):
        def keyed():
            for b in batches:
                found = [s for s in sets_of(b["text"].to_pylist(), width) if len(s)]
                keys = [block_keys(s, bands) for s in found]
                node = np.array([node_of(xxhash.xxh3_128_digest(s.tobytes()), renamed, bits) for s in found], np.int64)
                yield np.concatenate([np.zeros(0, np.int64), *keys]), np.repeat(node, [len(k) for k in keys])

        yield from together(keyed())

    return texts.select("text").mapInArrow(run, ENTRY)


def renamed_nodes(nodes: DataFrame, bits: int) -> dict[bytes, int]:
    """New numbers for sets whose numbers collide; of 2 ** 63 numbers hardly any ever do."""
    renamed: dict[bytes, int] = {}
    twice = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("node")
    for r in nodes.join(twice, "node", "left_semi").select("same").collect():
        renamed[bytes(r["same"])] = 2**62 + (int.from_bytes(hashlib.blake2b(r["same"], digest_size=8).digest(), "little") >> 2)
    if len(set(renamed.values())) < len(renamed):
        raise RuntimeError("two sets have one number")
    return renamed


def verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, width: int, bands: Bands, renamed: dict[bytes, int], bits: int = 63, tile: int = 256) -> DataFrame:
    """Of the pairs of nodes (a, b) those whose sets reach the similarity.

    `nodes` names a text for each; only texts of nodes in a pair are read out. Pairs are dealt by centre and tile
    of at most about `tile` members, so a centre's set is sent once a tile and a member's once a pair.
    """

    def packed(batches):
        for b in batches:
            found = sets_of(b["text"].to_pylist(), width)
            good = [i for i, (s, node) in enumerate(zip(found, b["node"].to_pylist())) if len(s) and node_of(xxhash.xxh3_128_digest(s.tobytes()), renamed, bits) == node]
            yield pa.RecordBatch.from_arrays([b["node"].take(pa.array(good, pa.int64())), pa.array([found[i].tobytes() for i in good], pa.binary())], names=["node", "s"])

    pairs = materialise(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    needed = materialise(nodes.join(ends, "node").select("node", "row"), "needed")
    among = maybe_among(needed, hashed("row"), needed.count())
    near = texts.filter(among(hashed("row"))).join(needed, "row").dropDuplicates(["node"])
    sets = materialise(near.select("node", "text").mapInArrow(packed, "node long, s binary"), "sets")

    num, den = bands.num, bands.den
    tiles = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    dealt = pairs.join(tiles, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("tiles")).alias("tile"))
    members = dealt.join(sets.withColumnRenamed("node", "b"), "b").select("a", "tile", "b", "s")
    centres = dealt.select("a", "tile").distinct().join(sets.withColumnRenamed("node", "a"), "a").select("a", "tile", F.lit(None).cast("long").alias("b"), "s")

    def run(batches):
        centre = np.zeros(0, np.uint64)
        for b in batches:
            out = []
            for x, y, s in zip(b["a"].to_pylist(), b["b"].to_pylist(), b["s"].to_pylist()):
                s = np.frombuffer(s, np.uint64)
                if y is None:  # ahead of its members
                    centre = s
                    continue
                common = len(np.intersect1d(centre, s, assume_unique=True))
                if den * common >= num * (len(centre) + len(s) - common):
                    out.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    by_tile = centres.unionByName(members).repartition("a", "tile").sortWithinPartitions("a", "tile", F.col("b").asc_nulls_first())
    found = materialise(by_tile.mapInArrow(run, "a long, b long").distinct(), "links")
    discard(sets, needed, pairs)
    return found


ENTRY = "key long, doc_id long, others array<long>"


def together(found, chunk: int = 2_000_000):
    """Arrow batches of ENTRY from (keys, documents) arrays, combined for about `chunk` entries at a time.

    The smallest document a chunk has under a key carries the rest in `others` (null: none). So a key that a
    third of all documents have is a few rows wherever keys are brought together.
    """
    shape = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("others", pa.list_(pa.int64()))])

    def combined(key: np.ndarray, doc_id: np.ndarray):
        order = np.lexsort((doc_id, key))
        key, doc_id = key[order], doc_id[order]
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (doc_id[1:] != doc_id[:-1])])
        key, doc_id = key[once], doc_id[once]
        start = np.concatenate([[True], key[1:] != key[:-1]])
        lead = np.flatnonzero(start)
        more = np.diff(np.append(lead, len(key))) - 1
        rest = doc_id[~start]
        ends = np.concatenate([[0], np.cumsum(more)])
        for at in range(0, len(lead), 500_000):
            to = slice(at, min(at + 500_000, len(lead)))
            part = ends[at : to.stop + 1]
            lists = pa.ListArray.from_arrays(pa.array((part - part[0]).astype(np.int32)), pa.array(rest[part[0] : part[-1]]), mask=pa.array(more[to] == 0))
            yield pa.RecordBatch.from_arrays([pa.array(key[lead[to]]), pa.array(doc_id[lead[to]]), lists], schema=shape)

    held, n = [], 0
    for keys, docs in found:
        held.append((keys, docs))
        n += len(keys)
        if n >= chunk:
            yield from combined(*map(np.concatenate, zip(*held)))
            held, n = [], 0
    if n:
        yield from combined(*map(np.concatenate, zip(*held)))


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, doc_id, least) of every document under a key that several have, from rows that `together` has made.

    One row per key and chunk meets, so no group grows with the number of documents under a key.
    """
    by_key = Window.partitionBy("key")
    leads = rows.withColumn("least", F.min("doc_id").over(by_key)).withColumn("_n", F.count(F.lit(1)).over(by_key))
    leads = leads.filter("_n > 1 OR others IS NOT NULL")
    members = F.concat(F.array("doc_id"), F.coalesce("others", F.array().cast("array<long>")))
    return leads.select("key", "least", F.explode(members).alias("doc_id"))


def close(pairs: DataFrame, whole: DataFrame, bands: Bands) -> DataFrame:
    """Of the pairs (a, b) those whose whole sketches differ in no more bits than linked sets may."""
    num, den = bands.num, bands.den

    @F.arrow_udf("boolean")
    def near(x: pa.Array, y: pa.Array, m: pa.Array, n: pa.Array) -> pa.Array:
        out = []
        for p, q, i, j in zip(x.to_pylist(), y.to_pylist(), m.to_pylist(), n.to_pylist()):
            size = min(len(p), len(q))
            out.append(int(np.bitwise_count(folded(p, size) ^ folded(q, size)).sum()) <= (i + j) * (den - num) // (den + num))
        return pa.array(out, pa.bool_())

    x = whole.select(F.col("doc_id").alias("a"), F.col("n").alias("_m"), F.col("bits").alias("_x"))
    y = whole.select(F.col("doc_id").alias("b"), F.col("n").alias("_n"), F.col("bits").alias("_y"))
    return pairs.join(x, "a").join(y, "b").filter(near("_x", "_y", "_m", "_n")).select("a", "b").distinct()


def dealt(stars: DataFrame, grouped: DataFrame, whole: DataFrame, tile: int) -> DataFrame:
    """The members of stars with several components, once for each pair of tiles (lo, hi) they are compared in.

    The tiles of a star's largest component come first and meet only the tiles of the remaining members, so
    of m members with r outside the largest component about m + 2 r m / tile rows are made.
    """
    member = stars.select(F.col("a").alias("star"), F.col("b").alias("doc_id"))
    member = member.join(grouped.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn("c", F.coalesce("component", "doc_id")).drop("component")
    by_component = member.groupBy("star", "c").agg(F.count(F.lit(1)).alias("_n"))
    mixed = by_component.groupBy("star").agg(F.sum("_n").alias("_m"), F.max(F.struct("_n", "c")).alias("_top"), F.count(F.lit(1)).alias("_k")).filter("_k > 1")
    tiles = lambda n: F.ceil(n / tile).cast("int")
    mixed = mixed.select("star", F.col("_top.c").alias("_c"), tiles(F.col("_top._n")).alias("_t"), tiles(F.col("_m") - F.col("_top._n")).alias("_u"))
    row = member.join(mixed, "star").join(whole, "doc_id")
    top, h = F.col("c") == F.col("_c"), F.xxhash64("doc_id")
    row = row.withColumn("i", F.when(top, F.pmod(h, F.col("_t"))).otherwise(F.col("_t") + F.pmod(h, F.col("_u"))).cast("int"))
    row = row.withColumn("j", F.explode(F.sequence(F.when(top, F.col("_t")).otherwise(0), F.col("_t") + F.col("_u") - 1)))
    return row.select("star", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "doc_id", "c", "n", "bits")


def apart(stars: DataFrame, grouped: DataFrame, whole: DataFrame, bands: Bands, tile: int = 4_096) -> DataFrame:
    """Pairs (a, b) of one star that lie in different components and whose whole sketches are close.

    Two documents that meet in a block have the same smallest document there, so they are members of its
    star. Members are compared by their sketches, tile by tile; only close pairs leave a task.
    """
    num, den = bands.num, bands.den
    row = dealt(stars, grouped, whole, tile)

    def run(batches):
        held, now = [], None

        def solve():
            own = sorted(held)
            size = min((len(r[4]) for r in own), default=0)
            if len(own) < 2:
                return
            sketch = np.stack([folded(r[4], size) for r in own])
            tile_of, ids, comp, n = (np.array([r[k] for r in own], np.int64) for k in range(4))
            if now[1] != now[2]:
                split = int(np.searchsorted(tile_of, now[1], side="right"))  # members of two tiles: each meets the other tile
                one, other = sorted((slice(0, split), slice(split, len(own))), key=lambda x: x.stop - x.start)
                each = [(k, other) for k in range(one.start, one.stop)]
            else:
                each = [(k, slice(k + 1, len(own))) for k in range(len(own) - 1)]
            for k, to in each:
                differ = np.bitwise_count(sketch[to] ^ sketch[k]).sum(axis=1)
                ok = (differ <= (n[to] + n[k]) * (den - num) // (den + num)) & (comp[to] != comp[k])
                for other_id in ids[to][ok].tolist():
                    found.append((min(int(ids[k]), other_id), max(int(ids[k]), other_id)))

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])
            found.clear()
            return out

        found: list[tuple[int, int]] = []
        for b in batches:
            columns = [b[c].to_pylist() for c in ("star", "lo", "hi", "i", "doc_id", "c", "n", "bits")]
            for star, lo, hi, *rest in zip(*columns):
                if (star, lo, hi) != now:
                    solve()
                    held, now = [], (star, lo, hi)
                    if len(found) > 100_000:
                        yield batch()
                held.append(tuple(rest))
        solve()
        yield batch()

    keys = ["star", "lo", "hi"]
    return row.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def linked(docs: DataFrame, width: int, bands: Bands, doc: str = "doc_id", text: str = "text", nulls: bool = False, bits: int = 63) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, links, components): doc_id, row, n, node of every row; a, b of links that join nodes up; node, component.

    With `nulls` texts without an id take part like any other.
    """
    sketched = materialise(sketches(docs, width, bands, doc, text, bits), "sketches")
    part = sketched.filter("same IS NOT NULL" if nulls else "same IS NOT NULL AND doc_id IS NOT NULL")
    nodes = materialise(part.groupBy("node", "same").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("bits").alias("bits")), "nodes")
    renamed = renamed_nodes(nodes, bits)
    rows = sketched.select("doc_id", "row", "n", "same", "node")
    if renamed:
        other = F.coalesce(*[F.when(F.col("same") == F.lit(bytearray(k)), F.lit(v)) for k, v in renamed.items()], F.col("node"))
        rows, nodes = rows.withColumn("node", other), nodes.withColumn("node", other)

    texts = narrowed(docs, doc, text)
    met = shared_keys(keyed_entries(texts if nulls else texts.filter("doc_id IS NOT NULL"), width, bands, renamed, bits)).filter("doc_id > least")
    stars = materialise(met.select(F.col("least").alias("a"), F.col("doc_id").alias("b")).distinct(), "stars")
    whole = nodes.select(F.col("node").alias("doc_id"), "n", "bits")
    # first each member with its largest star only; then what that has not joined up already
    sizes = stars.groupBy("a").agg(F.count(F.lit(1)).alias("size"))
    best = stars.join(sizes, "a").groupBy("b").agg(F.max_by("a", F.struct("size", "a")).alias("a")).select("a", "b")
    best = materialise(best, "best")
    links = verified(close(best, whole, bands), texts, nodes, width, bands, renamed, bits)
    grouped = components(links)
    of = lambda end: grouped.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    left = stars.join(best, ["a", "b"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left")
    left = materialise(left.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "apart")
    if not left.isEmpty():
        links = links.unionByName(verified(close(left, whole, bands), texts, nodes, width, bands, renamed, bits))
        grouped = components(links)
    rest = materialise(apart(stars, grouped, whole, bands).join(stars, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = links.unionByName(verified(rest, texts, nodes, width, bands, renamed, bits))
        grouped = components(links)
    discard(stars)
    return rows, links, grouped


def join(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, doc: str = "doc_id", text: str = "text", bits: int = 63) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs`."""
    rows, links, grouped = linked(docs, width, Bands(num, den), doc, text, bits=bits)
    named = rows.filter("node IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "node").distinct()
    ids = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b")
    shared = materialise(named.join(ids.select("doc_id", "a"), "doc_id").filter("node > a").select("a", F.col("node").alias("b")), "shared")
    if not shared.isEmpty():
        grouped = components(links.unionByName(shared))
    of_node = named.join(grouped, "node", "left").select("doc_id", "node", F.coalesce("component", "node").alias("c"))
    least = of_node.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    of_node = of_node.select("node", "c").distinct().join(least, "c").select("node", "component_id")
    found = rows.join(of_node, "node", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
