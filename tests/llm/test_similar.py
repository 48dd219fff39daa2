"""Parity-sketch join, components, neighbour search and repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from vigilake.llm import collide, components, parity, queries, suffixes
from vigilake.session import materialise

from .conftest import SF, TEXTS


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(width, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def classes(rows, width, num):
    """doc_id -> (set size, smallest linked id) by comparing all pairs."""
    ids, sets = [d for d, _ in rows], [shingles(t, width) for _, t in rows]
    at = list(range(len(rows)))

    def top(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if ids[i] is not None and ids[j] is not None and (common and 100 * common >= num * (len(sets[i]) + len(sets[j]) - common) or ids[i] == ids[j]):
                a, b = sorted((top(i), top(j)), key=lambda k: ids[k])
                at[b] = a
    return sorted(((ids[i], len(sets[i]), ids[top(i)]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("width,num", [(3, 90), (5, 80)])
def test_classes_of_documents(spark, documents, width, num):
    got = parity.join(spark.read.parquet(f"{SF}/documents.parquet"), width, num).collect()
    assert sorted(map(tuple, got), key=repr) == classes(list(zip(documents.doc_id, documents.text)), width, num)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_near_copies(spark):
    rng = random.Random(3)
    rows = [(i, edited(rng, [f"g{i % 4}w{k}" for k in range(150)], rng.randrange(6))) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, parity.join(docs).collect()), key=repr) == classes(rows, 3, 90)


def test_odd_texts_link(odd_docs, no_docs):
    rows = [(d, t) for d, t in TEXTS]
    got = sorted(map(tuple, parity.join(odd_docs).collect()), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in classes(rows, 3, 90)]
    of = {g[0]: g[2] for g in got}
    assert of[2] == 1 and of[8] == 7 and of[3] == 3 and of[9] == 9 and of[None] is None
    assert parity.join(no_docs).count() == 0


def test_blocks_meet():
    rng = np.random.default_rng(1)
    bands = parity.Bands(80)
    for n in (5, 9, 30, 100, 700):
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            drop = rng.integers(0, n // 9 + 1)
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, drop, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common) and drop:
                assert len(np.intersect1d(parity.block_keys(a, bands), parity.block_keys(b, bands)))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 160))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_neighbours_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = queries.op3_collision_counting(spark, SF).toPandas()
    rows = df.toPandas()
    x, ids = np.stack(rows.embedding.to_numpy()).astype(float), rows.vec_id.to_numpy()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    for q in ids[ids % 50 == 0]:
        c = unit @ unit[ids == q][0]
        best = [int(i) for i in ids[np.lexsort((ids, -c))] if i != q][:5]
        mine = got[got.query_id == q].sort_values("rank")
        assert np.allclose(mine.score, [c[ids == v][0] for v in mine.vec_id], atol=1e-12) and len(mine) == 5
        hit, total = hit + len({*best} & {*mine.vec_id}), total + 5
    assert hit >= 0.9 * total


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (50, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [1.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, rank int, v int")
    got = [(r.query_id, r["rank"], r.vec_id) for r in collide.nearest(df, collide.F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert collide.nearest(df.limit(0), collide.F.col("vec_id") % 50 == 0).count() == 0


def test_suffix_arrays():
    rng = random.Random(5)
    for _ in range(600):
        text = bytes(rng.randrange(97, 97 + rng.choice([1, 2, 3, 20])) for _ in range(rng.randrange(60)))
        assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def removed(rows, width=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept digest) from a table of all windows."""
    first, out = {}, []
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - width + 1 if d is not None else 0):
            w = raw[i : i + width]
            first[w] = min(d, first.get(w, d))
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - width + 1 if d is not None else 0):
            if first[raw[i : i + width]] < d:
                gone[i : i + width] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + bool(gone[0])) if len(raw) else 0, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeats_of_documents(spark, documents):
    got = queries.op4_lyndon_groups(spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == removed(list(zip(documents.doc_id, documents.text)))


def test_odd_repeats(odd_docs, no_docs):
    assert sorted(map(tuple, suffixes.repeats(odd_docs).collect()), key=repr) == removed(TEXTS)
    assert suffixes.repeats(no_docs).count() == 0


def test_large_buckets_are_dealt_anew(spark, odd_docs, monkeypatch):
    phrase = "the same sixteen bytes and more of them in every single one of these texts"
    rows = [(i, f"{i * 7919 % 1009} unlike {i % 13} {phrase} and {i % 11} other words of number {i * 31 % 97} to end it") for i in range(300)]
    rows += [(300 + i, "x" * (60 + 40 * i)) for i in range(8)] + [(310 + i, "ab" * (50 + 30 * i) + f" {i}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    levels = []
    deal = suffixes.pieces_of
    monkeypatch.setattr(suffixes, "pieces_of", lambda large, width, last: levels.append(last) or deal(large, width, last))
    assert sorted(map(tuple, suffixes.repeats(docs, most=600).collect()), key=repr) == removed(rows)
    assert levels == [False, True]  # by the next-smallest hash, then by whole windows
    assert sorted(map(tuple, suffixes.repeats(odd_docs, most=200).collect()), key=repr) == removed(TEXTS)
    # no task orders more than `most` bytes
    parts = [f"{i:04d} {phrase} {i:04d}".encode() for i in range(100)]
    shape = "bucket long, segment binary, bytes binary, windows int, anchor int, doc_id long"
    table = spark.createDataFrame([(1, b"%d" % i, p, len(p) - 49, -1, i) for i, p in enumerate(parts)], shape)
    assert suffixes.owned(table, 50, 5000).filter("owners IS NULL").count() == len(parts) and suffixes.owned(table, 50, 50_000).filter("owners IS NULL").count() == 0


def test_a_stray_member_moves_few_rows(spark):
    bands = parity.Bands(90, 100)
    texts = [(i, " ".join(f"w{j}" for j in range(100)) + f" tail{i}") for i in range(200)] + [(900, "other words of another text altogether"), (901, "w0 w1 w2 w3 w4 w5")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    whole = materialise(parity.sketches(docs, 3, bands, "doc_id", "text").filter("n > 0").select("doc_id", "n", "bits"), "whole")
    stars = spark.createDataFrame([(0, i) for i, _ in texts if i], "a long, b long")
    one = spark.createDataFrame([(i, 0) for i in range(200)], "node long, component long")
    moved = parity.dealt(stars, one, whole, 8)
    assert moved.count() == 199 + 2 * 25 + 2 and moved.filter("lo <> hi AND doc_id < 900").count() == 199  # 25 tiles, and one of the two others
    assert parity.apart(stars, one, whole, bands, 8).count() == 0
    # two halves and a stray one: all pairs across, each once
    two = spark.createDataFrame([(i, i % 2) for i in range(200)], "node long, component long")
    got = {tuple(r) for r in parity.apart(stars, two, whole, bands, 8).collect()}
    assert got == {(i, j) for i in range(1, 200) for j in range(i + 1, 200) if (i + j) % 2}


def test_segments_set_apart_share_no_window(spark):
    rng = random.Random(9)
    gram = b"sixteen bytes ab"
    parts = []
    for _ in range(300):
        left, right = (bytes(rng.choice(b"ab") for _ in range(rng.randrange(34))) for _ in range(2))
        raw = left[-34:] + gram + right[:34]
        if len(raw) >= 50:
            parts.append((raw, len(raw) - 49, 0, len(left[-34:])))
    windows = [{p[0][i : i + 50] for i in range(p[1])} for p in parts]
    alone = suffixes.apart(parts, 50)
    assert any(alone) and all(not any(windows[i] & w for j, w in enumerate(windows) if j != i and parts[j][0] != parts[i][0]) for i, x in enumerate(alone) if x)
    assert not any(suffixes.apart([*parts, (b"x" * 60, 11, 0, -1)], 50))


def test_places_of_anchors():
    rng = np.random.default_rng(2)
    for raw in (b"ab" * 200, rng.integers(97, 122, 700, dtype=np.uint8).tobytes(), b"x" * 49, b""):
        x = np.frombuffer(raw, np.uint8)
        bucket, first, n, at = suffixes.anchored_runs(x, 50)
        again = suffixes.runs(x, 50)
        assert all((p == q).all() for p, q in zip((bucket, first, n), again))
        h = suffixes.gram_hashes(x) if len(x) >= 16 else []
        for b, f, k, a in zip(bucket, first, n, at):
            places = {int(np.argmin(h[w : w + 35])) + w for w in range(f, f + k)}
            assert a == (places.pop() - f if len(places) == 1 else -1) and (a < 0 or h[f + a] == b)


def test_repeated_ids_and_colliding_nodes(spark):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    rows = [(i % 5, edited(rng, base, 1) if i % 2 else " ".join(f"v{rng.randrange(99)}" for _ in range(40))) for i in range(60)]
    rows += [(None, " ".join(base)), (None, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = classes(rows, 3, 90)
    for bits in (63, 4):
        got = sorted(map(tuple, parity.join(docs, bits=bits).collect()), key=repr)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g for g in got if g[0] is not None] == [w for w in want if w[0] is not None]


def test_windows_are_counted_where_queries_end():
    """Few radii are counted for a query, and none of its candidates comes from a wider window than its own."""
    rng = np.random.default_rng(5)
    vectors, ids = rng.standard_normal((3000, 32)), np.arange(3000)
    shard, counted = collide.Shard(ids, vectors, 5, 160, 11), []
    plain = shard.collisions
    shard.collisions = lambda left, right: counted.append(1) or plain(left, right)
    asked = np.arange(0, 3000, 50)
    got = list(shard.search(vectors[asked], asked))
    assert len(counted) <= 5 * len(asked)
    alone = [x for q in asked for x in shard.search(vectors[[q]], asked[asked == q])]
    assert got == alone
    # the counts are those of the projections themselves
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    apart = np.abs(shard.unit @ shard.lines - unit[0] @ shard.lines)
    left, right = shard.windows(unit[:1] @ shard.lines, 0.9)
    assert np.array_equal(plain(left[:, 0], right[:, 0]), (apart <= 0.9).sum(axis=1))


def test_repeats_leaves_no_shuffle_files_of_its_steps(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv

    def files():
        every = env.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in every.mkString("|").split("|") if "shuffle_" in f}

    passage = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"{i * 7919} {passage} {i * 104729}") for i in range(40)], "doc_id long, text string")
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(name)
    found = suffixes.repeats(docs)
    assert not files() - before
    assert spark.conf.get(name) == setting
    assert found.filter("n_removed >= 50").count() == 39


def test_suffix_arrays_of_many_strings(monkeypatch):
    """Many strings go in the same steps; only the last few with groups left are ordered for themselves."""
    rng, alone = random.Random(6), []
    plain = suffixes.group
    monkeypatch.setattr(suffixes, "group", lambda *state: alone.append(1) or plain(*state))
    for few, long in ((12, 32), (0, 0), (3, 5)):
        for _ in range(40):
            texts = [bytes(rng.randrange(97, 97 + rng.choice([1, 2, 3, 20])) for _ in range(rng.randrange(60))) * rng.choice([1, 3]) for _ in range(rng.randrange(1, 40))]
            ends = np.cumsum([len(t) for t in texts])
            alone.clear()
            got = suffixes.suffix_arrays(np.frombuffer(b"".join(texts), np.uint8), ends, few, long).tolist()
            assert len(alone) <= few
            assert got == [e - len(t) + i for t, e in zip(texts, ends.tolist()) for i in sorted(range(len(t)), key=lambda i: t[i:])]


def test_owners_of_a_block_of_buckets():
    """Runs of windows of many buckets at once, handed-on buckets among them, against a table of all windows."""
    rng = random.Random(8)
    gram, rows = b"sixteen bytes ab", []
    for bucket in range(60):
        for _ in range(rng.choice([1, 2, 2, 3, 12])):
            left, right = (bytes(rng.choice(b"ab") for _ in range(rng.randrange(20, 35))) for _ in range(2))
            raw = (b"%02d" % bucket + left)[-34:] + gram + right if rng.random() < 0.5 else b"a" * 20 + gram + right + b"a" * 14
            at = -1 if bucket % 7 == 3 else raw.index(gram)
            rows.append((bucket, hashlib.md5(raw).digest(), raw, len(raw) - 49, at, rng.randrange(1000)))
    names = ["bucket", "segment", "bytes", "windows", "anchor", "doc_id"]
    table = pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64()])})
    least, segments, size = {}, {}, {}
    for b, s, raw, n, _, d in rows:
        segments[b, s] = raw
        for i in range(n):
            least[b, raw[i : i + 50]] = min(d, least.get((b, raw[i : i + 50]), d))
    for (b, _), raw in segments.items():
        size.setdefault(b, []).append(len(raw) + 1)
    for most in (None, 400):
        got = [r for made in suffixes.solved(table, 50, most) for r in made.to_pylist()]
        on = {b for b, n in size.items() if most is not None and len(n) > 1 and sum(n) > most}
        assert bool(on) == (most is not None)
        assert sorted(r["segment"] for r in got if r["owners"] is None) == sorted(s for b, s in segments if b in on)
        found = {r["segment"]: [o["doc"] for o in r["owners"] for _ in range(o["a"], o["b"] + 1)] for r in got if r["owners"] is not None}
        assert found == {s: [least[b, raw[i : i + 50]] for i in range(len(raw) - 49)] for (b, s), raw in segments.items() if b not in on}


def test_runs_of_texts_together():
    rng = np.random.default_rng(3)
    raws = [rng.integers(97, 100 + i % 20, int(n), dtype=np.uint8).tobytes() for i, n in enumerate(rng.integers(0, 400, 300))] + [b"x" * 200_000, b"", b"ab" * 40]
    for anchored in (True, False):
        seen = 0
        for a, texts, of, bucket, first, n, at in suffixes.joined_runs(iter(raws), 50, anchored):
            assert a == seen and texts == raws[a : a + len(texts)]
            seen += len(texts)
            for i, raw in enumerate(texts):
                want = suffixes.anchored_runs(np.frombuffer(raw, np.uint8), 50)
                got = [x[of == i] for x in (bucket, first, n, at)]
                assert all((p == q).all() for p, q in list(zip(got, want))[: 4 if anchored else 3]) and len(got[0]) == len(want[0])
        assert seen == len(raws)


def test_copies_reach_no_bucket(spark, monkeypatch):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(i, text) for i in range(200)] + [(200 + i, f"{text[:120]} and {i * 7919} more") for i in range(3)]
    hashed, plain = [], suffixes.buckets_of
    monkeypatch.setattr(suffixes, "buckets_of", lambda docs, *more: hashed.append(docs.count()) or plain(docs, *more))
    got = suffixes.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == removed(rows)
    assert hashed[0] <= 14  # the four distinct texts, and what the bitmap lets through by chance


def test_words_shared_by_chance_are_not_gathered(spark, monkeypatch):
    """Windows are gathered for a key of the bytes around their anchor that several documents have, a document's equal segments once."""
    rng = random.Random(3)
    other = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    phrase, line = "twenty bytes of them", other(60)
    rows = [(i, "".join(f"{other(60)}{phrase}" for _ in range(5)) + other(60)) for i in range(40)]
    gathered, plain = [], suffixes.all_owned
    monkeypatch.setattr(suffixes, "all_owned", lambda segments, *more: gathered.append(segments.count()) or plain(segments, *more))
    for some in (rows, [*rows, (50, line * 30), (51, other(80) + line * 30)]):
        got = suffixes.repeats(spark.createDataFrame(some, "doc_id long, text string"))
        assert sorted(map(tuple, got.collect()), key=repr) == removed(some)
    assert gathered[0] == 0 and 0 < gathered[1] <= 60


def test_keys_of_several_documents(spark):
    """Keys come back with each document that has them, from packed rows of several chunks; a key of all documents is an entry a chunk."""
    rng = np.random.default_rng(1)
    chunks, have = [], {}
    for c in range(4):
        key, doc = rng.integers(0, 2**64, 400, dtype=np.uint64), rng.integers(0, 30, 400) + c * 20
        key[::3] = key[0] if c == 0 else chunks[0][0][0]
        key[1::3] = rng.integers(0, 2**64, 60, dtype=np.uint64)[rng.integers(0, 60, len(key[1::3]))]
        key[2::9] = (chunks[0][0] if chunks else key)[2::9]
        chunks.append((key, doc))
        for k, d in zip(key.view(np.int64).tolist(), doc.tolist()):
            have.setdefault(k, set()).add(d)
    rows = [tuple(r.values()) for key, doc in chunks for r in suffixes.packed_keys(key, doc, 8).to_pylist()]
    assert len(rows) == 32 and sum(r[1].count(chunks[0][0][:1].tobytes()) for r in rows) == 4
    got = suffixes.met_keys(spark.createDataFrame(rows, suffixes.KEYS)).collect()
    assert {tuple(r) for r in got} == {(k, d) for k, of in have.items() if len(of) > 1 for d in of}


def test_runs_on_each_side_of_an_anchor():
    """Equal windows have equal buckets and keys wherever they stand, in texts put together and in one of several pieces."""
    rng = np.random.default_rng(7)
    common = rng.integers(97, 122, 300, dtype=np.uint8).tobytes()
    long = rng.integers(97, 122, 1_200_000, dtype=np.uint8).tobytes()
    keys, shared = {}, 0
    for raws in ([b"", b"x" * 30, common, b"a" * 120 + common + b"b" * 70, b"ab" * 60, b"x" * 49], [long[:1_048_000] + common + long[1_048_000:] + b"ab" * 90]):
        of, bucket, first, n, at, key = suffixes.sided_runs(raws, 50)
        windows = [(i, w) for i, f, k in zip(of.tolist(), first.tolist(), n.tolist()) for w in range(f, f + k)]
        assert windows == [(i, w) for i, r in enumerate(raws) for w in range(max(0, len(r) - 49))]
        for i, f, k, *names in zip(*(x.tolist() for x in (of, first, n, bucket, key))):
            for w in range(f, f + k):
                shared += (window := raws[i][w : w + 50]) in keys
                assert keys.setdefault(window, names) == names
    assert shared > 700
