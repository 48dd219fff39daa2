import random
import re
from collections import Counter, defaultdict

import numpy as np

from tests.llm.conftest import SF, TEXTS
from vigilake.llm import divergence, queries


def brute(rows, least=3, top=200):
    """rows: (lang, source, text)."""
    found, df = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        found[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in found}:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = [s for g, s in found if g == lang]

        def shares(counts):
            whole = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // whole for t in kept}

        p = {s: shares(found[lang, s]) for s in sources}
        q = shares(sum((found[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if found[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(items[:most], 1)]
    return sorted(out)


def audited(docs, **k):
    return sorted(map(tuple, divergence.audit(docs, **k).select("lang", "source", "part", "item", "value", "rank").collect()))


def test_audit_of_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "source", "text").collect()]
    got = queries.op12_perfect_hash_recount(spark, SF)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_hashes_too_large_to_broadcast(spark, monkeypatch):
    rows = [(random.Random(i).choice(["en", "de", None]), f"s{i % 4}", " ".join(f"Wort{chr(97 + (i * j) % 23)}{'é' * (j % 3)}" for j in range(40))) for i in range(60)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    monkeypatch.setattr(divergence, "PER_SHARD", 16)
    used = []
    way = divergence.cells_by_shuffle
    monkeypatch.setattr(divergence, "cells_by_shuffle", lambda *a: used.append(1) or way(*a))
    want = brute(rows, top=5)
    assert audited(docs, top=5, most=0) == want and used
    assert audited(docs, top=5) == want and len(used) == 1


def test_odd_audits(odd_docs, no_docs):
    rows = [(None if d == 6 else "en", None if d == 5 else f"src{(d or 0) % 3}", t) for d, t in TEXTS]
    assert audited(odd_docs, least=2) == brute(rows, 2)
    assert audited(odd_docs, least=50) == brute(rows, 50)  # nothing is kept
    assert audited(no_docs) == []


def test_perfect_hashes():
    for n in (1, 2, 3, 17, 500, 5000):
        terms = [f"term{i}".encode() for i in range(n)]
        seed, shifts, by_slot = divergence.perfect(terms)
        assert sorted(by_slot) == sorted(terms)
        lookup = divergence.Lookup(1, [{"shard": 0, "seed": seed, "shifts": shifts, "terms": [t.decode() for t in by_slot]}])
        good, _, slot = lookup.find([*terms, b"other", b""])
        assert len(good) == n and [by_slot[s] for s in slot] == terms


def test_equal_hashes_take_another_seed(monkeypatch):
    true = divergence.halves
    monkeypatch.setattr(divergence, "halves", lambda terms, seed=0: true(terms, seed) if seed else (np.full(len(terms), 7, np.uint64), np.full(len(terms), 9, np.uint64)))
    seed, shifts, by_slot = divergence.perfect([b"a", b"b", b"c"])
    assert seed == 1
    lookup = divergence.Lookup(1, [{"shard": 0, "seed": seed, "shifts": shifts, "terms": [t.decode() for t in by_slot]}])
    good, _, slot = lookup.find([b"c", b"x", b"a"])
    assert good.tolist() == [0, 2] and [by_slot[s] for s in slot] == [b"c", b"a"]


def test_large_counts_stay_exact():
    counts, total, terms = np.array([0, 10**13, 123_456_789_012_345]), 2 * 10**14, 10**9
    assert divergence.shares(counts, total, terms).tolist() == [1 + 10**9 * (c + 1) // (total + terms) for c in counts.tolist()]


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    for text in (b"ab cd " * 20, b"x" * 50, b"x" * 50 + b" y", b"", b" " * 30 + b"end"):
        assert [t for part in divergence.terms_of(text) for t in part] == text.split()
