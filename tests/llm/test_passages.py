import hashlib
import random
import re

import pytest

from tests.llm.conftest import SF, TEXTS
from vigilake.llm import passages, queries


def removed(rows, width=50):
    """(doc_id, n_words, n_removed, kept digest) from a table of all windows."""
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first, out = {}, []
    for d, words in split:
        for i in range(len(words) - width + 1 if d is not None else 0):
            w = tuple(words[i : i + width])
            first[w] = min(d, first.get(w, d))
    for d, words in split:
        gone = set()
        for i in range(len(words) - width + 1 if d is not None else 0):
            if first[tuple(words[i : i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(docs, **k):
    return sorted(map(tuple, passages.repeats(docs, **k).collect()), key=repr)


def shared_texts(seed, n=60):
    """Texts with common passages at varied places, near copies, copies, and very repetitive ones."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randrange(1, 4)
    common = [[word() for _ in range(rng.choice([49, 50, 51, 80, 200]))] for _ in range(5)]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(4)):
            words += [word() for _ in range(rng.randrange(30))] + (rng.choice(common) if rng.random() < 0.7 else ["x"] * rng.randrange(120))
        if out and rng.random() < 0.3:
            words = list(out[rng.randrange(len(out))][1])
            if words and rng.random() < 0.7:
                words[rng.randrange(len(words))] = word()
        out.append((rng.choice([i, i, i, 7, None]), words))
    return [(d, rng.choice([" ", "  ", "\t\n"]).join(w)) for d, w in out]


def test_passages_of_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_seed_extend(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == removed(docs) and any(0 < r[2] < r[1] for r in got)


def test_odd_passages(odd_docs, no_docs):
    assert found(odd_docs) == removed(TEXTS)
    assert found(no_docs) == []


@pytest.mark.parametrize("most,width", [(passages.MOST, 50), (passages.MOST, 16), (2, 50)])
def test_passages_in_other_surroundings(spark, most, width):
    rows = [(d, t) for seed in range(3) for d, t in shared_texts(seed)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(docs, width=width, most=most) == removed(rows, width)


def test_normal_texts():
    for raw in (b"", b"  ", b"a", b" a  b\t\n c ", "é \x0b ü\x1cx ".encode()):
        assert passages.normal(raw) == b" ".join(raw.split())


def test_words_of_long_texts(monkeypatch):
    text = b" ".join(b"w%d" % i for i in range(500))
    whole = passages.hashed_words(text)
    monkeypatch.setattr(passages, "PIECE", 40)
    parts = passages.hashed_words(text)
    assert all((a == b).all() for a, b in zip(whole, parts)) and len(whole[0]) == 500
    assert len(passages.hashed_words(b"x" * 100 + b" y")[0]) == 2


def test_extension_is_linear_in_its_members():
    passage = [f"p{i}" for i in range(60)]
    members = [([f"l{d}"] * 20 + passage + [f"r{d}"] * 20, 30, 31, d) for d in range(3000)]
    owners = passages.extended(members, 50)
    assert all(own == [d] * 20 + [0] * 11 for d, own in enumerate(owners))
