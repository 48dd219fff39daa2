import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF, TEXTS
from vigilake.llm import merkle, queries

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(hashes):
    """(root, for each leaf its siblings as (before, after) per level)."""
    paths, level, at = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p // 16 * 16 : p // 16 * 16 + 16]
            paths[i].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
            at[i] = p // 16
        level = [h(*level[a : a + 16]) for a in range(0, len(level), 16)]
    return level[0], paths


def brute(rows):
    rows = sorted(rows, key=lambda r: ((r[1] is not None, (r[1] or "").encode()), r[0] is not None, r[0] or 0, leaf(r)))
    groups = [list(g) for _, g in groupby(rows, key=lambda r: r[1])]
    subs = [tree([leaf(r) for r in g]) for g in groups]
    root, tops = tree([s for s, _ in subs])
    out = []
    for g, (sub, paths), top in zip(groups, subs, tops):
        for r, path in zip(g, paths):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            x = leaf((*r[:4], text))
            for before, after in path + top:
                x = h(before, x, after)
            out.append((r[0], leaf(r), sub, root, h(*(b + a for b, a in path + top)), x, x == root))
    return sorted(out, key=repr)


def rebuilt(docs):
    altered = F.when(merkle.picked(), merkle.leaf_of(COLUMNS, {"text": merkle.lowered()}))
    found = merkle.manifest(docs, COLUMNS, altered=altered).withColumn("f", merkle.folded(F.coalesce("altered", "leaf")))
    return sorted(map(tuple, found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(), 256), "f", F.expr("f = root")).collect()), key=repr)


def test_manifest_of_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()]
    got = queries.op13_nested_rollup(spark, SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == brute(docs) and {r[6] for r in got} == {True, False}


def test_odd_manifest(odd_docs, no_docs):
    rows = [(d, None if d == 5 else f"src{(d or 0) % 3}", None if d == 6 else "en", None if t is None else len(t), t) for d, t in TEXTS]
    assert rebuilt(odd_docs) == brute(rows)
    assert rebuilt(no_docs) == []


@pytest.mark.parametrize("n", [1, 16, 17, 300])
def test_many_blocks(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", merkle.FAN)
    rows = [(i, "one" if i % 3 else f"Src{i % 60}", "en", 3, f"Text {i}") for i in range(n)]
    assert rebuilt(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)) == brute(rows)


def test_plan_has_no_join_for_proofs(spark):
    docs = spark.createDataFrame([(1, "a", "en", 1, "x")], "doc_id long, source string, lang string, n_chars long, text string")
    plan = merkle.manifest(docs, COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
