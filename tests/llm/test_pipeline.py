"""The pipeline against a plain version of its stages, and on odd documents."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from vigilake.llm import cotrain, mixing, pii, queries, stages
from vigilake.session import materialise

from .conftest import SF, TEXTS
from .test_similar import classes


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    after = []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), "stage")
        after.append({r.doc_id: r for r in docs.collect()})
    quality, near, clean, mixed, coded = after
    start = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {r.doc_id: r.kept for r in cotrain.classify(spark, start, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert {*quality} == {d for d, kept in scores.items() if kept}
    assert {*near} == {c for _, _, c in classes([(d, r.text) for d, r in quality.items()], 5, 80)}
    assert all(clean[d].text == pii.redact(near[d].text, None) and clean[d].n_chars == len(clean[d].text) for d in near)
    taken = mixing.mix(queries.with_domain(spark.createDataFrame(list(clean.values()), start.schema)), queries.MIX_LEVELS, queries.MIX_WEIGHTS, 80, 1)
    assert {*mixed} == {r.doc_id for r in taken.collect()} and len(mixed) < len(clean)
    library = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    assert all(coded[d].ids == library.encode(mixed[d].text, add_special_tokens=False).ids and coded[d].n_tokens == len(coded[d].ids) for d in mixed)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == {*coded}


def test_odd_documents(spark, odd_docs, no_docs):
    near = stages.one_of_near_copies(spark, odd_docs, SF)
    assert near.columns == odd_docs.columns
    ids = sorted((r.doc_id for r in near.collect()), key=repr)
    assert ids == sorted({d for d, _ in TEXTS} - {2, 8}, key=repr)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, SF)
        assert {*odd_docs.columns} <= {*out.columns}, name
        out.collect()
        assert stage(spark, no_docs, SF).count() == 0, name


def test_clashing_columns(spark):
    """Columns named like those the stages use themselves, in any case."""
    names = ("_of", "_digest", "_more", "_gone", "_again", "_taken", "_coded", "IDS", "N_Tokens", "whole", "_id", "_row", "key", "row", "node", "keep", "tree", "domain", "_text")
    rows = [(i, f"some words of text number {i % 3} for a.b{i}@example.org and more of them to read", "en", f"src{i}", 60, *["x"] * len(names)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert all(r["_more"] == r["whole"] == r["key"] == "x" for r in out.collect()), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {"ids", "decoded_sha256", "n_tokens"} <= {*last.columns} and last.count() == 6
