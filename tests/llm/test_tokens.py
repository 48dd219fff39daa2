"""BPE and plane files against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vigilake.llm import bpe, planes, queries
from vigilake.session import run_dir

from .conftest import SF, TEXTS

PATH = public_tokenizers.path(queries.WORD_BPE)
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=60))
def test_encoding_as_the_library(text):
    assert np.frombuffer(bpe.encoder(PATH).one(text), "<i4").tolist() == library(text)


def test_spellings_of_a_word_are_looked_up_once():
    e = bpe.Encoder(PATH)
    texts = ["Haus haus, HAUS. Élan élan!", "ÉLAN haus? ÿ ß. Ÿ ×a. aé1. don't. <|endoftext|>. e\u0301a, 42! a$$$", None, "", "x" * 300 + "."]
    assert e.array(pa.array(texts)).to_pylist() == [library(t) for t in texts]
    assert sorted(w for w in e.seen if w.lower().startswith(("haus", "élan"))) == ["haus", "élan"]
    assert e.array(pa.array(texts).slice(1, 2)).to_pylist() == [library(t) for t in texts[1:3]]


def test_long_words_take_the_heap_and_agree():
    v = bpe.encoder(PATH).vocabulary
    for word in ("a" * 1000, "ab" * 700, "thequickbrownfox" * 40):
        assert v.merge(word) == library(word)


def test_odd_texts_round_trip(odd_docs, no_docs):
    got = sorted((hashlib.sha256((r.text or "").encode()).hexdigest(), r.ids, r.decoded) for r in bpe.round_trip(odd_docs, PATH).collect())
    want = [(hashlib.sha256((t or "").encode()).hexdigest(), library(t), LIBRARY.decode(library(t), skip_special_tokens=False)) for _, t in TEXTS]
    assert got == sorted(want)
    assert bpe.round_trip(no_docs, PATH).count() == 0


def test_unknown_ids_are_left_out():
    assert bpe.decode_array(pa.array([[49406, -1, 10**6, 320], []], pa.list_(pa.int32())), PATH).to_pylist() == ["<|startoftext|> a</w>", ""]


def test_op10_is_the_library(spark, documents):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op10_rank_array_bpe(spark, SF).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d, t in zip(documents.doc_id, documents.text):
        ids = library(t)
        assert got[d] == (len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)))


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    back = planes.from_planes([p.tobytes() for p in planes.to_planes(ids, kind)], n, kind) if n else ids
    assert (back == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_round_trip(spark, odd_docs, no_docs, kind):
    folder = run_dir(spark, "planes")
    ordered = planes.in_order(odd_docs)
    manifest = planes.write_ids(ordered, folder, encode=lambda t: bpe.encoder(PATH).array(t), end=2, block=64, kind=kind)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids) for r in planes.read_ids(spark, folder).collect()))
    assert [g[0] for g in got] == np.cumsum([0, *(g[2] for g in got[:-1])]).tolist()
    assert [g[1] for g in got] == [None, *sorted(d for d, _ in TEXTS if d is not None)]
    assert sorted(g[3] for g in got) == sorted(library(t) + [2] for _, t in TEXTS)
    assert sum(r.n_docs for r in manifest.collect()) == len(TEXTS)
    empty = run_dir(spark, "planes")
    planes.write_ids(planes.in_order(no_docs), empty, encode=lambda t: bpe.encoder(PATH).array(t))
    assert planes.read_ids(spark, empty).count() == 0


def test_op1_reads_back_what_the_library_makes(spark, documents):
    got = {r.doc_id: r for r in queries.op1_bit_planes(spark, SF).collect()}
    at = 0
    for d, t in sorted(zip(documents.doc_id, documents.text)):
        ids = np.array([*library(t), 2], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids), planes.crc32(ids))
        at += len(ids)
