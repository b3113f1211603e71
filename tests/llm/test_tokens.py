"""Encoding, wavelet-matrix files (operator 2) and packing (operator 6)."""

import random
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import packing, wavelet
from ledgerlake.llm.common import tokenizer_path
from ledgerlake.llm.encode import Encoder

from .helpers import ODD_TEXTS, no_docs, odd_docs

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")


def library(path):
    tok = Tokenizer.from_file(path)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


ENCODERS = {p: (Encoder(p), library(p)) for p in (WORD, BYTE)}
ATOMS = st.sampled_from([*"aBz'sdl 09.,\n\t!éΣİ中\x1c\x85́", "  ", "\n\n", " \n", "<|endoftext|>", "'ll", " x", "the", " The", "ing."])


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=300, deadline=None)
@given(st.lists(ATOMS, max_size=30).map("".join))
def test_cached_pieces_give_the_librarys_ids(path, text):
    enc, ids = ENCODERS[path]
    assert np.frombuffer(enc.encode([text])[0], "<u2").tolist() == ids(text)


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.lists(ATOMS | st.sampled_from(["word", " next", "\nline", "***", " x!?", "\nso."]), max_size=12).map("".join), max_size=6))
def test_batches_give_the_librarys_ids(path, texts):
    enc, ids = ENCODERS[path]
    got = enc.batch(pa.array(texts, pa.string()), enc.ids([7])).to_pylist()
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [ids(t) + [7] for t in texts]


def test_words_are_looked_up_once_a_batch(monkeypatch):
    """A text of a plain kind costs no Python work a word: only distinct pieces are looked up, and the word of ``word***`` is the word."""
    enc = Encoder(BYTE)
    monkeypatch.setattr(enc, "_prefixed", lambda text: pytest.fail("encoded word by word"))
    asked = []
    monkeypatch.setattr(enc, "_tok", type("Asked", (), {"encode": lambda self, text, **k: asked.append(text) or ENCODERS[BYTE][0]._tok.encode(text, **k)})())
    texts = ["one two two*** one\ntwo one$$$ two." * 50, "two one\none two"]
    got = enc.batch(pa.array(texts)).to_pylist()
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [library(BYTE)(t) for t in texts]
    assert not [a for a in asked if any(c.isalpha() for c in a) and a != " two.one"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=1500))
def test_wavelet_matrix(values):
    wm = wavelet.WaveletMatrix.of(np.array(values, np.uint16))
    assert wm.values().tolist() == values
    for i in range(0, len(values), 97):
        assert wm.access(i) == values[i]
    for c in {*values[:5], 69, 200}:
        at = [i for i, v in enumerate(values) if v == c]
        assert wm.count(c) == len(at)
        assert wm.rank(c, len(values) // 2) == sum(i < len(values) // 2 for i in at)
        assert [wm.select(c, k) for k in range(len(at))] == at and wm.positions(c).tolist() == at
        assert wm.select(c, len(at)) == -1


def expected_ids(path, end, texts):
    ids = library(path)
    return [ids(t) + [end] for t in texts]


@pytest.mark.parametrize("shard_bytes", [1 << 14, 1 << 30])
def test_token_files(spark, tmpdir_path, shard_bytes):
    docs = odd_docs(spark)
    path = f"{tmpdir_path}/tokens-{shard_bytes}"
    wavelet.write_tokens(docs, path, WORD, 2, shard_bytes=shard_bytes, segment_tokens=3000)
    got = wavelet.digests(spark, path).orderBy("start").collect()
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    start = 0
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    for r, ids in zip(got, expected_ids(WORD, 2, [r.text for r in rows])):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    token = library(WORD)("there")[0]
    found = wavelet.occurrences(spark, path, token).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in found} == {r.doc_id: library(WORD)(r.text).count(token) for r in rows if token in library(WORD)(r.text)}


def test_no_documents(spark, tmpdir_path):
    wavelet.write_tokens(no_docs(spark), f"{tmpdir_path}/none", WORD, 2)
    assert wavelet.digests(spark, f"{tmpdir_path}/none").count() == 0
    assert packing.pack(no_docs(spark), BYTE, 0).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_best_fit_decreasing_against_a_scan(lengths):
    window, offset, count = packing.best_fit_decreasing(lengths, 40)
    room, want = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fit = [r for r in room if r >= lengths[i]]
        if fit:
            k = room.index(min(fit))
        else:
            room.append(40)
            k = len(room) - 1
        want[i] = room[k]  # the capacity it met: the tightest
        room[k] -= lengths[i]
    assert [40 - o for o in offset] == want and count == len(room)
    assert len({(w, o) for w, o in zip(window, offset)}) == len(lengths)


def test_packing_covers_each_id_once(spark):
    docs = odd_docs(spark)
    got = packing.pack(docs, BYTE, 0, window=64, block_tokens=500).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    for doc, own in texts.items():
        ids = library(BYTE)(own[0]) + [0]
        pieces = sorted((p for p in got if p.doc_id == doc), key=lambda p: p.start)
        for start in {p.start for p in pieces}:
            assert sum(p.start == start for p in pieces) == len(own)
        joined = {p.start: p for p in pieces}
        assert np.frombuffer(b"".join(joined[s].ids for s in sorted(joined)), "<u4").tolist() == ids
        assert all(p.doc_tokens == len(ids) and p.length == len(p.ids) // 4 for p in pieces)
    sequences = {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = packing.pack(docs, BYTE, 0).agg(F.sum("length").alias("ids"), F.countDistinct("sequence_id").alias("n")).first()
    assert 1 - out.ids / (1024 * out.n) < 0.02
    assert ODD_TEXTS


def test_batches_of_pieces_against_the_library():
    """Ids of Arrow columns are those of the library's default call, control strings included."""
    from ledgerlake.llm.encode import Encoder
    rng = random.Random(21)
    bits = ["a", "B", "é", "É", ".", ",", " ", "  ", "\n", "!", "1", "²", "中", "İ", "Σ", "e\u0301", "'s", "<|endoftext|>", "<|STARTOFTEXT|>", "\t", "\xa0", ").", "ß", "***", "word", "Word's"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        enc, lib = Encoder(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
        want = [array("H", [*e.ids, 7]).tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]
        column = pa.array([None, *texts, None])
        assert enc.batch(column, enc.ids([7])).to_pylist() == [enc.ids([7]), *want, enc.ids([7])]
        assert enc.batch(column.slice(5, 40), enc.ids([7])).to_pylist() == want[4:44]
        assert enc.batch(column.slice(0, 0)).to_pylist() == []
        assert [x + enc.ids([7]) for x in enc.encode(texts)] == want


def test_one_access_unpacks_one_block_a_plane():
    from ledgerlake.llm import wavelet
    values = np.random.default_rng(1).integers(0, 50_000, 600_000).astype(np.uint16)
    raw = wavelet.write_segment(0, 0, [1], [len(values)], values, 16)
    (_, _, _, _, wm), = wavelet.read_segments(raw + b"\n")
    assert wm.access(123_456) == values[123_456]
    assert all(len(p.blocks) > 4 and len(p._open) <= 2 for p in wm.planes)
    c = int(values[400_000])
    at = np.flatnonzero(values == c)
    assert wm.rank(c, 500_000) == (at < 500_000).sum() and wm.select(c, len(at) - 1) == at[-1] and wm.positions(c).tolist() == at.tolist()
    assert (wm.values() == values).all()
