"""Encoding against tiktoken, decoding as an exact round trip."""

import hashlib

import numpy as np
import pytest
from agrolume.llm import bpe
from agrolume.llm.queries import RANKS, token_digests
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH, PATTERN = tokenizers.path(RANKS), tokenizers.PATTERN
RANK = bpe.read_ranks(PATH)
KNOWN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANK, special_tokens={})


def expected(doc_id, text):
    ids = KNOWN.encode_ordinary(text or "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())


def check(docs):
    got = sorted((tuple(r) for r in token_digests(docs, PATH, PATTERN).collect()), key=str)
    assert got == sorted((expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)


def test_the_test_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_long_and_odd_texts(spark):
    texts = ["", None, "a" * 40_000, " " * 50_000 + "x", "word " * 9_000, "é\n\n  ü 12'll " * 5_000, "\U0001f600don't" * 4_000, "x" * 16_384, ("ab" * 9_000 + " ") * 4]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(3, texts[4], None), (None, "null id", None)]
    check(spark.createDataFrame(rows, "doc_id long, text string, ids string"))
    check(spark.createDataFrame([], "doc_id long, text string, ids string"))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab'st \n\t.1é", max_size=120))
def test_windows_agree_with_the_whole(text):
    chunk, overlap = bpe.CHUNK, bpe.OVERLAP
    bpe.CHUNK, bpe.OVERLAP = 16, 3
    try:
        parts = list(bpe.windows(text))
    finally:
        bpe.CHUNK, bpe.OVERLAP = chunk, overlap
    encoder = bpe.Encoder(RANK, PATTERN)
    pieces = [encoder.find.findall(w) for _, w in parts]
    starts = [s + np.cumsum([0] + [len(p) for p in f])[:-1] for (s, _), f in zip(parts, pieces)]
    ranges = bpe.stitch(starts, [s + len(w) for s, w in parts])
    joined = [p for f, (a, b) in zip(pieces, ranges) for p in f[a:b]]
    assert joined == encoder.find.findall(text)
    assert np.frombuffer(b"".join(encoder.blobs(joined)), np.int32).tolist() == KNOWN.encode_ordinary(text)


MERGER = bpe.Merger(RANK)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abcdeéx日", max_size=400), min_size=1, max_size=9))
def test_pieces_merge_alike(pieces):
    for long in (bpe.LONG, 0, 10**6):
        before, bpe.LONG = bpe.LONG, long
        try:
            got = [np.frombuffer(b, np.int32).tolist() for b in MERGER.ids([p.encode() for p in pieces])]
        finally:
            bpe.LONG = before
        assert got == [KNOWN._core_bpe.encode_single_piece(p.encode()) if p else [] for p in pieces]


def test_remembered_pieces_stay_right(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    encoder = bpe.Encoder(RANK, PATTERN)
    for text in ["one two three four", "three four five", "one six seven one", "two two xyzzyq"] * 3:
        found = encoder.find.findall(text)
        assert np.frombuffer(b"".join(encoder.blobs(found)), np.int32).tolist() == KNOWN.encode_ordinary(text)


def test_windows_are_linear():
    for text in ("x" * 4_000_000, "x" * 2_000_000 + " y" * 100_000, "日本" * 1_000_000 + " "):
        assert sum(len(w) for _, w in bpe.windows(text)) <= 1.1 * len(text)
