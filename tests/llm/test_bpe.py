import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.llm import bpe, queries

RANKS = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
SMALL = bpe.Codec(RANKS, P.PATTERN, leaf=3, reach=1)


def check(text, codec=SMALL):
    ids = codec.encode(text)
    assert ids.tolist() == SMALL.encoding.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab'srelvd \n\t é1漢!\U0001f600", max_size=80))
def test_tree_equals_whole_text(text):
    check(text)


@pytest.mark.parametrize("text", ["", " ", "x" * 5000, " " * 3000, "a " * 3000, "we'll they're 'S\n\n  x", "é" * 999 + " \n", " \x1c a"])
def test_odd_texts(text):
    check(text)
    check(text, bpe.Codec.cached(RANKS, P.PATTERN))


def test_long_random():
    r = random.Random(1)
    text = "".join(r.choice(["word", " ", "  ", "\n", "'re", "123", "…", "mañana"]) for _ in range(40000))
    check(text, bpe.Codec(RANKS, P.PATTERN, leaf=512))


def test_frame(spark):
    rows = [(1, "Hello wörld"), (2, None), (3, ""), (3, ""), (None, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text as ids", "1 as n_tokens")
    got = bpe.digests(df, queries.RANKS, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted((i or 0, len(SMALL.encoding.encode_ordinary(t or ""))) for i, t in rows)
    for r, (_, t) in zip(got, rows):
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(np.array(SMALL.encoding.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest()
    enc = bpe.encode(df, queries.RANKS, P.PATTERN)
    assert [bytes(r.bytes) for r in bpe.decode(enc, queries.RANKS, P.PATTERN).collect()] == [(t or "").encode() for _, t in rows]
    assert bpe.digests(df.limit(0), queries.RANKS, P.PATTERN).count() == 0
