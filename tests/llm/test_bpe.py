import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiflow.llm import bpe, queries

from .conftest import SF

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS, P.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=5))
def test_equals_the_library_and_decodes_back(texts):
    for text, ids in zip(texts, CODEC.encode(texts)):
        assert ids.tolist() == LIB.encode_ordinary(text)
        assert CODEC.decode(ids) == text.encode()


def test_long_runs():
    r = random.Random(2)
    texts = ["x" * 100_000, "ab" * 30_000, " " * 20_000, "é" * 5000, "1234567890" * 500, "aAaa" * 5000,
             "".join(r.choice("abcde") for _ in range(20_000)), "".join(chr(r.randrange(0x100, 0x3000)) for _ in range(5000))]
    for text, ids in zip(texts, CODEC.encode(texts)):
        assert ids.tolist() == LIB.encode_ordinary(text) and CODEC.decode(ids) == text.encode()


def test_other_vocabulary():
    name = "byte_bpe_multi_50k.tiktoken"
    ranks = bpe.read_ranks(P.path(name))
    lib = tiktoken.Encoding("multi", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "Grüße, 世界 und здравствуй мир, naïve café " * 20
    assert next(bpe.Codec(ranks, P.PATTERN).encode([text])).tolist() == lib.encode_ordinary(text)


def test_pair_table():
    left, right = np.arange(500) % 50, np.arange(500) // 50
    table = bpe.PairTable(left, right, np.arange(500, dtype=np.int32))
    assert (table.find(left, right) == np.arange(500)).all()
    assert (table.find(np.array([-1, 60, 3]), np.array([3, 60, -1])) == bpe._NONE).all()


def row(text):
    ids = LIB.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op1_byte_bpe(spark, SF).collect()}
    assert got == {i: row(t) for i, t in texts.items()}


def test_awkward_rows(spark, awkward, nothing):
    ids = bpe.encode(awkward, RANKS, P.PATTERN)
    got = bpe.decode(ids.selectExpr("doc_id", "ids", "ids AS copy"), RANKS, P.PATTERN).collect()
    key = lambda x: str(x)
    assert sorted(((r.doc_id, bytes(r.decoded), r.copy) for r in got), key=key) == sorted(
        ((r["doc_id"], (r["text"] or "").encode(), LIB.encode_ordinary(r["text"] or "")) for r in awkward.collect()), key=key)
    assert bpe.encode(nothing, RANKS, P.PATTERN).collect() == []
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(nulls, RANKS, P.PATTERN).first().decoded) == b""
