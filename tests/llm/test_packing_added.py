"""Added tokens inside texts, against the tokenizers library as it comes."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from lexiflow.llm import packing, queries

from .conftest import texts_frame

TEXTS = ["<|endoftext|>", "a <|endoftext|> b", "  <|endoftext|>\n\n<|endoftext|><|endoftext|>x", "<|endoftext|", "<<|endoftext|>>",
         "ab " * 900 + "<|endoftext|>" + " cd" * 900, "plain words", "", None]


def want():
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = [[*lib.encode(t or "", add_special_tokens=False).ids, 2] for t in TEXTS]
    assert sum(50256 in x for x in ids) == 5
    return Counter((d, k, s, n, zlib.crc32(np.array(x[s:s + n], "<u4").tobytes()))
                   for d, x in enumerate(ids) for k, (s, n) in enumerate(packing.cut(len(x), 1024)))


def test_query_and_stage_find_added_tokens(spark, tmp_dir):
    docs = texts_frame(spark, [(i, t, "en", "a") for i, t in enumerate(TEXTS)])
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    for rows in (queries.op6_best_fit_packing(spark, tmp_dir), dict(corpus_pipeline.STAGES)["packing"](spark, docs, tmp_dir)):
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows.collect()) == want()
