import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lexiflow.llm import bpe, packing, queries

from .conftest import SF, texts_frame

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))


def fewest(items, capacity):
    """Least number of sequences, by trying all."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                go(i + 1, bins[:k] + [bins[k] + items[i]] + bins[k + 1:])
        go(i + 1, bins + [items[i]])

    go(0, [])
    return best[0]


def test_patterns_use_every_piece_once():
    for seed in range(200):
        r = random.Random(seed)
        capacity = r.choice([10, 17, 64])
        counts = Counter(r.randrange(1, r.choice([capacity, capacity // 2, capacity // 3]) + 1) for _ in range(r.randrange(1, 60)))
        used = Counter()
        for items, times in packing.solve(counts, capacity):
            assert items and times > 0 and sum(items) <= capacity
            for w in items:
                used[w] += times
        assert used == counts


def exact(items):
    fixed, left = packing.reduce_by_dominance(Counter(items), 20)
    rest = [w for w, n in left.items() for _ in range(n)]
    return sum(t for _, t in fixed) + (fewest(rest, 20) if rest else 0) == fewest(items, 20), len(fixed)


def test_fixed_sets_cost_no_sequence():
    """The reduction is exact: fixed sequences + the least number for the rest = the least number for all."""
    some = 0
    for seed in range(5000):
        r = random.Random(seed)
        least = r.choice([1, 2, 3, 5])
        same, n = exact([r.randrange(least, r.choice([8, 12, 20])) for _ in range(r.randrange(6, 13))])
        assert same, seed
        some += n
    assert some > 5000  # patterns fixed


def test_a_set_of_three_is_not_dominated_by_a_pair():
    items = [10, 8, 3, 3, 3, 4, 4, 4]
    assert exact(items)[0]
    fixed, _ = packing.reduce_by_dominance(Counter(items), 20)
    assert (10, 8) not in [f for f, _ in fixed]
    assert sum(t for _, t in packing.solve(Counter(items), 20)) <= 3


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(4, 4) == [(0, 4)]


def check(rows, texts, capacity=1024):
    """Pieces cover every document, sequences are gapless, and few."""
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = [[*lib.encode(t or "", add_special_tokens=False).ids, 2] for _, t in texts]
    want = Counter((d, k, s, n, zlib.crc32(np.array(x[s:s + n], "<u4").tobytes()))
                   for (d, _), x in zip(texts, ids) for k, (s, n) in enumerate(packing.cut(len(x), capacity)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(map(len, ids)) // capacity)


def test_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check(queries.op6_best_fit_packing(spark, SF).collect(), docs)
    assert used <= 1.02 * least + 1


@pytest.mark.parametrize("together", [20_000, 3])
def test_awkward_rows(spark, awkward, nothing, monkeypatch, together):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", together)
    docs = awkward.union(texts_frame(spark, [(99, "<|endoftext|> " + " " * 5000 + "ab" * 9000, None, None)] * 7))
    added = packing.read_added_tokens(P.path("byte_bpe_50k.json"))
    check(packing.pack(docs, RANKS, P.PATTERN, added=added).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert packing.pack(nothing, RANKS, P.PATTERN).collect() == []


def test_ids_come_out_on_request(spark):
    docs = texts_frame(spark, [(1, "hello world " * 700, None, None)])
    rows = packing.token_pieces(docs, RANKS, P.PATTERN, 2, 1024, with_ids=True).orderBy("piece").collect()
    ids = np.concatenate([r["ids"] for r in rows])
    assert ids[-1] == 2 and [len(r["ids"]) for r in rows] == [r["length"] for r in rows]
