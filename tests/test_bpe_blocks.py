"""Rounds over blocks of words, against the reference's rule applied to every occurrence."""

import random
import time
from collections import Counter

import pyarrow as pa
import pytest
from test_bpe_full import brute

from lexiflow.operators import bpe, bpe_blocks as B


def in_blocks(corpus, n, substring, parts):
    """Merges, final symbols and rounds of a training in several blocks."""
    ranked = list(Counter(corpus).items())
    alphabet = sorted({c for w in corpus for c in w + "_"})
    held = []
    for me in range(parts):
        rows = [([*w, "_"], freq, place) for place, (w, freq) in enumerate(ranked) if place * 7919 % parts == me]
        kinds = (pa.list_(pa.string()), pa.int64(), pa.int64())
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["syms", "freq", "place"]) if rows else None
        held.append(B.block_of([batch.slice(0, 3), batch.slice(3)] if rows else [], alphabet))
    r, n_rounds = B.Rounds(alphabet, substring), 0
    r.changed([B.all_pairs(b, alphabet) for b in held])
    while len(r.merges) < n:
        items, horizon, asked = r.candidates()
        if not items:
            break
        if asked:
            r.placed(asked, [B.run_round(b, r.told([], asked), substring)[1][2] for b in held])
        rules = r.choose(items, horizon, n - len(r.merges))
        if rules:
            n_rounds += 1
            asked = r.ahead(rules)
            told = r.told(rules, asked)
            held, messages = zip(*[B.run_round(b, told, substring) for b in held])
            changes, own, places = zip(*messages)
            r.add(sorted(set().union(*own)))
            r.changed(changes)
            r.placed(asked, places)
    found = [s for b in held for batch in B.symbols_of(b, r.symbols, 7) for s in batch.column("syms").to_pylist()]
    return r.merges, {"".join(s): tuple(s) for s in found}, n_rounds


@pytest.mark.parametrize("substring", [True, False])
def test_rounds_equal_merges_one_by_one(substring):
    for seed in range(60):
        r = random.Random(seed)
        letters = ("ab", "abcde", "abcdefghijklmnopqrstuvw")[seed % 3]
        corpus = ["".join(r.choices(letters, k=r.randint(1, 9 + seed % 5))) for _ in range(r.randint(1, 60))]
        n = r.choice([3, 10**6])
        assert in_blocks(corpus, n, substring, r.choice([1, 2, 5]))[:2] == brute(corpus, n, substring), seed


@pytest.mark.parametrize("word", ["a" * 40, "ab" * 20, "abba" * 9, "aab" * 13])
@pytest.mark.parametrize("substring", [True, False])
def test_long_runs(word, substring):
    """Matches that overlap, and matches in a row that make one symbol."""
    corpus = [word, word[1:], word[:7], word[3:16], "b" + word] * 2
    assert in_blocks(corpus, 10**6, substring, 2)[:2] == brute(corpus, 10**6, substring)


@pytest.mark.parametrize("mode", ["substring", "symbol"])
def test_no_message_takes_a_second(spark, mode):
    """A round of several blocks is far from the second that a message between barrier tasks takes Spark; checkpoints in
    between leave the result as it is."""
    r = random.Random(5)
    corpus = ["".join(r.choices("abcdef", k=r.randint(1, 8))) for _ in range(200)]
    tokens = spark.createDataFrame([(i // 10, i % 10, w) for i, w in enumerate(corpus)], "doc_id long, pos int, token string")
    words = bpe.word_table(tokens).localCheckpoint()
    bpe.train_rounds(words, 1, "_", mode, 3)  # starts the workers
    merges, symbols = brute(corpus, 120, mode == "substring")
    n_rounds = in_blocks(corpus, 120, mode == "substring", 3)[2]
    begin = time.time()
    assert [(x.a, x.b, x.cnt) for x in bpe.train_rounds(words, 120, "_", mode, 3).merges.orderBy("rank").collect()] == merges
    assert time.time() - begin < 0.8 * n_rounds > 24
    got = bpe.train(words, 120, "_", mode, checkpoint_every=2, tasks=3)
    assert [(x.a, x.b, x.cnt) for x in got.merges.orderBy("rank").collect()] == merges
    assert {x.word + "_": tuple(x.syms) for x in got.words.collect()} == symbols


@pytest.mark.parametrize("mode", ["substring", "symbol"])
def test_no_words(spark, mode):
    got = bpe.train(bpe.word_table(spark.createDataFrame([], "doc_id long, pos int, token string")), 5, "_", mode)
    assert got.merges.count() == got.words.count() == got.vocab.count() == 0
