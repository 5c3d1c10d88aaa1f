"""What a round of merges costs besides its words: jobs, and bytes told to all tasks."""

import pickle
import random

from test_bpe_full import brute

from lexiflow.operators import bpe, bpe_blocks as B


def test_few_words_take_no_job_a_round(spark):
    r = random.Random(11)
    corpus = ["".join(r.choices("abcdef", k=r.randint(1, 8))) for _ in range(200)]
    tokens = spark.createDataFrame([(i // 10, i % 10, w) for i, w in enumerate(corpus)], "doc_id long, pos int, token string")
    sc = spark.sparkContext
    sc.setJobGroup("few-words", "")
    merges = [(x.a, x.b, x.cnt) for x in bpe.train_rounds(bpe.word_table(tokens), 10**6).merges.orderBy("rank").collect()]
    jobs = len(sc.statusTracker().getJobIdsForGroup("few-words"))
    sc.setJobGroup("default", "")
    assert merges == brute(corpus, 10**6, True)[0] and len(merges) > 200
    assert jobs < 30


def test_old_symbols_are_told_once():
    symbols = [f"s{i}" for i in range(60_000)]
    rounds, kept = B.Rounds(symbols, True), []
    rounds.rebase(lambda value: kept.append(value) or B._Held(value))
    rounds.add(["new"])
    told = rounds.told([], [])
    assert len(kept) == 1 and B._Table(told, True).strings(told.fresh_codes) == ["new"]
    assert len(pickle.dumps(told._replace(base=None))) < 5_000


def test_pairs_are_arrays():
    """A pair is some 33 bytes of arrays, not entries of dictionaries."""
    symbols = [chr(200 + i) for i in range(1_000)]
    rounds, keys = B.Rounds(symbols, True), B.np.arange(300_000) % 1_000 << 32 | B.np.arange(300_000) // 1_000
    some = B.np.ones(len(keys), B.np.int64)
    rounds.changed([B.Changes(1_000, [], B.np.sort(keys), some, some, some)])
    held = sum(c.nbytes for t in (rounds.old, rounds.young) for c in t.columns())
    assert held <= 40 * len(keys) and len(rounds.old.key) + len(rounds.young.key) == len(keys)
