"""Training until no pair is left, against the reference's rule applied to every occurrence."""

import random
from collections import Counter

import pytest

from lexiflow.operators import bpe
from lexiflow.operators.bpe_rounds import WordPart, merge_symbols, train_part
from lexiflow.plans import catalog as C

SF = "/root/testdata/sf0.001"


def brute(corpus, n, substring, eow="_"):
    """Merges and final symbols by counting every pair of every occurrence again for each merge."""
    words = [(*w, eow) for w in corpus]
    merges = []
    while len(merges) < n:
        pairs = Counter(p for w in words for p in zip(w, w[1:]))  # in the order first seen
        if not pairs:
            break
        a, b = max(pairs, key=pairs.get) if substring else min(pairs, key=lambda p: (-pairs[p], p))
        merges.append((a, b, pairs[a, b]))
        words = [tuple(" ".join(w).replace(f"{a} {b}", a + b).split(" ")) if substring else merge_symbols(w, a, b) for w in words]
    return merges, {"".join(w): w for w in words}


def in_parts(corpus, n, substring, parts):
    """The rounds of several parts, their messages passed on here: merges, final symbols, rounds."""
    held, loops = [], []
    ranked = list(Counter(corpus).items())
    for me in range(parts):
        part, changes = WordPart(substring), {}
        for place, (w, freq) in enumerate(ranked):
            if place * 7919 % parts == me:
                part.add([*w, "_"], freq, place, changes)
        held.append(part)
        loops.append(train_part(part, changes, n))
    messages, done, rounds = [next(x) for x in loops], [], 0
    while not done:
        rounds += 1
        answers = []
        for x in loops:
            try:
                answers.append(x.send(messages))
            except StopIteration as end:
                done.append(end.value)
        messages = answers
    assert len(done) == parts and all(d == done[0] for d in done)
    return done[0], {"".join(s): tuple(s) for p in held for s in map(p.symbols, range(len(p.words)))}, rounds


@pytest.mark.parametrize("substring", [True, False])
def test_rounds_equal_merges_one_by_one(substring):
    for seed in range(45):
        r = random.Random(seed)
        letters = ("ab", "abcde", "abcdefghijklmnopqrstuvw")[seed % 3]
        corpus = ["".join(r.choices(letters, k=r.randint(1, 9))) for _ in range(r.randint(1, 60))]
        n = r.choice([3, 10**6])
        merges, words = brute(corpus, n, substring)
        assert in_parts(corpus, n, substring, r.choice([1, 2, 5]))[:2] == (merges, words), seed


@pytest.mark.parametrize("substring", [True, False])
def test_many_merges_share_a_round(substring):
    """Words of many symbols with different counts: far fewer rounds than merges, the same merges."""
    r = random.Random(3)
    word = lambda: "".join(chr(97 + int(24 * r.random() ** 1.5)) + chr(200 + int(60 * r.random() ** 1.5)) for _ in range(r.randint(1, 4)))
    corpus = [w for w in (word() for _ in range(250)) for _ in range(r.randint(1, 9))]
    merges, words = brute(corpus, 10**6, substring)
    found, symbols, messages = in_parts(corpus, 10**6, substring, 3)
    assert (found, symbols) == (merges, words)
    rounds = messages / 2 if substring else messages
    assert rounds < 0.85 * len(merges)


@pytest.mark.parametrize("mode", ["substring", "symbol"])
@pytest.mark.parametrize("tasks,n", [(1, 10**6), (3, 8)])
def test_train_rounds(spark, mode, tasks, n):
    """Until no pair is left in one task; a few rounds of three tasks."""
    r = random.Random(7)
    corpus = ["".join(r.choices("abcdef", k=r.randint(1, 8))) for _ in range(300)]
    tokens = spark.createDataFrame([(i // 10, i % 10, w) for i, w in enumerate(corpus)], "doc_id long, pos int, token string")
    got = bpe.train_rounds(bpe.word_table(tokens), n, "_", mode, tasks)
    merges, words = brute(corpus, n, mode == "substring")
    assert len(merges) > 100 or n == 8
    assert [(x.a, x.b, x.cnt) for x in got.merges.orderBy("rank").collect()] == merges
    assert {x.word + "_": tuple(x.syms) for x in got.words.collect()} == words
    vocab = [x.token for x in got.vocab.orderBy("position").collect()]
    new = [a + b for a, b, _ in merges]
    start = sorted({c for w in corpus for c in w + "_"})
    assert vocab == (start + [*dict.fromkeys(new)] if mode == "substring" else sorted({*start, *new}))


def test_registered_queries_go_on_after_twenty_merges(spark):
    few, many = C.q_bpe_train(spark, SF), C.q_bpe_train_full(spark, SF)
    rows = [tuple(x) for x in many.orderBy("rank").collect()]
    assert rows[:C.BPE_MERGES] == [tuple(x) for x in few.orderBy("rank").collect()]
    assert len(rows) > 50 * C.BPE_MERGES
    tokens = [w.lower() for x in C.tf.corpus_tokens(C._docs(spark, SF), C.CFG).orderBy("doc_id", "pos").collect() for w in [x["token"]] if w]
    assert [x[1:] for x in rows[:200]] == brute(tokens, 200, True)[0]
