import random
import re

import numpy as np
import pyarrow as pa

from lexiflow.llm import minhash, queries
from lexiflow.llm.components import connected_components
from lexiflow.llm.shingles import column_sets

from .conftest import SF, texts_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """[(doc_id, text)] with distinct ids → {doc_id: (n, component)} over all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    where, root = {}, {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in where.values() for k, a in enumerate(ids) for b in ids[k + 1:]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def answer(df):
    return {r.k_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_matches_brute_force_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = queries.op8_minhash_dedup(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute([tuple(d) for d in docs])
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_drifting_copies_keep_every_link(spark):
    """Copies that drift from their source: many are unlike the centre of their bucket but like each other."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    rows, line = [], list(base)
    for i in range(150):
        copy = list(base if i % 3 else line)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        if i % 3 == 0:
            line = copy
        rows.append((i, " ".join(copy)))
    assert answer(minhash.near_duplicates(texts_frame(spark, [(i, t, None, None) for i, t in rows]))) == brute(rows)


def test_awkward_rows(spark, awkward, nothing):
    got = minhash.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r.k_id: r for r in got if r.k_id is not None}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[9].n_shingles == 0
    assert all(by_id[i].component_id == i and by_id[i].kept for i in by_id)
    assert by_id[7].n_shingles == by_id[8].n_shingles == 1
    nulls = sorted(((r.n_shingles, r.component_id, r.kept) for r in got if r.k_id is None), key=str)
    assert nulls == [(0, None, True), (1, 3, False)]
    assert minhash.near_duplicates(nothing).collect() == []


def test_documents_listed_twice_change_nothing(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(3000)}" for _ in range(90)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(0, 12)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    docs = texts_frame(spark, [(i, t, None, None) for i, t in rows + rows[::2] + rows[:5]])
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == 95 and {r.k_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_short_texts_are_one_sequence(spark):
    rows = [(1, "a b c"), (2, "A B C"), (3, "a b"), (4, "a b c d e"), (5, "a b c d e f"), (6, "a c b"), (7, "")]
    assert answer(minhash.near_duplicates(texts_frame(spark, [(i, t, None, None) for i, t in rows]))) == brute(rows)


def test_shingle_hashes_match_sets():
    texts = ["", "a", "a b c d e", "A b C d e f g a b c d e", " x\ty\nz ", None, "é ü É 😀 ß \x00 q", "a\x00 a a\x00", "ab c" * 50]
    sets = list(column_sets(pa.array(texts)))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    offset = pa.array(["zz"] + texts).slice(1)
    assert all((a == b).all() for a, b in zip(sets, column_sets(offset)))


def test_densified_bins_agree_as_often_as_the_sets():
    rng = np.random.default_rng(3)
    for size in (4, 40, 2000):
        agree = []
        for _ in range(60):
            pool = np.unique(rng.integers(0, 2**64, int(size * 1.25), dtype=np.uint64))
            a, b = pool[: int(len(pool) * 0.9)], pool[int(len(pool) * 0.1):]
            sig = minhash.signatures([a, b], 250)
            agree.append((sig[0] == sig[1]).mean() - len(np.intersect1d(a, b)) / len(pool))
        assert abs(np.mean(agree)) < 0.06


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 180)] + [(5, j) for j in range(300, 400)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(300)]
    edges += [(7, 7), (-3, 150)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root if x != 7}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
