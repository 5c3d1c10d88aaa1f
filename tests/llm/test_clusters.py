import hashlib
import itertools

import numpy as np
import pytest

from lexiflow.llm import clusters, queries

SF = "/root/testdata/sf0.001"


def brute(rows, k=16, rounds=3, dims=64):
    """Every vector against every centroid, in Python integers."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dims and all(c is not None and np.isfinite(c) for c in x):
            kept.append((vec_id, [max(-2**63, min(2**63 - 1, int(np.floor(float(c) * 64)))) for c in x]))
    named = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in named[:k]]

    def assign():
        out = []
        for vec_id, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((vec_id, v, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for j in range(len(centroids)):
            mine = [v for _, v, c, _ in own if c == j]
            if mine:
                centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    own = assign()
    top = 2**63 - 1
    held = lambda n: min(n, top)
    inertia = {j: held(sum(held(d) for _, _, c, d in own if c == j)) for j in range(len(centroids))}
    total = held(sum(held(d) for *_, d in own))
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, held(d), inertia[c], total, sha[c]) for i, _, c, d in own), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, 0, "x") for i, x in rows], "vec_id long, embedding array<double>, key int, ids string")


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_hilbert_places_are_a_curve():
    for dims, bits in ((2, 3), (3, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = [bytes(k) for k in clusters.hilbert_keys(points, bits)]
        assert len(set(keys)) == len(points)
        order = points[np.argsort(np.array([int.from_bytes(k, "big") for k in keys]))]
        assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_candidates_never_lose_the_nearest():
    rng = np.random.default_rng(3)
    pruned = 0
    for _ in range(200):
        x = rng.integers(-9, 10, (6, 4)).astype(float) + rng.integers(-40, 41, 4)
        c = rng.integers(-40, 41, (7, 4)).astype(float)
        near = clusters.candidates(x.min(axis=0)[None], x.max(axis=0)[None], c)[0]
        best, dist = clusters.nearest(x, c, np.flatnonzero(near))
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (best == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
        pruned += (~near).sum()
    assert pruned > 200


def test_registered_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = queries.QUERIES["op13_hilbert_clusters"](spark, SF)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert found(got) == brute([(r["vec_id"], r["embedding"]) for r in table.collect()])


def test_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=64).round(3).tolist()) for i in range(90)]
    rows += [(200 + i, [0.25] * 64) for i in range(150)]  # one vector with most rows
    rows += [(7, rows[7][1]), (7, [0.5] * 64), (None, [0.1] * 64)]  # repeated and null ids
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [None] + [1.0] * 63), (304, [float("nan")] * 64), (305, [float("inf")] * 64)]
    assert found(clusters.cluster(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("size", [1e5, 1e9, 1e30])
def test_large_components_are_exact(spark, size):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=64) * size).tolist()) for i in range(40)]
    assert found(clusters.cluster(frame(spark, rows))) == brute(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert found(clusters.cluster(frame(spark, rows))) == brute(rows)
    assert clusters.cluster(frame(spark, [])).collect() == []
