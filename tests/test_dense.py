import numpy as np
import pytest

from lexiflow.operators import dense
from lexiflow.operators.cells import dot_measure


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(queries, rows, k, cosine=True, digits=9):
    out = []
    for q, x, _ in queries:
        found = []
        for t, y, _ in rows:
            if t == q or t is None:
                continue
            a, b = ([float(np.float32(c or 0)) for c in v or []] for v in (x, y))
            value = sum(i * j for i, j in zip(a, b))
            if cosine:
                den = np.sqrt(sum(i * i for i in a)) * np.sqrt(sum(i * i for i in b))
                value = value / den if den else 0.0
            found.append((-round(value, digits) + 0.0, t))
        out += [(q, r + 1, t, -s + 0.0) for r, (s, t) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [None, (1, 1), (3, 4)])
def test_blocks_equal_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist(), i % 3) for i in range(120)]  # many ties
    queries = [r for r in rows if r[0] % 10 == 0]
    for measure, cosine in ((dense.cosine_measure, True), (dot_measure, False)):
        got = dense.top_k(frame(spark, queries), frame(spark, rows), 7, measure, blocks=blocks).collect()
        assert sorted((r["q"], r["rank"], r["t"], r["sim"]) for r in got) == brute(queries, rows, 7, cosine)


def test_awkward_vectors(spark):
    rows = [(1, [1.0, 0.0, 2.0], 0), (2, None, 1), (3, [], 1), (4, [1.0, None, 2.0], 0), (5, [0.0, 0.0, 0.0], 2), (6, [1.0], 2),
            (7, [2.0, 0.0, 4.0, 9.0], 2), (None, [1.0, 0.0, 2.0], 3)]
    queries = [r for r in rows if r[0] is not None]
    got = dense.top_k(frame(spark, queries), frame(spark, rows), 99, blocks=(2, 2)).collect()
    assert sorted((r["q"], r["rank"], r["t"], r["sim"]) for r in got) == brute(queries, rows, 99)
    assert dense.top_k(frame(spark, []), frame(spark, rows), 3).collect() == []
    assert dense.top_k(frame(spark, rows), frame(spark, []), 3).collect() == []


def test_a_vector_with_most_rows(spark):
    rows = [(i, [1.0, 2.0], 1) for i in range(400)] + [(1000 + i, [1.0, float(i)], 0) for i in range(40)]
    queries = rows[:3] + rows[-2:]
    got = dense.top_k(frame(spark, queries), frame(spark, rows), 10, blocks=(1, 3)).collect()
    assert sorted((r["q"], r["rank"], r["t"], r["sim"]) for r in got) == brute(queries, rows, 10)


def test_votes(spark):
    rows = [(0, [1.0, 0.0], 9), (1, [1.0, 0.1], 2), (2, [1.0, 0.2], 1), (3, [0.0, 1.0], 5), (4, [0.0, 1.0], 5)]
    got = dense.knn(frame(spark, rows[:1]), frame(spark, rows), 2).orderBy("rank").collect()
    assert [(r["vec_id"], r["label"], r["predicted"]) for r in got] == [(1, 2, 1), (2, 1, 1)]


def test_fifty_thousand_vectors(spark):
    """A block's memory is bounded; the nearest of planted pairs are found."""
    rng = np.random.default_rng(1)
    base = rng.normal(size=(50_000, 16)).astype(np.float32)
    base[1::20] = base[0::20] + np.float32(1e-3)  # a near copy right behind every query
    df = spark.createDataFrame(list(enumerate(base.tolist())), "vec_id long, embedding array<float>")
    got = dense.top_k(df.where("vec_id % 20 = 0"), df, 3)
    best = got.where("rank = 1").selectExpr("count(*) AS n", "count_if(t = q + 1) AS hit").first()
    assert best["n"] == 2500 and best["hit"] == 2500


def test_vectors_are_not_copied_to_blocks(spark):
    """The blocks are read from where they are stored: only the best rows of a block are shuffled, for the merge."""
    e = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)], "vec_id long, embedding array<double>")
    got = dense.top_k(e, e, 5, blocks=(2, 3))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert got.count() == 300
