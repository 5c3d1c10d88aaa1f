"""Neighbours of a table with itself: the same rows as the cells give, and nothing but the result leaves a task."""

import random

import pytest

from lexiflow.operators import cells, knn


def _weights(spark, n, whole):
    r = random.Random(3)
    rows = [(7 * i - 50, t, r.randrange(-2, 9) if whole else r.random()) for i in range(n) for t in r.sample("abcdefghij", r.randrange(5))]
    rows += [(10_000 + i, "a", 5 if whole else 0.5) for i in range(6)]  # equal vectors
    folds = [(7 * i - 50, r.randrange(4)) for i in range(n)] + [(10_000 + i, i % 4) for i in range(6)]
    return spark.createDataFrame(rows, f"doc_id long, term string, w {'long' if whole else 'double'}"), spark.createDataFrame(folds, "doc_id long, fold int")


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("k", [4, 1000])
def test_blocks_equal_cells(spark, monkeypatch, whole, k):
    weights, folds = _weights(spark, 60, whole)
    vectors = cells.document_vectors(weights, folds).cache()
    for block_measure in (None, cells.weighted_jaccard) if not whole else (None,):
        want = sorted(tuple(r) for r in cells.top_k(vectors, vectors, k, buckets=(1, 1), block_measure=block_measure).collect())
        for kept, strip, terms, products in ((10**6, 64, 256, 10**6), (5 * min(k, 66), 3, 2, 7)):
            for name, value in (("KEPT_ROWS", kept), ("OWN_STRIP", strip), ("DENSE_TERMS", terms), ("PRODUCTS", products)):
                monkeypatch.setattr(cells, name, value)
            got = sorted(tuple(r) for r in knn.cross_validated_neighbours(weights, folds, k, block_measure=block_measure).collect())
            assert got == want


def test_only_the_result_leaves_a_task(spark):
    """No merge of k rows per query and block: nothing is shuffled or ranked behind the tasks that compare."""
    weights, folds = _weights(spark, 60, True)
    plan = knn.cross_validated_neighbours(weights, folds, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan.split("MapInArrow")[0]
