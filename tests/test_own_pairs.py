"""All pairs of a table with itself: the same rows as the cells give, and no copies of vectors are shuffled."""

import pytest

from lexiflow.operators import cells
from lexiflow.operators.similarity import all_pairs_similarity
from tests.test_own_top_k import _weights


@pytest.mark.parametrize("docs", [4, 8192])
@pytest.mark.parametrize("with_folds", [True, False])
def test_blocks_equal_cells(spark, monkeypatch, docs, with_folds):
    weights, folds = _weights(spark, 60, True)
    vectors = cells.document_vectors(weights, folds).cache()
    names = ["q", "t", "dot", "sim", "norm_sq_q", "norm_sq_t", "fold_q", "fold_t"]
    want = sorted(map(tuple, cells.pairs(vectors, vectors, once=True, other_folds=with_folds, buckets=(1, 1)).select(names).collect()))
    monkeypatch.setattr(cells, "BLOCK_DOCS", docs)
    got = sorted(map(tuple, cells.own_pairs(vectors, 66, other_folds=with_folds).select(names).collect()))
    assert got == want and len(got) > 100


def test_no_vector_is_copied_to_cells(spark):
    """Blocks are stored once; behind them only one block a task moves."""
    weights, folds = _weights(spark, 60, True)
    plan = all_pairs_similarity(weights, folds)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Exchange" not in plan.split("MapInArrow")[0] and "explode" not in plan
