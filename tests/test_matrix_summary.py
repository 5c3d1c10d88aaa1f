"""Slices of the matrix that are summed up in the task that makes them."""

import numpy as np

from lexiflow.operators import tfidf as tf


def test_summary_equals_values_and_no_slice_leaves_its_task(spark):
    weights = [(d, f"t{t}", d * 7 + t) for d in range(9) for t in range(d)]
    w = spark.createDataFrame(weights, "doc_id long, term string, w long")
    docs = spark.createDataFrame([(d, "x") for d in range(9)], "doc_id long, class string")
    terms = spark.createDataFrame([(f"t{t}",) for t in range(11)], "term string")
    matrix = tf.matrix_blocks(w, docs, terms, rows=4, columns=3)
    whole = tf.dense_rows(matrix, 4, 3).collect()
    summed = tf.dense_rows(matrix, 4, 3, lambda v: [(v == 0).sum(axis=1), v @ np.arange(1, v.shape[1] + 1)], "zeros long, places long")
    assert "values" not in summed.columns
    want = sorted((r.doc_id, r["class"], r.column_block, r.first_column, r["values"].count(0), sum(x * (i + 1) for i, x in enumerate(r["values"]))) for r in whole)
    assert sorted(map(tuple, summed.collect())) == want and len(want) == 9 * 4
