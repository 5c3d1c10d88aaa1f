"""Votes are counted where the neighbours are found: the same votes as over a table of neighbours, without one."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import knn, scoring
from lexiflow.plans.tfidf_knn import knn_cross_validation
from lexiflow.session import stored_folder


def _tables(spark, twice=False):
    r = random.Random(9)
    weights = [(i, t, r.randrange(1, 9)) for i in range(50) for t in r.sample("abcdefgh", r.randrange(4))]
    folds = [(i, r.choice(["x", "y", "z", None]), r.randrange(3)) for i in range(50)]
    folds += [(7, "y", 0), (8, None, 2)] if twice else []
    return spark.createDataFrame(weights, "doc_id long, term string, w long"), spark.createDataFrame(folds, "doc_id long, class string, fold int")


@pytest.mark.parametrize("twice", [False, True])
def test_votes_equal_those_over_neighbours(spark, twice):
    weights, folds = _tables(spark, twice)
    found = knn.cross_validated_neighbours(weights, folds.select("doc_id", "fold"), 7)
    want = knn.count_votes(found, folds)
    got = knn.cross_validated_votes(weights, folds, 7)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got.select("q", "t_class", "votes")) == rows(want.select("q", "t_class", "votes"))
    assert rows(knn.predict_by_votes(got, folds)) == rows(knn.predict(found, folds))
    codes = scoring.label_codes(folds)
    assert rows(scoring.scores_of_votes(got, codes)) == rows(scoring.vote_scores(found, folds, codes))


def test_no_table_of_neighbours(spark):
    """Predictions store no neighbours, and nothing but sums per query and class is shuffled behind the comparison."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", F.col("lang").alias("class"))
    folder = stored_folder(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/neighbours-*"))
    run = knn_cross_validation(docs)
    assert run.predictions.count() == docs.count() and set(glob.glob(f"{folder}/neighbours-*")) == before
    plan = knn.cross_validated_votes(run.weights, run.folds, 5)._jdf.queryExecution().executedPlan().toString()
    last = plan.split("Initial Plan")[0].split("MapInArrow")[0]
    assert "partial_count" in last.split("Exchange")[-1] and "Sort [t" not in last
