"""F4 stratified counts, F8 quotas and dealing; every document in one fold."""

from collections import Counter

from lexiflow.operators.folds import fold_quotas, quota_folds, stratified_folds, train_test_split


def _docs(spark):
    rows = [(i, "a") for i in range(5)] + [(5 + i, "b") for i in range(4)]
    return spark.createDataFrame(rows, "doc_id long, class string")


def test_f4_counts(spark):
    f = stratified_folds(_docs(spark), k=3, seed=42).collect()
    c = Counter((r["class"], r.fold) for r in f)
    assert [c[("a", i)] for i in range(3)] == [2, 2, 1]
    assert [c[("b", i)] for i in range(3)] == [1, 1, 2]
    assert Counter(r.fold for r in f) == {0: 3, 1: 3, 2: 3}


def test_f8_quotas_and_dealing(spark):
    q = {r["class"]: r for r in fold_quotas(_docs(spark), 3).collect()}
    assert round(q["a"].pct, 4) == 55.5556 and round(q["b"].pct, 4) == 44.4444
    assert q["a"].rows_per_fold == 3.0 and q["a"].quota == 2 and q["b"].quota == 1
    f = quota_folds(_docs(spark), 3, 42).collect()
    c = Counter((r["class"], r.fold) for r in f)
    assert [c[("a", i)] for i in range(3)] == [2, 2, 1]
    assert [c[("b", i)] for i in range(3)] == [2, 1, 1]  # the one leftover b dealt to fold 0


def test_each_document_once_and_balanced(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "lang AS class")
    f = stratified_folds(docs, 10, 42).collect()
    assert len(f) == docs.count() == len({r.doc_id for r in f})
    per = Counter((r["class"], r.fold) for r in f)
    for cls in {r["class"] for r in f}:
        counts = [per[(cls, i)] for i in range(10)]
        assert max(counts) - min(counts) <= 1


def test_train_test_split(spark):
    f = stratified_folds(_docs(spark), k=3, seed=42)
    s = train_test_split(f, 3).collect()
    assert len(s) == 27
    assert Counter(r.split for r in s) == {"test": 9, "train": 18}


def test_an_id_in_two_classes_loses_one_row(spark):
    from lexiflow.operators import folds as fo

    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (0, "b"), (None, None), (3, None)], "doc_id long, class string")
    left = {tuple(r) for r in fo.drop_first_n_per_class(docs, 1).collect()}
    assert left == {(1, "b"), (2, "b"), (3, None)}
