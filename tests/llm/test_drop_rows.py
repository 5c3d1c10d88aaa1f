"""Rows are dropped and found exactly whatever the number of keys, and only texts that may match are shuffled."""

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import common


def _docs(spark, n=3000):
    docs = spark.range(n).select(F.when(F.col("id") != 5, F.col("id")).alias("doc_id"),
                                 F.when(F.col("id") % 7 != 0, F.concat(F.lit("t"), F.col("id") % 11)).alias("text"),
                                 F.lit(1).alias("bit_page"), F.lit("x").alias("a b"))
    return docs.repartition(4)


@pytest.mark.parametrize("bound", ["10m", "1b"])
@pytest.mark.parametrize("most", [1, 2048])
def test_rows_left_and_found(spark, monkeypatch, bound, most):
    monkeypatch.setattr(common, "MOST_PAGES", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    try:
        docs = _docs(spark)
        rejected = docs.where("doc_id IS NULL OR doc_id % 3 = 0").select(*common.row_key()).union(spark.createDataFrame([(1, 99)], "k_id long, k_text long"))
        left = common.drop_rows(docs, rejected)
        assert left.columns == docs.columns
        assert sorted(map(str, left.collect())) == sorted(map(str, docs.where("doc_id % 3 <> 0").collect()))
        keys = common.stored(spark.range(0, 3000, 4).withColumnRenamed("id", "doc_id"), "keys")
        found = common.semi_join(docs, keys, "doc_id", F.xxhash64)
        assert found.columns == docs.columns and sorted(r.doc_id for r in found.collect()) == list(range(0, 3000, 4))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_texts_are_shuffled(spark):
    """One text in a hundred is rejected: about that share is moved, not all texts."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    keys = common.stored(docs.where("doc_id % 100 = 0").select(*common.row_key()), "keys")
    value = lambda i, t: F.xxhash64(i.cast("string"), t)
    may, others = common.may_hold(docs, lambda df: value(df["doc_id"], F.xxhash64(df["text"])), keys, value(F.col("k_id"), F.col("k_text")))
    n = may.count()
    assert 200 <= n < 1200 and others.count() == 20_000 - n and may.where("doc_id % 100 = 0").count() == 200
