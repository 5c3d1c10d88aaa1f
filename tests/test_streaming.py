"""Structured Streaming classification of arriving document files; vocabulary stemming hook."""

from pyspark.sql import functions as F

from lexiflow.operators.knn import k_from_size, predict_texts
from lexiflow.operators.tfidf import TfidfConfig, fit_tfidf, stem_terms
from lexiflow.streaming.classify import classify_stream

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.col("lang").alias("class"))
    model = fit_tfidf(docs, TfidfConfig())
    k = k_from_size(docs.count())
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("doc_id"), "text")
    src = f"{tmp_dir}/in"
    bench.where("doc_id % 2 = 0").write.parquet(f"{src}/part0")
    bench.where("doc_id % 2 = 1").write.parquet(f"{src}/part1")
    # one file set per sub-folder: point the stream at a folder holding both sets' files
    files = spark.read.parquet(f"{src}/part0", f"{src}/part1")
    files.write.parquet(f"{tmp_dir}/flat")
    q = classify_stream(spark, f"{tmp_dir}/flat", model, docs.select("doc_id", "class"), k,
                        f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination(300)
    back = spark.read.parquet(f"{tmp_dir}/out")
    assert "batch_id" in back.columns  # a retried batch overwrites its own folder
    got = {r.doc_id: r.predicted for r in back.collect()}
    want = {r.doc_id: r.predicted for r in
            predict_texts(bench, model, docs.select("doc_id", "class"), k).where("rank = 1").collect()}
    assert got == want and len(got) == bench.count()


def test_stem_terms(spark):
    vocab = spark.createDataFrame([("kediler",), ("kedi",), ("deniz",)], "term string")
    stems = spark.createDataFrame([("kediler", "kedi")], "term string, stem string")
    assert sorted(r.term for r in stem_terms(vocab, stems).collect()) == ["deniz", "kedi"]
