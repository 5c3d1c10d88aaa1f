"""Classify documents as they arrive, with Structured Streaming.

New document files (parquet with doc_id, text) in a folder are read as a stream; each
micro-batch is classified against a labelled train set under a fitted TF-IDF model
(one query × all train documents, zero-similarity documents included) and the
predictions of batch b are written to ``batch_id=b`` of a parquet sink, so a retried batch
overwrites its own rows. Vocabulary, idf and train vectors are stored once, before the
stream starts. The state kept by the query is only the file log of the source and the
sink's commit log, under ``checkpoint_location``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.knn import predict_texts, train_vectors
from ..operators.tfidf import TfidfConfig, TfidfModel
from ..session import stored

DOC_SCHEMA = "doc_id bigint, text string"


def classify_stream(spark: SparkSession, source_dir: str, model: TfidfModel, train: DataFrame, k: int,
                    sink_dir: str, checkpoint_location: str, cfg: TfidfConfig = TfidfConfig(),
                    available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``train``: (doc_id, class). With ``available_now`` the query processes
    the files present and stops (batch-like runs); otherwise it keeps polling."""
    reader = spark.readStream.schema(DOC_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    vectors = train_vectors(model.tfidf, train)
    model = model._replace(idf=stored(model.idf, "idf"), vocab=stored(model.vocab, "vocabulary"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        preds = predict_texts(batch, model, train, k, cfg, vectors).where("rank = 1").select("doc_id", "predicted")
        preds.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
