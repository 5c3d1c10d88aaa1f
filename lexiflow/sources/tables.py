"""Readers for the parquet tables the engine works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("documents", "labels", "embeddings", "benchmark", "conversations", "pages")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_documents(spark: SparkSession, sf_dir: str, class_col: str = "source") -> DataFrame:
    """``documents`` as a labelled corpus (doc_id, text, class). Only three columns are read."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", "text", F.col(class_col).alias("class"))


def conversation_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as a labelled corpus; the id packs (conv_id, turn) into
    the upper and lower 32 bits, class = role."""
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select((F.col("conv_id") * F.lit(1 << 32) + F.col("turn")).alias("doc_id"), "text",
                       F.col("role").alias("class"))
