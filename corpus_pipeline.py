"""Pipeline over ``documents``: every stage is (name, function) with function(spark, docs, sf_dir).

The columns of ``documents`` pass through all stages but the last, which returns the packed
pieces. Defined cases (nulls, empty texts, repeated rows, empty tables, further columns) are
those of the operators: a null text is a document without words and fails the quality
rules; rows that repeat a document end as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiflow.llm import bpe, exact_dedup, minhash, packing, pii, rules
from lexiflow.llm.common import drop_rows, stored
from lexiflow.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the habits of their host; one that is listed under
    several hosts is judged for each."""
    return rules.kept_documents(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.keep_one(docs, exact_dedup.exact_dedup(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near copies: the one with the smallest doc_id."""
    return drop_rows(docs, stored(minhash.near_duplicates(docs).where("NOT kept").select("k_id", "k_text"), "near-copies"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    added = packing.read_added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, ranks, public_tokenizers.PATTERN, added=added)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]
#: The stages train a model, merge components and pack by best fit, which SQL can't express; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
