"""Registered queries against their DuckDB statements on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, frame_hash

SF = "/root/testdata/sf0.001"
FAST = ["sanitize_text", "sanitize_tokens", "sanitize_chars", "stopword_anti_join", "vocabulary", "term_counts",
        "doc_term_totals", "collection_frequency", "idf", "tfidf", "tfidf_smooth_l2", "word_count",
        "bpe_pair_counts", "vector_norms", "all_pairs_similarity", "query_similarity", "knn_predict",
        "stratified_folds", "quota_folds", "fold_quotas", "drop_first_n_per_class", "label_encode",
        "dot_product_arrays", "cosine_embeddings", "knn_embeddings", "encode_pad_mask", "weighted_metrics",
        "bpe_train", "bpe_train_symbol", "bpe_vocab", "bpe_full_words", "bpe_segmented", "tfidf_bpe_vocab", "stem_vocab",
        "tfidf_wide_top_terms", "knn_library_stored", "knn_fit_predict", "knn_custom_similarity", "batch_score",
        "folds_file_round_trip", "fold_snapshot_round_trip", "fold_csv_round_trip", "vocabulary_file_round_trip",
        "metrics_csv_round_trip", "tfidf_table_round_trip", "nearest_documents"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_entry():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 45


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    o = con.execute(E.oracle_sql()[name]).df()
    assert len(s) == len(o)
    assert sorted(s.columns) == sorted(o.columns)
    assert frame_hash(s) == frame_hash(o)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["class", "precision", "recall", "f1"]
    assert any(r["class"] == "Average" for r in rows)
