"""The queries whose names don't say full train until no pair is left, or the reference's number of merges, too."""

import duckdb
import pytest
from test_bpe_full import SF, brute

import __spark_entry__ as E
from lexiflow.plans import catalog as C
from tools.check_oracle import frame_hash


@pytest.fixture(scope="module")
def few_documents(spark, tmp_path_factory):
    """A few short documents as a table folder."""
    sf = str(tmp_path_factory.mktemp("few"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars BETWEEN 200 AND 900 AND doc_id < 60").orderBy("doc_id").limit(12)
    docs.coalesce(1).write.parquet(f"{sf}/documents.parquet")
    return sf


def test_segmented_goes_on_until_no_pair_is_left(spark, few_documents):
    tokens = [x.token.lower() for x in C.q_sanitize_tokens(spark, few_documents).orderBy("doc_id", "pos").collect() if x.token]
    merges, symbols = brute(tokens, C.BPE_FULL_MERGES, True)
    assert len(merges) > 5 * C.BPE_MERGES
    found = {r.word + "_": tuple(r.seg.split(" ")) for r in C.q_bpe_segmented(spark, few_documents).collect()}
    assert found == symbols and all(len(s) == 1 for s in found.values())


@pytest.mark.parametrize("name", ["bpe_segmented", "bpe_segmented_corpus", "tfidf_bpe_vocab"])
def test_sql_of_whole_training(spark, few_documents, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{few_documents}/documents.parquet/*.parquet')")
    s, o = E.queries()[name](spark, few_documents).toPandas(), con.execute(E.oracle_sql()[name]).df()
    assert len(s) == len(o) > 0 and sorted(s.columns) == sorted(o.columns)
    assert frame_hash(s) == frame_hash(o)
