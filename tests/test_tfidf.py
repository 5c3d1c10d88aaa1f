"""TF-IDF on the four-document fixture, case rule, frequency rule, tf sums."""

from pyspark.sql import functions as F

from lexiflow.operators.tfidf import TfidfConfig, fit_tfidf

DOCS = [(0, "kedi köpek kedi", "x"), (1, "kedi Kuş köpek", "x"), (2, "balık kuş deniz", "y"),
        (3, "deniz balık Balık ve", "y")]
CFG = TfidfConfig(stop_words=("ve",), min_df=1, max_df=1.0)


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, class string")


def test_f2_weights(spark):
    m = fit_tfidf(_docs(spark), CFG)
    cf = {r.term: r.cf for r in m.freqs.collect()}
    assert cf == {"kedi": 3, "balık": 3, "köpek": 2, "kuş": 2, "deniz": 2}
    totals = {r.doc_id: r.term_count for r in m.totals.collect()}
    assert totals == {0: 3, 1: 2, 2: 3, 3: 2}
    nz = {(r.doc_id, r.term): r.tfidf for r in m.tfidf.where("w != 0").collect()}
    assert nz == {(0, "köpek"): 0.041646, (1, "köpek"): 0.062469, (2, "kuş"): 0.041646,
                  (2, "deniz"): 0.041646, (3, "deniz"): 0.062469}
    idf = {r.term: r.idf for r in m.idf.collect()}
    assert abs(idf["kuş"] - 0.124939) < 1e-6 and idf["kedi"] == 0.0


def test_document_frequency_option(spark):
    m = fit_tfidf(_docs(spark), TfidfConfig(stop_words=("ve",), min_df=1, max_df=1.0, freq="document"))
    df = {r.term: r.df for r in m.freqs.collect()}
    assert df["kedi"] == 2 and df["balık"] == 2


def test_lower_case_matching_option(spark):
    m = fit_tfidf(_docs(spark), TfidfConfig(stop_words=("ve",), min_df=1, max_df=1.0, match_case="lower"))
    totals = {r.doc_id: r.term_count for r in m.totals.collect()}
    assert totals == {0: 3, 1: 3, 2: 3, 3: 3}


def test_tf_sums_to_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    m = fit_tfidf(docs, TfidfConfig(min_df=1, max_df=10**12))  # no term filtered out
    sums = m.tfidf.groupBy("doc_id").agg(F.sum("tf").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0


def test_the_whole_matrix_is_read_back(spark):
    """Blocks of two rows and three columns: every cell, zeros and a document without an entry."""
    from lexiflow.operators import tfidf as tf

    cells = {(10, "b"): 5, (10, "e"): -2, (20, "a"): 7, (40, "d"): 1, (40, "g"): 9}
    weights = spark.createDataFrame([(d, t, w) for (d, t), w in cells.items()] + [(20, "c", 0)], "doc_id long, term string, w long")
    docs = spark.createDataFrame([(10, "x"), (20, "y"), (30, "x"), (40, None), (50, "y")], "doc_id long, class string")
    terms = spark.createDataFrame([(t,) for t in "abcdefg"], "term string")
    matrix = tf.matrix_blocks(weights, docs, terms, 2, 3)
    found = {}
    for r in tf.dense_rows(matrix, 2, 3).collect():
        assert r["class"] == {10: "x", 20: "y", 30: "x", 40: None, 50: "y"}[r["doc_id"]]
        for i, w in enumerate(r["values"]):
            found[r["doc_id"], "abcdefg"[r["first_column"] + i]] = w
    assert found == {(d, t): cells.get((d, t), 0) for d in (10, 20, 30, 40, 50) for t in "abcdefg"}
    assert matrix.blocks.count() == 4  # empty blocks are not stored


def test_entries_are_not_shuffled(spark, monkeypatch):
    """Words counted in the rows give what grouping and joins give; also where a term is made by another token only."""
    from lexiflow.operators import tfidf as tf

    docs = spark.createDataFrame([(0, "ab cannot can Not gonna x y"), (1, "Ab ab na gon x x zu"), (2, None), (3, "zu Cannot not ve"), (4, "Ab")], "doc_id long, text string")
    cfg = TfidfConfig(extra_stop_words=("zu",), min_df=0.1, max_df=5.0)
    words = tf.corpus_tokens(docs, cfg)
    want = fit_tfidf(docs, cfg, vocab=tf.vocabulary(words, cfg))  # looked up in a given vocabulary
    for apart in ({}, {"x": ("x", "q"), "ab": ("ab", "q")}):  # the second: not told by themselves, though in the vocabulary
        monkeypatch.setattr(tf, "CONTRACTION_SPLITS", {**tf.CONTRACTION_SPLITS, **apart})
        got = fit_tfidf(docs, cfg)
        for name in ("tfidf", "counts", "totals", "in_vocab", "idf"):
            a, b = getattr(got, name), getattr(want, name)
            assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), (name, apart)
        assert got.tfidf.count() > 0 and (apart or "Exchange hashpartitioning" not in got.tfidf._jdf.queryExecution().executedPlan().toString())


def test_repeated_ids_are_grouped(spark):
    docs = spark.createDataFrame([(0, "ab ab cd"), (0, "ab"), (None, "cd"), (None, "cd ef")], "doc_id long, text string")
    m = fit_tfidf(docs, TfidfConfig(min_df=0.1, max_df=5.0))
    assert {(r.doc_id, r.term, r.n, r.term_count) for r in m.tfidf.collect()} == {(0, "ab", 3, 4), (0, "cd", 1, 4), (None, "cd", 2, 3), (None, "ef", 1, 3)}
