"""byte-pair merges in both modes, segmentation and fully merged words."""

from lexiflow.operators import bpe


def _words(spark, corpus):
    rows = [(0, i, w) for i, w in enumerate(corpus.split())]
    toks = spark.createDataFrame(rows, "doc_id long, pos int, token string")
    return bpe.word_table(toks)


def _run(spark, corpus, mode):
    res = bpe.train(_words(spark, corpus), 4, "_", mode=mode)
    merges = [(r.a, r.b, r.cnt) for r in res.merges.orderBy("rank").collect()]
    segs = {r.word: r.seg for r in res.words.collect()}
    full = sorted(r.term for r in bpe.full_words(res.words, "_").collect())
    return merges, segs, full


def test_f5_first_corpus(spark):
    m, s, full = _run(spark, "low low lower", "substring")
    assert m == [("l", "o", 3), ("lo", "w", 3), ("low", "_", 2), ("low", "e", 1)]
    assert s == {"low": "low_", "lower": "lowe r _"}
    assert full == ["low"]
    m, s, full = _run(spark, "low low lower", "symbol")
    assert m == [("l", "o", 3), ("lo", "w", 3), ("low", "_", 2), ("e", "r", 1)]
    assert s == {"low": "low_", "lower": "low er _"}


def test_f5_cut_across_symbols(spark):
    corpus = " ".join(["ab"] * 4 + ["xa"] * 5 + ["xab"])
    m, s, full = _run(spark, corpus, "substring")
    assert m == [("x", "a", 6), ("b", "_", 5), ("xa", "_", 5), ("a", "b_", 4)]
    assert s == {"ab": "ab_", "xa": "xa_", "xab": "xab_"}
    assert full == ["ab", "xa", "xab"]
    m, s, full = _run(spark, corpus, "symbol")
    assert m == [("x", "a", 6), ("b", "_", 5), ("xa", "_", 5), ("a", "b_", 4)]
    assert s["xab"] == "xa b_"
    assert full == ["ab", "xa"]


def test_symbols_rebuild_word(spark):
    w = bpe.with_symbols(_words(spark, "hello world"), "_").collect()
    assert all("".join(r.syms) == r.word + "_" for r in w)
