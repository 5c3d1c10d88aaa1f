"""Plan checks: pruning and pushdown reach the scan, the vocabulary join is a
size-checked broadcast at this size, the top-k comes from cells."""

from lexiflow.plans import catalog as C

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(C.q_sanitize_tokens(spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_vocabulary_semi_join_broadcast(spark):
    plan = _plan(C.q_in_vocab_tokens(spark, SF))
    assert "LeftSemi" in plan


def test_neighbours_come_from_cells_without_a_pair_table(spark):
    from lexiflow.operators import cells
    from lexiflow.operators.folds import stratified_folds

    folds = stratified_folds(C._docs(spark, SF), 10, 42)
    v = cells.document_vectors(C._model(spark, SF).tfidf, folds)
    plan = _plan(cells.top_k(v, v, 14))
    above = plan.split("FlatMapCoGroupsInArrow")[0]
    assert "FlatMapCoGroupsInArrow" in plan and "Window" in above
    assert "Join" not in above and "CartesianProduct" not in plan


def test_tfidf_joins_the_document_table_once(spark):
    plan = _plan(C.q_tfidf(spark, SF)).split("Initial Plan")[0]
    assert plan.count("document-tokens") <= 1 or plan.count("Scan parquet") <= 6


def test_no_rows_lost_without_a_class(spark):
    from lexiflow.operators.folds import quota_folds, stratified_folds

    docs = spark.createDataFrame([(1, "a"), (2, None), (None, None), (4, "a"), (5, None)], "doc_id long, class string")
    assert stratified_folds(docs, 2).count() == 5 and quota_folds(docs, 2).count() == 5
