"""What reading the nested fold document moves."""

from lexiflow.sources import corpus


def test_values_take_no_part_in_the_sums_over_sections(spark, tmp_dir, monkeypatch):
    rows = [(i, f'text "{i}" \\', "ab"[i % 2], i % 3) for i in range(12)]
    corpus.write_folds_json(spark.createDataFrame(rows, "doc_id long, text string, class string, fold int"), f"{tmp_dir}/folds")
    seen, whole = [], corpus.running_sum

    def checked(df, col, out, *args):
        seen.append(out)
        assert out != "sections" or df.where("NOT is_key").isEmpty()
        if out == "before":  # the file ends are sent to the pieces
            assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
        return whole(df, col, out, *args)

    monkeypatch.setattr(corpus, "running_sum", checked)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = corpus.read_folds_json(spark, f"{tmp_dir}/folds").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(tuple(r) for r in got) == rows and "sections" in seen
