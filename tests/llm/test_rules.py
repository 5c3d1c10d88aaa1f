import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from lexiflow.llm import queries, rules

from .conftest import SF, texts_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(hit), failed)


def test_counts_match_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op10_host_rules(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(docs[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_awkward_rows(spark, awkward, nothing):
    got = rules.host_rules(awkward).collect()
    want = sorted(brute(r["text"]) for r in awkward.collect())
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert rules.host_rules(nothing).collect() == []


def test_host_habit_rejects_and_lone_failure_is_forgiven(spark):
    clean = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(300)]
    dirty = [c + " " + "# " * 30 for c in clean]
    rows = [(i, clean[i], "en", f"good{i % 10}") for i in range(200)]
    rows += [(1000 + i, dirty[i], "en", "bad") for i in range(60)] + [(2000, dirty[70], "en", "good1")]
    rows += [(3000, clean[250], "en", "bad")]
    got = {r.k_id: r for r in rules.host_rules(texts_frame(spark, rows)).collect()}
    assert all(got[i].kept for i in range(200)) and got[3000].kept and got[2000].kept
    assert not any(got[1000 + i].kept for i in range(60))


def test_a_bad_host_at_an_ordinary_rate_is_rejected(spark):
    """A quarter of one host's documents fail a soft rule, one in fifty elsewhere; the query's SQL agrees."""
    text = lambda i, bad: " ".join([f"w{i}x{j}" for j in range(60)] + ["#"] * (12 * bad))
    rows = [(i, text(i, i % 50 == 0), "en", f"h{i % 8}") for i in range(1600)]
    rows += [(5000 + i, text(5000 + i, i % 4 == 0), "en", "bad") for i in range(200)]
    docs = texts_frame(spark, rows)
    got = {r.k_id: r.kept for r in rules.host_rules(docs).collect()}
    assert {i for i, kept in got.items() if not kept} == {5000 + i for i in range(0, 200, 4)}
    assert {r.doc_id for r in rules.kept_documents(docs).collect()} == {i for i, kept in got.items() if kept}
    con = duckdb.connect()
    frame = docs.toPandas()  # noqa: F841
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    assert dict(con.execute(f"SELECT doc_id, kept FROM ({queries.ORACLE_SQL['op10_host_rules']})").fetchall()) == got


def test_kept_documents_keep_clashing_columns(spark, awkward, nothing):
    names = ["k_id", "t", "h", "n", "c", "l", "rule_counts", "v_host", "n_words", "a b", "strict_lines"]
    docs = awkward
    for c in names:
        docs = docs.withColumn(c, F.lit(c))
    left = rules.kept_documents(docs)
    assert left.columns == docs.columns and all(r[c] == c for r in left.collect() for c in names)
    verdicts = rules.host_rules(docs)
    assert sorted(map(str, (r["doc_id"] for r in left.collect()))) == sorted(map(str, (r.k_id for r in verdicts.collect() if r.kept)))
    assert rules.kept_documents(nothing).collect() == []


def test_no_document_is_shuffled_for_a_verdict(spark):
    plan = rules.kept_documents(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_only_spark_functions(spark):
    plan = queries.op10_host_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
