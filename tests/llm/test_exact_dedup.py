import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from lexiflow.llm import exact_dedup, queries

from .conftest import SF, texts_frame


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), i == best[t or ""],
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)


def answer(df):
    return sorted(((r.k_id, r.keep_id, r.group_size, r.kept, bytes(r.sha).hex()) for r in df.collect()), key=str)


def test_filter_has_no_false_negative_and_few_false_positives():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 30000):
        keys = rng.integers(-2**63, 2**63, n, dtype=np.int64)
        built = exact_dedup.build_filter(keys)
        assert exact_dedup.probe_filter(keys, *built).all()
        others = rng.integers(-2**63, 2**63, 20000, dtype=np.int64)
        assert exact_dedup.probe_filter(others, *built).mean() < 0.02
        assert n < 1000 or len(built[3]) < 1.5 * n


def test_awkward_rows(awkward, nothing):
    want = brute([(r["doc_id"], r["text"]) for r in awkward.collect()])
    for batches in (1, 2, 3):
        assert answer(exact_dedup.exact_dedup(awkward, batches)) == want
    assert exact_dedup.exact_dedup(nothing).collect() == []


def test_matches_brute_force_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op3_exact_dedup(spark, SF).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str) == brute(
        [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_digest_clash_is_settled_by_the_bytes(spark, monkeypatch):
    """With a digest that only sees the first letter, equal digests still need equal texts."""
    real = F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: real(F.substring(c, 1, 1), n))
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.hash(F.substring(F.col(c[0]) if isinstance(c[0], str) else c[0], 1, 1)).cast("long")
                        if str(c[0]) != "k_id" else F.col("k_id"))
    rows = [(1, "ab"), (2, "ac"), (3, "ab"), (4, "b"), (5, "ac"), (6, "ac"), (7, "c")]
    out = exact_dedup.exact_dedup(texts_frame(spark, [(i, t, None, None) for i, t in rows]))
    assert sorted((r.k_id, r.keep_id, r.group_size) for r in out.collect()) == [
        (1, 3, 2), (2, 6, 3), (3, 3, 2), (4, 4, 1), (5, 6, 3), (6, 6, 3), (7, 7, 1)]


def test_one_row_of_each_group_stays(spark, awkward):
    kept = exact_dedup.keep_one(awkward, exact_dedup.exact_dedup(awkward))
    assert kept.columns == awkward.columns
    texts = [r["text"] or "" for r in awkward.collect()]
    left = [r["text"] or "" for r in kept.collect()]
    assert sorted(left) == sorted(set(texts))
    assert {r["doc_id"] for r in kept.collect()} >= {3, 2}


def test_keep_one_keeps_columns_of_any_name(spark):
    rows = [(1, "a a", "t"), (1, "a a", "u"), (2, "b", "v"), (None, "b", "w"), (None, None, "x"), (None, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, whole_text_key string")
    for c in ("k_id", "k_text", "h", "sha", "t", "a b"):
        docs = docs.withColumn(c, F.lit(c))
    left = exact_dedup.keep_one(docs, exact_dedup.exact_dedup(docs))
    assert left.columns == docs.columns
    got = left.collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "None"]
    assert {(r.doc_id, r.text, r.whole_text_key) for r in got} <= set(rows) and all(r["a b"] == "a b" for r in got)
