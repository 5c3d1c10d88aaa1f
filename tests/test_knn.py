"""F3 zero fill and vote tie; exact agreement with a brute-force comparison of every
pair on the smallest driver table; plan shape."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import cells
from lexiflow.operators.folds import stratified_folds
from lexiflow.operators.knn import KnnClassifier, first_k, knn_neighbours, predict
from lexiflow.operators.similarity import all_pairs_similarity, mirror_pairs
from lexiflow.operators.tfidf import TfidfConfig, fit_tfidf
from lexiflow.plans.tfidf_knn import knn_cross_validation
from lexiflow.sources.corpus import write_table

DOCS = [(0, "kedi köpek kedi", "x"), (1, "kedi Kuş köpek", "x"), (2, "balık kuş deniz", "y"),
        (3, "deniz balık Balık ve", "y")]


def test_f3_zero_fill_and_tie(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, class string")
    m = fit_tfidf(docs, TfidfConfig(stop_words=("ve",), min_df=1, max_df=1.0))
    folds = spark.createDataFrame([(0, "x", 0), (1, "x", 0), (2, "y", 1), (3, "y", 0)],
                                  "doc_id long, class string, fold int")
    pairs = all_pairs_similarity(m.tfidf, folds)
    sims = mirror_pairs(pairs, ("fold",), ("sim",))
    nb = knn_neighbours(sims, folds.select("doc_id", "fold"), 2)
    got = [(r.t, r.sim) for r in nb.where("q = 2").orderBy("rank").collect()]
    assert got == [(3, 0.707107), (0, 0.0)]
    pred = {r.doc_id: r.predicted for r in predict(nb, folds).collect()}
    assert pred[2] == "x"


def _brute_force(tfidf_rows, folds, classes, k):
    vec = defaultdict(dict)
    for d, t, w in tfidf_rows:
        if w != 0:
            vec[d][t] = w
    norm = {d: math.sqrt(sum(w * w for w in v.values())) for d, v in vec.items()}
    order = sorted(folds, key=lambda d: (folds[d], d))
    preds = {}
    for q in folds:
        cands = []
        for t in order:
            if folds[t] == folds[q]:
                continue
            if q in vec and t in vec and norm[q] > 0 and norm[t] > 0:
                dot = sum(w * vec[t].get(term, 0) for term, w in vec[q].items())
                s = round(dot / (math.sqrt(norm[q] ** 2) * math.sqrt(norm[t] ** 2)), 6)
            else:
                s = 0.0
            cands.append((s, t))
        top = sorted(cands, key=lambda c: -c[0])[:k]  # stable: train order on ties
        votes = Counter(classes[t] for _, t in top)
        best = max(votes.values())
        preds[q] = min(c for c, v in votes.items() if v == best)
    return preds


def test_predictions_equal_brute_force(spark):
    docs = (spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text", F.col("lang").alias("class")))
    run = knn_cross_validation(docs, TfidfConfig(), 10, 42)
    folds = {r.doc_id: r.fold for r in run.folds.collect()}
    classes = {r.doc_id: r["class"] for r in docs.select("doc_id", "class").collect()}
    rows = [(r.doc_id, r.term, r.w) for r in run.model.tfidf.collect()]
    want = _brute_force(rows, folds, classes, run.k)
    got = {r.doc_id: r.predicted for r in run.predictions.collect()}
    assert got == want


def _flow(spark):
    docs = (spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text", F.col("lang").alias("class")))
    return docs, fit_tfidf(docs, TfidfConfig())


def test_plan_has_no_cartesian_product_and_no_pair_table(spark):
    docs, m = _flow(spark)
    run = knn_cross_validation(docs, TfidfConfig(), 10, 42)
    plan = run.predictions._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    folds = spark.range(1).select(F.col("id").alias("doc_id"), F.lit(0).alias("fold"))
    top = cells.top_k(cells.document_vectors(m.tfidf, folds), cells.document_vectors(m.tfidf, folds), 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "SortMergeJoin" not in plan.split("FlatMapCoGroupsInArrow")[0]


def test_cells_equal_brute_force_whatever_the_buckets(spark, monkeypatch):
    docs, m = _flow(spark)
    folds = stratified_folds(docs, 5, 1).cache()
    vec, fold = defaultdict(dict), {r.doc_id: r.fold for r in folds.collect()}
    for r in m.tfidf.collect():
        vec[r.doc_id][r.term] = r.w
    want = {}
    for a in fold:
        for b in fold:
            dot = sum(w * vec[b].get(t, 0) for t, w in vec[a].items())
            if a < b and fold[a] != fold[b] and dot:
                na, nb = (sum(w * w for w in vec[x].values()) for x in (a, b))
                sim = dot / (math.sqrt(na) * math.sqrt(nb))
                want[a, b] = (dot, math.copysign(math.floor(abs(sim) * 1e6 + 0.5) / 1e6, sim))
    want = {p: v for p, v in want.items() if v[1]}
    v = cells.document_vectors(m.tfidf, folds).cache()
    monkeypatch.setattr(cells, "STRIP", 7)
    monkeypatch.setattr(cells, "PRODUCTS", 500)
    tops = []
    for buckets in ((1, 1), (3, 2)):
        got = cells.pairs(v, v, once=True, other_folds=True, buckets=buckets).collect()
        assert {(r.q, r.t): (int(r.dot), r.sim) for r in got} == want and len(got) == len(want)
        tops.append(sorted(tuple(r) for r in cells.top_k(v, v, 9, buckets=buckets).collect()))
    assert tops[0] == tops[1] and len(tops[0]) == 9 * len(fold)


def test_any_ids_and_any_k(spark):
    """Ids beyond 31 bits, negative ids, and a k above the number of candidates and above 1000."""
    ids = [-5, 0, 1 << 40, (1 << 62) + 1]
    rows = [(i, t, w) for i, t, w in zip(ids, "aabb", (3, 4, 5, 6))] + [(ids[0], "b", 1)]
    weights = spark.createDataFrame(rows, "doc_id long, term string, w long")
    docs = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, fold int")
    got = cells.top_k(cells.document_vectors(weights, docs), cells.document_vectors(weights, docs), 1500).collect()
    assert {(r.q, r.t): r.sim for r in got}[-5, (1 << 62) + 1] == 0.316228 and len(got) == 8


def test_first_k_is_bounded_for_any_k(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 5003).alias("t"))
    for k in (3, 1500):
        got = first_k(df, ["g"], k, [F.col("t")], F.col("t"))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "_part" in plan
        by = {g: sorted(r.t for r in df.where(f"g = {g}").collect())[:k] for g in (0, 1)}
        rows = got.collect()
        assert {g: [r.t for r in sorted(rows, key=lambda r: r._r) if r.g == g] for g in (0, 1)} == by


def test_custom_table_equals_the_cells(spark):
    """The zero fill of ``knn_neighbours`` on a table of similarities gives what the cells give."""
    docs, m = _flow(spark)
    folds = stratified_folds(docs, 10, 42)
    sims = mirror_pairs(all_pairs_similarity(m.tfidf, folds), ("fold",), ("sim",))
    a = knn_neighbours(sims, folds.select("doc_id", "fold"), 14).select("q", "rank", "t", "sim").collect()
    b = knn_cross_validation(docs, TfidfConfig(), 10, 42, k=14).neighbours.select("q", "rank", "t", "sim").collect()
    assert sorted(a) == sorted(b)


def test_stored_artefacts_take_the_place_of_computed_ones(spark, tmp_dir):
    docs, m = _flow(spark)
    first = knn_cross_validation(docs, TfidfConfig(), 10, 42)
    write_table(first.weights, f"{tmp_dir}/w")
    write_table(first.folds, f"{tmp_dir}/f", partition_by=("fold",))
    again = knn_cross_validation(docs, tfidf=spark.read.parquet(f"{tmp_dir}/w"), folds=spark.read.parquet(f"{tmp_dir}/f"))
    assert again.model is None and sorted(again.predictions.collect()) == sorted(first.predictions.collect())
    with pytest.raises(ValueError):
        knn_cross_validation(docs, tfidf=docs)


def test_fit_and_predict(spark):
    docs, _ = _flow(spark)
    model = KnnClassifier(k=5).fit(docs)
    own = {r.doc_id: r.predicted for r in model.predict(docs.select("doc_id", "text")).collect()}
    truth = {r.doc_id: r["class"] for r in docs.collect()}
    assert sum(own[i] == truth[i] for i in truth) > 0.9 * len(truth)
    with pytest.raises(ValueError):
        KnnClassifier().fit(docs.drop("class"))


def test_block_measures_see_whole_vectors(spark):
    """Weighted Jaccard by blocks against plain Python; shared sums in small parts."""
    import random

    from lexiflow.operators import cells

    r = random.Random(5)
    vec = {d: {f"t{r.randrange(30)}": r.randrange(1, 9) for _ in range(r.randrange(0, 8))} for d in range(60)}
    rows = [(d, t, w) for d, v in vec.items() for t, w in v.items()]
    weights = spark.createDataFrame(rows, "doc_id long, term string, w long")
    folds = spark.createDataFrame([(d, d % 3) for d in vec], "doc_id long, fold int")
    vectors = cells.document_vectors(weights, folds)

    def jaccard(a, b):
        least = sum(min(w, vec[b][t]) for t, w in vec[a].items() if t in vec[b])
        most = sum(vec[a].values()) + sum(vec[b].values()) - least
        return int(least / most * 1e6 + 0.5) / 1e6 if most else 0.0

    want = []
    for q in vec:
        best = sorted((-jaccard(q, t), t % 3, t) for t in vec if t % 3 != q % 3)[:5]
        want += [(q, i + 1, t, -s) for i, (s, _, t) in enumerate(best)]
    for products in (2_000_000, 7):
        old, cells.PRODUCTS = cells.PRODUCTS, products
        got = cells.top_k(vectors, vectors, 5, buckets=(2, 3), block_measure=cells.weighted_jaccard).collect()
        cells.PRODUCTS = old
        assert sorted((x["q"], x["rank"], x["t"], x["sim"]) for x in got) == sorted(want)


def test_the_smaller_side_is_copied():
    """Few queries: the train vectors go to one cell each, whatever the number of tasks."""
    assert cells._buckets(200, 50_000, 24, 2048) == (1, 25)  # 25 cells for the memory of a cell
    assert cells._buckets(200, 5_000, 24, 8192) == (1, 24)
    assert cells._buckets(50_000, 200, 24, 2048) == (25, 1)
    s_q, s_c = cells._buckets(5_000, 5_000, 24, 8192)
    assert s_q * s_c >= 24 and abs(s_q - s_c) <= 1 and cells._buckets(1, 1, 24, 8192) == (1, 1) and cells._buckets(0, 9, 4, 8) == (1, 4)
