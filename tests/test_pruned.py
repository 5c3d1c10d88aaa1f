import pytest

from lexiflow.operators import pruned, simjoin
from tests.test_simjoin import frame, vectors


def brute(vec, folds, queries, k):
    out = []
    for q in queries:
        found = []
        for t in vec:
            dot = sum(w * vec[t].get(x, 0) for x, w in vec[q].items())
            den = (sum(w * w for w in vec[q].values()) ** 0.5) * (sum(w * w for w in vec[t].values()) ** 0.5)
            sim = int(dot / den * 1e6 + 0.5) / 1e6 if den and dot > 0 else 0.0
            if folds[q] != folds[t] and sim > 0:
                found.append((-sim, folds[t], t))
        out += [(q, r, t, f, -s) for r, (s, f, t) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def tables(spark, vec, folds, queries):
    return (frame(spark, vec), spark.createDataFrame([(q,) for q in queries], "doc_id long"),
            spark.createDataFrame(list(folds.items()), "doc_id long, fold int"))


@pytest.mark.parametrize("k,part", [(1, (8192, 512)), (5, (7, 3)), (300, (8192, 512))])
def test_equals_brute_force(spark, k, part):
    """Negative weights, copies (ties), vectors without entries, fewer than k neighbours, parts of hot terms."""
    vec = vectors(150, 60, 3, copies=40)
    folds = {d: d % 4 for d in vec}
    queries = [d for d in vec if d % 3 == 0]
    w, q, f = tables(spark, vec, folds, queries)
    got = pruned.top_k(w, q, f, k, per_part=part)
    assert sorted(map(tuple, got.collect())) == brute(vec, folds, queries, k)


@pytest.mark.parametrize("n", [200, 400])
def test_bounds_skip_candidates(spark, n):
    """Every vector shares a weak common term, so all pairs are similar; those with a nearer group are skipped."""
    vec = {d: {"common": 1, f"g{d // 8}": 10, f"own{d}": 3} for d in range(n)}
    folds = {d: d % 8 for d in vec}
    w, q, f = tables(spark, vec, folds, [d for d in vec if d % 4 == 0])
    w = w.where("doc_id IS NOT NULL")
    queries = q.join(f, "doc_id")
    entries = simjoin.prefixes(w, 0.0)
    bounds = pruned.lower_bounds(entries, w, queries, f, 7)
    assert bounds.count() == n // 4
    assert pruned.candidate_pairs(entries, queries, f, bounds).count() == n // 4 * 7  # not n / 4 * n * 7 / 8
    got = pruned.top_k(w, q, f, 7).collect()
    assert sorted(map(tuple, got)) == brute(vec, folds, [d for d in vec if d % 4 == 0], 7)


def test_empty_tables_and_repeated_queries(spark):
    vec = {1: {"a": 1}, 2: {"a": 2}, 3: {}}
    w, q, f = tables(spark, vec, {1: 0, 2: 1, 3: 1}, [1, 1, 3, 9])
    assert [tuple(r) for r in pruned.top_k(w, q, f, 2).collect()] == [(1, 1, 2, 1, 1.0)]
    for empty in (pruned.top_k(w.limit(0), q, f, 2), pruned.top_k(w, q.limit(0), f, 2), pruned.top_k(w, q, f.limit(0), 2)):
        assert empty.collect() == []
    with pytest.raises(ValueError):
        pruned.top_k(w, q, f, 0)


def test_no_entries_and_no_pairs_are_shuffled(spark):
    """Behind the stored blocks nothing moves but the blocks of queries."""
    vec = vectors(60, 20, 3, copies=4)
    w, q, f = tables(spark, vec, {d: d % 4 for d in vec}, [d for d in vec if d % 3 == 0])
    plan = pruned.top_k(w, q, f, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "Exchange" not in plan.split("MapInArrow")[0]
