import numpy as np

from lexiflow.llm import quality, queries

from .conftest import texts_frame

SF = "/root/testdata/sf0.01"


def test_agrees_with_the_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries.op4_quality_bayes(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    good = [got[i].kept for i, q in labels.items() if q == 1]
    bad = [got[i].kept for i, q in labels.items() if q == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_site_posteriors_match_brute_force(spark):
    got = queries.op4_quality_bayes(spark, SF).collect()
    p = np.array([r.p_doc for r in got])
    mean = p.mean()

    def level(keys):
        groups = {}
        for k, x in zip(keys, p):
            groups.setdefault(k, []).append(x)
        return groups

    hosts, paths = level([r.host for r in got]), level([(r.host, r.path) for r in got])
    within = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in paths.values()) / (len(p) - len(paths))
    strength = lambda spread, free: quality.site_strength(within, spread, len(p), free)
    s = strength(sum(len(v) * (np.mean(v) - mean) ** 2 for v in hosts.values()), len(hosts) - 1)
    t = strength(sum(len(v) * (np.mean(v) - np.mean(hosts[k[0]])) ** 2 for k, v in paths.items()), len(paths) - len(hosts))
    p_host = {k: (sum(v) + mean * s) / (len(v) + s) for k, v in hosts.items()}
    for r in got:
        v = paths[r.host, r.path]
        p_path = (sum(v) + p_host[r.host] * t) / (len(v) + t)
        assert abs(r.p_host - p_host[r.host]) < 1e-9 and abs(r.p_path - p_path) < 1e-9
        hold = min(1 - 1e-6, max(1e-6, r.p_doc))
        total = np.log(hold / (1 - hold)) + np.log(p_path / (1 - p_path)) - np.log(mean / (1 - mean))
        assert abs(r.quality - 1 / (1 + np.exp(-total))) < 1e-9 and r.kept == (r.quality >= 0.5)


def test_sites_change_verdicts_of_borderline_documents(spark):
    """Middling documents stay on a good host and go on a bad one, whose documents are mostly bad."""
    rng = np.random.default_rng(1)
    def text(bad):
        words = [f"w{rng.integers(10**6)}" for _ in range(60)]
        return " ".join("SPAM!!" if i < bad else w for i, w in enumerate(words))
    rows = [(i, text(0 if i % 20 else 60), "en", f"good{i % 5}") for i in range(300)]
    rows += [(1000 + i, text(60 if i % 5 else 0), "en", "bad") for i in range(100)]
    rows += [(2000 + i, text(int(b)), "en", h) for i, (b, h) in enumerate((b, h) for b in np.linspace(2, 58, 57) for h in ("good0", "bad"))]
    labels = spark.createDataFrame([(i, int(t.count("SPAM") < 30)) for i, t, _, _ in rows if i < 2000 or i % 3 == 0], "doc_id long, quality int")
    got = quality.quality_scores(texts_frame(spark, rows), labels).collect()
    changed = {(r.host[:4], r.kept) for r in got if r.kept != (r.p_doc >= 0.5)}
    assert changed <= {("bad", False), ("good", True)} and changed


def test_sparse_sites_say_little(spark):
    rng = np.random.default_rng(0)
    text = lambda good: " ".join(f"w{rng.integers(10**6)}" if good else "SPAM!!" for _ in range(60))
    rows = [(i, text(i % 10 > 0), "en", f"h{i % 7}") for i in range(200)] + [(1000 + i, text(False), "en", "bad") for i in range(60)]
    rows += [(2000, text(False), "en", "tiny")]
    labels = spark.createDataFrame([(i, int(i < 1000 and i % 10 > 0)) for i, *_ in rows if i < 2000], "doc_id long, quality int")
    got = {r.k_id: r for r in quality.quality_scores(texts_frame(spark, rows), labels).collect()}
    assert got[1000].p_host < 0.1 < got[2000].p_host and got[11].kept and not got[1000].kept


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(7, 1), (8, 0), (8, 0), (None, 1), (1, None), (99, 1)], "doc_id long, quality int")
    for used in (labels, labels.where("quality = 1"), labels.limit(0)):
        got = quality.quality_scores(awkward, used).collect()
        assert len(got) == awkward.count() and all(0 <= r.quality <= 1 for r in got)
        assert quality.quality_scores(nothing, used).collect() == []
    assert {(r.p_doc, r.kept) for r in got} == {(0.5, True)}
