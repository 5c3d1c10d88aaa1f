import numpy as np

from lexiflow.llm import quality

from .conftest import texts_frame


def fit(x, y, ridge=1.0):
    """Newton steps on all rows at once."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, penalty = np.zeros(z.shape[1]), np.r_[1e-6, np.full(x.shape[1], ridge)]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w + np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
    return 1 / (1 + np.exp(-z @ w))


def test_fit_reads_every_labelled_row(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["ab", "Cde", "x1", "?!", "long-word", "#"], rng.integers(1, 12))) for _ in range(7000)]
    labels = [(i, int(rng.random() < 0.3 + 0.4 * ("#" in t))) for i, t in enumerate(texts)]
    docs = texts_frame(spark, [(i, t, "en", f"h{i % 5}") for i, t in enumerate(texts)])
    got = {r.k_id: r.p_doc for r in quality.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    data = [t.encode() for t in texts]
    x = quality.features(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    want = fit(x, np.array([q for _, q in labels], float))
    assert np.abs(np.array([got[i] for i in range(len(texts))]) - want).max() < 1e-6
