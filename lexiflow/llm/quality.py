"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic model over text statistics gives every document a probability of good quality; it
is fitted on all labelled rows by Newton steps whose sums Spark adds up. The probabilities are added up per path
(host and section) and per host. A host's rate is shrunk towards the global one, and a path's
towards its host's, each with a prior worth so many documents as the variance of documents
within a site is times the variance between the sites of that level (both measured), so a sparse
site says little more than its parent. The verdict adds the site's log odds against the global
ones to the document's.

In ``documents`` the host is ``source`` and the path its section ``lang``. The texts are read
once, into a table of one row of numbers per document; sites are added up with partial
aggregation, so a host with a third of all rows is one row per task.

Defined cases: a null text counts as empty; texts of any length are measured whole; a quality equal
to the threshold is kept; a null source or lang is a site of its own; a
document with several labels has their mean; repeated rows count each; without labels
of both kinds every document is kept with its probability at one half; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, stored, text_or_empty
from .shingles import chunks, utf8_buffers, word_hashes

FEATURES = ("log_words", "word_length", "upper", "digits", "marks", "symbols", "other", "lines", "distinct", "short", "repeated")
_B = np.arange(256)
_GROUPS = [(_B >= 65) & (_B <= 90), (_B >= 48) & (_B <= 57), np.isin(_B, list(b".,;:!?'\"")), np.isin(_B, list(b"#*$%&|<>=~^_{}[]\\/@+")),
           _B >= 128, _B == 10]


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) of whole texts."""
    part, at = raw[offsets[0]:offsets[-1]], offsets - offsets[0]
    size = np.maximum(np.diff(at), 1)
    share = [np.diff(np.concatenate([[0], np.cumsum(g[part])])[at]) / size for g in _GROUPS]
    hashes, count = word_hashes(raw, offsets)
    letters = np.diff(np.concatenate([[0], np.cumsum((part > 32))])[at])
    distinct, repeated = np.zeros(len(count)), np.zeros(len(count))
    ends = np.cumsum(count)
    for i, (n, end) in enumerate(zip(count.tolist(), ends.tolist())):
        if n:
            _, times = np.unique(hashes[end - n:end], return_counts=True)
            distinct[i], repeated[i] = len(times) / n, times.max() / n
    words = np.maximum(count, 1)
    short = 1 / (1 + letters / words)
    return np.stack([np.log1p(count), letters / words, *share, distinct, short, repeated], axis=1)


def _sums(labelled: DataFrame, of) -> np.ndarray:
    """of(x, y), an array of numbers, added up over the tasks' batches of all rows; one row per
    task reaches the driver."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(-1, len(FEATURES))
                part = of(x, batch.column(1).to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    rows = labelled.select("x", "y").mapInArrow(run, "s array<double>").collect()
    return np.sum([r["s"] for r in rows], axis=0) if rows else np.zeros(0)


def fit_logistic(labelled: DataFrame, ridge: float = 1.0, rounds: int = 25) -> tuple[float, np.ndarray]:
    """Intercept and weights for unscaled features, by Newton steps on the penalised likelihood of
    all rows (x, y); zeros without labels of both kinds."""
    k = len(FEATURES)
    r = labelled.agg(F.min("y").alias("least"), F.max("y").alias("most"), F.count(F.lit(1)).alias("n")).first()
    if not r["n"] or not r["least"] < 0.5 <= r["most"]:
        return 0.0, np.zeros(k)
    mean = _sums(labelled, lambda x, y: x.sum(axis=0)) / r["n"]
    scale = np.sqrt(_sums(labelled, lambda x, y: ((x - mean) ** 2).sum(axis=0)) / r["n"]) + 1e-9
    w, penalty = np.zeros(k + 1), np.r_[1e-6, np.full(k, ridge)]

    def step_sums(x, y):
        z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        return np.concatenate([z.T @ (y - p), ((z * (p * (1 - p) + 1e-9)[:, None]).T @ z).ravel()])

    for _ in range(rounds):
        sums = _sums(labelled, step_sums)
        step = np.linalg.solve(sums[k + 1:].reshape(k + 1, k + 1) + np.diag(penalty), sums[:k + 1] - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0] - (w[1:] * mean / scale).sum()), w[1:] / scale


def _measure(batches):
    for batch in batches:
        raw, offsets = utf8_buffers(batch.column(4))
        for lo, hi in chunks(offsets):
            x = features(raw, offsets[lo:hi + 1])
            ends = np.arange(hi - lo + 1, dtype=np.int32) * len(FEATURES)
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(lo, hi - lo) for c in batch.columns[:4]), pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))],
                names=["k_id", "k_text", "host", "path", "x"])


def site_strength(within: float, spread: float, documents: float, free: float) -> float:
    """Documents that a site's prior is worth, from 2 to 1,000,000. ``within``: variance of documents in
    a site, ``spread``: squared distances of site means from their parent's, summed over the
    documents, ``free``: sites less parents."""
    between = (spread - free * within) / documents if documents else 0.0
    return min(1e6, max(2.0, within / between)) if between > 0 else 1e6


def quality_scores(docs: DataFrame, labels: DataFrame, site_weight: float = 1.0, threshold: float = 0.5) -> DataFrame:
    """k_id, k_text, host, path, p_doc, p_host, p_path, quality, kept of every row of ``docs``."""
    rows = stored(docs.select(*row_key(), F.col("source").cast("string").alias("host"), F.col("lang").cast("string").alias("path"),
                              text_or_empty().alias("t"))
                  .mapInArrow(_measure, "k_id long, k_text long, host string, path string, x array<double>"), "text-statistics")
    truth = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    start, weights = fit_logistic(stored(rows.join(truth, F.col("k_id") == F.col("doc_id")).select("x", "y"), "labelled-statistics"))
    logit = F.lit(start)
    for i, w in enumerate(weights):
        logit = logit + F.col("x")[i] * F.lit(float(w))
    rows = stored(rows.select("k_id", "k_text", "host", "path", (1 / (1 + F.exp(-logit))).alias("p")), "document-evidence")

    mean = min(1 - 1e-6, max(1e-6, rows.agg(F.avg("p")).first()[0] or 0.5))
    sums = stored(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")),
                  "path-sums")
    hosts = stored(sums.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("paths"),
                                            F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("t")), "host-sums")
    # squared distances: of documents from their path's mean, of paths from their host's, of hosts from all
    r = hosts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hosts"), F.sum("paths").alias("paths"), F.sum(F.col("q") - F.col("t")).alias("inner"),
                  F.sum(F.col("t") - F.col("s") * F.col("s") / F.col("n")).alias("path_spread"),
                  F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.lit(mean), F.lit(2.0))).alias("host_spread")).first()
    n = r["n"] or 0
    within = max(0.0, r["inner"] or 0.0) / max(1, n - (r["paths"] or 0))
    strength = site_strength(within, r["host_spread"] or 0.0, n, r["hosts"] - 1)
    path_strength = site_strength(within, r["path_spread"] or 0.0, n, (r["paths"] or 0) - r["hosts"])
    hosts = hosts.select("host", ((F.col("s") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))).alias("p_host"))
    paths = sums
    paths, hosts = paths.alias("x"), hosts.alias("y")
    site = paths.join(hosts, F.col("x.host").eqNullSafe(F.col("y.host"))).select(
        F.col("x.host").alias("s_host"), F.col("x.path").alias("s_path"), "p_host",
        ((F.col("s") + F.col("p_host") * F.lit(path_strength)) / (F.col("n") + F.lit(path_strength))).alias("p_path"))
    site = stored(site, "site-posteriors")
    odds = lambda p: F.log(p / (1 - p))
    held = lambda p: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    joined = rows.join(site, rows["host"].eqNullSafe(site["s_host"]) & rows["path"].eqNullSafe(site["s_path"]))
    total = odds(held(F.col("p"))) + F.lit(site_weight) * (odds(held(F.col("p_path"))) - F.lit(math.log(mean / (1 - mean))))
    quality = 1 / (1 + F.exp(-total))
    return joined.select("k_id", "k_text", "host", "path", F.col("p").alias("p_doc"), "p_host", "p_path",
                         quality.alias("quality"), (quality >= threshold).alias("kept"))
