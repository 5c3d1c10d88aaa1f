"""TF-IDF kNN flow: clean → TF-IDF → stratified folds → kNN → metrics.

All folds are predicted in one plan (fold is a column). Weights and folds are stored once
and read by the branches; a stored TF-IDF table or stored folds of an earlier run take
their place when given. Predictions, scores and metrics read the votes of the classes, at most documents x
classes rows; the neighbours, documents x k rows, are computed only where a caller asks for them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cells import BlockMeasure, Measure, cosine_measure
from ..operators.folds import distinct_classes, stratified_folds
from ..operators.knn import cross_validated_neighbours, cross_validated_votes, k_from_size, predict_by_votes
from ..operators.metrics import macro_metrics
from ..operators.tfidf import TfidfConfig, TfidfModel, fit_tfidf
from ..session import stored
from ..sources.corpus import require_columns


@dataclass
class KnnRun:
    """``compare`` is given ``cross_validated_neighbours`` or ``cross_validated_votes`` and runs it on this run's tables."""
    model: TfidfModel | None
    weights: DataFrame
    folds: DataFrame
    k: int
    docs: DataFrame
    compare: Callable[[Callable[..., DataFrame]], DataFrame]

    @cached_property
    def neighbours(self) -> DataFrame:
        """(q, fold_q, rank, t, fold_t, sim); not stored, every reading compares all documents."""
        return self.compare(cross_validated_neighbours)

    @cached_property
    def votes(self) -> DataFrame:
        """(q, t_class, votes), stored."""
        return stored(self.compare(cross_validated_votes), "votes")

    @cached_property
    def predictions(self) -> DataFrame:
        return predict_by_votes(self.votes, self.folds)

    @cached_property
    def metrics(self) -> DataFrame:
        return macro_metrics(self.predictions, distinct_classes(self.docs))


def knn_cross_validation(docs: DataFrame, cfg: TfidfConfig = TfidfConfig(), n_folds: int = 10, seed: int = 42,
                         k: int | None = None, measure: Measure = cosine_measure, digits: int = 6,
                         tfidf: DataFrame | None = None, folds: DataFrame | None = None,
                         block_measure: BlockMeasure | None = None) -> KnnRun:
    """``docs``: (doc_id, text, class). k defaults to ⌊√N⌋ (one count job). ``measure``: similarity
    of (dot, |q|², |t|²), or ``block_measure``: any similarity of two blocks of vectors. ``tfidf`` (doc_id, term, w) and ``folds`` (doc_id, class, fold):
    stored tables to use instead of computing them."""
    require_columns(docs, ["doc_id", "class"], "documents")
    model = fit_tfidf(docs, cfg) if tfidf is None else None
    weights = require_columns(model.tfidf if model else tfidf, ["doc_id", "term", "w"], "TF-IDF table")
    folds = stored(stratified_folds(docs, n_folds, seed), "folds") if folds is None else require_columns(
        folds, ["doc_id", "class", "fold"], "folds").withColumn("fold", F.col("fold").cast("int"))
    if k is None:
        k = k_from_size(docs.count())
    return KnnRun(model, weights, folds, k, docs, lambda fn: fn(weights, folds, k, measure, digits, block_measure=block_measure))
