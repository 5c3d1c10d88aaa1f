"""k-nearest-neighbour classification over sparse similarities.

Candidates of a query are all documents of the other folds; neighbours are ranked by
(similarity desc, fold, doc_id) — the train order of the reference (folds in order,
rows in index order) under a stable sort — and the label vote takes the most
frequent class, ties to the smallest label. Documents that share no term with the query
have similarity 0 and are candidates too.

``cross_validated_neighbours`` keeps the k best of a block of documents while it reads all blocks
(``cells.own_top_k``), ``predict_texts`` reduces to the k best inside document
cells (``cells.top_k``), zero similarities included. ``knn_neighbours`` takes any table of
non-zero similarities instead. There, zero-similarity candidates are never materialised
as pairs: let a query have p positive and m negative non-zero similarities. If p < k, the
first k+m candidates in train order hold at least k−p zero-similarity documents (at most
p+m of them are non-zero), so only those k+m are generated — by an equi-join with the
first rows of every fold — and the non-zero ones are removed with an anti-join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from ..sources.corpus import require_columns
from . import cells
from .ranking import range_rank


def k_from_size(n_docs: int) -> int:
    """k = ⌊√N⌋ (at least 1)."""
    return max(1, int(math.isqrt(int(n_docs))))


PARTS = 64  # parts of a group ranked side by side before they are merged


def first_k(df: DataFrame, by: Sequence[str], k: int, order: list[Column], part: Column) -> DataFrame:
    """The first ``k`` rows of every group, with their place ``_r`` from 1. Each group is ranked in
    PARTS hashed parts, and only k rows of a part meet, whatever k is."""
    parts = F.pmod(F.xxhash64(part), F.lit(PARTS))
    inner = Window.partitionBy(*by, "_part").orderBy(*order)
    cut = df.withColumn("_part", parts).withColumn("_r", F.row_number().over(inner)).where(F.col("_r") <= k)
    return (cut.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
            .where(F.col("_r") <= k).drop("_part"))


def _top(df: DataFrame, k: int, order: list) -> DataFrame:
    return first_k(df, ["q"], k, order, F.col("t")).drop("_r")


def knn_neighbours(sims: DataFrame, docs_folds: DataFrame, k: int, has_negative: bool | None = None,
                   n_folds: int | None = None, queries: DataFrame | None = None) -> DataFrame:
    """Top-k neighbours per query: (q, fold_q, rank, t, fold_t, sim).

    ``sims``: ordered pairs (q, t, fold_q, fold_t, sim) with non-zero (rounded) sim between
    documents of different folds. ``docs_folds``: (doc_id, fold) of every document, folds
    numbered 0..n_folds-1; all of them are candidates, and queries unless ``queries``
    (doc_id, fold) names the documents to predict.
    """
    order = [F.col("sim").desc(), F.col("fold_t"), F.col("t")]
    pos_top = _top(sims.where(F.col("sim") > 0), k, order)

    stats = sims.groupBy("q").agg(F.count_if(F.col("sim") > 0).alias("p"), F.count_if(F.col("sim") < 0).alias("m"))
    queries = (docs_folds if queries is None else queries).select(F.col("doc_id").alias("q"), F.col("fold").alias("fold_q"))
    fill = (queries.join(stats, "q", "left").fillna(0, subset=["p", "m"]).where(F.col("p") < k))

    if has_negative is None:
        has_negative = sims.where(F.col("sim") < 0).limit(1).count() > 0
    if has_negative:
        neg_top = _top(sims.where(F.col("sim") < 0).join(fill.select("q"), "q", "left_semi"), k, order)
        max_m = fill.agg(F.max("m")).first()[0] or 0
    else:
        neg_top = None
        max_m = 0
    head_len = k + int(max_m)

    # first head_len documents of every fold, by id
    rows = docs_folds.select(F.col("doc_id").alias("t"), F.col("fold").alias("g"))
    heads = first_k(rows, ["g"], head_len, [F.col("t")], F.col("t")).select("t", "g", (F.col("_r") - 1).alias("r"))
    sizes = docs_folds.groupBy(F.col("fold").alias("g")).agg(F.count(F.lit(1)).alias("size_g"))
    sizes = sizes.withColumn("before_g", F.coalesce(
        F.sum("size_g").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if n_folds is None:
        n_folds = int(docs_folds.agg(F.max("fold")).first()[0] or 0) + 1
    f_lo, f_hi = 0, n_folds - 1
    fq_size = sizes.select(F.col("g").alias("fold_q"), F.col("size_g").alias("size_q"))
    # per fill query and other fold g: how many of g's first rows fall in its first L candidates
    per_fold = (fill.withColumn("L", F.lit(k) + F.col("m"))
                .join(fq_size, "fold_q")
                .withColumn("g", F.explode(F.sequence(F.lit(f_lo), F.lit(f_hi))))
                .where(F.col("g") != F.col("fold_q"))
                .join(sizes, "g")
                .withColumn("off", F.col("before_g") - F.when(F.col("fold_q") < F.col("g"), F.col("size_q")).otherwise(0))
                .withColumn("need", F.least(F.col("size_g"), F.greatest(F.lit(0), F.col("L") - F.col("off"))))
                .where(F.col("need") > 0))
    cand = (per_fold.select("q", "fold_q", "g", F.explode(F.sequence(F.lit(0), F.col("need") - 1)).alias("r"))
            .join(heads, ["g", "r"])
            .select("q", "fold_q", "t", F.col("g").alias("fold_t")))
    # non-zero pairs of the queries that need filling only (fewer than k + m per query):
    # a semi-join with the fill set, broadcast by AQE when that set is small
    nz = sims.select("q", "t").join(fill.select("q"), "q", "left_semi")
    zeros = cand.join(nz, ["q", "t"], "left_anti").withColumn("sim", F.lit(0.0))

    cols = ["q", "fold_q", "t", "fold_t", "sim"]
    allc = pos_top.select(*cols).unionByName(zeros.select(*cols))
    if neg_top is not None:
        allc = allc.unionByName(neg_top.select(*cols))
    w = Window.partitionBy("q").orderBy(*order)
    return (allc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("q", "fold_q", "rank", "t", "fold_t", "sim"))


def count_votes(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """(q, t_class, votes): neighbours of every class. ``labels``: (doc_id, class)."""
    lab = labels.select(F.col("doc_id").alias("t"), F.col("class").alias("t_class"))
    return neighbours.join(lab, "t").groupBy("q", "t_class").agg(F.count(F.lit(1)).alias("votes"))


def most_votes(votes: DataFrame) -> DataFrame:
    """(q, predicted): the class with most of ``votes`` (q, t_class, votes), ties to the smallest label."""
    w = Window.partitionBy("q").orderBy(F.col("votes").desc(), F.col("t_class"))
    return (votes.withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .select("q", F.col("t_class").alias("predicted")))


def vote(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """(q, predicted): most frequent neighbour class, ties to the smallest label.
    ``labels``: (doc_id, class)."""
    return most_votes(count_votes(neighbours, labels))


def predict(neighbours: DataFrame, docs_folds: DataFrame) -> DataFrame:
    """(doc_id, fold, actual, predicted) for every document. ``docs_folds``: (doc_id, class, fold)."""
    return predict_by_votes(count_votes(neighbours, docs_folds.select("doc_id", "class")), docs_folds)


def predict_by_votes(votes: DataFrame, docs_folds: DataFrame) -> DataFrame:
    """``predict`` from votes (q, t_class, votes)."""
    return (docs_folds.join(most_votes(votes).withColumnRenamed("q", "doc_id"), "doc_id", "left")
            .select("doc_id", "fold", F.col("class").alias("actual"), "predicted"))


def cross_validated_neighbours(weights: DataFrame, folds: DataFrame, k: int, measure: cells.Measure = cells.cosine_measure,
                               digits: int = 6, weight: str = "w", block_measure: cells.BlockMeasure | None = None) -> DataFrame:
    """Neighbours of every document of ``folds`` (doc_id, fold) among the documents of the other
    folds — the pooled result of all folds in one plan. A column ``label`` (int) of ``folds`` comes back as the neighbour's."""
    also = [c for c in folds.columns if c == "label"]
    keys = folds.select(F.struct("fold", "doc_id", *also).alias("key"))
    places = range_rank(keys, "key", "place").select("key.doc_id", "key.fold", *(f"key.{c}" for c in also), "place")
    vectors = cells.document_vectors(weights, places, weight, also=["place", *also])
    return cells.own_top_k(vectors, k, folds.count(), measure, digits, block_measure)


def cross_validated_votes(weights: DataFrame, folds: DataFrame, k: int, measure: cells.Measure = cells.cosine_measure,
                          digits: int = 6, weight: str = "w", block_measure: cells.BlockMeasure | None = None) -> DataFrame:
    """``count_votes`` of ``cross_validated_neighbours`` of ``folds`` (doc_id, class, fold). A class travels with its vector as
    a number and a task adds up the votes of its queries, so the k neighbours of a document are neither
    stored nor shuffled. Documents listed twice may have several classes: their neighbours are joined with all of them."""
    run = lambda docs: cross_validated_neighbours(weights, docs, k, measure, digits, weight, block_measure)
    if not folds.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        return count_votes(stored(run(folds.select("doc_id", "fold")), "neighbours"), folds.select("doc_id", "class"))
    labels = folds.select("class").distinct()
    codes = stored(range_rank(labels, "class", "label").select(F.col("class").alias("t_class"), F.col("label").cast("int").alias("label")), "labels")
    coded = folds.join(codes, F.col("class").eqNullSafe(F.col("t_class"))).select("doc_id", "fold", "label")
    votes = run(coded).groupBy("q", "label").agg(F.count(F.lit(1)).alias("votes"))
    return votes.join(codes, "label").select("q", "t_class", "votes")


def predict_vectors(queries: DataFrame, train: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """Neighbours and votes of query vectors among train vectors (both doc_id, terms, weights):
    (doc_id, rank, t, sim, predicted), ties to train order (doc id)."""
    found = stored(cells.top_k(queries.withColumn("fold", F.lit(0)), train.withColumn("fold", F.lit(1)), k), "neighbours")
    votes = vote(found, classes)
    return found.join(votes, "q").select(F.col("q").alias("doc_id"), "rank", "t", "sim", "predicted")


def train_vectors(weights: DataFrame, train: DataFrame, weight: str = "w") -> DataFrame:
    """Vectors of a train set, as a stored table that later predictions read."""
    return stored(cells.document_vectors(weights, train.select("doc_id", F.lit(1).alias("fold")), weight), "train-vectors")


def predict_texts(texts: DataFrame, model, train: DataFrame, k: int, cfg=None, vectors: DataFrame | None = None) -> DataFrame:
    """Classify new texts (doc_id, text) against a labelled train set (doc_id, class) under a
    fitted TF-IDF ``model``: (doc_id, rank, t, sim, predicted) — one query × all train
    documents, zero-similarity documents included. ``vectors``: of ``train_vectors``."""
    from .tfidf import TfidfConfig, transform_texts

    weights = transform_texts(texts, model, cfg or TfidfConfig())
    queries = cells.document_vectors(weights, texts.select("doc_id", F.lit(0).alias("fold")))
    vectors = train_vectors(model.tfidf, train) if vectors is None else vectors
    return predict_vectors(queries, vectors, train.select("doc_id", "class"), k)


class KnnClassifier:
    """``fit`` a TF-IDF kNN classifier on (doc_id, text, class), ``predict`` new (doc_id, text)."""

    def __init__(self, k: int | None = None, cfg=None) -> None:
        self.k, self.cfg = k, cfg

    def fit(self, docs: DataFrame) -> KnnClassifier:
        from .tfidf import TfidfConfig, fit_tfidf

        require_columns(docs, ["doc_id", "text", "class"], "training documents")
        self.cfg = self.cfg or TfidfConfig()
        self.model = fit_tfidf(docs, self.cfg)
        self.k = self.k or k_from_size(docs.count())
        self.train = docs.select("doc_id", "class")
        self.vectors = train_vectors(self.model.tfidf, self.train)
        return self

    def neighbours(self, texts: DataFrame) -> DataFrame:
        require_columns(texts, ["doc_id", "text"], "texts")
        return predict_texts(texts, self.model, self.train, self.k, self.cfg, self.vectors)

    def predict(self, texts: DataFrame) -> DataFrame:
        """(doc_id, predicted)."""
        return self.neighbours(texts).where("rank = 1").select("doc_id", "predicted")
