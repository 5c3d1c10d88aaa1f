"""Stratified folds, class statistics, quotas and train/test splits.

Stratified rule (same per-(class, fold) counts as the public library's stratified
K-fold with shuffling): classes ordered by first appearance (smallest doc id), the
rows of class c take positions offset(c) .. offset(c)+n(c)-1 of that order, a row's
position inside its class is its rank by a seeded md5 hash, and the fold is
position mod K. The member lists of the library's own random generator are not
reproduced (its seed drives a different generator). Documents without a class are a class
of their own. Windows without a partition run over one row per class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .knn import first_k
from .ranking import prefix_rank, seeded_hash


def class_table(docs: DataFrame, class_col: str = "class", id_col: str = "doc_id") -> DataFrame:
    """(class, cnt, first_id, offset): one row per class, ``offset`` = rows of classes seen
    earlier. The window runs over the class table only (one row per class)."""
    t = docs.groupBy(F.col(class_col).alias("class")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min(id_col).alias("first_id"))
    w = Window.orderBy("first_id", "class").rowsBetween(Window.unboundedPreceding, -1)
    return t.withColumn("offset", F.coalesce(F.sum("cnt").over(w), F.lit(0)).cast("bigint"))


def stratified_folds(docs: DataFrame, k: int = 10, seed: int = 42, class_col: str = "class",
                     id_col: str = "doc_id") -> DataFrame:
    """(doc_id, class, fold)."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(class_col).alias("class"))
    base = base.withColumn("_h", seeded_hash("doc_id", seed))
    ranked = prefix_rank(base, ["class"], "_h", "doc_id", out="_rn")
    offs = class_table(base, "class", "doc_id").select(F.col("class").alias("_class"), "offset")
    return (ranked.join(offs, F.col("class").eqNullSafe(F.col("_class")))
            .select("doc_id", "class", ((F.col("offset") + F.col("_rn")) % F.lit(k)).cast("int").alias("fold")))


def class_counts(docs: DataFrame, class_col: str = "class") -> DataFrame:
    """(class, cnt)."""
    return docs.groupBy(F.col(class_col).alias("class")).agg(F.count(F.lit(1)).alias("cnt"))


def _n_docs(docs: DataFrame) -> Column:
    return docs.select(F.count(F.lit(1)).cast("double")).scalar()


def class_percentages(docs: DataFrame, class_col: str = "class") -> DataFrame:
    """(class, cnt, pct) with pct = round(cnt·100 / N, 4), half-even as Python's round."""
    n = _n_docs(docs)
    return class_counts(docs, class_col).withColumn(
        "pct", F.bround((F.col("cnt").cast("double") * F.lit(100.0)) / n, 4))


def fold_quotas(docs: DataFrame, k: int = 10, class_col: str = "class") -> DataFrame:
    """(class, cnt, pct, rows_per_fold, quota): quota = int(round(N/K · pct / 100)), half-even."""
    n = _n_docs(docs)
    per_fold = n / F.lit(float(k))
    return class_percentages(docs, class_col).select(
        "class", "cnt", "pct", per_fold.alias("rows_per_fold"),
        F.bround((per_fold * F.col("pct")) / F.lit(100.0), 0).cast("int").alias("quota"))


def quota_folds(docs: DataFrame, k: int = 10, seed: int = 42, class_col: str = "class",
                id_col: str = "doc_id") -> DataFrame:
    """(doc_id, class, fold) by per-class quotas: every fold takes ``quota`` rows of each class
    in seeded-hash order while rows last; rows left over after K folds are dealt round-robin
    from fold 0 in the same hash order over all classes."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(class_col).alias("class"))
    base = base.withColumn("_h", seeded_hash("doc_id", seed))
    ranked = prefix_rank(base, ["class"], "_h", "doc_id", out="_rn")
    q = fold_quotas(base, k, "class").select(F.col("class").alias("_class"), "quota")
    r = ranked.join(q, F.col("class").eqNullSafe(F.col("_class"))).drop("_class")
    in_quota = (F.col("quota") > 0) & (F.col("_rn") < F.col("quota") * F.lit(k))
    placed = r.where(in_quota).select("doc_id", "class", (F.col("_rn") / F.col("quota")).cast("int").alias("fold"))
    left = r.where(~in_quota).select("doc_id", "class", "_h").withColumn("_g", F.lit(0))
    dealt = prefix_rank(left, ["_g"], "_h", "doc_id", out="_lr").select(
        "doc_id", "class", (F.col("_lr") % F.lit(k)).cast("int").alias("fold"))
    return placed.unionByName(dealt)


def train_test_split(folds: DataFrame, k: int) -> DataFrame:
    """(fold, split, doc_id, class): for every fold i, its own rows are 'test', all others 'train'.
    Linear (K rows per document), no join."""
    ex = folds.select("doc_id", "class", F.col("fold").alias("_own"),
                      F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
    return ex.select("fold", F.when(F.col("fold") == F.col("_own"), F.lit("test")).otherwise(F.lit("train")).alias("split"),
                     "doc_id", "class")


def drop_first_n_per_class(docs: DataFrame, n: int = 40, class_col: str = "class", id_col: str = "doc_id") -> DataFrame:
    """Rows left after removing the first ``n`` documents (by id) of every class.
    The first-n table is a bounded top-n for any n."""
    first = first_k(docs.select(id_col, class_col), [class_col], n, [F.col(id_col)], F.col(id_col))
    first = first.select(F.col(id_col).alias("_first_id"), F.col(class_col).alias("_first_class"))
    same = F.col(id_col).eqNullSafe(F.col("_first_id")) & F.col(class_col).eqNullSafe(F.col("_first_class"))  # an id may be in two classes
    return docs.join(first, same, "left_anti")


def distinct_classes(docs: DataFrame, class_col: str = "class") -> DataFrame:
    return docs.select(F.col(class_col).alias("class")).distinct()
