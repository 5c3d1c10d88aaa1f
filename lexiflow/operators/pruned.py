"""The k nearest documents of chosen query documents, with candidates skipped by bounds.

``top_k`` stores the vectors in blocks once. The task of a block of queries reads all blocks one after another and
keeps the k best of every query so far (``cells.own_top_k``); the k-th of them is a lower bound of what may still come in. In a
block the products of its rare terms are added up first. What is left of both vectors lies in its frequent terms, so
products so far plus the product of the lengths of both rests is an upper bound; pairs below the query's bound are left out, the
others are computed on the whole vectors. Neither entries nor pairs are shuffled or written. All pairs of queries and
documents still meet in their rare terms, so the time grows with their product.

``lower_bounds`` and ``candidate_pairs`` find the pairs by joins of entries:

1. Heads: the entries of every term in order of impact, the largest first. A query meets the
   heads of its strongest terms, and these pairs are computed exactly. The k-th best of them is a
   lower bound of the query's k-th best similarity.
2. Prefix: the query's terms until what is left of its vector is shorter than that bound. A
   candidate that shares none of them can't reach the bound, whatever follows. Prefixes meet
   all entries of their terms.
3. Residuals: all other shared terms lie behind the query's prefix and behind the last term met, so
   the same upper bound holds for the rests there.

A query with fewer than k similar documents so far has no bound and nothing is skipped. The result is exact for every k; how much
is skipped depends on how far the k-th best stands out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .cells import document_vectors, own_top_k
from .knn import first_k
from .ranking import range_rank
from .simjoin import confirmed

#: Strongest terms of a query that meet heads, and entries of a head as a multiple of k.
SEED_TERMS, HEAD = 4, 2
#: Entries of a term that meet in one part: candidates, queries.
PER_PART = (8192, 512)
#: Documents of a block at most: candidates, queries.
PER_BLOCK = (8192, 4096)


def _ranked(sims: DataFrame, folds: DataFrame, k: int) -> DataFrame:
    """(q, rank, t, fold_t, sim): the k largest similarities above 0 of every query, ties by fold and id."""
    named = folds.select(F.col("doc_id").alias("t"), F.col("fold").alias("fold_t"))
    rows = sims.where("sim > 0").select(F.col("lo").alias("q"), F.col("hi").alias("t"), "sim").join(named, "t")
    order = [F.col("sim").desc(), F.col("fold_t"), F.col("t")]
    return first_k(rows, ["q"], k, order, F.col("t")).select("q", F.col("_r").cast("int").alias("rank"), "t", "fold_t", "sim")


def lower_bounds(entries: DataFrame, weights: DataFrame, queries: DataFrame, folds: DataFrame, k: int, digits: int = 6, weight: str = "w") -> DataFrame:
    """(q, bound): the k-th best similarity of a query among the heads of its strongest terms; queries with
    fewer than k there are left out."""
    own = entries.join(queries.select("doc_id", "fold"), "doc_id")
    own = stored(first_k(own, ["doc_id"], SEED_TERMS, [F.abs("x").desc(), F.col("term")], F.col("term")).select("doc_id", "fold", "term"), "seed-terms")
    strong = [F.abs("x").desc(), F.col("doc_id")]
    asked = entries.select("doc_id", "term", "x").join(own.select("term").distinct(), "term", "left_semi")  # heads of these terms only
    heads = first_k(asked, ["term"], HEAD * k, strong, F.col("doc_id"))
    heads = heads.select("term", F.col("doc_id").alias("hi")).join(folds.select(F.col("doc_id").alias("hi"), F.col("fold").alias("fold_hi")), "hi")
    seeds = own.select("term", F.col("doc_id").alias("lo"), "fold").join(heads, "term").where("fold <> fold_hi").select("lo", "hi").distinct()
    sims = confirmed(stored(seeds, "seed-pairs"), weights, 10.0**-digits, digits, weight)
    return _ranked(sims, folds, k).where(F.col("rank") == k).select("q", F.col("sim").alias("bound"))


def candidate_pairs(entries: DataFrame, queries: DataFrame, folds: DataFrame, bounds: DataFrame, digits: int = 6,
                    per_part: tuple[int, int] = PER_PART) -> DataFrame:
    """(lo, hi): query and candidate of another fold that the bounds leave."""
    unit = 10.0**-digits
    own = entries.join(queries.select("doc_id", "fold"), "doc_id").join(bounds.withColumnRenamed("q", "doc_id"), "doc_id", "left")
    # one unit below the bound: rounding of a similarity can add half a unit
    own = own.withColumn("least", F.greatest(F.coalesce("bound", F.lit(0.0)) - unit, F.lit(0.4 * unit)))
    own = own.where(F.col("rest") * F.col("rest") + F.col("x") * F.col("x") >= F.col("least") * F.col("least"))
    own = stored(own.select("doc_id", "fold", "term", "x", "rest", "least"), "query-prefixes")
    after = own.groupBy("doc_id").agg(F.min("rest").alias("after"))
    count = lambda rows, name, most: rows.groupBy("term").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))
    parts = count(own, "q_parts", per_part[1]).join(count(entries, "c_parts", per_part[0]), "term")
    deal = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = own.join(after, "doc_id").join(parts, "term").select("*", deal("q_parts").alias("i")).select("*", every("c_parts").alias("j"))
    left = left.select("term", "i", "j", F.col("doc_id").alias("lo"), F.col("fold").alias("q_fold"), F.col("x").alias("q_x"), "least", "after")
    right = entries.join(folds.select("doc_id", "fold"), "doc_id").join(parts, "term").select("*", deal("c_parts").alias("j")).select("*", every("q_parts").alias("i"))
    right = right.select("term", "i", "j", F.col("doc_id").alias("hi"), F.col("fold").alias("c_fold"), F.col("x").alias("c_x"), F.col("rest").alias("c_rest"))
    met = left.join(right, ["term", "i", "j"]).where("q_fold <> c_fold").groupBy("lo", "hi").agg(
        F.sum(F.col("q_x") * F.col("c_x")).alias("shared"), F.min("c_rest").alias("c_rest"), F.first("after").alias("after"), F.first("least").alias("least"))
    return met.where(F.col("shared") + F.col("after") * F.col("c_rest") >= F.col("least") - F.lit(1e-9)).select("lo", "hi")


def top_k(weights: DataFrame, queries: DataFrame, folds: DataFrame, k: int, digits: int = 6, weight: str = "w",
          per_part: tuple[int, int] = PER_BLOCK) -> DataFrame:
    """(q, rank, t, fold_t, sim): the k nearest documents of other folds for every query, by (sim descending,
    fold, id); only similarities that are above 0 when rounded to ``digits``.

    ``weights``: (doc_id, term, weight); ``queries``: (doc_id), some of the documents; ``folds``: (doc_id, fold) of
    all documents. ``per_part``: documents of a block at most, candidates and queries. Null ids and folds take no part; a query without weights has no rows; an empty
    table gives an empty result."""
    if k < 1:
        raise ValueError("k must be at least 1")
    ids, fold_type = weights.schema["doc_id"].dataType, folds.schema["fold"].dataType
    folds = stored(folds.where("doc_id IS NOT NULL AND fold IS NOT NULL").select("doc_id", "fold"), "top-folds")
    wanted = queries.select("doc_id").distinct().withColumn("_asked", F.lit(1))
    keys = folds.join(wanted, "doc_id", "left").select(F.struct("fold", "doc_id", F.coalesce("_asked", F.lit(0)).alias("label")).alias("key"))
    places = stored(range_rank(keys, "key", "place").select("key.doc_id", "key.fold", "key.label", "place"), "top-places")
    vectors = document_vectors(weights.where(F.col("doc_id").isNotNull()), places, weight, also=["place", "label"]).where(F.size("terms") > 0)
    asked = places.where("label = 1").count()
    found = own_top_k(vectors, k, places.count(), digits=digits, docs=per_part[0], asked=(asked, per_part[1])).where("sim > 0")
    return found.select(F.col("q").cast(ids).alias("q"), "rank", F.col("t").cast(ids).alias("t"), F.col("fold_t").cast(fold_type).alias("fold_t"), "sim")
