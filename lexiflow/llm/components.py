"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b), long and not null, any direction → (node, component) of all their nodes;
    a component is named after its smallest node.

    Every step takes minima per node (combined in each task before the shuffle) and joins
    them back; the edges go through a table in the checkpoint folder after each round, and
    the loop ends when a round changes nothing. Only a count and a checksum reach the driver.
    """
    def pairs(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def sign(df: DataFrame):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    current = stored(pairs(edges), "edges")
    before = sign(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = stored(large.distinct(), "large-star")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(lower.select("a", F.col("m").alias("b"))).distinct())
        current = stored(small, "small-star")
        after = sign(current)
        if after == before:
            break
        before = after
    return (current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
