"""Ranks inside groups that may be huge (one class may hold a third of all rows).

``row_number() OVER (PARTITION BY g ORDER BY key)`` sorts a whole group in one task. Here the
order is cut into contiguous parts — by the prefix of a uniform hash, or by range
partitions of any key — and a row's rank is its rank inside its part plus the rows of the
parts before. Deterministic, so a lost task recomputes the same ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

HASH_PREFIX = 5  # hex digits: about a million parts per group


def seeded_hash(id_col: str | Column, seed: int | str) -> Column:
    """md5 hex of "<id>:<seed>" — the shuffle order used for folds (same value in DuckDB)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def prefix_rank(df: DataFrame, group_cols: Sequence[str], hash_col: str, tie_col: str,
                out: str = "rn", prefix_len: int = HASH_PREFIX) -> DataFrame:
    """Add ``out`` = 0-based rank of each row inside ``group_cols`` (null is a group) ordered by the
    uniform hash string ``hash_col``, then ``tie_col``."""
    g = list(group_cols)
    b = df.withColumn("_bucket", F.coalesce(F.substring(F.col(hash_col), 1, prefix_len), F.lit("")))
    local = b.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*g, "_bucket").orderBy(hash_col, tie_col)) - 1)
    counts = b.groupBy(*g, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*g).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    offsets = offsets.select(F.col("_bucket").alias("_ob"), "_off", *[F.col(c).alias(f"_o_{c}") for c in g])
    same = F.col("_bucket") == F.col("_ob")
    for c in g:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return (local.join(offsets, same)
            .withColumn(out, (F.col("_local") + F.col("_off")).cast("bigint"))
            .drop("_bucket", "_local", "_off", "_ob", *[f"_o_{c}" for c in g]))


def range_rank(keys: DataFrame, key: str, out: str) -> DataFrame:
    """Distinct values of one column → (key, ``out``): 0-based rank in the order of the key. The keys
    are dealt to range partitions, which are written once, so both uses see the same parts."""
    spark = keys.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = stored(keys.select(key).repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = sizes.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = dealt.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1)
    return local.join(sizes, F.col("_part") == F.col("_p")).select(key, (F.col("_local") + F.col("_off")).alias(out))


def running_sum(df: DataFrame, col: str, out: str, part: str = "part", at: str = "at") -> DataFrame:
    """Add ``out``: the sum of ``col`` over all rows before, in the order of (``part``, ``at``). Summed inside
    each part (as long as the part) plus the totals of the parts before."""
    inside = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    totals = df.groupBy(part).agg(F.sum(col).alias("_total"))
    totals = totals.select(F.col(part).alias("_part"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    own = df.withColumn(out, F.coalesce(F.sum(col).over(inside), F.lit(0)))
    return own.join(totals, F.col(part) == F.col("_part")).withColumn(out, F.col(out) + F.col("_before")).drop("_part", "_before")
