"""Nearest rows of dense vectors by blocked matrix products.

Query vectors are hashed into S_q blocks, candidates into S_c; blocks are stored once, one row each. Every
pair of blocks is read by a task that multiplies strips of queries with the candidates of its block and
hands on the k best per query, strip by strip; a merge keeps the k best over a query's blocks. Shuffled are
the vectors once and at most queries x S_c x k short rows on the way out; no table of pairs exists, and a
task's memory is bounded by the block sizes, whatever k is.

Vectors of different lengths are compared over the shorter one (norms over their own); null
vectors and components count as empty and zero. Equal similarities go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .cells import Measure, cosine_measure

#: Vectors of a side in one task, and products (query x candidate) held at a time.
QUERIES_PER_BLOCK, CANDIDATES_PER_BLOCK, PRODUCTS = 16_384, 32_768, 2_000_000


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists as rows of a matrix, zeros behind the shorter ones."""
    lists = column.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(size), int(size.max(initial=0))))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _best(value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of every row; of equal ones those further left. -inf is left out."""
    width = value.shape[1]
    if k < width:
        least = np.partition(value, width - k, axis=1)[:, width - k]
        row, col = np.nonzero((value >= least[:, None]) & (value > -np.inf))
    else:
        row, col = np.nonzero(value > -np.inf)
    order = np.lexsort((col, -value[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, np.arange(len(value)))
    place = np.arange(len(row)) - first[row]
    return row[place < k], col[place < k]


def _products(x: np.ndarray, y: np.ndarray, measure: Measure, digits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, similarities of a strip of x with y)."""
    both = min(x.shape[1], y.shape[1])
    norm_x, norm_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
    step = max(1, PRODUCTS // max(1, len(y)))
    for lo in range(0, len(x), step):
        dot = x[lo:lo + step, :both] @ y[:, :both].T
        yield lo, np.round(measure(dot, norm_x[lo:lo + step, None], norm_y[None, :]), digits) + 0.0


def top_k(queries: DataFrame, candidates: DataFrame, k: int, measure: Measure = cosine_measure, digits: int = 9,
          blocks: tuple[int, int] | None = None) -> DataFrame:
    """(q, rank, t, sim, norm): the k best of ``candidates`` (vec_id, embedding) for every row of ``queries``
    (the same columns) by (sim descending, id), rows of the query's own id left out. ``norm`` is the
    candidate's length."""
    schema = pa.schema([("q", pa.int64()), ("t", pa.int64()), ("sim", pa.float64()), ("norm", pa.float64())])
    if blocks is None:
        cores = queries.sparkSession.sparkContext.defaultParallelism
        n_q, n_c = queries.count(), candidates.count()
        s_q = max(1, math.ceil(n_q / QUERIES_PER_BLOCK))
        blocks = s_q, max(1, math.ceil(n_c / CANDIDATES_PER_BLOCK), min(math.ceil(2 * cores / s_q), math.ceil(n_c / 256)))
    s_q, s_c = blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i].values
                q, t = get("q_ids").to_numpy(), get("c_ids").to_numpy()
                x, y = (_matrix(pa.chunked_array([get(name)])) for name in ("q_vectors", "c_vectors"))
                norm = np.sqrt((y * y).sum(axis=1))
                for lo, value in _products(x, y, measure, digits):  # a strip's best leave at once, whatever k is
                    own = q[lo:lo + len(value)]
                    value[own[:, None] == t[None, :]] = -np.inf
                    row, col = _best(value, k)
                    yield pa.RecordBatch.from_arrays([pa.array(own[row]), pa.array(t[col]), pa.array(value[row, col]), pa.array(norm[col])], schema=schema)

    def pack(block: pa.Table) -> pa.Table:
        block = block.sort_by("id")
        lists = [block[c].combine_chunks() for c in ("id", "v")]
        return pa.table([block["block"].slice(0, 1), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists)], names=["block", "ids", "vectors"])

    def side(df: DataFrame, number: int, letter: str) -> DataFrame:
        rows = df.where("vec_id IS NOT NULL").select(
            F.col("vec_id").cast("long").alias("id"), F.coalesce(F.col("embedding").cast("array<double>"), F.array().cast("array<double>")).alias("v"),
            F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int").alias("block"))
        blocks = rows.groupBy("block").applyInArrow(pack, "block int, ids array<long>, vectors array<array<double>>")
        return stored(blocks, "dense-blocks", by=("block",)).select(F.col("ids").alias(f"{letter}_ids"), F.col("vectors").alias(f"{letter}_vectors"))

    found = side(queries, s_q, "q").crossJoin(side(candidates, s_c, "c")).mapInArrow(run, "q long, t long, sim double, norm double")
    order = Window.partitionBy("q").orderBy(F.col("sim").desc(), "t")  # at most S_c · k rows per query
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("q", "rank", "t", "sim", "norm"))


def knn(queries: DataFrame, candidates: DataFrame, k: int, measure: Measure = cosine_measure, digits: int = 9) -> DataFrame:
    """(q, rank, vec_id, label, sim, predicted): neighbours and the most frequent label among them, ties to
    the smallest label. ``candidates``: (vec_id, embedding, label)."""
    from .knn import vote

    found = stored(top_k(queries, candidates, k, measure, digits), "dense-neighbours")
    labels = candidates.select(F.col("vec_id").alias("doc_id"), F.col("label").alias("class"))
    votes = vote(found, labels).withColumnRenamed("q", "v_q")
    named = labels.select(F.col("doc_id").alias("t"), F.col("class").alias("label"))
    return (found.join(votes, F.col("q") == F.col("v_q")).join(named, "t")
            .select("q", "rank", F.col("t").alias("vec_id"), "label", "sim", "predicted"))
