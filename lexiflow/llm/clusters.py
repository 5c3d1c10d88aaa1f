"""Centroid clustering over blocks of a space-filling curve with min/max boxes.

Vectors are brought into Hilbert order (every component scaled to a few bits between its
least and largest value) by range partitions of the curve's key, and consecutive vectors
form blocks of ``BLOCK`` rows. A block is one row of a stored table: its vectors and the box of its
least and largest components (a zone map). In every round a block first bounds its
distances: a centroid whose least distance to the box exceeds another's largest one can't be
nearest to any vector of the block. The others are its candidates and are compared exactly,
all vectors of the block at once. Equal distances go to the smaller centroid number.

A round sums components per task; Spark adds them up (centroids x components rows reach the
driver, whatever the size of the table). Equal vectors are dealt by ``vec_id`` too, so a
vector with a third of all rows lies in many blocks.

Defined cases: vectors with another number of components, null or non-finite components are left out;
a null ``vec_id`` is a vector like any other, but starts a centroid only after all others; rows
that repeat count each; with fewer vectors than centroids there are as many centroids as
vectors; an empty table gives an empty result; other columns are ignored. Components are whole
numbers of 64 bits (larger ones saturate), all sums are exact, and a distance or inertia beyond 64 bits
is given as 2^63 - 1. A text column is not read, so long texts play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Vectors in a block, bits of a component in the curve's key, vectors dealt to one range partition.
BLOCK, BITS, DEALT_TOGETHER = 64, 4, 50_000
#: Up to this size of a component all sums of squares are exact in doubles (64 · 2^44 < 2^53).
EXACT = 1 << 22
LARGEST = 2**63 - 1


# --- the curve -------------------------------------------------------------------------------

def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (n, dims) with components of ``bits`` bits, as rows of
    bytes that sort like the places (Skilling's transform, all points at once)."""
    axes = [x[:, i].astype(np.uint16) for i in range(x.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = np.uint16(q - 1)
        for i, a in enumerate(axes):
            on = (a & np.uint16(q)) != 0
            swap = np.where(on, np.uint16(0), (axes[0] ^ a) & low)
            axes[i] = a ^ swap
            axes[0] = axes[0] ^ swap ^ np.where(on, low, np.uint16(0)) if i else np.where(on, a ^ low, a)
        q >>= 1
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros(len(x), np.uint16)
    q = top
    while q > 1:
        turn ^= np.where((axes[-1] & np.uint16(q)) != 0, np.uint16(q - 1), np.uint16(0))
        q >>= 1
    planes = [((a ^ turn) >> np.uint16(b)) & np.uint16(1) for b in range(bits - 1, -1, -1) for a in axes]
    return np.packbits(np.stack(planes, axis=1).astype(np.uint8), axis=1)


# --- blocks ------------------------------------------------------------------------------------

class Layout(NamedTuple):
    dims: int
    kind: str  # numpy type of the stored components
    exact: bool  # sums of squares fit doubles


def whole_vectors(embeddings: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): vectors that are kept, as whole numbers floor(scale · x)."""
    e = F.col("embedding")
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(math.inf))
    kept = embeddings.where((F.size(e) == dims) & F.forall(e, finite))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform(e, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims)


def hilbert_blocks(vectors: DataFrame, dims: int) -> tuple[DataFrame, Layout]:
    """Stored blocks (ids array<long>, vectors, low and high binary) of ``vectors`` (vec_id, v) in the
    order of the curve."""
    r = vectors.agg(F.count(F.lit(1)).alias("n"), *(f(F.col("v")[i]).alias(f"{name}{i}")
                                                    for i in range(dims) for name, f in (("lo", F.min), ("hi", F.max)))).first()
    low = [r[f"lo{i}"] or 0 for i in range(dims)]
    high = [r[f"hi{i}"] or 0 for i in range(dims)]
    size = max(abs(x) for x in (*low, *high))
    kind = next((k for k, top in (("<i2", 2**15 - 1), ("<i4", 2**31 - 1)) if size <= top), "<i8")
    start, span = np.array(low, np.float64), np.maximum(np.array(high, np.float64) - np.array(low, np.float64), 1.0)
    cells = 1 << BITS

    def with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scaled = (_matrix(batch.column("v"), dims) - start) / span * cells
                keys = hilbert_keys(np.clip(scaled, 0, cells - 1).astype(np.uint16), BITS)
                data = pa.py_buffer(keys.tobytes())
                column = pa.FixedSizeBinaryArray.from_buffers(pa.binary(keys.shape[1]), len(keys), [None, data])
                yield pa.RecordBatch.from_arrays([*batch.columns, column.cast(pa.binary())], names=["vec_id", "v", "key"])

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK:
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                whole = rows // BLOCK * BLOCK
                yield packed(table.slice(0, whole))
                held, rows = [table.slice(whole)], rows - whole
        if rows:
            yield packed(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    def packed(rows: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(rows.column("v"), dims).astype(kind)
        ids = rows.column("vec_id")
        cuts = range(0, len(x), BLOCK)
        return pa.RecordBatch.from_arrays(
            [pa.array([ids.slice(a, BLOCK).to_pylist() for a in cuts], pa.list_(pa.int64())),
             *(pa.array([f(x[a:a + BLOCK]).tobytes() for a in cuts], pa.binary())
               for f in (lambda b: b, lambda b: b.min(axis=0), lambda b: b.max(axis=0)))], names=["ids", "vectors", "low", "high"])

    cores = vectors.sparkSession.sparkContext.defaultParallelism
    parts = max(1, math.ceil(r["n"] / DEALT_TOGETHER), min(2 * cores, math.ceil(r["n"] / BLOCK)))
    keyed = vectors.mapInArrow(with_key, "vec_id long, v array<long>, key binary")
    ordered = keyed.repartitionByRange(parts, "key", "vec_id").sortWithinPartitions("key", "vec_id")
    table = ordered.select("vec_id", "v").mapInArrow(to_blocks, "ids array<long>, vectors binary, low binary, high binary")
    return stored(table, "vector-blocks"), Layout(dims, kind, size <= EXACT)


# --- nearest centroids ----------------------------------------------------------------------------

def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(boxes, centroids): False where another centroid is nearer to every point of the box.
    ``low`` and ``high`` (boxes, dims)."""
    least = np.zeros((len(low), len(centroids)), low.dtype)
    most = np.zeros_like(least)
    for j, c in enumerate(centroids):
        below, above = low - c, c - high
        gap = np.maximum(np.maximum(below, above), 0)
        far = np.maximum(np.abs(below), np.abs(above))
        least[:, j], most[:, j] = (gap * gap).sum(axis=1), (far * far).sum(axis=1)
    return least <= most.min(axis=1, keepdims=True)


def nearest(x: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of every row of ``x`` among the numbers ``among`` (ascending)
    and its squared distance; whole numbers in doubles or Python integers."""
    c = centroids[among]
    if x.dtype == object:
        d = np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)
    else:
        d = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    best = np.array([min(range(len(c)), key=row.__getitem__) for row in d]) if x.dtype == object else d.argmin(axis=1)
    return among[best], d[np.arange(len(x)), best]


def _assigned(batch: pa.RecordBatch, layout: Layout, centroids: list[list[int]]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, vectors, cluster, distance) of every block of a batch."""
    kind = np.float64 if layout.exact else object
    c = np.array(centroids, dtype=object).astype(kind)
    as_rows = lambda name: np.frombuffer(b"".join(batch.column(name).to_pylist()), layout.kind).reshape(-1, layout.dims).astype(kind)
    near = candidates(as_rows("low"), as_rows("high"), c)
    lists, data = batch.column("ids"), batch.column("vectors")
    for i in range(batch.num_rows):
        x = np.frombuffer(data[i].as_buffer(), layout.kind).reshape(-1, layout.dims).astype(kind)
        yield lists[i].values, x, *nearest(x, c, np.flatnonzero(near[i]))


def _sums(blocks: DataFrame, layout: Layout, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Per centroid the number of its vectors and the sums of their components."""
    dims, k = layout.dims, len(centroids)

    def run(batches):
        count, total = [0] * k, [[0] * dims for _ in range(k)]
        for batch in batches:
            for _, x, cluster, _ in _assigned(batch, layout, centroids):
                for j in np.unique(cluster).tolist():
                    own = x[cluster == j]
                    count[j] += len(own)
                    total[j] = [a + int(b) for a, b in zip(total[j], own.sum(axis=0))]
        used = [j for j in range(k) if count[j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([j for j in used for _ in range(dims)], pa.int32()), pa.array([i for _ in used for i in range(dims)], pa.int32()),
             pa.array([count[j] for j in used for _ in range(dims)], pa.int64()),
             pa.array([Decimal(s) for j in used for s in total[j]], pa.decimal128(38, 0))], names=["cluster", "dim", "n", "s"])

    rows = (blocks.mapInArrow(run, "cluster int, dim int, n long, s decimal(38,0)")
            .groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())  # centroids · dims rows
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["dim"]] = int(r["s"])
    return out


def cluster(embeddings: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, scale: int = 64, dims: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector: ``rounds``
    of assignment and replacement by the exact floor of the mean, then a last assignment."""
    spark = embeddings.sparkSession
    vectors = stored(whole_vectors(embeddings, dims, scale), "whole-vectors")
    named = vectors.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    centroids = [list(r["v"]) for r in named.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()]
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], schema)
    blocks, layout = hilbert_blocks(vectors, dims)
    for _ in range(rounds):
        for j, (n, sums) in _sums(blocks, layout, centroids).items():
            centroids[j] = [s // n for s in sums]

    def last(batches):
        for batch in batches:
            for ids, _, own, distance in _assigned(batch, layout, centroids):
                whole = [min(int(d), LARGEST) for d in distance]
                yield pa.RecordBatch.from_arrays([ids, pa.array(own, pa.int32()), pa.array(whole, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    done = stored(blocks.mapInArrow(last, "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    everything = min(sum(sums.values()), LARGEST)
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    table = spark.createDataFrame([(j, min(s, LARGEST), everything, digest(centroids[j])) for j, s in sums.items()],
                                  "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = done.join(F.broadcast(table), F.col("cluster") == F.col("c"))  # a row per centroid
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
