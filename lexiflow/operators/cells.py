"""Exact similarities inside document cells.

Query vectors are hashed into S_q buckets, candidate vectors into S_c, and every bucket pair
is a cell: one task holds a few thousand documents of each side and computes all their
dot products over shared terms. What leaves a cell is already reduced: the k best
candidates per query (zero similarities included, so no fill step is needed), or the
non-zero pairs where a caller asks for them. A merge keeps the k best over the S_c
cells of a query. Shuffled rows are documents x cells on the way in and at most
queries x S_c x k on the way out; no table of all pairs exists.

Inside a cell the candidates' postings are sorted by term and the products of one
strip of queries are added up in a dense block, a bounded number of products at a time, so
memory does not depend on how hot a term is. With integer weights all sums are exact.

``own_top_k`` compares a table with itself, where queries x S_c x k would be far more rows than the
result: vectors lie in stored blocks, and the task of one block reads all blocks one after another and keeps
the k best of its queries so far. Nothing but the result leaves it, and its memory is one block of each side
and the best rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

DOCS_PER_CELL = 8192  # documents of one side in a cell: a strip is STRIP x 8192 doubles
PAIR_DOCS_PER_CELL = 2048  # the same where a cell returns pairs
STRIP = 256
PRODUCTS = 2_000_000  # products expanded at a time
_LAST = -(2**62)
#: Of a stored block: documents, entries, and rows (documents x k) that its task keeps; query rows compared at a time;
#: frequent terms multiplied as a dense matrix.
BLOCK_DOCS, BLOCK_ENTRIES, KEPT_ROWS, OWN_STRIP, DENSE_TERMS = 8192, 1_000_000, 4_000_000, 64, 256

#: (dot, squared norm of the query, squared norm of the candidate) → similarity
Measure = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def cosine_measure(dot: np.ndarray, norm_q: np.ndarray, norm_t: np.ndarray) -> np.ndarray:
    """dot / (|q| · |t|), 0 when either norm is 0."""
    den = np.sqrt(norm_q) * np.sqrt(norm_t)
    return np.divide(dot, den, out=np.zeros_like(dot), where=den != 0)


def dot_measure(dot: np.ndarray, norm_q: np.ndarray, norm_t: np.ndarray) -> np.ndarray:
    """The dot product itself (vectors that are normalised already)."""
    return dot


class SparseBlock(NamedTuple):
    """Sparse vectors of several documents: the entries of row i are offsets[i]..offsets[i + 1] of ``codes``
    (terms as numbers, the same in both blocks of a measure, ascending names) and ``weights``."""
    ids: np.ndarray
    offsets: np.ndarray
    codes: np.ndarray
    weights: np.ndarray

    def sums(self) -> np.ndarray:
        """Sum of the weights of every row."""
        return np.bincount(np.repeat(np.arange(len(self.ids)), np.diff(self.offsets)), weights=self.weights, minlength=len(self.ids))


#: Both sides' whole vectors → similarities (rows of the first, rows of the second): any measure.
BlockMeasure = Callable[[SparseBlock, SparseBlock], np.ndarray]


def shared_sums(left: SparseBlock, right: SparseBlock, combine: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.multiply) -> np.ndarray:
    """(left rows, right rows): ``combine`` of the two weights, added up over the terms both have; a
    bounded number of entries at a time."""
    order = np.argsort(right.codes, kind="stable")
    row_r = np.repeat(np.arange(len(right.ids)), np.diff(right.offsets))[order]
    weight_r = right.weights[order]
    count = np.bincount(right.codes, minlength=int(max(left.codes.max(initial=-1), right.codes.max(initial=-1))) + 1)
    start = np.cumsum(count) - count
    row_l = np.repeat(np.arange(len(left.ids)), np.diff(left.offsets))
    out = np.zeros(len(left.ids) * len(right.ids))
    upto, a, b = np.cumsum(count[left.codes]), 0, len(left.codes)
    while a < b:
        done = upto[a - 1] if a else 0
        part = slice(a, a + max(1, int(np.searchsorted(upto[a:], done + PRODUCTS, "right"))))
        times = count[left.codes[part]]
        at = np.arange(int(times.sum())) + np.repeat(start[left.codes[part]] - (np.cumsum(times) - times), times)
        cell = np.repeat(row_l[part] * len(right.ids), times) + row_r[at]
        out += np.bincount(cell, weights=combine(np.repeat(left.weights[part], times), weight_r[at]), minlength=len(out))
        a = part.stop
    return out.reshape(len(left.ids), len(right.ids))


def weighted_jaccard(left: SparseBlock, right: SparseBlock) -> np.ndarray:
    """Sum of the smaller weights over the sum of the larger ones, for weights of at least 0; 0 for empty rows."""
    least = shared_sums(left, right, np.minimum)
    most = left.sums()[:, None] + right.sums()[None, :] - least
    return np.divide(least, most, out=np.zeros_like(least), where=most != 0)


def document_vectors(weights: DataFrame, docs: DataFrame, weight: str = "w", also: Sequence[str] = ()) -> DataFrame:
    """(doc_id, fold, terms, weights): one row per document of ``docs`` (doc_id, fold), with empty
    arrays where a document has no weight. A row is as long as its document. ``also``: further columns of ``docs`` to keep."""
    lists = (weights.where(F.col(weight) != 0).groupBy("doc_id")
             .agg(F.sort_array(F.collect_list(F.struct("term", F.col(weight).cast("double").alias("w")))).alias("_p")))
    lists = lists.select(F.col("doc_id").alias("_id"), F.col("_p.term").alias("terms"), F.col("_p.w").alias("weights"))
    return (docs.select("doc_id", "fold", *also).join(lists, F.col("doc_id") == F.col("_id"), "left")
            .select("doc_id", F.col("fold").cast("int").alias("fold"), *also,
                    F.coalesce("terms", F.array().cast("array<string>")).alias("terms"),
                    F.coalesce("weights", F.array().cast("array<double>")).alias("weights")))


def _buckets(queries: int, candidates: int, tasks: int, per_cell: int) -> tuple[int, int]:
    """Buckets of both sides: enough for the memory of a cell and for ``tasks`` cells. A further bucket of one side
    copies the other side once more, so the smaller side is the one that is copied."""
    least_q, least_c = (max(1, math.ceil(n / per_cell)) for n in (queries, candidates))
    best = None
    for s_q in range(least_q, max(least_q, min(tasks, queries)) + 1):
        s_c = max(least_c, min(math.ceil(tasks / s_q), candidates))
        cost = queries * s_c + candidates * s_q, abs(s_q - s_c)
        if best is None or cost < best[0]:
            best = cost, (s_q, s_c)
    return best[1]


class _Side:
    """One side of a cell: ids and folds in (fold, id) order, postings by row."""

    def __init__(self, table: pa.Table) -> None:
        table = table.select(range(4)).rename_columns(["doc_id", "fold", "terms", "weights"])
        ids, folds = table["doc_id"].to_numpy(), table["fold"].to_numpy()
        order = np.lexsort((ids, folds))
        table = table.take(pa.array(order))
        self.ids, self.folds = ids[order], folds[order]
        lists = table["terms"].combine_chunks()
        self.terms = lists.flatten()
        self.size = np.diff(lists.offsets.to_numpy())
        self.end = np.cumsum(self.size)
        self.weights = table["weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(len(self.ids)), self.size)
        self.norm = np.bincount(self.row, weights=self.weights**2, minlength=len(self.ids)).astype(np.float64)


def _dots(left: _Side, right: _Side) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lo, hi, dot products) of strips of left rows with all right rows."""
    codes = pa.chunked_array([left.terms.cast(pa.large_string()), right.terms.cast(pa.large_string())]).combine_chunks().dictionary_encode()
    code = codes.indices.to_numpy(zero_copy_only=False)
    code_l, code_r = code[: len(left.terms)], code[len(left.terms):]
    order = np.argsort(code_r, kind="stable")
    count = np.bincount(code_r, minlength=len(codes.dictionary))
    start = np.cumsum(count) - count
    row_r, weight_r = right.row[order], right.weights[order]
    width = len(right.ids)
    for lo in range(0, len(left.ids), STRIP):
        hi = min(lo + STRIP, len(left.ids))
        a, b = int(left.end[lo] - left.size[lo]), int(left.end[hi - 1])
        block = np.zeros((hi - lo) * width)
        upto = np.cumsum(count[code_l[a:b]])
        while a < b:
            done = upto[a - b - 1] if len(upto) > b - a else 0
            n = max(1, int(np.searchsorted(upto[len(upto) - (b - a):], done + PRODUCTS, "right")))
            part = slice(a, a + n)
            times = count[code_l[part]]
            total = int(times.sum())
            if total:
                at = np.arange(total) + np.repeat(start[code_l[part]] - (np.cumsum(times) - times), times)
                cell = np.repeat((left.row[part] - lo) * width, times) + row_r[at]
                block += np.bincount(cell, weights=np.repeat(left.weights[part], times) * weight_r[at], minlength=len(block))
            a += n
        yield lo, hi, block.reshape(hi - lo, width)


def _block_values(left: _Side, right: _Side, measure: BlockMeasure) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lo, hi, similarities) of strips of left rows with all right rows."""
    codes = pa.chunked_array([left.terms.cast(pa.large_string()), right.terms.cast(pa.large_string())]).combine_chunks().dictionary_encode()
    code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    whole = SparseBlock(right.ids, np.append(0, right.end), code[len(left.terms):], right.weights)
    for lo in range(0, len(left.ids), STRIP):
        hi = min(lo + STRIP, len(left.ids))
        a, b = int(left.end[lo] - left.size[lo]), int(left.end[hi - 1])
        yield lo, hi, measure(SparseBlock(left.ids[lo:hi], np.append(a, left.end[lo:hi]) - a, code[a:b], left.weights[a:b]), whole)


def _rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """x · 10^digits as whole numbers, halves away from zero."""
    return (np.sign(x) * np.floor(np.abs(x) * 10.0**digits + 0.5)).astype(np.int64)


def _cells(queries: DataFrame, candidates: DataFrame, buckets: tuple[int, int] | None, per_cell: int):
    """Both sides copied to their cells, grouped by cell."""
    if buckets is None:
        tasks = 2 * queries.sparkSession.sparkContext.defaultParallelism
        buckets = _buckets(queries.count(), candidates.count(), tasks, per_cell)
    s_q, s_c = buckets
    own = lambda s: F.pmod(F.xxhash64("doc_id"), F.lit(s)).cast("int")
    every = lambda s: F.explode(F.sequence(F.lit(0), F.lit(s - 1)))
    names = ["doc_id", "fold", "terms", "weights"]
    left = queries.select(*names, own(s_q).alias("i")).select("*", every(s_c).alias("j"))
    right = candidates.select(*names, own(s_c).alias("j")).select("*", every(s_q).alias("i"))
    right = right.select(*(F.col(c).alias(f"c_{c}") for c in (*names, "i", "j")))  # own columns, also for a table with itself
    return left.groupBy("i", "j").cogroup(right.groupBy("c_i", "c_j"))


def top_k(queries: DataFrame, candidates: DataFrame, k: int, measure: Measure = cosine_measure, digits: int = 6,
          buckets: tuple[int, int] | None = None, block_measure: BlockMeasure | None = None) -> DataFrame:
    """The k best candidates of every query among those of other folds: (q, fold_q, rank, t, fold_t,
    sim), by (sim descending, fold, id); similarities rounded to ``digits`` first. ``measure`` sees dot
    products and norms; a ``block_measure`` sees the whole vectors and takes its place."""
    schema = pa.schema([("q", pa.int64()), ("fold_q", pa.int32()), ("t", pa.int64()), ("fold_t", pa.int32()), ("sim", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x, y = _Side(left), _Side(right)
        width, out = len(y.ids), []
        keep = min(k, width)
        strips = (((lo, hi, measure(dot, x.norm[lo:hi, None], y.norm[None, :])) for lo, hi, dot in _dots(x, y))
                  if block_measure is None else _block_values(x, y, block_measure))
        for lo, hi, similarity in strips:
            value = _rounded(similarity, digits)
            # one whole number orders by (similarity, train order); the own fold comes last
            key = value * width + np.arange(width - 1, -1, -1)
            key[x.folds[lo:hi, None] == y.folds[None, :]] = _LAST
            best = np.argpartition(-key, keep - 1, axis=1)[:, :keep] if keep < width else np.tile(np.arange(width), (hi - lo, 1))
            row = np.repeat(np.arange(hi - lo), keep)
            col = best.ravel()
            real = key[row, col] != _LAST
            row, col = row[real], col[real]
            out.append(pa.table([x.ids[lo:hi][row], x.folds[lo:hi][row], y.ids[col], y.folds[col], value[row, col] / 10.0**digits], schema=schema))
        return pa.concat_tables(out)

    best = _cells(queries, candidates, buckets, DOCS_PER_CELL).applyInArrow(run, "q long, fold_q int, t long, fold_t int, sim double")
    order = Window.partitionBy("q").orderBy(F.col("sim").desc(), "fold_t", "t")  # at most S_c · k rows per query
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("q", "fold_q", "rank", "t", "fold_t", "sim"))


_BLOCK = ("place bigint, ids array<bigint>, folds array<int>, labels array<int>, places array<bigint>, ends array<bigint>, codes array<int>, "
          "ws array<double>, names array<string>")


def _pack(docs: int):
    """Rows of vectors → blocks of at most ``docs`` documents and about BLOCK_ENTRIES entries, terms numbered in each block."""
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.string()]

    def block(rows: pa.Table) -> pa.RecordBatch:
        terms = rows["terms"].combine_chunks()
        codes = terms.flatten().dictionary_encode()
        values = [rows["doc_id"].combine_chunks(), rows["fold"].combine_chunks(), rows["label"].combine_chunks(), rows["place"].combine_chunks(),
                  pa.array(np.cumsum(np.diff(terms.offsets.to_numpy()))), codes.indices, rows["weights"].combine_chunks().flatten(), codes.dictionary]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(t)) for x, t in zip(values, types)]
        return pa.RecordBatch.from_arrays([rows["place"].combine_chunks().slice(0, 1).cast(pa.int64()), *lists],
                                          names=["place", "ids", "folds", "labels", "places", "ends", "codes", "ws", "names"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, entries = [], 0, 0
        for batch in batches:
            size, lo = np.diff(batch.column("terms").offsets.to_numpy()), 0
            for i in range(batch.num_rows):
                if rows and (rows == docs or entries + size[i] > BLOCK_ENTRIES):
                    yield block(pa.Table.from_batches([*held, batch.slice(lo, i - lo)]))
                    held, rows, entries, lo = [], 0, 0, i
                rows, entries = rows + 1, entries + int(size[i])
            held.append(batch.slice(lo))
        if rows:
            yield block(pa.Table.from_batches(held))

    return run


class _Block:
    """One stored block."""

    def __init__(self, batch: pa.RecordBatch, i: int, letter: str) -> None:
        get = lambda name: batch.column(f"{letter}_{name}")[i].values
        self.ids, self.folds, self.labels, self.places, self.ends, self.codes, self.ws = (
            get(c).to_numpy(zero_copy_only=False) for c in ("ids", "folds", "labels", "places", "ends", "codes", "ws"))
        self.names = get("names")
        self.offsets = np.append(0, self.ends)
        self.row = np.repeat(np.arange(len(self.ids)), np.diff(self.offsets))
        self.norm = np.bincount(self.row, weights=self.ws**2, minlength=len(self.ids)).astype(np.float64)
        self.whole = bool((self.ws == np.floor(self.ws)).all())

    def codes_in(self, other: _Block) -> np.ndarray:
        """The codes that the own entries have in ``other``; terms it lacks come behind its own."""
        code = pc.index_in(self.names, value_set=other.names).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.where(code < 0, len(other.names) + np.arange(len(code)), code)[self.codes]


def _block_dots(x: _Block, y: _Block, code: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lo, hi, dot products) of strips of rows of ``x`` (its terms as codes of ``y``) with all rows of ``y``. The products of the
    terms that are most frequent in ``y`` come from a dense matrix if all sums are exact; all others
    are expanded for one row at a time, in the order of its terms."""
    width, names = len(y.ids), len(y.names)
    count = np.bincount(y.codes, minlength=names)
    column = np.full(names, -1)
    if x.whole and y.whole:
        best = np.argsort(-count, kind="stable")[:DENSE_TERMS]
        column[best] = np.arange(len(best))
    n = int(column.max(initial=-1)) + 1
    dense = column[y.codes]
    matrix = np.zeros((n, width))
    matrix[dense[dense >= 0], y.row[dense >= 0]] = y.ws[dense >= 0]
    rest = np.flatnonzero(dense < 0)
    rest = rest[np.argsort(y.codes[rest], kind="stable")]
    row, weight = y.row[rest], y.ws[rest]
    count = np.where(column < 0, count, 0)
    start = np.cumsum(count) - count
    for lo in range(0, len(x.ids), OWN_STRIP):
        hi = min(lo + OWN_STRIP, len(x.ids))
        part = np.arange(x.offsets[lo], x.offsets[hi])
        part = part[code[part] < names]
        own, at, w = x.row[part] - lo, code[part], x.ws[part]
        out = np.zeros((hi - lo, width))
        if n:
            in_matrix = column[at] >= 0
            left = np.zeros((hi - lo, n))
            left[own[in_matrix], column[at[in_matrix]]] = w[in_matrix]
            out = left @ matrix
            own, at, w = own[~in_matrix], at[~in_matrix], w[~in_matrix]
        times = count[at]
        upto = np.cumsum(times)
        for i in np.unique(own):
            a, b = np.searchsorted(own, (i, i + 1))
            while a < b:
                done = upto[a - 1] if a else 0
                c = min(b, a + max(1, int(np.searchsorted(upto[a:b], done + PRODUCTS, "right"))))
                t = times[a:c]
                index = np.repeat(start[at[a:c]] - (np.cumsum(t) - t), t)
                index += np.arange(len(index))
                out[i] += np.bincount(row[index], weights=np.repeat(w[a:c], t) * weight[index], minlength=width)
                a = c
        yield lo, hi, out


def _bounded_dots(x: _Block, y: _Block, code: np.ndarray, best: _Best) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(lo, rows from lo on, columns, dot products) of the pairs whose cosine may be among the best of their query. The products of
    the terms that are rare in ``y`` come first; they and the product of the lengths of both rests are an
    upper bound, and only pairs that reach the query's k-th best so far meet in the frequent terms too."""
    width, names = len(y.ids), len(y.names)
    count = np.bincount(y.codes, minlength=names)
    column = np.full(names, -1)
    frequent = np.argsort(-count, kind="stable")[:DENSE_TERMS]
    column[frequent] = np.arange(len(frequent))
    dense = column[y.codes]
    there = dense >= 0
    matrix = np.zeros((width, len(frequent)))
    matrix[y.row[there], dense[there]] = y.ws[there]
    lengths = np.stack([np.sqrt(y.norm), np.sqrt(np.bincount(y.row[there], weights=y.ws[there] ** 2, minlength=width))])
    rest = np.flatnonzero(~there)
    rest = rest[np.argsort(y.codes[rest], kind="stable")]
    row, weight = y.row[rest], y.ws[rest]
    count = np.where(column < 0, count, 0)
    start = np.cumsum(count) - count
    for lo in range(0, len(x.ids), OWN_STRIP):
        hi = min(lo + OWN_STRIP, len(x.ids))
        part = np.arange(x.offsets[lo], x.offsets[hi])
        part = part[code[part] < names]
        own, at, w = x.row[part] - lo, code[part], x.ws[part]
        in_matrix = column[at] >= 0
        left = np.zeros((hi - lo, len(frequent)))
        left[own[in_matrix], column[at[in_matrix]]] = w[in_matrix]
        own, at, w = own[~in_matrix], at[~in_matrix], w[~in_matrix]
        times, out = count[at], np.zeros((hi - lo, width))
        upto, cuts = np.cumsum(times), np.searchsorted(own, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            a, b = cuts[i], cuts[i + 1]
            while a < b:
                done = upto[a - 1] if a else 0
                c = min(b, a + max(1, int(np.searchsorted(upto[a:b], done + PRODUCTS, "right"))))
                t = times[a:c]
                index = np.repeat(start[at[a:c]] - (np.cumsum(t) - t), t)
                index += np.arange(len(index))
                out[i] += np.bincount(row[index], weights=np.repeat(w[a:c], t) * weight[index], minlength=width)
                a = c
        length = np.sqrt(x.norm[lo:hi])
        bound = np.nan_to_num(best.bounds(lo, hi), neginf=-2.0) - 1e-9  # a cosine is -1 at least
        least = np.stack([bound * length, -np.sqrt((left**2).sum(axis=1))], axis=1) @ lengths
        rows, cols = np.nonzero(out >= least)
        if len(rows) * 10 > out.size:
            out += left @ matrix.T
            dots = out[rows, cols]
        else:
            dots = out[rows, cols]
            for a in range(0, len(rows), STRIP * 16):
                some = slice(a, a + STRIP * 16)
                dots[some] += np.einsum("ij,ij->i", left[rows[some]], matrix[cols[some]])
        yield lo, rows, cols, dots


class _Best:
    """The k best candidates so far of every query of a block. One whole number orders by (rounded similarity, place)."""

    def __init__(self, block: _Block, k: int, n: int, digits: int) -> None:
        self.block, self.n, self.digits = block, n, digits
        self.key = np.full((len(block.ids), k), _LAST)
        self.id = np.zeros(self.key.shape, np.int64)
        self.fold = np.zeros(self.key.shape, np.int32)
        self.label = np.zeros(self.key.shape, np.int32)
        self.least = self.key.min(axis=1)

    def bounds(self, lo: int, hi: int) -> np.ndarray:
        """What a similarity must have at least to be among the best."""
        least = self.least[lo:hi]
        bound = np.where(least == _LAST, -np.inf, (least // self.n - 0.5) / 10.0**self.digits)
        return bound - np.where(least == _LAST, 0.0, np.abs(bound) * 1e-9 + 1e-12)  # room for rounding, the keys decide

    def add(self, lo: int, hi: int, similarity: np.ndarray, y: _Block) -> None:
        row, col = np.nonzero(similarity >= self.bounds(lo, hi)[:, None])
        self.add_pairs(lo, hi, row, col, similarity[row, col], y)

    def add_pairs(self, lo: int, hi: int, row: np.ndarray, col: np.ndarray, similarity: np.ndarray, y: _Block) -> None:
        """Pairs (row behind ``lo``, column) in the order of their rows."""
        least = self.least[lo:hi]
        key = _rounded(similarity, self.digits) * self.n + (self.n - 1 - y.places[col])
        keep = (key > least[row]) & (self.block.folds[lo:hi][row] != y.folds[col])
        row, col, key = row[keep], col[keep], key[keep]
        if not len(row):
            return
        size = np.bincount(row, minlength=hi - lo)
        rows = np.flatnonzero(size)
        k, width = self.key.shape[1], int(size.max())
        at = np.arange(len(row)) - np.repeat((np.cumsum(size) - size)[rows], size[rows])
        line = np.searchsorted(rows, row)
        keys = np.full((len(rows), width), _LAST)
        cols = np.zeros((len(rows), width), np.int64)
        keys[line, at], cols[line, at] = key, col
        here = lo + rows
        keys = np.concatenate([self.key[here], keys], axis=1)
        best = np.argpartition(-keys, k - 1, axis=1)[:, :k] if width else np.arange(k)
        self.key[here] = np.take_along_axis(keys, best, axis=1)
        for kept, own in ((self.id, y.ids), (self.fold, y.folds), (self.label, y.labels)):
            kept[here] = np.take_along_axis(np.concatenate([kept[here], own[cols]], axis=1), best, axis=1)
        self.least[here] = self.key[here].min(axis=1)

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        x = self.block
        for lo in range(0, len(x.ids), STRIP):
            order = np.argsort(-self.key[lo:lo + STRIP], axis=1)
            key, t, fold, label = (np.take_along_axis(v[lo:lo + STRIP], order, axis=1) for v in (self.key, self.id, self.fold, self.label))
            row, col = np.nonzero(key != _LAST)
            yield pa.RecordBatch.from_arrays([pa.array(x.ids[lo:lo + STRIP][row]), pa.array(x.folds[lo:lo + STRIP][row], pa.int32()), pa.array(col + 1, pa.int32()),
                                              pa.array(t[row, col]), pa.array(fold[row, col], pa.int32()), pa.array((key[row, col] // self.n) / 10.0**self.digits),
                                              pa.array(label[row, col], pa.int32())], schema=schema)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stored blocks → the rows with the label 1, as they were before they were packed."""
    for batch in batches:
        for i in range(batch.num_rows):
            get = lambda name: batch.column(name)[i].values
            ends = np.append(0, get("ends").to_numpy())
            rows = np.flatnonzero(get("labels").to_numpy() == 1)
            size = ends[rows + 1] - ends[rows]
            at = pa.array(np.repeat(ends[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum()))
            offsets = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (get("names").take(get("codes").take(at)), get("ws").take(at))]
            rows = pa.array(rows)
            yield pa.RecordBatch.from_arrays([*(get(c).take(rows) for c in ("ids", "folds", "labels", "places")), *lists],
                                             names=["doc_id", "fold", "label", "place", "terms", "weights"])


def own_top_k(vectors: DataFrame, k: int, n: int, measure: Measure = cosine_measure, digits: int = 6,
              block_measure: BlockMeasure | None = None, docs: int | None = None, asked: tuple[int, int] | None = None) -> DataFrame:
    """``top_k`` of all ``n`` rows of ``vectors`` (doc_id, fold, terms, weights, place) with themselves. ``place``: the row's
    number from 0 in the order (fold, id). ``docs``: documents of a block, else by ``n``, k and the cores. A column ``label`` (int) of
    ``vectors`` comes back as the candidate's, so votes need no join. ``asked``: only rows with the label 1 are queries; how many
    they are and how many a block has at most. These queries skip candidates by bounds, which is worth it for a small k."""
    spark, k = vectors.sparkSession, max(1, min(k, n))
    docs = docs or (BLOCK_DOCS if asked else max(1, min(BLOCK_DOCS, KEPT_ROWS // k, math.ceil(n / (2 * spark.sparkContext.defaultParallelism)))))
    schema = pa.schema([("q", pa.int64()), ("fold_q", pa.int32()), ("rank", pa.int32()), ("t", pa.int64()), ("fold_t", pa.int32()), ("sim", pa.float64()), ("label", pa.int32())])
    label = F.col("label").cast("int") if "label" in vectors.columns else F.lit(0)
    blocks = stored(vectors.select("doc_id", "fold", label.alias("label"), "place", "terms", "weights").mapInArrow(_pack(docs), _BLOCK), "vector-blocks")
    side = lambda df, letter: df.select(*(F.col(c).alias(f"{letter}_{c}") for c in blocks.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, _Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                at, y = batch.column("q_place")[i].as_py(), _Block(batch, i, "c")
                if at not in best:
                    best[at] = _Best(_Block(batch, i, "q"), k, n, digits)
                x = best[at].block
                code = x.codes_in(y)
                if asked and measure is cosine_measure and x.whole and y.whole:
                    for lo, row, col, dot in _bounded_dots(x, y, code, best[at]):
                        best[at].add_pairs(lo, min(lo + OWN_STRIP, len(x.ids)), row, col, measure(dot, x.norm[lo:][row], y.norm[col]), y)
                    continue
                if block_measure is None:
                    strips = ((lo, hi, measure(dot, x.norm[lo:hi, None], y.norm[None, :])) for lo, hi, dot in _block_dots(x, y, code))
                else:
                    whole = SparseBlock(y.ids, y.offsets, y.codes.astype(np.int64), y.ws)
                    strips = ((lo, hi, block_measure(SparseBlock(x.ids[lo:hi], x.offsets[lo:hi + 1] - x.offsets[lo], code[x.offsets[lo]:x.offsets[hi]], x.ws[x.offsets[lo]:x.offsets[hi]]), whole))
                              for lo in range(0, len(x.ids), OWN_STRIP) for hi in [min(lo + OWN_STRIP, len(x.ids))])
                for lo, hi, similarity in strips:
                    best[at].add(lo, hi, similarity, y)
        for found in best.values():
            yield from found.rows(schema)

    # a task has one block of queries at hand and reads all blocks in one partition, one after another
    if asked:
        per = max(1, min(asked[1], KEPT_ROWS // k, math.ceil(asked[0] / (2 * spark.sparkContext.defaultParallelism))))
        rows = blocks.mapInArrow(_asked, "doc_id bigint, fold int, label int, place bigint, terms array<string>, weights array<double>")
        of_queries = stored(rows.repartition(max(1, math.ceil(asked[0] / per))).mapInArrow(_pack(per), _BLOCK), "query-blocks")
    else:
        of_queries = blocks
    queries = side(of_queries, "q").repartitionByRange(max(1, of_queries.count()), "q_place")
    found = side(blocks, "c").coalesce(1).hint("shuffle_replicate_nl").crossJoin(queries).mapInArrow(
        run, "q bigint, fold_q int, rank int, t bigint, fold_t int, sim double, label int")
    return found if "label" in vectors.columns else found.drop("label")


def own_pairs(vectors: DataFrame, n: int, measure: Measure = cosine_measure, digits: int = 6, other_folds: bool = False) -> DataFrame:
    """``pairs`` of all ``n`` rows of ``vectors`` with themselves, each once with q < t. Vectors lie in stored blocks as in ``own_top_k``; two
    blocks meet in the task of one of them, which a hash of both decides. Nothing but the result leaves a task, a strip at a time."""
    docs = max(1, min(BLOCK_DOCS, math.ceil(n / (2 * vectors.sparkSession.sparkContext.defaultParallelism))))
    rows = vectors.where(F.size("terms") > 0).select("doc_id", "fold", F.lit(0).alias("label"), F.monotonically_increasing_id().alias("place"), "terms", "weights")
    blocks = stored(rows.mapInArrow(_pack(docs), _BLOCK), "vector-blocks")
    side = lambda df, letter: df.select(*(F.col(c).alias(f"{letter}_{c}") for c in blocks.columns))
    kinds = [("q", pa.int64(), "long"), ("t", pa.int64(), "long"), ("dot", pa.float64(), "double"), ("sim", pa.float64(), "double"),
             ("norm_sq_q", pa.float64(), "double"), ("norm_sq_t", pa.float64(), "double"), ("fold_q", pa.int32(), "int"), ("fold_t", pa.int32(), "int")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = (_Block(batch, i, letter) for letter in "qc")
                same = batch.column("q_place")[i] == batch.column("c_place")[i]
                for lo, hi, dot in _block_dots(x, y, x.codes_in(y)):
                    value = _rounded(measure(dot, x.norm[lo:hi, None], y.norm[None, :]), digits)
                    keep = value != 0
                    if same:
                        keep &= x.ids[lo:hi, None] < y.ids[None, :]
                    if other_folds:
                        keep &= x.folds[lo:hi, None] != y.folds[None, :]
                    row, col = np.nonzero(keep)
                    left, right = lo + row, col
                    swap = x.ids[left] > y.ids[right]
                    both = [(x.ids[left], y.ids[right]), (x.norm[left], y.norm[right]), (x.folds[left], y.folds[right])]
                    ids, norms, folds = ((np.where(swap, b, a), np.where(swap, a, b)) for a, b in both)
                    columns = [*ids, dot[row, col], value[row, col] / 10.0**digits, *norms, *folds]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(columns, kinds)], names=[name for name, _, _ in kinds])

    own, other = F.col("q_place"), F.col("c_place")
    first = F.pmod(F.xxhash64(F.least(own, other), F.greatest(own, other)), F.lit(2)) == 0
    queries = side(blocks, "q").repartitionByRange(max(1, blocks.count()), "q_place")
    met = side(blocks, "c").coalesce(1).hint("shuffle_replicate_nl").join(queries, (own == other) | ((own != other) & ((own < other) == first)))
    return met.mapInArrow(run, ", ".join(f"{name} {kind}" for name, _, kind in kinds))


def pairs(queries: DataFrame, candidates: DataFrame, measure: Measure = cosine_measure, digits: int = 6, once: bool = False,
          other_folds: bool = False, buckets: tuple[int, int] | None = None) -> DataFrame:
    """All pairs with a non-zero rounded similarity: (q, t, dot, sim, norm_sq_q, norm_sq_t, fold_q,
    fold_t). ``once``: only q < t; ``other_folds``: only pairs from different folds. The output is
    what grows with the square of the documents; ``top_k`` does not need it."""
    names = ["q", "t", "dot", "sim", "norm_sq_q", "norm_sq_t", "fold_q", "fold_t"]
    schema = pa.schema([(n, pa.int32() if n[:4] == "fold" else pa.int64() if n in "qt" else pa.float64()) for n in names])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x, y = _Side(left), _Side(right)
        out = []
        for lo, hi, dot in _dots(x, y):
            value = _rounded(measure(dot, x.norm[lo:hi, None], y.norm[None, :]), digits)
            keep = value != 0
            if once:
                keep &= x.ids[lo:hi, None] < y.ids[None, :]
            if other_folds:
                keep &= x.folds[lo:hi, None] != y.folds[None, :]
            row, col = np.nonzero(keep)
            out.append(pa.table([x.ids[lo:hi][row], y.ids[col], dot[row, col], value[row, col] / 10.0**digits, x.norm[lo:hi][row],
                                 y.norm[col], x.folds[lo:hi][row], y.folds[col]], schema=schema))
        return pa.concat_tables(out)

    return _cells(queries, candidates, buckets, PAIR_DOCS_PER_CELL).applyInArrow(run, ", ".join(
        f"{f.name} {'int' if f.type == pa.int32() else 'long' if f.type == pa.int64() else 'double'}" for f in schema))
