"""Best-fit packing of tokenised documents after a dominance reduction.

Documents become token pieces of at most ``capacity`` tokens. Which pieces share a sequence
depends on their lengths only, so the packing is solved on the histogram of lengths (at
most ``capacity`` numbers, whatever the size of the corpus):

1. Reduction (Martello and Toth): for a piece and every set of pieces that fits beside it,
   a set that dominates all others is fixed for good: the piece alone if nothing fits, else the
   piece with its largest fitting partner, if no set of two or more pieces that fits is larger than
   that partner (such a set could give up its place to the partner piece by piece). The sums
   that sets of any number of pieces can have are worked out as bits of a whole number. The rule
   is applied to as many equal pieces at once as it holds for, until it holds for none.
2. What remains is packed by best fit, longest first, again equal pieces together.

The solution is a list of patterns (lengths, number of sequences). Every piece gets a rank
among the pieces of its length and takes the pattern slot of that rank. Ranks are taken
inside hashed parts of a length plus the sizes of the parts before, so a length with a
third of all pieces is ranked by many tasks.

Defined cases: a null text counts as empty, its document is the end token alone; very long texts
are cut into pieces; pieces of one length are ranked by doc_id, piece, start and checksum, ties are
equal rows; rows that repeat are packed each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import json
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored, text_or_empty
from .shingles import text_chunks

#: Pieces per ranking part of a length, if one length had all pieces.
RANKED_TOGETHER = 20_000

Patterns = list[tuple[tuple[int, ...], int]]


# --- tokens ----------------------------------------------------------------------------------

_ENCODERS: dict[tuple, object] = {}


def read_added_tokens(path: str) -> dict[str, int]:
    """Added tokens of a tokenizers JSON file. They are found in a text as they are written;
    options that would take in their surroundings are refused."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t[o] for t in added for o in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens with single_word, lstrip, rstrip or normalized are not supported")
    return {t["content"]: t["id"] for t in added}


def _encoder(shared, pattern: str, added: dict[str, int]):
    """One encoder per worker process and vocabulary."""
    import tiktoken

    ranks = shared.value
    key = (len(ranks), hash(frozenset(ranks.items())), pattern, frozenset(added.items()))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    return _ENCODERS[key]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole if it fits, else a first piece with
    the remainder and full ones after it."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def token_pieces(docs: DataFrame, ranks: dict[bytes, int], pattern: str, end_id: int, capacity: int, with_ids: bool = False,
                 added: dict[str, int] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document; the vocabulary (a
    file of fixed size) is broadcast. An ``added`` token in a text is its id; without them its
    letters are encoded like any others."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        encoder = _encoder(shared, pattern, added or {})
        for batch in batches:
            for lo, _, part in text_chunks(batch.column(1)):
                rows, crc, tokens = [], [], []
                for i, text in enumerate(part, lo):
                    ids = np.append(encoder.encode_to_numpy(text, allowed_special="all", disallowed_special=()), end_id).astype("<u4")
                    for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                        rows.append((i, piece, start, length))
                        own = ids[start:start + length]
                        crc.append(zlib.crc32(own.tobytes()))
                        if with_ids:
                            tokens.append(own)
                row, piece, start, length = np.array(rows, np.int64).T
                columns = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                           pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    ends = np.cumsum([0, *length.tolist()]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(tokens).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).mapInArrow(run, schema)


# --- the packing of the histogram -----------------------------------------------------------

def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[Patterns, dict[int, int]]:
    """Fixed patterns and what is left of the histogram."""
    left = {w: n for w, n in counts.items() if n > 0}
    fixed: Patterns = []

    def take(items: tuple[int, ...], times: int) -> None:
        fixed.append((items, times))
        for w in items:
            left[w] -= times
            if not left[w]:
                del left[w]

    def dominating(w: int) -> tuple[tuple[int, ...], int] | None:
        """A set with w that dominates all others, and how often it can be fixed at once: taking
        pieces away never makes another set fit, so it dominates until its pieces run out."""
        room = capacity - w
        sizes = sorted(x for x in left if x <= room and left[x] > (x == w))
        if not sizes:
            return (w,), left[w]
        best = sizes[-1]
        if best == room or not _sum_between(sizes, [left[x] - (x == w) for x in sizes], best, room):
            return (w, best), left[w] // 2 if best == w else min(left[w], left[best])
        return None

    changed = True
    while changed:
        changed = False
        for w in sorted(left, reverse=True):
            while w in left and (found := dominating(w)):
                take(*found)
                changed = True
    return fixed, left


def _sum_between(sizes: list[int], counts: list[int], low: int, high: int) -> bool:
    """Whether some pieces have a sum above ``low`` and up to ``high``; no single piece has."""
    if sizes[0] + sizes[0 if counts[0] > 1 or len(sizes) < 2 else 1] > high:
        return False
    sums, within, wanted = 1, (1 << (high + 1)) - 1, (1 << (high + 1)) - (1 << (low + 1))
    for size, n in zip(reversed(sizes), reversed(counts)):  # bit k of sums: some pieces have the sum k
        n, times = min(n, high // size), 1
        while n:
            times = min(times, n)
            sums |= sums << size * times & within
            n, times = n - times, 2 * times
        if sums & wanted:
            return True
    return False


def best_fit(counts: dict[int, int], capacity: int) -> Patterns:
    """Best fit, longest pieces first; equal pieces and equal sequences are handled together."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            room = min((r for r, groups in open_.items() if r >= w and groups), default=None)
            items, times = ((), n) if room is None else open_[room].pop()
            room = capacity if room is None else room
            each = min(room // w, n)
            full = min(times, n // each)
            n -= full * each
            open_[room - each * w].append((items + (w,) * each, full))
            if items and times > full:
                open_[room].append((items, times - full))
    return [g for groups in open_.values() for g in groups]


def solve(counts: dict[int, int], capacity: int) -> Patterns:
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def slots(patterns: Patterns) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset) sorted by length and first rank."""
    rows, used, sequence = [], defaultdict(int), 0
    for items, times in patterns:
        offset = 0
        for w in items:
            rows.append((w, used[w], sequence, offset))
            used[w] += times
            offset += w
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


# --- the packing of the pieces ---------------------------------------------------------------

def with_ranks(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 within each length. Equal rows are counted before they are ranked."""
    names = pieces.columns
    parts = max(1, math.ceil(pieces.count() / RANKED_TOGETHER))
    rows = (pieces.groupBy(*names).agg(F.count(F.lit(1)).alias("times"))
            .withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts))))
    within = W.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = (rows.groupBy("length", "part").agg(F.sum("times").alias("size"))
             .select("length", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before")))
    ranked = rows.withColumn("first", F.sum("times").over(within) - F.col("times"))
    return (ranked.join(stored(sizes, "length-parts"), ["length", "part"])
            .select(*names, (F.col("first") + F.col("before")).alias("first"), F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("k"))
            .select(*names, (F.col("first") + F.col("k")).alias("rank")))


def pack(docs: DataFrame, ranks: dict[bytes, int], pattern: str, end_id: int = 2, capacity: int = 1024,
         added: dict[str, int] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = stored(token_pieces(docs, ranks, pattern, end_id, capacity, added=added), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    shared = docs.sparkSession.sparkContext.broadcast(slots(solve(counts, capacity)))

    def place(batches):
        table = shared.value
        key = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            slot = np.searchsorted(key, (length << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(table[slot, 2] + rank - table[slot, 1]), pa.array(table[slot, 3])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return with_ranks(pieces).mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
