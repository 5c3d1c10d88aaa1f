"""Byte-level BPE encoding and decoding with a given rank file.

Every match of the split pattern is encoded by itself. The distinct matches of a batch are
put into padded matrices by length; in each round every row merges its leftmost pair of
least rank, looked up in a hash table of pairs, so all rows get one column shorter; rows
without a pair are taken out. A match that is a token as a whole is that token. Matches are
remembered per task in a table of bounded size.

Matches of more than ``WIDE`` bytes are rows of their own; there a round merges all places of
the least rank, as long as that is what leftmost merges would have done.

Defined cases: a null text counts as empty (no ids, no bytes); repeated rows are encoded
each; null ids decode to no bytes; an empty table gives an empty result; other columns pass through
``decode`` and are ignored by ``encode``.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .shingles import text_chunks

WIDE = 48
#: Remembered matches per task, and the longest that is remembered.
REMEMBERED, LONGEST = 400_000, 64
#: Ids per batch that ``decode`` gives out.
DECODED_TOGETHER = 1 << 19
_NONE = np.int32(2**31 - 1)
_FREE = np.uint64(2**64 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one line per token, base64 bytes and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PairTable:
    """Open-addressing hash table (left id, right id) → rank, probed for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> None:
        bits = max(4, int(4 * len(left)).bit_length())
        self.mask, self.shift = np.uint64((1 << bits) - 1), np.uint64(64 - bits)
        self.keys = np.full(1 << bits, _FREE, np.uint64)
        self.ranks = np.full(1 << bits, _NONE, np.int32)
        key = self._key(left, right)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == _FREE]
            at, first = np.unique(slot[free], return_index=True)
            self.keys[at], self.ranks[at] = key[free[first]], rank[free[first]]
            todo = np.setdiff1d(todo, free[first], assume_unique=True)
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(left, right):
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, key):
        return (key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, or ``_NONE``. Negative ids (padding) have none."""
        out = np.full(left.shape, _NONE, np.int32)
        flat = out.ravel()
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        key = self._key(left.ravel()[todo], right.ravel()[todo])
        slot = self._slot(key)
        while len(todo):
            there = self.keys[slot]
            hit = there == key
            flat[todo[hit]] = self.ranks[slot[hit]]
            on = ~hit & (there != _FREE)
            todo, key, slot = todo[on], key[on], (slot[on] + np.uint64(1)) & self.mask
        return flat.reshape(left.shape)


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.pairs = PairTable(left, right, rank.astype(np.int32))
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            tokens[r] = t
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.known: dict[str, bytes] = {}

    # --- encoding
    def _wide(self, piece: bytes) -> np.ndarray:
        """One long row. All places of the least rank are merged at once, unless a merge makes
        a pair that ranks before the places still waiting; then only the leftmost is."""
        ids = self.byte[np.frombuffer(piece, np.uint8)]
        rank = self.pairs.find(ids[:-1], ids[1:])
        while len(rank) and (least := rank.min()) != _NONE:
            at = np.flatnonzero(rank == least)
            if len(at) > 1:  # of overlapping places every other one, from the left
                run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
                at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
                own = np.full(len(at), least)
                sooner = min(self.pairs.find(own[:1], own[:1])[0],
                             self.pairs.find(ids[at[at > 0] - 1], own[at > 0]).min(initial=_NONE),
                             self.pairs.find(own[at + 2 < len(ids)], ids[at[at + 2 < len(ids)] + 2]).min(initial=_NONE))
                if sooner <= least:
                    at = at[:1]
            ids[at] = least
            ids, rank = np.delete(ids, at + 1), np.delete(rank, at)
            at = at - np.arange(len(at))  # where the merged ids are now
            for near in (at[at > 0] - 1, at[at < len(rank)]):
                rank[near] = self.pairs.find(ids[near], ids[near + 1])
        return ids

    def _matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        sizes = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < sizes[:, None], self.byte[raw], np.int32(-1))
        rank = self.pairs.find(ids[:, :-1], ids[:, 1:])
        out: list[np.ndarray | None] = [None] * len(pieces)
        rows = np.arange(len(pieces))
        while True:
            least = rank.min(axis=1) if rank.shape[1] else np.full(len(ids), _NONE)
            for k in np.flatnonzero(least == _NONE):
                out[rows[k]] = ids[k][ids[k] >= 0]
            on = least != _NONE
            if not on.any():
                return out
            rows, ids, rank, least = rows[on], ids[on], rank[on], least[on]
            at = rank.argmin(axis=1)
            every = np.arange(len(rows))
            ids[every, at] = least
            keep = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, keep + (keep > at[:, None]), axis=1)
            keep = keep[:-1]
            rank = np.take_along_axis(rank, keep + (keep >= at[:, None]), axis=1)
            before = np.flatnonzero(at > 0)
            rank[before, at[before] - 1] = self.pairs.find(ids[before, at[before] - 1], ids[before, at[before]])
            after = np.flatnonzero(at < ids.shape[1] - 1)
            rank[after, at[after]] = self.pairs.find(ids[after, at[after]], ids[after, at[after] + 1])

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif len(p) > WIDE:
                out[i] = self._wide(p)
            else:
                buckets.setdefault(next(w for w in (4, 6, 8, 10, 12, 16, 24, WIDE) if w >= len(p)), []).append(i)
        for width, members in buckets.items():
            for i, ids in zip(members, self._matrix([pieces[i] for i in members], width)):
                out[i] = ids
        return out

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of every text, in order."""
        split = [self.split.findall(t) for t in texts]
        fresh = list(set().union(*split) - self.known.keys())
        long = {p: ids.tobytes() for p, ids in zip(fresh, self.encode_pieces([p.encode() for p in fresh]))}
        self.known |= {p: ids for p, ids in long.items() if len(p) <= LONGEST}
        long = {p: ids for p, ids in long.items() if len(p) > LONGEST}
        known = self.known
        for pieces in split:
            if long:
                ids = b"".join([known[p] if p in known else long[p] for p in pieces])
            else:
                ids = b"".join([known[p] for p in pieces])
            yield np.frombuffer(ids, np.int32)
        if len(known) > REMEMBERED:
            self.known = {}

    # --- decoding
    def decode(self, ids: np.ndarray) -> bytes:
        size = self.length[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b""
        return self.flat[np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1])].tobytes()


_CODECS: dict[tuple, Codec] = {}


def _codec(shared, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    key = (len(shared.value), hash(frozenset(shared.value.items())), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value, pattern)
    return _CODECS[key]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """documents → doc_id, ids (array of int) of the whole text. The vocabulary (a file of
    fixed size) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        codec = _codec(shared, pattern)
        for batch in batches:
            for lo, hi, part in text_chunks(batch.column(1)):
                ids = list(codec.encode(part))
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))],
                    names=["doc_id", "ids"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
            .mapInArrow(run, "doc_id long, ids array<int>"))


def decode(encoded: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Replaces the column ``ids`` by ``decoded``, the bytes of its tokens."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    others = [c for c in encoded.columns if c != "ids"]

    def run(batches):
        codec = _codec(shared, pattern)
        for batch in batches:
            column = batch.column(len(others))
            ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + DECODED_TOGETHER, "right")) - 1)
                data = [codec.decode(values[a:b]) for a, b in zip(ends[lo:hi].tolist(), ends[lo + 1:hi + 1].tolist())]
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[:-1]), pa.array(data, pa.binary())], names=[*others, "decoded"])
                lo = hi

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != "ids")
    return encoded.select(*others, F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(run, f"{fields}, decoded binary")
