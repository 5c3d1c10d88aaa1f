"""Exact deduplication against immutable snapshots.

A snapshot is a table of exact buckets (one row per distinct digest) with static
binary-fuse filters, one per digest bucket, so that no filter grows with the corpus.
An incoming batch is first grouped by itself; its distinct digests are screened by the
snapshot's filters, and only the positives join the exact buckets. Digests that occur
twice or more, in the batch, in the snapshot or across both, are candidates; their texts
are compared byte by byte (texts are grouped by digest and whole text, combined in each
task before the shuffle, so a text with a million copies moves once per task). If two
texts should share a digest, their rows are settled by the texts themselves.

``exact_dedup`` runs this over one table: the rows are dealt by a hash of doc_id into
batches, each batch is screened against the snapshots of the batches before it and then
frozen as the next one.

Defined cases: a null text counts as empty; a null doc_id is smaller than any other; rows that
repeat doc_id and text are one document listed twice: they count in group_size and carry
the same verdict; texts of any length are compared whole; an empty table gives an empty result;
other columns are ignored, and ``keep_one`` keeps them, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_rows, free_name, row_key, semi_join, stored, text_or_empty

#: Distinct digests per filter (about 1.13 bytes each), and the least number of filters.
KEYS_PER_FILTER = 20_000
MIN_FILTERS = 128


# --- binary-fuse filter over 64-bit keys, 3-wise, 8-bit fingerprints ---------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _geometry(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of start segments for n keys."""
    length = 4 if n < 2 else 1 << min(18, max(2, int(math.floor(math.log(n) / math.log(3.33) + 2.25))))
    factor = 1.125 if n < 2 else max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    return length, max(1, math.ceil(n * factor / length) - 2)


def _places(keys: np.ndarray, seed: int, length: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, 3) slots and 8-bit fingerprints of the keys."""
    h = _mix(keys + np.uint64(seed))
    span = np.uint64(starts * length)
    first = ((h >> np.uint64(32)) * span) >> np.uint64(32)
    mask, step = np.uint64(length - 1), np.uint64(length)
    slots = np.stack([first, (first + step) ^ ((h >> np.uint64(18)) & mask), (first + step + step) ^ (h & mask)], axis=1)
    return slots.astype(np.int64), ((h ^ (h >> np.uint64(40))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """seed, segment length, start segments, fingerprints. Slots that a single key uses are
    peeled layer by layer and filled in the opposite order; a seed that leaves a core is
    replaced by the next one."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    length, starts = _geometry(n)
    for seed in range(1, 200):
        slots, prints = _places(keys, seed * 0x9E3779B97F4A7C15 & (2**64 - 1), length, starts)
        size = (starts + 2) * length
        count = np.bincount(slots.ravel(), minlength=size)
        total = np.zeros(size, np.int64)
        np.add.at(total, slots.ravel(), np.repeat(np.arange(n), 3))
        layers, single = [], np.flatnonzero(count == 1)
        done = 0
        while len(single):
            key, at = np.unique(total[single], return_index=True)
            layers.append((key, single[at]))
            done += len(key)
            touched = slots[key].ravel()
            np.subtract.at(count, touched, 1)
            np.subtract.at(total, touched, np.repeat(key, 3))
            touched = np.unique(touched)
            single = touched[count[touched] == 1]
        if done == n:
            out = np.zeros(size, np.uint8)
            for key, slot in reversed(layers):
                own = slots[key]
                out[slot] = prints[key] ^ out[own[:, 0]] ^ out[own[:, 1]] ^ out[own[:, 2]]
            return seed, length, starts, out.tobytes()
        starts += 1
    raise ValueError("no seed peels the keys")


def probe_filter(keys: np.ndarray, seed: int, length: int, starts: int, blob: bytes) -> np.ndarray:
    """True for every key that the filter was built over, and for about 0.4 % of the others."""
    table = np.frombuffer(blob, np.uint8)
    slots, prints = _places(keys.astype(np.uint64), seed * 0x9E3779B97F4A7C15 & (2**64 - 1), length, starts)
    return (table[slots[:, 0]] ^ table[slots[:, 1]] ^ table[slots[:, 2]]) == prints


# --- snapshots -----------------------------------------------------------------------------

@dataclass
class Snapshot:
    """Exact buckets (h, sha, n) and filters (bucket, seed, length, starts, blob); both stored."""
    buckets: DataFrame
    filters: DataFrame
    n_filters: int


def _bucket(n: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.col("h"), 8), F.lit(n)).cast("int").alias("bucket")


def freeze(groups: DataFrame) -> Snapshot:
    """Snapshot of grouped digests (h, sha, n)."""
    buckets = stored(groups, "exact-buckets")
    n_filters = max(MIN_FILTERS, math.ceil(buckets.count() / KEYS_PER_FILTER))

    def build(key, part):
        seed, length, starts, blob = build_filter(part["h"].to_numpy())
        return pd.DataFrame({"bucket": [key[0]], "seed": [seed], "length": [length], "starts": [starts], "blob": [blob]})

    filters = (buckets.select("h", _bucket(n_filters)).groupBy("bucket")
               .applyInPandas(build, "bucket int, seed int, length int, starts int, blob binary"))
    return Snapshot(buckets, stored(filters, "fuse-filters"), n_filters)


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The rows of ``groups`` (h, sha) whose digest passes the snapshot's filters."""
    def probe(key, part, filters):
        if not len(filters) or not len(part):
            return part.iloc[:0][["h", "sha"]]
        f = filters.iloc[0]
        return part[probe_filter(part["h"].to_numpy(), int(f.seed), int(f.length), int(f.starts), f.blob)][["h", "sha"]]

    return (groups.select("h", "sha", _bucket(snapshot.n_filters)).groupBy("bucket")
            .cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(probe, "h long, sha binary"))


def repeated_digests(groups: DataFrame, snapshots: list[Snapshot]) -> DataFrame:
    """(h, sha) of ``groups`` that occur twice in the batch, or in it and in a snapshot."""
    found = groups.where("n > 1").select("h", "sha")
    for snap in snapshots:
        found = found.union(screen(groups, snap).join(snap.buckets.select("h", "sha"), ["h", "sha"]))
    return found


def digests(docs: DataFrame) -> DataFrame:
    """k_id, h (screening digest) and sha (exact digest) of every row: one pass over the texts."""
    return docs.select(*row_key(), F.unhex(F.sha2(text_or_empty(), 256)).alias("sha")).withColumnRenamed("k_text", "h")


def exact_dedup(docs: DataFrame, batches: int = 2) -> DataFrame:
    """k_id, k_text, keep_id, group_size, kept and sha of every row of ``docs``."""
    rows = stored(digests(docs), "digests")
    batch = F.pmod(F.xxhash64("k_id"), F.lit(batches))
    snapshots, repeated = [], None
    for i in range(batches):
        groups = stored(rows.where(batch == i).groupBy("h", "sha").agg(F.count(F.lit(1)).alias("n")), "batch-groups")
        found = repeated_digests(groups, snapshots)
        repeated = found if repeated is None else repeated.union(found)
        if i + 1 < batches:
            snapshots.append(freeze(groups))
    wanted = stored(repeated.select("h").distinct(), "repeated")

    # byte check: group the candidates by digest and whole text
    text = text_or_empty()
    candidates = docs.select(F.col("doc_id").alias("k_id"), text.alias("t")).withColumn("h", F.xxhash64("t"))
    candidates = semi_join(candidates, wanted, "h", F.xxhash64).withColumn("sha", F.unhex(F.sha2("t", 256)))
    texts = candidates.groupBy("sha", "t").agg(F.max("k_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    sized = stored(texts.groupBy("sha").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"),
                                            F.sum("group_size").alias("group_size")), "byte-groups")
    clash = sized.where("texts > 1").select("sha")
    multi = sized.where("texts = 1 AND group_size > 1").select(F.col("sha").alias("g_sha"), "keep_id", "group_size")
    alone = rows
    settled = None
    if not clash.isEmpty():  # two texts of one digest: settle these rows by their texts
        own = (docs.select(*row_key(), text.alias("t")).withColumn("sha", F.unhex(F.sha2("t", 256)))
               .join(clash, "sha", "left_semi"))
        settled = own.join(texts, ["sha", "t"]).select("k_id", F.col("k_text").alias("h"), "sha", "keep_id", "group_size")
        alone = rows.join(clash, "sha", "left_anti")
    out = alone.join(multi, F.col("sha") == F.col("g_sha"), "left").select(
        "k_id", "h", "sha", F.when(F.col("g_sha").isNull(), F.col("k_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))
    if settled is not None:
        out = out.unionByName(settled)
    return out.select("k_id", F.col("h").alias("k_text"), "keep_id", "group_size",
                      F.col("k_id").eqNullSafe(F.col("keep_id")).alias("kept"), "sha")


def keep_one(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of equal texts; columns unchanged."""
    verdicts = stored(verdicts.where("group_size > 1").select("k_id", "k_text", "kept"), "dedup-verdicts")
    out = drop_rows(docs, verdicts.where("NOT kept").select("k_id", "k_text").distinct())
    twice = stored(verdicts.where("kept").groupBy("k_id", "k_text").count().where("count > 1")
                   .select("k_id", "k_text"), "listed-twice")
    if twice.isEmpty():
        return out
    same = F.col("doc_id").eqNullSafe(twice["k_id"]) & (F.xxhash64(text_or_empty()) == twice["k_text"])
    name = free_name(docs, "whole_text_key")
    listed = out.join(twice, same, "left_semi").withColumn(name, text_or_empty()).dropDuplicates(["doc_id", name])
    return drop_rows(out, twice).unionByName(listed.drop(name))
