"""Near-duplicate classes by one-permutation MinHash with optimal densification.

1. One pass over the texts gives every document its set of hashed 5-word shingles (A-Z
   lower-cased), a 128-bit key of the set, and a signature of ``BANDS * ROWS`` bins: the
   smallest shingle hash of each bin; an empty bin copies a full one that a hash of
   (bin, attempt) chooses. Documents with the same set are one class from here on.
2. Bands of the signatures are buckets. Each bucket gives star-shaped edges, from every
   member to the smallest one, so a bucket of n members gives n - 1 pairs. They are
   confirmed on the full sets and joined into components.
3. A star can miss a link between two members that are both unlike the centre. Only
   buckets whose members ended up in different components can hide one. Their documents go
   through an exact search: shingles in order of rarity, a prefix of each set that any
   similar set must share a member of, bounds on size and place, and only pairs across
   components. The pairs are confirmed on the full sets, and the components merged.

Two sets with a similarity of 0.75 share no band with a probability of about 1e-6 (less
above); no cap is set anywhere.

Defined cases: texts of any length give their whole set; a similarity of exactly the bound links;
a document without words or text has an empty set, is linked with nothing and
stays; rows that repeat doc_id and text carry the same verdict; two different texts under
one doc_id are one node (a link of either is a link of both); a row without doc_id joins
the component of a document with the same set, else it stays alone with a null
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import row_key, semi_join, stored, text_or_empty
from .components import connected_components
from .shingles import column_sets, mix

ROWS, BANDS = 5, 50
#: Documents per signature matrix.
BLOCK = 1024
#: Items before it that a prefix item carries.
EARLIER = 4


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """(documents, bins) of bin minima, empty bins densified. Sets are sorted and not empty."""
    sig = np.zeros((len(sets), bins), np.uint64)
    full = np.zeros((len(sets), bins), bool)
    for i, s in enumerate(sets):
        place = (((s >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
        head = np.flatnonzero(np.diff(place, prepend=-1))
        sig[i, place[head]] = s[head]
        full[i, place[head]] = True
    lone = full.sum(axis=1) == 1
    sig[lone] = sig[lone].max(axis=1, keepdims=True)
    row, col = np.nonzero(~full & ~lone[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        source = (mix(col.astype(np.uint64) + np.uint64(attempt * 0x632BE59BD9B4E019 & (2**64 - 1))) % np.uint64(bins)).astype(np.int64)
        hit = full[row, source]
        sig[row[hit], col[hit]] = sig[row[hit], source[hit]]
        row, col = row[~hit], col[~hit]
    return sig


def band_hashes(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """(documents, bands) bucket keys."""
    odd = np.arange(1, 2 * rows, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    part = mix(sig).reshape(len(sig), bands, rows) * odd
    return mix(part.sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = np.zeros(0, np.uint64)
    for batch in batches:
        block: list[np.ndarray] = []
        done = 0

        def flush():
            nonlocal done
            n = np.array([len(s) for s in block], np.int64)
            keys = np.zeros((2, len(block)), np.uint64)
            bands = np.zeros((len(block), BANDS), np.int64)
            some = [s for s in block if len(s)]
            if some:
                keys[0, n > 0] = [np.add.reduce(mix(s + np.uint64(1)), dtype=np.uint64) for s in some]
                keys[1, n > 0] = [np.bitwise_xor.reduce(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))) for s in some]
                bands[n > 0] = band_hashes(signatures(some, ROWS * BANDS), ROWS, BANDS)
            head = batch.slice(done, len(block))
            done += len(block)
            return pa.RecordBatch.from_arrays(
                [head.column(0), head.column(1), pa.array(n), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))],
                names=["k_id", "k_text", "n", "key1", "key2", "bands"])

        for s in column_sets(batch.column(2)):
            block.append(s if len(s) else empty)
            if len(block) == BLOCK:
                yield flush()
                block = []
        if block:
            yield flush()


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done, rows, size = 0, [], 0
        for s in [*column_sets(batch.column(1)), None]:
            if s is not None:
                rows.append(s.view(np.int64))
                size += len(s)
            if rows and (s is None or size > 500_000):
                ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(rows)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))],
                    names=["node", "items"])
                done, rows, size = done + len(rows), [], 0


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = 75) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets (node, items) are at least ``percent`` % similar."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(left, "a").join(right, "b")
            .where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b"))


def _fits(n: Column, m: Column, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """k_id, k_text, n_shingles, component_id, kept of every row of ``docs``."""
    rows = stored(docs.select(*row_key(), text_or_empty().alias("t")).mapInArrow(
        _sketch, "k_id long, k_text long, n long, key1 long, key2 long, bands array<long>"), "sketches")
    classes = rows.where("n > 0 AND k_id IS NOT NULL").groupBy("key1", "key2").agg(
        F.min("k_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = stored(classes, "set-classes")

    # star-shaped candidate edges of the buckets with two members or more
    members = classes.select("node", "n", F.explode("bands").alias("band"))
    centres = (members.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n")).alias("c"))
               .where("size > 1").select("band", F.col("c.node").alias("centre"), F.col("c.n").alias("c_n")))
    members = stored(members.join(stored(centres, "centres"), "band"), "bucket-members")
    star = (members.where("node <> centre").where(_fits(F.col("n"), F.col("c_n"), percent))
            .select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    needed = stored(members.select("node").distinct(), "bucket-nodes")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), text_or_empty().alias("t"))
    sets = semi_join(texts, needed, "node", F.xxhash64).mapInArrow(_full_sets, "node long, items array<long>")
    if not rows.where("n > 0").groupBy("k_id", "k_text").count().where("count > 1").isEmpty():
        sets = sets.dropDuplicates(["node", "items"])  # documents listed twice
    sets = stored(sets.withColumn("own", F.xxhash64("items")), "full-sets")
    links = stored(confirmed(star, sets, percent), "star-links")
    parts = stored(connected_components(links), "components")

    # links that the stars can't see
    found = stored(confirmed(_across(members, parts, sets, percent), sets, percent), "cross-links")
    if not found.isEmpty():
        parts = stored(connected_components(links.union(found)), "components")

    keyed = classes.select("key1", "key2", "node").join(parts, "node", "left").select(
        F.col("key1").alias("c_key1"), F.col("key2").alias("c_key2"), F.coalesce("component", "node").alias("component"))
    out = rows.drop("bands").join(keyed, (F.col("n") > 0) & (F.col("key1") == F.col("c_key1")) & (F.col("key2") == F.col("c_key2")), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("k_id"))
    return out.select("k_id", "k_text", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("k_id").eqNullSafe(component).alias("kept"))


def _across(members: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) in different components that an exact prefix search leaves, among the
    documents of buckets that span components."""
    own = F.coalesce("component", "node")
    placed = members.select("band", "node").join(parts, "node", "left").select("band", "node", own.alias("part"))
    split = placed.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("band")
    open_nodes = stored(placed.join(split, "band", "left_semi").select("node", "part").distinct(), "open-nodes")

    items = sets.join(open_nodes, "node").select(
        "node", "part", "own", F.size("items").alias("n"), F.explode("items").alias("item"))
    common = items.groupBy("item").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    common = stored(items.join(common, "item"), "common-items")
    # a similar set shares one of the n - ceil(0.75 n) + 1 rarest items; items of one set only come first
    seen = W.partitionBy("node", "own")
    place = F.col("n") - F.count(F.lit(1)).over(seen) + F.row_number().over(seen.orderBy("df", "item")) - 1
    prefix = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100)
    earlier = F.collect_list("item").over(seen.orderBy("df", "item").rowsBetween(-EARLIER, -1))
    heads = stored(common.withColumn("place", place).withColumn("earlier", earlier).where(F.col("place") <= prefix)
                   .select("item", "node", "part", "n", "place", "earlier"), "prefixes")
    # of an item's components the largest one meets the others, not itself
    sizes = heads.groupBy("item", "part").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("item").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("size", "part")).alias("m")).where("parts > 1")
    main = stored(main.select("item", F.col("m.part").alias("main")), "main-parts")
    heads = stored(heads.join(main, "item"), "open-prefixes")
    x, y = heads.where("part <> main").alias("x"), heads.alias("y")
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    enough = (100 + percent) * left >= percent * (F.col("x.n") + F.col("y.n"))
    new = (F.col("x.part") != F.col("y.part")) & ((F.col("y.part") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
    # copies share runs of items: two sets that share one just before have met there, their first meeting is never left out
    first = ~F.arrays_overlap("x.earlier", "y.earlier")
    met = x.join(y, (F.col("x.item") == F.col("y.item")) & new & enough & _fits(F.col("x.n"), F.col("y.n"), percent) & first)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
