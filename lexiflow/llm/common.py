"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.session import stored  # noqa: F401  tables in the shared checkpoint folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of a rejected key in a hash table.
KEY_BYTES = 64
#: Bits of a page of ``may_hold``, bits per key, and the most pages (4 KB each).
PAGE_BITS, BITS_PER_KEY, MOST_PAGES = 32768, 32, 2048
#: White space that separates words, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"


def let(expr: Column, body: Callable[[Column], Column]) -> Column:
    """``body(expr)`` with ``expr`` evaluated once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(expr), body), 1)


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other code point as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key() -> list[Column]:
    """Columns that name a document when ``doc_id`` may be null or repeated."""
    return [F.col("doc_id").alias("k_id"), F.xxhash64(text_or_empty()).alias("k_text")]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has (letters of either case)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def may_hold(df: DataFrame, value: Callable[[DataFrame], Column], keys: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``value`` (long, of a uniform hash) may be a ``key`` of ``keys``, and all others: columns
    unchanged, two readings of ``df``. Every key sets one bit in pages of bits, which are broadcast instead of the keys
    (MOST_PAGES at most); about one other row in BITS_PER_KEY is among the first, more where the pages are full."""
    pages = min(MOST_PAGES, max(1, math.ceil(keys.count() * BITS_PER_KEY / PAGE_BITS)))
    place = lambda c: F.pmod(c, F.lit(pages * PAGE_BITS).cast("long"))
    page, bits = free_name(df, "bit_page"), free_name(df, "page_bits")
    own = place(key)
    filled = stored(keys.select(F.shiftright(own, 15).alias(page), own.bitwiseAND(F.lit(PAGE_BITS - 1).cast("long")).alias("at"))
                    .groupBy(page).agg(F.bitmap_construct_agg("at").alias(bits)), "key-bits")
    at = place(value(df))
    byte = F.substring(filled[bits], (F.shiftright(at.bitwiseAND(F.lit(PAGE_BITS - 1).cast("long")), 3) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), at.bitwiseAND(F.lit(7).cast("long")).cast("int"))
    met = df.join(F.broadcast(filled), F.shiftright(at, 15) == filled[page], "left")
    hit = F.coalesce(bit, F.lit(0)) == 1
    return met.where(hit).drop(page, bits), met.where(~hit).drop(page, bits)


def few(keys: DataFrame) -> bool:
    """Whether the counted keys are within the session's bound for broadcasts."""
    bound = keys.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return keys.count() * KEY_BYTES <= bound


def semi_join(docs: DataFrame, keys: DataFrame, on: str, value: Callable[[Column], Column]) -> DataFrame:
    """The rows of ``docs`` whose column ``on`` is one of the stored ``keys``; ``value``: its uniform hash. Few keys are broadcast,
    else only rows that may hold one are shuffled."""
    if few(keys):
        return docs.join(F.broadcast(keys), on, "left_semi")
    may, _ = may_hold(docs, lambda df: value(df[on]), keys, value(keys[on]))
    return may.join(keys.hint("shuffle_hash"), on, "left_semi")


def drop_rows(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the documents named in ``rejected`` (k_id, k_text); columns unchanged. Few keys are
    broadcast, if their counted size is within the session's bound; else they are the hashed side of
    a shuffled join, so no text is sorted, and only texts that may be rejected are shuffled."""
    rejected = stored(rejected.select("k_id", "k_text"), "rejected-keys")
    text_hash = lambda df: F.xxhash64(F.coalesce(df["text"].cast("string"), F.lit("")))
    same = lambda df: df["doc_id"].eqNullSafe(rejected["k_id"]) & (text_hash(df) == rejected["k_text"])
    if few(rejected):
        return docs.join(F.broadcast(rejected), same(docs), "left_anti")
    key = lambda i, t: F.xxhash64(i.cast("string"), t)
    may, others = may_hold(docs, lambda df: key(df["doc_id"], text_hash(df)), rejected, key(F.col("k_id"), F.col("k_text")))
    return others.union(may.join(rejected.hint("shuffle_hash"), same(may), "left_anti"))
