"""Byte-pair encoding over the table of distinct words.

The corpus is the lower-cased cleaned text split into words. Instead of one row per
occurrence, every distinct word is one row with its frequency and its first
position in corpus order (document id, word position) — pair counts are frequency
weighted, and "first seen" ties are resolved from the first positions.

Two merge rules:
* ``substring`` — a word is the string of its symbols joined by spaces and a merge
  replaces the substring "a b" by "ab", left to right without overlap; it can cut
  across symbols ("xa b" contains "a b"). Ties between equally frequent pairs go to
  the pair seen first in corpus order.
* ``symbol`` — whole-symbol equality, left to right; ties go to the smallest pair.

``train`` holds the distinct words in blocks (``bpe_blocks``). A round is one job: all blocks make the
merges that can't change each other, and send back how the counts of pairs changed. What the driver holds are the
symbols and the counts of their pairs, never a word.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark import RDD, Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete_path, ensure_checkpoint_dir, stored
from . import bpe_blocks as blocks
from .ranking import range_rank


def word_table(tokens: DataFrame) -> DataFrame:
    """(word, freq, first_doc, first_pos) from cleaned tokens (doc_id, pos, token)."""
    w = tokens.select(F.lower("token").alias("word"), "doc_id", "pos").where(F.col("word") != "")
    return w.groupBy("word").agg(
        F.count(F.lit(1)).alias("freq"),
        F.min(F.struct("doc_id", "pos")).alias("_first"),
    ).select("word", "freq", F.col("_first.doc_id").alias("first_doc"), F.col("_first.pos").alias("first_pos"))


def characters(word: Column) -> Column:
    """array of the code points of ``word`` as strings."""
    return F.regexp_extract_all(word, F.lit("(?s)."), 0)


def with_symbols(words: DataFrame, eow: str = "_") -> DataFrame:
    """Add ``syms``: characters of the word plus the end-of-word token."""
    return words.withColumn("syms", F.concat(characters(F.col("word")), F.array(F.lit(eow))))


def initial_vocabulary(words: DataFrame, mode: str = "substring") -> DataFrame:
    """(symbol): distinct initial symbols. In ``substring`` mode the vocabulary is made of
    the characters of the joined symbol strings, so a multi-character end token
    contributes its characters (the space is dropped at the end)."""
    if mode == "substring":
        chars = words.select(F.explode(characters(F.concat_ws("", "syms"))).alias("symbol"))
    else:
        chars = words.select(F.explode("syms").alias("symbol"))
    return chars.where((F.col("symbol") != "") & (F.col("symbol") != " ")).distinct()


def _pairs(words: DataFrame, syms: Column) -> DataFrame:
    z = F.arrays_zip(F.slice(syms, 1, F.greatest(F.size(syms) - 1, F.lit(0))), F.slice(syms, 2, F.size(syms)))
    return words.select("freq", "first_doc", "first_pos",
                        F.posexplode(z).alias("i", "p")).select(
        F.col("p.0").alias("a"), F.col("p.1").alias("b"), "freq", "first_doc", "first_pos", "i")


def pair_counts(words: DataFrame, syms: Column | None = None) -> DataFrame:
    """(a, b, cnt): frequency-weighted adjacent pairs."""
    return _pairs(words, F.col("syms") if syms is None else syms).groupBy("a", "b").agg(F.sum("freq").alias("cnt"))


class BpeResult(NamedTuple):
    merges: DataFrame  # (rank, a, b, cnt)
    vocab: DataFrame  # (position, token)
    words: DataFrame  # (word, freq, first_doc, first_pos, seg, syms)


#: Distinct words of a block (up to the first number all are one block; at most), and rounds between checkpoints.
ALONE_WORDS, MOST_WORDS, ROUNDS_PER_CHECKPOINT = 100_000, 2_000_000, 20


def train(words: DataFrame, n: int, eow: str = "_", mode: str = "substring", checkpoint_every: int = ROUNDS_PER_CHECKPOINT,
          tasks: int | None = None) -> BpeResult:
    """Up to ``n`` merges, stopping when no pair is left. ``tasks``: blocks of words. Words with the same first
    place (repeated document ids) are taken in the order of the words."""
    if mode not in ("substring", "symbol"):
        raise ValueError("mode must be 'substring' or 'symbol'")
    spark, substring = words.sparkSession, mode == "substring"
    w = with_symbols(words, eow)
    if substring:
        w = w.withColumn("syms", F.split(F.concat_ws(" ", "syms"), " ", -1))
    w = stored(w.orderBy("first_doc", "first_pos", "word").withColumn("place", F.monotonically_increasing_id()), "bpe-words")
    n_words = w.count()
    cores = spark.sparkContext.defaultParallelism
    tasks = tasks or (cores * math.ceil(n_words / (cores * MOST_WORDS)) if n_words > ALONE_WORDS else 1)
    alphabet = sorted(r[0] for r in w.select(F.explode("syms")).distinct().collect())

    def pack(batches):
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(blocks.block_of(batches, alphabet))], pa.binary())], names=["block"])

    packed = w.select("syms", "freq", "place").repartition(tasks).sortWithinPartitions("place").mapInArrow(pack, "block binary")
    if tasks == 1:  # no job a round
        state = _Blocks(packed.rdd.map(lambda row: blocks.train_alone(pickle.loads(row["block"]), alphabet, n, substring)), checkpoint_every)
        made, symbols = sum(state.collect(lambda _, merges: merges), []), []
    else:
        state = _Blocks(packed.rdd.map(lambda row: (pickle.loads(row["block"]), None)), checkpoint_every)
        made, symbols = _rounds(state, alphabet, n, substring)

    def unpack(batches):
        for batch in batches:
            for block in batch.column("block").to_pylist():
                yield from blocks.symbols_of(pickle.loads(block), symbols)

    final = spark.createDataFrame(state.finish().map(lambda held: (pickle.dumps(held[0]),)), "block binary")
    syms = final.mapInArrow(unpack, "place long, syms array<string>")
    done = (w.drop("syms").join(syms, "place").select("word", "freq", "first_doc", "first_pos", "syms")
            .withColumn("seg", F.concat_ws(" ", "syms")))
    merges = spark.createDataFrame([(i, *m) for i, m in enumerate(made)], "rank int, a string, b string, cnt bigint")
    return BpeResult(merges, _vocabulary(initial_vocabulary(w, mode), merges, mode), done)


def _rounds(state: _Blocks, alphabet: list[str], n: int, substring: bool) -> tuple[list[tuple[str, str, int]], list[str]]:
    """A job a round: the merges, and the symbols of the codes that all blocks share."""
    rounds = blocks.Rounds(alphabet, substring)
    rounds.changed(state.collect(lambda block, _: blocks.all_pairs(block, alphabet)))

    def run(rules: list, asked: list) -> Callable:
        told, base = state.broadcast(rounds.told(rules, asked)._replace(base=None)), rounds.base
        return lambda block, _: blocks.run_round(block, told.value._replace(base=base), substring)

    while len(rounds.merges) < n:
        items, horizon, asked = rounds.candidates()
        if not items:
            break
        if asked:
            look = run([], asked)
            rounds.placed(asked, state.collect(lambda *held, look=look: look(*held)[1][2]))
        rules = rounds.choose(items, horizon, n - len(rounds.merges))
        if not rules:
            continue
        rounds.rebase(state.base)
        asked = rounds.ahead(rules)
        changes, own, places = zip(*state.advance(run(rules, asked)))
        rounds.add(sorted(set().union(*own)))
        rounds.changed(changes)
        rounds.placed(asked, places)
    return rounds.merges, rounds.symbols


class _Blocks:
    """The blocks of a training (block, message) after each round: kept in memory, and now and then in the checkpoint folder."""

    def __init__(self, rdd: RDD, checkpoint_every: int) -> None:
        self.every, self.rounds, self.told, self.bases, self.saved = checkpoint_every, 0, [], [], None
        ensure_checkpoint_dir(SparkSession.active())
        self.rdd = rdd.persist(StorageLevel.MEMORY_AND_DISK)

    def broadcast(self, value) -> Broadcast:
        self.told.append(self.rdd.context.broadcast(value))
        return self.told[-1]

    def base(self, value) -> Broadcast:
        """For many rounds."""
        self.bases.append(self.rdd.context.broadcast(value))
        return self.bases[-1]

    def collect(self, fn: Callable) -> list:
        return self.rdd.map(lambda held: fn(*held)).collect()

    def advance(self, fn: Callable) -> list:
        """The next round: its messages. The blocks before are let go once it is there."""
        before, self.rdd = self.rdd, self.rdd.map(lambda held: fn(*held)).persist(StorageLevel.MEMORY_AND_DISK)
        self.rounds += 1
        save = self.rounds % self.every == 0
        if save:
            self.rdd.checkpoint()
        messages = self.collect(lambda _, message: message)
        before.unpersist()
        if save:
            self._cut()
        return messages

    def _cut(self) -> None:
        """The lineage ends in the checkpoint: what only it needed goes. The last round's blocks name what they were told."""
        for b in (*self.told[:-1], *self.bases[:-1]):
            b.destroy()
        if self.saved:
            delete_path(SparkSession.active(), self.saved)
        self.told, self.bases, self.saved = self.told[-1:], self.bases[-1:], self.rdd.getCheckpointFile()

    def finish(self) -> RDD:
        """The last blocks, in the checkpoint folder."""
        last = self.rdd
        if not last.isCheckpointed():
            self.rdd = last.map(lambda held: (held[0], None))
            self.rdd.checkpoint()
            self.rdd.count()
            self._cut()
        last.unpersist()
        return self.rdd


def train_rounds(words: DataFrame, n: int, eow: str = "_", mode: str = "substring", tasks: int | None = None) -> BpeResult:
    """``train`` for thousands of merges."""
    return train(words, n, eow, mode, tasks=tasks)


def _vocabulary(init_vocab: DataFrame, merges: DataFrame, mode: str) -> DataFrame:
    """(position, token). ``substring``: sorted initial symbols, then new tokens in merge
    order (first time only). ``symbol``: all tokens sorted."""
    new = merges.select(F.concat("a", "b").alias("token"), "rank").groupBy("token").agg(F.min("rank").alias("rank"))
    new = new.join(init_vocab.withColumnRenamed("symbol", "token"), "token", "left_anti")
    if mode == "symbol":
        allv = init_vocab.withColumnRenamed("symbol", "token").unionByName(new.select("token")).where("token != ''")
        return range_rank(allv, "token", "position").select("position", "token")
    base = range_rank(init_vocab, "symbol", "position")
    n0 = init_vocab.select(F.count(F.lit(1))).scalar()
    extra = new.withColumn("position", n0 + F.row_number().over(Window.orderBy("rank")) - 1)  # one row per merge
    return base.select("position", F.col("symbol").alias("token")).unionByName(extra.select("position", "token"))


def segmented_words(words: DataFrame) -> DataFrame:
    """(word, freq, seg): the segmented corpus without duplicates."""
    return words.select("word", "freq", "seg")


def segmented_corpus(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_id, pos, seg): every corpus word in its place, segmented."""
    return (tokens.select("doc_id", "pos", F.lower("token").alias("word")).join(words.select("word", "seg"), "word")
            .select("doc_id", "pos", "seg"))


def full_words(words: DataFrame, eow: str = "_") -> DataFrame:
    """(term): words merged into one symbol, with a one-character end token stripped —
    the only segmented words that can equal a document token."""
    one = words.where(F.size("syms") == 1).select(F.element_at("syms", 1).alias("tok"))
    if len(eow) == 1:
        one = one.select(F.when(F.col("tok").endswith(F.lit(eow)), F.expr("substring(tok, 1, length(tok) - 1)"))
                         .otherwise(F.col("tok")).alias("term"))
    else:
        one = one.select(F.col("tok").alias("term"))
    return one.where(F.col("term") != "").distinct()
