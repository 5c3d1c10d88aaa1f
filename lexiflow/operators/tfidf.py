"""Vocabulary and TF-IDF in long (sparse) form.

Every function maps DataFrames to DataFrames. Scalars that depend on the data
(number of documents) enter the plan as scalar subqueries. ``fit_tfidf`` stores the
per-(document, token) count table and the distinct tokens, from which the vocabulary,
the frequencies and the weights are read.

Rules kept from the reference (see README, "Semantics"):
* the vocabulary is built from lower-cased tokens, but document tokens are matched
  as they are, so capitalised tokens never count (``match_case="raw"``);
* the min/max filter and the idf use the *collection* frequency (occurrences of the
  lower-cased term in all text), not the document frequency (``freq="collection"``);
* the matched-token total of a document is taken before that filter;
* idf = log10(N / (1 + f)); tf·idf is kept as the integer ``w = round(tf·idf·1e6)``
  (exact sums downstream) and as the double ``tfidf = w / 1e6``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .ranking import range_rank
from ..sources.corpus import require_columns
from ..functions.text import (
    CONTRACTION_SPLITS,
    DEFAULT_STOP_WORDS,
    kept_words,
    lower_stop_set,
    sanitize_text,
    vocabulary_parts,
)

WEIGHT_SCALE = 1_000_000  # weights are stored as round(tf*idf * 1e6), i.e. 6 decimals


@dataclass(frozen=True)
class TfidfConfig:
    stop_words: tuple[str, ...] = DEFAULT_STOP_WORDS
    extra_stop_words: tuple[str, ...] = ()  # second list unioned in for the vocabulary only
    only_alpha: bool = True
    sep: str = " "
    min_df: int | float = 0.001  # int = absolute, float = fraction of N
    max_df: int | float = 0.55
    split_contractions: bool = True
    match_case: str = "raw"  # "raw" (reference) or "lower"
    freq: str = "collection"  # "collection" (reference) or "document"
    id_col: str = "doc_id"
    text_col: str = "text"


def _bound(v: int | float, n_docs: Column) -> Column:
    if isinstance(v, bool):
        raise TypeError("threshold must be int or float")
    if isinstance(v, int):
        return F.lit(v).cast("double")
    return F.lit(float(v)) * n_docs


def document_count(docs: DataFrame) -> Column:
    """N as a scalar-subquery column (documents without any token count too)."""
    return docs.select(F.count(F.lit(1)).cast("double")).scalar()


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of an input with fewer scan partitions than cores to all cores: tokenising is
    CPU-bound. An input that is scanned by enough tasks is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def corpus_tokens(docs: DataFrame, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """(doc_id, pos, token): the cleaned words of every document, in order."""
    return spread(docs).select(
        F.col(cfg.id_col).alias("doc_id"),
        F.posexplode(kept_words(F.col(cfg.text_col), cfg.stop_words, cfg.only_alpha, cfg.sep)).alias("pos", "token"),
    )


def sanitized_documents(docs: DataFrame, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    return spread(docs).select(
        F.col(cfg.id_col).alias("doc_id"),
        sanitize_text(F.col(cfg.text_col), cfg.stop_words, cfg.only_alpha, cfg.sep).alias("clean_text"),
    )


def stopword_filtered_terms(tokens: DataFrame, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """(doc_id, pos, part, term): lower-cased word-tokenizer output minus the stop set."""
    stops = lower_stop_set(cfg.stop_words, cfg.extra_stop_words)
    parts = tokens.select(
        "doc_id", "pos",
        F.posexplode(vocabulary_parts(F.lower("token"), cfg.split_contractions)).alias("part", "term"),
    )
    cond = F.col("term") != F.lit("")
    if stops:
        cond = cond & ~F.lower("term").isin(stops)
    return parts.where(cond)


def vocabulary(tokens: DataFrame, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """(term): distinct lower-cased terms that survive the stop list. ``tokens`` needs a
    ``token`` column only (positions are not used)."""
    stops = lower_stop_set(cfg.stop_words, cfg.extra_stop_words)
    words = tokens.select(F.lower("token").alias("low")).distinct()
    terms = words.select(F.explode(vocabulary_parts(F.col("low"), cfg.split_contractions)).alias("term"))
    cond = F.col("term") != F.lit("")
    if stops:
        cond = cond & ~F.lower("term").isin(stops)
    return terms.where(cond).distinct()


def document_tokens(tokens: DataFrame) -> DataFrame:
    """(doc_id, token, n): occurrences of each raw token per document — the one table
    every frequency below is derived from."""
    return tokens.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


def unique_ids(docs: DataFrame, id_col: str = "doc_id") -> bool:
    """Whether every row has an id of its own (none null): one job over the ids alone."""
    n, ids = docs.agg(F.count(F.lit(1)), F.count_distinct(F.col(id_col))).first()
    return n == ids


def counted_words(lists: DataFrame, word: str) -> DataFrame:
    """Rows with a list ``words`` → one row per distinct word of the list, named ``word``, with its number ``n``;
    the other columns stay. Nothing is shuffled, so a document has to be one row."""
    others = [f for f in lists.schema.fields if f.name != "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            flat = words.flatten().cast(pa.large_string()).dictionary_encode()
            if not len(flat):
                continue
            row = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(words), 0).to_numpy())
            width = len(flat.dictionary)
            key, n = np.unique(row * width + flat.indices.to_numpy().astype(np.int64), return_counts=True)
            at = pa.array(key // width)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name).take(at) for f in others), flat.dictionary.take(pa.array(key % width)).cast(pa.string()),
                                              pa.array(n, pa.int64())], names=[*(f.name for f in others), word, "n"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in others]
    return lists.mapInArrow(run, ", ".join([*kinds, f"{word} string", "n long"]))


def _own_term(token: Column, cfg: TfidfConfig) -> Column:
    """Whether ``vocabulary`` makes the term ``token`` of that token itself. Other tokens may make it too."""
    apart = [*lower_stop_set(cfg.stop_words, cfg.extra_stop_words), *(CONTRACTION_SPLITS if cfg.split_contractions else ()), ""]
    return (token == F.lower(token)) & ~token.isin(apart)


def _match_token(tokens: DataFrame, cfg: TfidfConfig) -> DataFrame:
    tok = F.lower("token") if cfg.match_case == "lower" else F.col("token")
    return tokens.select("doc_id", "pos", tok.alias("term"))


def in_vocab_tokens(tokens: DataFrame, vocab: DataFrame, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """(doc_id, pos, term): document tokens found in the vocabulary (raw case by default).
    The join strategy is left to Catalyst/AQE: the vocabulary grows with the corpus,
    so it is broadcast only when its measured size is under the threshold."""
    return _match_token(tokens, cfg).join(vocab.select("term"), "term", "left_semi")


def term_counts(in_vocab: DataFrame) -> DataFrame:
    """(doc_id, term, n)."""
    return in_vocab.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


def doc_term_totals(docs: DataFrame, counts: DataFrame, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """(doc_id, term_count): matched tokens per document, before the frequency filter; 0 if none."""
    totals = counts.groupBy("doc_id").agg(F.sum("n").alias("term_count"))
    ids = docs.select(F.col(cfg.id_col).alias("doc_id"))
    return ids.join(totals, "doc_id", "left").select("doc_id", F.coalesce("term_count", F.lit(0)).alias("term_count"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """(term, df): documents containing the term."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def collection_frequency(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """(term, cf): occurrences of the lower-cased token over all text, for vocabulary terms."""
    low = tokens.select(F.lower("token").alias("term"))
    return low.join(vocab.select("term"), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("cf"))


def frequency_filter(freqs: DataFrame, n_docs: Column, min_df: int | float, max_df: int | float,
                     col: str = "cf") -> DataFrame:
    """Keep terms with min ≤ frequency ≤ max (int bound = absolute, float = × N)."""
    f = F.col(col).cast("double")
    return freqs.where((f >= _bound(min_df, n_docs)) & (f <= _bound(max_df, n_docs)))


def idf_table(kept: DataFrame, n_docs: Column, col: str = "cf") -> DataFrame:
    """(term, <col>, idf) with idf = log10(N / (1 + frequency)); may be 0 or negative."""
    return kept.withColumn("idf", F.log10(n_docs / (F.col(col) + F.lit(1)).cast("double")))


def weight_column(n: Column, term_count: Column, idf: Column) -> Column:
    """Integer weight round(n/term_count · idf · 1e6) as bigint."""
    return F.round((n.cast("double") / term_count.cast("double")) * idf * F.lit(float(WEIGHT_SCALE)), 0).cast("bigint")


def _weights(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", "term", "n", "term_count",
        (F.col("n").cast("double") / F.col("term_count").cast("double")).alias("tf"),
        weight_column(F.col("n"), F.col("term_count"), F.col("idf")).alias("w"),
    ).withColumn("tfidf", F.col("w") / F.lit(float(WEIGHT_SCALE)))


def tfidf_from_parts(counts: DataFrame, totals: DataFrame, idf: DataFrame) -> DataFrame:
    """(doc_id, term, n, term_count, tf, w, tfidf) for every (document, kept term) present."""
    return _weights(counts.join(idf.select("term", "idf"), "term").join(totals.where("term_count > 0"), "doc_id"))


class TfidfModel(NamedTuple):
    tokens: DataFrame
    doc_tokens: DataFrame
    vocab: DataFrame
    in_vocab: DataFrame
    counts: DataFrame
    totals: DataFrame
    freqs: DataFrame
    idf: DataFrame
    tfidf: DataFrame
    n_docs: Column


def fit_tfidf(docs: DataFrame, cfg: TfidfConfig = TfidfConfig(), vocab: DataFrame | None = None,
              materialize: bool = True, stems: DataFrame | None = None) -> TfidfModel:
    """Whole TF-IDF plan over ``docs(doc_id, text)``.

    ``vocab`` replaces the word-tokenizer vocabulary (e.g. a stored vocabulary, a union
    of vocabularies, or the fully merged words of a byte-pair encoding); ``stems`` (term,
    stem) replaces its terms by their stems.

    Two tables are written: (document, token, n), which every branch reads, and the distinct
    tokens with their totals. Vocabulary, frequencies and idf are worked out on the distinct
    tokens; the document table is joined once with the tokens that are in the vocabulary.

    Where every document has an id of its own, its words are counted in its row. With the own vocabulary
    and raw case, most tokens are terms by themselves (``_own_term``): they are told and added up in the
    row too, and only the other tokens are looked up in the vocabulary. Entries then meet the terms
    that pass the filter alone; these are at most (words per document) / min_df where min_df is a fraction,
    whatever the number of documents, so they are broadcast."""
    require_columns(docs, [cfg.id_col, cfg.text_col], "documents")
    if cfg.freq not in ("collection", "document"):
        raise ValueError(f"freq must be 'collection' or 'document', not {cfg.freq!r}")
    tokens = corpus_tokens(docs, cfg)
    keep = stored if materialize else (lambda df, _: df)
    by_row = unique_ids(docs, cfg.id_col)
    alone = by_row and vocab is None and stems is None and cfg.match_case != "lower"
    if by_row:
        words = F.col("words")
        lists = spread(docs).select(F.col(cfg.id_col).alias("doc_id"), kept_words(F.col(cfg.text_col), cfg.stop_words, cfg.only_alpha, cfg.sep).alias("words"))
        own = F.size(F.filter(words, lambda w: _own_term(w, cfg))).cast("long") if alone else F.lit(None).cast("long")
        dt = keep(counted_words(lists.select("doc_id", "words", own.alias("own")), "token"), "document-tokens")
        dt, totals_of = dt.select("doc_id", "token", "n"), dt
    else:
        dt = keep(document_tokens(tokens), "document-tokens")
    distinct = keep(dt.groupBy("token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("df")), "distinct-tokens")
    vocab = vocabulary(distinct, cfg) if vocab is None else vocab.select("term").distinct()
    vocab = keep(vocab if stems is None else stem_terms(vocab, stems), "vocabulary")
    n_docs = document_count(docs)
    lower = cfg.match_case == "lower"
    tok = F.lower("token") if lower else F.col("token")
    if alone:
        mine = _own_term(F.col("term"), cfg)
        others = distinct.select(F.col("token").alias("term")).where(~mine).join(vocab, "term", "left_semi")
        others = keep(others, "other-terms")  # made by other tokens only
        some = not others.isEmpty()

        def known_terms(rows: DataFrame) -> DataFrame:
            own = rows.where(mine)
            return own.unionByName(rows.join(others, "term", "left_semi").select(*rows.columns)) if some else own

        inv = known_terms(_match_token(tokens, cfg)).select("term", "doc_id", "pos")
        counts = known_terms(dt.select("doc_id", F.col("token").alias("term"), "n")).select("term", "doc_id", "n")
    else:
        inv = in_vocab_tokens(tokens, vocab, cfg)
        counts = dt.select("doc_id", tok.alias("term"), "n").join(vocab, "term", "left_semi")
    if lower:  # distinct raw tokens may lower to the same term
        counts = counts.groupBy("doc_id", "term").agg(F.sum("n").alias("n"))
    totals = doc_term_totals(docs, counts, cfg)
    if cfg.freq == "collection":
        low = distinct.select(F.lower("token").alias("term"), "n").join(vocab, "term", "left_semi")
        freqs, col = low.groupBy("term").agg(F.sum("n").alias("cf")), "cf"
    elif lower:
        freqs, col = document_frequency(counts), "df"
    else:
        freqs, col = distinct.select(F.col("token").alias("term"), "df").join(vocab, "term", "left_semi"), "df"
    idf = idf_table(frequency_filter(freqs, n_docs, cfg.min_df, cfg.max_df, col), n_docs, col)
    if alone:
        weighing = keep(idf.select("term", "idf"), "kept-terms")
        few = isinstance(cfg.min_df, float) and cfg.min_df > 0
        entries = totals_of.withColumnRenamed("token", "term").join(F.broadcast(weighing) if few else weighing, "term")
        total = F.col("own")
        if some:
            more = dt.withColumnRenamed("token", "term").join(others, "term", "left_semi").groupBy("doc_id").agg(F.sum("n").alias("more"))
            entries = entries.join(keep(more, "other-totals"), "doc_id", "left")
            total = total + F.coalesce("more", F.lit(0))
        return TfidfModel(tokens, dt, vocab, inv, counts, totals, freqs, idf, _weights(entries.withColumn("term_count", total)), n_docs)
    # one join with the document table: vocabulary terms, with their idf where they pass the filter
    known = vocab.join(idf.select(F.col("term").alias("_term"), "idf"), F.col("term") == F.col("_term"), "left").select("term", "idf")
    known = keep(known, "known-terms")  # its size is known then: few terms are broadcast, and no entry is shuffled for them
    terms = dt.select("doc_id", tok.alias("term"), "n")
    if lower:
        terms = terms.groupBy("doc_id", "term").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("doc_id"))  # as long as a document
    weighted = terms.join(known, "term").withColumn("term_count", total).where("idf IS NOT NULL")
    return TfidfModel(tokens, dt, vocab, inv, counts, totals, freqs, idf, _weights(weighted), n_docs)


def transform_texts(texts: DataFrame, model: TfidfModel, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """Weights of new texts (e.g. queries) under a fitted vocabulary and idf:
    (doc_id, term, n, term_count, tf, w, tfidf)."""
    tokens = corpus_tokens(texts, cfg)
    counts = term_counts(in_vocab_tokens(tokens, model.vocab, cfg))
    totals = counts.groupBy("doc_id").agg(F.sum("n").alias("term_count"))
    return tfidf_from_parts(counts, totals, model.idf)


def tfidf_wide(tfidf: DataFrame, docs: DataFrame, terms: list[str], cfg: TfidfConfig = TfidfConfig(),
               class_col: str | None = None) -> DataFrame:
    """Dense view: one row per document, one column per chosen term (0 where absent),
    class last. ``terms`` must be a short, explicit list: a pivot over the whole
    vocabulary would create one column per term."""
    ids = docs.select(F.col(cfg.id_col).alias("doc_id"), *([F.col(class_col).alias("class")] if class_col else []))
    sub = tfidf.where(F.col("term").isin(terms))
    wide = sub.groupBy("doc_id").pivot("term", terms).agg(F.first("tfidf"))
    out = ids.join(wide, "doc_id", "left").fillna(0.0, subset=terms)
    cols = ["doc_id", *terms] + (["class"] if class_col else [])
    return out.select(*cols)


def tfidf_wide_top(model: TfidfModel, docs: DataFrame, n: int, class_col: str | None = None) -> DataFrame:
    """Dense view of the ``n`` most frequent terms without knowing them beforehand: columns
    t1..tn by rank (frequency, then term), 0 where absent. The schema is fixed."""
    top = model.idf.orderBy(F.col("cf").desc(), F.col("term")).limit(n)
    top = top.withColumn("place", F.row_number().over(Window.orderBy(F.col("cf").desc(), F.col("term"))))  # n rows
    cells = model.tfidf.join(top.select("term", "place"), "term")
    wide = cells.groupBy("doc_id").agg(*(F.sum(F.when(F.col("place") == i, F.col("tfidf")).otherwise(0.0)).alias(f"t{i}")
                                         for i in range(1, n + 1)))
    ids = docs.select("doc_id", *([F.col(class_col).alias("class")] if class_col else []))
    return ids.join(wide, "doc_id", "left").fillna(0.0, subset=[f"t{i}" for i in range(1, n + 1)])


#: Rows and columns of a block of the matrix.
MATRIX_ROWS, MATRIX_COLUMNS = 256, 4096


class MatrixBlocks(NamedTuple):
    rows: DataFrame  # row, doc_id, class
    columns: DataFrame  # column, term
    blocks: DataFrame  # row_block, column_block, offsets, codes, weights


def matrix_blocks(tfidf: DataFrame, docs: DataFrame, terms: DataFrame, rows: int = MATRIX_ROWS, columns: int = MATRIX_COLUMNS,
                  class_col: str = "class") -> MatrixBlocks:
    """The whole document x term matrix in compressed sparse rows: one stored row per block of ``rows``
    documents and ``columns`` terms that has an entry. ``offsets`` (rows + 1) cut ``codes`` (columns inside
    the block, ascending) and ``weights`` (the integer w) into matrix rows. ``docs``: (doc_id, class), doc_id unique;
    ``terms``: (term) in the matrix; documents and terms are numbered in their order."""
    ids = range_rank(docs.select("doc_id").where("doc_id IS NOT NULL"), "doc_id", "row")
    row_index = stored(ids.join(docs.select("doc_id", F.col(class_col).alias("class")), "doc_id").select("row", "doc_id", "class"), "matrix-rows")
    column_index = stored(range_rank(terms.select("term"), "term", "column").select("column", "term"), "matrix-columns")
    cells = (tfidf.select("doc_id", "term", "w").where("w <> 0").join(row_index.select("row", "doc_id"), "doc_id").join(column_index, "term")
             .select(F.floor(F.col("row") / rows).alias("row_block"), F.floor(F.col("column") / columns).alias("column_block"),
                     (F.col("row") % rows).alias("r"), (F.col("column") % columns).cast("int").alias("c"), "w"))

    def pack(block: pa.Table) -> pa.Table:  # at most rows · columns entries
        r, c, w = (block[name].to_numpy() for name in ("r", "c", "w"))
        order = np.lexsort((c, r))
        offsets = np.searchsorted(r[order], np.arange(rows + 1)).astype(np.int32)
        lists = [pa.array([x], t) for x, t in ((offsets, pa.list_(pa.int32())), (c[order], pa.list_(pa.int32())), (w[order], pa.list_(pa.int64())))]
        return pa.table([block["row_block"].slice(0, 1), block["column_block"].slice(0, 1), *lists],
                        names=["row_block", "column_block", "offsets", "codes", "weights"])

    packed = cells.groupBy("row_block", "column_block").applyInArrow(
        pack, "row_block long, column_block long, offsets array<int>, codes array<int>, weights array<long>")
    return MatrixBlocks(row_index, column_index, stored(packed, "matrix-blocks"))


def dense_rows(matrix: MatrixBlocks, rows: int = MATRIX_ROWS, columns: int = MATRIX_COLUMNS,
               summary: Callable[[np.ndarray], list[np.ndarray]] | None = None, fields: str = "") -> DataFrame:
    """(doc_id, class, column_block, first_column, values): dense slices of every row of the matrix, zeros
    and rows without an entry included; ``values`` has a whole number w for each column of the block. ``summary`` of
    slices (documents x columns, in the task that makes them) takes the place of ``values``: columns ``fields``."""
    n_columns = matrix.columns.select(F.count(F.lit(1))).scalar()
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n_columns - 1) / columns)))
    slices = matrix.rows.where(n_columns > 0).select("row", "doc_id", "class", every.alias("column_block"))
    slices = slices.withColumn("row_block", F.floor(F.col("row") / rows)).withColumn("width", F.least(F.lit(columns), n_columns - F.col("column_block") * columns))
    schema = f"doc_id long, class string, column_block long, first_column long, {fields if summary else 'values array<long>'}"
    names = [f.split()[0] for f in schema.split(", ")]

    def fill(part: pa.Table, block: pa.Table) -> pa.Table:
        row, width = part["row"].to_numpy() % rows, part["width"].to_numpy()
        dense = np.zeros((rows, columns), np.int64)
        if block.num_rows:
            offsets, codes, weights = (block[c].combine_chunks().flatten().to_numpy() for c in ("offsets", "codes", "weights"))
            dense[np.repeat(np.arange(rows), np.diff(offsets)), codes] = weights
        if summary and part.num_rows:  # all rows of a block of columns have one width
            first = pa.array(part["column_block"].to_numpy() * columns)
            return pa.table([part["doc_id"], part["class"], part["column_block"], first, *map(pa.array, summary(dense[row, :width[0]]))], names=names)
        values = [dense[r, :w] for r, w in zip(row, width)]
        ends = pa.array(np.cumsum([0, *width]).astype(np.int32))
        first = pa.array(part["column_block"].to_numpy() * columns)
        return pa.table([part["doc_id"], part["class"], part["column_block"], first, pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values)))],
                        names=names) if len(values) else part.schema.empty_table()

    blocks = matrix.blocks.select(F.col("row_block").alias("b_row"), F.col("column_block").alias("b_column"), "offsets", "codes", "weights")
    return slices.groupBy("row_block", "column_block").cogroup(blocks.groupBy("b_row", "b_column")).applyInArrow(fill, schema)


# ---------------------------------------------------------------------------
# Library-style TF-IDF: lower-case, words of ≥ 2 word characters, raw counts,
# smooth idf = ln((1 + N) / (1 + df)) + 1, L2-normalised rows.
# ---------------------------------------------------------------------------

WORD2_PATTERN = r"[\p{L}\p{N}_]{2,}"


def smooth_tfidf(docs: DataFrame, cfg: TfidfConfig = TfidfConfig(), min_df: int | float = 1,
                 max_df: int | float = 1.0, max_features: int | None = None) -> DataFrame:
    """(doc_id, term, count, idf, weight) over the cleaned text of each document."""
    clean = sanitized_documents(docs, cfg)
    lists = clean.select("doc_id", F.regexp_extract_all(F.lower("clean_text"), F.lit(WORD2_PATTERN), 0).alias("words"))
    if unique_ids(docs, cfg.id_col):
        counts = counted_words(lists, "term").withColumnRenamed("n", "count")
    else:
        counts = lists.select("doc_id", F.explode("words").alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("count"))
    counts = stored(counts, "word-counts")
    n_docs = document_count(docs)
    stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("count").alias("total"))
    stats = stats.where((F.col("df").cast("double") >= _bound(min_df, n_docs)) &
                        (F.col("df").cast("double") <= _bound(max_df, n_docs)))
    if max_features is not None:
        # top terms by total count, ties by term: a bounded top-k, not a global sort
        stats = stats.orderBy(F.col("total").desc(), F.col("term")).limit(int(max_features))
    stats = stats.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df").cast("double"))) + F.lit(1.0))
    stats = stored(stats, "word-statistics")  # with a known size: few terms are broadcast
    v = counts.join(stats.select("term", "idf"), "term").withColumn("v", F.col("count").cast("double") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy("doc_id")))  # as long as a document
    return v.withColumn("norm", norm).select("doc_id", "term", "count", "idf", (F.col("v") / F.col("norm")).alias("weight"))


def stem_terms(vocab: DataFrame, stem_map: DataFrame) -> DataFrame:
    """Optional stemming of the vocabulary only (documents are not stemmed): replace each
    term by its stem from a supplied (term, stem) table, keep it when it has none."""
    m = stem_map.select("term", "stem")
    return vocab.select("term").join(m, "term", "left").select(F.coalesce("stem", "term").alias("term")).distinct()
