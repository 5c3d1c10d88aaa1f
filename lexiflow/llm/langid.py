"""Language identification with error-correcting output codes.

Every language has a codeword of +1 and -1. Each bit has a binary classifier over hashed
byte trigrams: the log ratio of the mean trigram distributions of the languages on its two
sides, from counts over all labelled rows that may be learned from. A text's margins are
the means of its trigrams' log ratios, scaled so that the two sides lie around +1 and -1.
Decoding sums an exponential loss per bit, weighted by how far the bit separates its sides,
and takes the codeword with the least loss; if the runner-up is within ``AMBIGUOUS`` of it, the
text is flagged.

The model is a table of (languages x ``BUCKETS``) counts, added up by Spark; only that table
reaches the driver. Defined cases: texts of any length are read whole; of languages with the same
loss the first in the alphabet wins, and the text is flagged; a null text, or one without a letter, is ``und`` with score 0;
rows with a null label or a null doc_id teach nothing; without any label every text is
``und``; repeated rows count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_or_empty
from .shingles import chunks, utf8_buffers

BUCKETS = 1 << 15
AMBIGUOUS = 0.1
_SPACE = 0x20
#: Letters (A-Z lower-cased, all bytes from 0x80 on); everything else is a space.
_NORMAL = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else _SPACE for b in range(256)], np.uint32)


def trigrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around every letter byte, and the number of them per text."""
    part = _NORMAL[raw[offsets[0]:offsets[-1]]]
    at = offsets - offsets[0]
    if not len(part):
        return np.zeros(0, np.int64), np.zeros(len(at) - 1, np.int64)
    before, after = np.empty_like(part), np.empty_like(part)
    before[1:], after[:-1] = part[:-1], part[1:]
    full = at[:-1] < at[1:]
    before[at[:-1][full]] = _SPACE
    after[at[1:][full] - 1] = _SPACE
    letter = part != _SPACE
    gram = ((before << np.uint32(16)) | (part << np.uint32(8)) | after)[letter]
    count = np.diff(np.concatenate([[0], np.cumsum(letter)])[at])
    return ((gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)).astype(np.int64), count


def codewords(n: int) -> np.ndarray:
    """(languages, bits) of +1 and -1: all splits of up to 7 languages, else the best of some
    random codes by least distance."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 7:
        splits = np.arange(2 ** (n - 1) - 1)
        return np.array([[1.0] * len(splits), *(np.where((splits >> i) & 1, 1.0, -1.0) for i in range(n - 1))])
    bits, best, apart = 8 * math.ceil(math.log2(n)), None, -1
    for seed in range(20):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        distance = (code.shape[1] - code @ code.T) / 2 + bits * np.eye(n)
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    ratio: np.ndarray  # (BUCKETS, bits), already scaled
    shift: np.ndarray
    weight: np.ndarray

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and ambiguity of every text."""
        gram, count = trigrams(raw, offsets)
        total = np.zeros((len(count), self.ratio.shape[1]), np.float64)
        some = np.flatnonzero(count)
        if len(some):
            total[some] = np.add.reduceat(self.ratio[gram], (np.cumsum(count) - count)[some], axis=0)
        margin = np.clip(total / np.maximum(count, 1)[:, None] - self.shift, -4, 4)
        loss = (np.exp(-margin[:, None, :] * self.code) * self.weight).sum(axis=2)
        order = np.sort(loss, axis=1)
        share = np.exp(4 * (order[:, :1] - loss))
        gap = order[:, 1] - order[:, 0] if loss.shape[1] > 1 else np.ones(len(loss))
        return loss.argmin(axis=1), 1 / share.sum(axis=1), gap < AMBIGUOUS


def fit(counts: dict[str, np.ndarray]) -> Model | None:
    """Model from trigram counts per language."""
    languages = sorted(counts)
    if not languages:
        return None
    code = codewords(len(languages))
    dist = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * BUCKETS) for x in languages])
    up, down = code > 0, code < 0
    high = (dist.T @ up) / np.maximum(up.sum(axis=0), 1)
    low = (dist.T @ down) / np.maximum(down.sum(axis=0), 1)
    ratio = np.log(high / low) if code.shape[1] else np.zeros((BUCKETS, 0))
    top, bottom = (high * ratio).sum(axis=0), (low * ratio).sum(axis=0)
    apart = np.maximum(top - bottom, 1e-9)
    weight = apart / apart.sum() if len(apart) else apart
    return Model(languages, code, (2 * ratio / apart).astype(np.float32), (top + bottom) / apart, weight)


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """True for the documents that nothing may be learned from; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold


def language_counts(docs: DataFrame, learn: Column) -> dict[str, np.ndarray]:
    """Trigram counts per language over all rows to learn from."""
    def run(batches):
        totals: dict[str, np.ndarray] = {}

        def flush():
            for lang, n in totals.items():
                hit = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit), pa.string()), pa.array(hit, pa.int64()), pa.array(n[hit], pa.int64())], names=["lang", "bucket", "n"])
            totals.clear()

        for batch in batches:
            raw, offsets = utf8_buffers(batch.column(1))
            langs, number = np.unique(np.array(batch.column(0).to_pylist(), dtype=object), return_inverse=True)
            for lo, hi in chunks(offsets):
                gram, count = trigrams(raw, offsets[lo:hi + 1])
                own = np.repeat(number[lo:hi], count)
                for k in np.unique(number[lo:hi]):
                    add = np.bincount(gram[own == k], minlength=BUCKETS)
                    totals[langs[k]] = totals.get(langs[k], 0) + add
            if len(totals) > 100:
                yield from flush()
        yield from flush()

    rows = (docs.where(learn & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), text_or_empty().alias("t"))
            .mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    out: dict[str, np.ndarray] = {}
    table = stored(rows, "trigram-counts").toPandas()  # languages x BUCKETS numbers
    for lang, part in table.groupby("lang"):
        out[lang] = np.zeros(BUCKETS)
        out[lang][part["bucket"].to_numpy()] = part["n"].to_numpy()
    return out


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            n = batch.num_rows
            best, score, close = np.zeros(n, np.int64), np.zeros(n), np.ones(n, bool)
            if m is not None:
                raw, offsets = utf8_buffers(batch.column(2))
                for lo, hi in chunks(offsets):
                    best[lo:hi], score[lo:hi], close[lo:hi] = m.predict(raw, offsets[lo:hi + 1])
            known = batch.column(1).to_numpy(zero_copy_only=False) & (m is not None)
            names = np.array([*(m.languages if m else ()), "und"], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[np.where(known, best, len(names) - 1)], pa.string()),
                 pa.array(np.where(known, score, 0.0)), pa.array(np.where(known, close, True))],
                names=["doc_id", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
    return rows.select("doc_id", F.col("t").rlike(r"\p{L}").alias("letter"), "t").mapInArrow(
        run, "doc_id long, lang_pred string, score double, ambiguous boolean")
