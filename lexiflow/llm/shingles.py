"""Sets of hashed 5-word shingles, computed for whole Arrow batches of texts with numpy.

Words are the runs of non-white-space of the text with A-Z lower-cased. A word's hash adds
a random 64-bit value per byte times an odd power of its place; a shingle's hash mixes
five word hashes. Texts are cut nowhere: a batch is worked through in chunks of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
CHUNK_BYTES = 1 << 20

_BYTE = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_IS_WORD = ~((_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D)))
_VALUE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE = _VALUE[_LOWER]
_BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)
_PLACE = np.random.default_rng(7).integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * CHUNK_BYTES)
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK_BYTES bytes; at least one whole text each."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, "right")) - 1)
        yield lo, hi
        lo = hi


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges of about CHUNK_BYTES bytes with their texts as strings; nulls are empty."""
    _, offsets = utf8_buffers(column)
    for lo, hi in chunks(offsets):
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def word_hashes(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts (runs of bytes of the class ``is_word``, A-Z
    lower-cased) and the number of words of each."""
    n_docs = len(offsets) - 1
    part = raw[offsets[0]:offsets[-1]]
    if not len(part):
        return np.zeros(0, np.uint64), np.zeros(n_docs, np.int64)
    at = offsets - offsets[0]
    word = is_word[part]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = at[:-1][at[:-1] < at[1:]]
    first[begins] = word[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n_docs, np.int64)
    up, down = _POWERS.upto(len(part))
    sums = np.add.reduceat(np.where(word, _VALUE[part] * up, np.uint64(0)), starts)
    counts = np.diff(np.searchsorted(starts, at))
    return mix(sums * down[starts]), counts


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; texts with fewer words have one shingle
    of all their words, texts without words none."""
    words, counts = word_hashes(raw, offsets)
    total = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        total += words[k:len(total) + k] * _PLACE[k] if len(total) else total
    total = mix(total)
    ends = np.cumsum(counts)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist()):
        if n >= WORDS:
            out.append(np.unique(total[end - n:end - WORDS + 1]))
        elif n:
            out.append(mix((words[end - n:end] * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)))
        else:
            out.append(words[:0])
    return out


def column_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """``shingle_sets`` of a whole Arrow column, text by text."""
    raw, offsets = utf8_buffers(column)
    for lo, hi in chunks(offsets):
        yield from shingle_sets(raw, offsets[lo:hi + 1])
