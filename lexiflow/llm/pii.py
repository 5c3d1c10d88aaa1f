"""Personal data by patterns and a linear-chain conditional random field.

Base spans come from four patterns (e-mail, IP address, card number, phone number), scanned
in linear time. A conditional random field over word shapes adds spans that the patterns
miss, among them ``secret`` (keys, tokens, passwords). It is trained on a small labelled table: the
sentences of ``pii_examples`` (forms that the patterns miss, and look-alikes), and sentences of
``TRAIN_DOCS`` documents (those with the smallest hashes) tagged with their base spans, sentences
with a span up to a bound and a sample of the others, weighted for the rest. Sentences are decoded
by Viterbi in matrices of similar length; an added span needs a posterior of ``CONFIDENCE``
for each of its words and must not touch a base span. The posteriors of a sentence are worked out
once, whatever the number of its hits.

A sentence ends at a mark or a line's end, and after ``SENTENCE`` words. Offsets are code points, the
end exclusive. Defined cases: a null text counts as empty (no spans) and stays null when redacted;
texts of any length are scanned whole; of states with equal scores the first one wins; repeated rows are
scanned each; an empty table gives an empty result and trains nothing; other columns are
ignored by ``find_spans`` and kept by ``redact``, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_key, stored, text_or_empty
from .pii_examples import labelled_examples
from .shingles import _POWERS, mix, text_chunks

KINDS = ("email", "ip", "card", "phone")
#: Kinds of the random field: those of the patterns and one of its own.
ALL_KINDS = (*KINDS, "secret")
#: Bounds of the labelled table: documents, sentences with a span, sentences without; longer sentences
#: are parts of so many words there. Weight of a sentence of ``pii_examples``.
TRAIN_DOCS, TRAIN_WITH, TRAIN_WITHOUT, TRAIN_WORDS = 2000, 600, 1500, 64
EXAMPLE_WEIGHT = 20.0
CONFIDENCE = 0.95
SENTENCE = 512

# --- base spans --------------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin at the first digit of a run, and no repetition gives back
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base matches, by kind and start."""
    out = []
    at, low = text.find("@"), 0
    while at >= 0:
        local = at - low - len(text[low:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        low = domain.end() if domain else at + 1
        if domain:
            out.append((0, at - local, low))
        at = text.find("@", low)
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


# --- words, shapes and sentences ------------------------------------------------------------------

SHAPES = 1 << 16
#: Shape ids: beyond a sentence's ends, and any shape seen less often than this in training.
_OUTSIDE, _RARE, RARE_BELOW = 0, 1, 3
_CLASS = np.full(129, 1, np.uint8)  # 0 white space, 1 lower case and other letters, 2 upper case, 3 digits, 4 on: itself
_CLASS[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = 0
_CLASS[65:91], _CLASS[48:58] = 2, 3
for _i, _c in enumerate(c for c in range(33, 127) if not chr(c).isalnum()):
    _CLASS[_c] = 4 + _i
_COARSE = 1 << 15
_BIT = np.full(4 + 96, 11, np.int64)  # letters, digits and groups of marks
_BIT[1:4] = 0, 1, 2
for _i, _c in enumerate(c for c in range(33, 127) if not chr(c).isalnum()):
    _BIT[4 + _i] = next((3 + j for j, group in enumerate(("@", ".", "-_", "+", "()[]{}", "\"'", "=:", "/")) if chr(_c) in group), 11)
_RUN = np.random.default_rng(11).integers(1, 2**63, 64 * 16, dtype=np.uint64) | np.uint64(1)


@dataclass
class Words:
    """Words of several texts joined by newlines: places, ids of shapes (runs of classes) and of coarse
    ones (classes and length), length classes, sentences."""
    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    coarse: np.ndarray
    size: np.ndarray
    first: np.ndarray  # index of the first word of each sentence, and the number of words


def words_of(texts: list[str]) -> tuple[Words, np.ndarray]:
    """Words of the texts and the offset of each text."""
    joined = "\n".join(texts) + "\n"
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    cls = _CLASS[np.minimum(codes, 128)]
    head = np.flatnonzero(np.diff(cls, prepend=255))
    length = np.diff(np.append(head, len(cls)))
    kind = cls[head]
    space = kind == 0
    begins = ~space & np.append(True, space[:-1])
    run, run_len, run_kind = head[~space], length[~space], kind[~space]
    first = np.flatnonzero(begins[~space])
    if not len(first):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none, none, np.zeros(1, np.int64)), offsets
    bucket = np.where(run_kind == 3, np.minimum(run_len, 6) + (run_len > 12) + (run_len > 19) + (run_len > 6), np.minimum(run_len, 2))
    up, down = _POWERS.upto(len(run))
    hashed = mix(np.add.reduceat(_RUN[run_kind.astype(np.int64) * 16 + bucket] * up, first) * down[first])
    shape = (hashed % np.uint64(SHAPES - 2)).astype(np.int64) + 2
    last = np.append(first[1:], len(run)) - 1
    start, end = run[first], run[last] + run_len[last]
    lines = np.cumsum(codes == 10)
    stop = np.isin(codes[end - 1], [ord(c) for c in ".!?;"])
    new = np.append(True, stop[:-1] | (lines[start[1:]] != lines[end[:-1] - 1]))
    size = np.minimum(end - start, 24)
    coarse = np.bitwise_or.reduceat(1 << _BIT[run_kind], first) * 8 + np.minimum((end - start) // 4, 7)
    heads = np.append(np.flatnonzero(new), len(start))
    for a, b in zip(heads[:-1], heads[1:]):
        new[a:b:SENTENCE] = True
    return Words(start, end, shape, coarse, size, np.append(np.flatnonzero(new), len(start))), offsets


def _neighbours(shape: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shapes before and after each word; 0 at the ends of a sentence."""
    before, after = np.append(0, shape[:-1]), np.append(shape[1:], 0)
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return before, after


# --- the random field -------------------------------------------------------------------------------

STATES = 1 + 2 * len(ALL_KINDS)  # 0 outside; 1 + 2k first word of kind k, 2 + 2k further word


@dataclass
class Field:
    shape: np.ndarray  # (SHAPES, STATES), likewise before and after
    before: np.ndarray
    after: np.ndarray
    coarse: np.ndarray  # (_COARSE, STATES)
    size: np.ndarray  # (25, STATES)
    step: np.ndarray  # (STATES, STATES)

    def emissions(self, w: Words) -> np.ndarray:
        before, after = _neighbours(w.shape, w.first)
        return self.shape[w.shape] + self.before[before] + self.after[after] + self.coarse[w.coarse] + self.size[w.size]


def _possible() -> np.ndarray:
    """0 for steps that can be, a large loss for a further word of a kind after anything else."""
    out = np.zeros((STATES, STATES), np.float32)
    for k in range(len(ALL_KINDS)):
        out[:, 2 + 2 * k] = -1e4
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return out


_POSSIBLE = _possible()
_BEGIN = _POSSIBLE[0]


def _matrices(length: np.ndarray, words: int = 400_000):
    """Sentences in groups of similar length, longest first, of about ``words`` words: (numbers, lengths)."""
    order = np.argsort(-length, kind="stable")
    at = 0
    while at < len(order):
        longest = length[order[at]]
        upto = int(np.searchsorted(-length[order], -max(1, longest * 3 // 4), "right"))
        upto = min(upto, at + max(1, words // int(longest)))
        yield order[at:upto], length[order[at:upto]]
        at = upto


def viterbi(emission: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best state of every word."""
    out = np.zeros(len(emission), np.int8)
    move = step + _POSSIBLE
    for rows, length in _matrices(np.diff(first)):
        begin, width = first[rows], int(length[0])
        active = np.searchsorted(-length, -np.arange(width), "left")  # rows longer than t
        best = emission[begin] + _BEGIN
        back = np.zeros((width, len(rows), STATES), np.int8)
        for t in range(1, width):
            n = active[t]
            score = best[:n, :, None] + move
            back[t, :n] = score.argmax(axis=1)
            best[:n] = score.max(axis=1) + emission[begin[:n] + t]
        state = best.argmax(axis=1)
        for t in range(width - 1, -1, -1):
            n = active[t]
            out[begin[:n] + t] = state[:n]
            if t:
                state[:n] = back[t, np.arange(n), state[:n]]
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def forward_backward(emission: np.ndarray, length: np.ndarray, step: np.ndarray, with_steps: bool = True):
    """emission (n, width, states) padded → log Z, word posteriors, summed step posteriors per row
    (zeros if not wanted)."""
    n, width, _ = emission.shape
    move = step + _POSSIBLE
    ahead, behind = np.zeros_like(emission), np.zeros_like(emission)
    ahead[:, 0] = emission[:, 0] + _BEGIN
    for t in range(1, width):
        ahead[:, t] = _logsum(ahead[:, t - 1, :, None] + move, 1) + emission[:, t]
    for t in range(width - 2, -1, -1):
        on = (length > t + 1)[:, None]
        behind[:, t] = np.where(on, _logsum(move + (emission[:, t + 1] + behind[:, t + 1])[:, None, :], 2), 0)
    last = ahead[np.arange(n), length - 1]
    z = _logsum(last, 1)
    inside = np.arange(width) < length[:, None]
    post = np.exp(np.minimum(ahead + behind - z[:, None, None], 0)) * inside[:, :, None]  # padding holds any number
    steps = np.zeros((n, STATES, STATES), emission.dtype)
    for t in range(1, width if with_steps else 1):
        joint = ahead[:, t - 1, :, None] + move + (emission[:, t] + behind[:, t])[:, None, :] - z[:, None, None]
        steps += np.exp(np.minimum(joint, 0)) * inside[:, t, None, None]
    return z, post, steps


class _Table:
    """Sentences of similar length as padded matrices, with their gold counts."""

    def __init__(self, sentences: list[dict], ids: np.ndarray) -> None:
        width = max(len(s["shape"]) for s in sentences)
        self.length = np.array([len(s["shape"]) for s in sentences])
        self.weight = np.array([s["weight"] for s in sentences])
        inside = np.arange(width) < self.length[:, None]

        def padded(name: str) -> np.ndarray:
            return np.array([list(s[name]) + [0] * (width - len(s[name])) for s in sentences])

        shape, tag = np.searchsorted(ids, padded("shape")), padded("tag")
        before, after = np.zeros_like(shape), np.zeros_like(shape)
        before[:, 1:], after[:, :-1] = shape[:, :-1], shape[:, 1:]
        self.index = [shape, before, after, padded("coarse"), padded("size")]
        self.gold = (tag[:, :, None] == np.arange(STATES)) * inside[:, :, None]
        self.steps = np.zeros((STATES, STATES))
        for t in range(1, width):
            np.add.at(self.steps, (tag[:, t - 1], tag[:, t]), inside[:, t] * self.weight)

    def slopes(self, part: list[np.ndarray]) -> list[np.ndarray]:
        _, post, steps = forward_backward(sum(p[i] for p, i in zip(part, self.index)), self.length, part[5])
        miss = ((self.gold - post) * self.weight[:, None, None]).reshape(-1, STATES)
        out = []
        for p, i in zip(part, self.index):
            out.append(np.zeros_like(p))
            np.add.at(out[-1], i.ravel(), miss)
        return [*out, self.steps - (steps * self.weight[:, None, None]).sum(axis=0)]


def train(sentences: list[dict], rounds: int = 50, rate: float = 0.5, ridge: float = 1e-3) -> Field | None:
    """Weighted likelihood by Adagrad. sentences: shape, coarse, size, tag (lists) and weight."""
    if not any(any(s["tag"]) for s in sentences):
        return None
    total = sum(s["weight"] for s in sentences)
    sentences = sorted((s | {"weight": s["weight"] / total} for s in sentences), key=lambda s: len(s["shape"]))
    seen_ids, times = np.unique(np.array([x for s in sentences for x in s["shape"]]), return_counts=True)
    ids = np.array([_OUTSIDE, _RARE, *seen_ids[times >= RARE_BELOW].tolist()])
    often = set(ids.tolist())
    sentences = [s | {"shape": [x if x in often else _RARE for x in s["shape"]]} for s in sentences]
    groups: dict[int, list[dict]] = {}
    for s in sentences:
        groups.setdefault((len(s["shape"]) - 1).bit_length(), []).append(s)
    tables = [_Table(g, ids) for g in groups.values()]
    part = [np.zeros((len(ids), STATES)) for _ in range(3)] + [np.zeros((n, STATES)) for n in (_COARSE, 25, STATES)]
    seen = [np.full_like(p, 1e-8) for p in part]
    for _ in range(rounds):
        for p, s, *slopes in zip(part, seen, *(t.slopes(part) for t in tables)):
            g = sum(slopes) - ridge * p / len(sentences)
            s += g * g
            p += rate * g / np.sqrt(s)
    whole = [np.tile(p[_RARE].astype(np.float32), (SHAPES, 1)) for p in part[:3]]
    for w, p in zip(whole, part):
        w[ids] = p
    return Field(*whole, *(p.astype(np.float32) for p in part[3:]))


# --- spans of texts ----------------------------------------------------------------------------------

def _tags(w: Words, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """State of every word, from spans with offsets into the joined texts."""
    tag = np.zeros(len(w.start), np.int64)
    for kind, start, end in spans:
        a, b = np.searchsorted(w.end, start, "right"), np.searchsorted(w.start, end, "left")
        tag[a:b] = 2 + 2 * kind
        tag[a:a + 1] = 1 + 2 * kind
    return tag


def _posteriors(emission: np.ndarray, first: np.ndarray, state: np.ndarray, sentences: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Posterior of its state for every word of the given sentences, 0 elsewhere."""
    out = np.zeros(len(emission))
    for rows, length in _matrices(np.diff(first)[sentences], 50_000):
        begin, width = first[sentences[rows]], int(length[0])
        inside = np.arange(width) < length[:, None]
        word = np.where(inside, begin[:, None] + np.arange(width), 0)
        _, post, _ = forward_backward(emission[word].astype(np.float64), length, step.astype(np.float64), False)
        out[word[inside]] = np.take_along_axis(post, state[word][:, :, None].astype(np.int64), 2)[:, :, 0][inside]
    return out


def _added(joined: str, w: Words, model: Field, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the field that touch no base span, with offsets into the joined texts."""
    if not len(w.start):
        return []
    emission = model.emissions(w)
    state = viterbi(emission, w.first, model.step)
    taken = _tags(w, base) > 0
    further = (state > 0) & (state % 2 == 0)
    further[w.first[:-1]] = False
    hits = []
    for a in np.flatnonzero((state % 2 == 1) & ~taken).tolist():
        b = a + 1
        while b < len(state) and further[b] and state[b] == state[a] + 1:
            b += 1
        if not taken[a:b].any():
            hits.append((a, b))
    if not hits:
        return []
    sure = _posteriors(emission, w.first, state, np.unique(np.searchsorted(w.first, [a for a, _ in hits], "right") - 1), model.step)
    out = []
    for a, b in hits:
        if sure[a:b].min() < CONFIDENCE:
            continue
        kind = (int(state[a]) - 1) // 2
        start, end = int(w.start[a]), int(w.end[b - 1])
        while start < end and not (joined[start].isalnum() or joined[start] in "+("):
            start += 1
        while start < end and not (joined[end - 1].isalnum()):
            end -= 1
        if start < end:
            out.append((kind, start, end))
    return out


def spans_of(texts: list[str], model: Field | None) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, base) of every text, by kind and start."""
    base = [base_spans(t) for t in texts]
    out = [[(*s, True) for s in spans] for spans in base]
    if model is not None:
        w, offsets = words_of(texts)
        moved = [(k, int(o) + a, int(o) + b) for o, spans in zip(offsets, base) for k, a, b in spans]
        for k, a, b in _added("\n".join(texts), w, model, moved):
            i = int(np.searchsorted(offsets, a, "right")) - 1
            out[i].append((k, a - int(offsets[i]), b - int(offsets[i]), False))
    return [sorted(s) for s in out]


def _rows_of(w: Words, tag: np.ndarray) -> list[dict]:
    """Sentences as rows; long ones in parts that don't cut a span."""
    out = []
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        while lo < hi:
            cut = min(lo + TRAIN_WORDS, hi)
            while cut < hi and tag[cut] and tag[cut] % 2 == 0:
                cut += 1
            out.append({name: getattr(w, name)[lo:cut].tolist() for name in ("shape", "coarse", "size")}
                       | {"tag": tag[lo:cut].tolist(), "with_span": bool(tag[lo:cut].any())})
            lo = cut
    return out


def example_rows() -> list[dict]:
    """The labelled sentences of ``pii_examples`` as rows."""
    out = []
    for text, spans in labelled_examples():
        w, _ = words_of([text])
        base = base_spans(text)  # a pattern's own span has the pattern's kind
        own = [(ALL_KINDS.index(k), a, b) for k, a, b in spans if not any(a < e and s < b for _, s, e in base)]
        out += [r | {"weight": EXAMPLE_WEIGHT} for r in _rows_of(w, _tags(w, base + own))]
    return out


def labelled_sentences(docs: DataFrame) -> list[dict]:
    """The small labelled table: at most TRAIN_WITH + TRAIN_WITHOUT sentences and the examples."""
    lists = ("shape", "coarse", "size", "tag")

    def run(batches):
        schema = pa.schema([*((c, pa.list_(pa.int64())) for c in lists), ("with_span", pa.bool_())])
        for batch in batches:
            for _, _, part in text_chunks(batch.column(0)):
                w, offsets = words_of(part)
                tag = _tags(w, [(k, int(o) + a, int(o) + b) for o, t in zip(offsets, part) for k, a, b in base_spans(t)])
                yield pa.RecordBatch.from_pylist(_rows_of(w, tag), schema)

    ids = stored(docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS).distinct(), "train-docs")
    texts = docs.join(F.broadcast(ids), "doc_id", "left_semi").select(text_or_empty().alias("t"))  # at most TRAIN_DOCS ids
    table = stored(texts.mapInArrow(run, ", ".join(f"{c} array<long>" for c in lists) + ", with_span boolean"), "labelled-sentences")
    key = F.xxhash64("shape", "tag")
    out = []
    for flag, bound in ((True, TRAIN_WITH), (False, TRAIN_WITHOUT)):
        rows = table.where(F.col("with_span") == flag)
        part = [r.asDict() for r in rows.orderBy(key, *lists).limit(bound).collect()]
        all_rows = rows.count()
        out += [r | {"weight": all_rows / len(part)} for r in part]
    return out + example_rows() if out else []


def trained(docs: DataFrame) -> Field | None:
    return train(labelled_sentences(docs))


_SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def _tagger(shared, redacted: bool):
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def run(batches):
        for batch in batches:
            others = batch.num_columns - 1
            for lo, hi, part in text_chunks(batch.column(others)):
                spans = spans_of(part, shared.value)
                keep = [c.slice(lo, hi - lo) for c in batch.columns[:others]]
                if redacted:
                    new = pa.array([redact_text(t, s) for t, s in zip(part, spans)], pa.string())
                else:
                    new = pa.array([[{"kind": ALL_KINDS[k], "start": a, "end": b, "base": x} for k, a, b, x in s] for s in spans], pa.list_(kind))
                yield pa.RecordBatch.from_arrays([*keep, new], names=[*batch.schema.names[:others], "found"])

    return run


def find_spans(docs: DataFrame) -> DataFrame:
    """k_id, k_text and spans (kind, start, end, base) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs))  # tables of fixed size
    rows = docs.select(*row_key(), text_or_empty().alias("t")).mapInArrow(_tagger(shared, False), f"k_id long, k_text long, found {_SPANS}")
    return rows.withColumnRenamed("found", "spans")


def redact_text(text: str, spans: list[tuple[int, int, int, bool]]) -> str | None:
    """``text`` with every span replaced by its kind in brackets; null if there is none.
    Overlapping spans are replaced as one, named after the one that starts first."""
    if not spans:
        return None
    out, at, end = [], 0, -1
    for k, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[at:a], f"[{ALL_KINDS[k].upper()}]"]
            end = b
        end = at = max(end, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with spans replaced in ``text`` (and ``n_chars`` of those rows); columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs))
    schema = docs.schema
    row = F.struct(*[docs[f"`{c.replace('`', '``')}`"] for c in docs.columns])
    packed = docs.select(row.alias("row"), F.col("text").cast("string").alias("t"))
    rows = packed.mapInArrow(_tagger(shared, True), T.StructType([T.StructField("row", schema), T.StructField("found", T.StringType())]))

    def value(name: str):
        own = F.col("row").getField(name)
        if name == "text":
            return F.coalesce("found", own).alias(name)
        if name == "n_chars":
            return F.when(F.col("found").isNotNull(), F.length("found").cast(schema[name].dataType)).otherwise(own).alias(name)
        return own.alias(name)

    return rows.select(*(value(c) for c in docs.columns))
