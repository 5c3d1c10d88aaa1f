"""Chat formatting on the level of tokens.

A template marks every turn with control strings. In the token sequence a control string is
one reserved id behind the vocabulary; role names and texts are encoded as segments of their own, so
no token spans a mark, and the reserved ids are spliced in between. The loss mask is the prefix
sum of +1 and -1 at the ends of the segments that are learned (the assistant's texts, without marks).

Control strings that occur in a content are escaped: a backslash goes behind their first
character, and one more where backslashes stand there already, so that taking one away
reads the content back exactly and a formatted text holds its own control strings only.

``format_turns`` works row by row and shuffles nothing: a turn is a row of ids and mask, and the turns of
a conversation, in order, are its sequence. A conversation with a third of all turns is so
formatted by all tasks. ``read_turns`` reads role, text and learned text from the ids and the mask.
``conversation_digests`` hashes the turns of a conversation one after the other; SHA-256 has no other
way, so one task streams the sorted turns of a conversation, a batch at a time.

Defined cases: a null role or text counts as empty; roles without marks of their own are written
between ``[ROLE]`` and ``[/ROLE]``; null turns come first, equal turns are ordered by role and text;
repeated rows are turns each; a null ``conv_id`` is a conversation of its own; texts of any length
are one segment each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import _encoder
from .shingles import text_chunks


@dataclass(frozen=True)
class Template:
    """Marks before and after the text of a role; any other role is written between the marks
    ``other`` and its text ends with ``other_end``. Texts of ``learned`` roles are under the loss mask."""
    turns: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("", "</s>")})
    other: tuple[str, str] = ("[ROLE]", "[/ROLE]")
    other_end: str = "</s>"
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        controls = self.controls
        heads = {c[0] for c in controls}
        if any(len(c) < 2 or "\\" in c or heads & set(c[1:]) for c in controls):
            raise ValueError("a control string has two characters at least, no backslash, and no other's first character inside")
        if len({c for _, c in self.turns.values()} | {self.other[0]}) < len(self.turns) + 1:
            raise ValueError("the marks after the roles' texts must differ")

    @property
    def controls(self) -> list[str]:
        """All control strings; their reserved ids follow the vocabulary in this order."""
        return sorted({c for marks in self.turns.values() for c in marks if c} | {*self.other, self.other_end})

    def _heads(self, escaped: str) -> re.Pattern:
        return re.compile("|".join(f"{re.escape(c[0])}{escaped}(?=\\\\*{re.escape(c[1:])})" for c in self.controls))

    def escape(self, text: str) -> str:
        return self._heads("").sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._heads("\\\\").sub(lambda m: m[0][:-1], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool, bool]]:
        """(string, control, learned) of a turn; empty contents are left out."""
        before, after = self.turns.get(role, (None, self.other_end))
        head = [(self.other[0], True, False), (role, False, False), (self.other[1], True, False)] if before is None else [(before, True, False)]
        return [s for s in (*head, (text, False, role in self.learned), (after, True, False)) if s[0]]


TEMPLATE = Template()


def format_turns(turns: DataFrame, ranks: dict[bytes, int], pattern: str, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, turn, ids and loss (1 where learned) of every row of ``turns`` (conv_id, turn, role, text);
    the vocabulary (a file of fixed size) is broadcast."""
    shared = turns.sparkSession.sparkContext.broadcast(ranks)
    base = max(ranks.values()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern, {})
        reserved = {c: base + i for i, c in enumerate(template.controls)}
        for batch in batches:
            roles = batch.column(2).to_pylist()
            for lo, hi, texts in text_chunks(batch.column(3)):
                parts, learned, per_row = [], [], []
                for role, text in zip(roles[lo:hi], texts):
                    segments = template.segments(role, text)
                    per_row.append(len(segments))
                    for string, control, loss in segments:
                        parts.append(np.array([reserved[string]]) if control else encoder.encode_to_numpy(
                            template.escape(string), allowed_special=set(), disallowed_special=()))
                        learned.append(loss)
                ends = np.cumsum([len(p) for p in parts])
                starts, on = ends - [len(p) for p in parts], np.array(learned)
                change = np.zeros(ends[-1] + 1, np.int8)
                np.add.at(change, starts[on], 1)
                np.subtract.at(change, ends[on], 1)
                offsets = pa.array(np.concatenate([[0], ends[np.cumsum(per_row) - 1]]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in range(2)),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts).astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(np.cumsum(change[:-1], dtype=np.int8)))],
                    names=["conv_id", "turn", "ids", "loss"])

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, ids array<int>, loss array<tinyint>")


def parsed(ids: np.ndarray, loss: np.ndarray, names: dict[int, str], decode, template: Template) -> Iterator[tuple[str, str, str, int]]:
    """(role, text, learned text, formatted characters) of the turns in a sequence. ``names``: control
    strings by id, ``decode``: ids → string."""
    by_mark = {marks[0] or marks[1]: role for role, marks in template.turns.items()}
    cuts = np.flatnonzero(ids >= min(names)).tolist()
    at = 0
    while cuts:
        first, chars, role = cuts[0], 0, None
        if first == at and names[int(ids[at])] == template.other[0]:
            name = decode(ids[at + 1:cuts[1]])
            chars, role = len(name) + sum(map(len, template.other)), template.unescape(name)
            at, cuts = cuts[1] + 1, cuts[2:]
        elif first == at and names[int(ids[at])] in by_mark and template.turns[by_mark[names[int(ids[at])]]][0]:
            role = by_mark[names[int(ids[at])]]
            chars, at, cuts = len(names[int(ids[at])]), at + 1, cuts[1:]
        end, cuts = cuts[0], cuts[1:]
        close = names[int(ids[end])]
        text, on = decode(ids[at:end]), loss[at:end] == 1
        learned = text if on.all() else decode(ids[at:end][on])
        yield (by_mark[close] if role is None else role, template.unescape(text), template.unescape(learned), chars + len(text) + len(close))
        at = end + 1


def read_turns(formatted: DataFrame, ranks: dict[bytes, int], pattern: str, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, turn, role, text, learned (text under the loss mask) and n_chars of every turn of
    ``formatted`` (conv_id, turn, ids, loss)."""
    shared = formatted.sparkSession.sparkContext.broadcast(ranks)
    base = max(ranks.values()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern, {})
        names = {base + i: c for i, c in enumerate(template.controls)}
        decode = lambda ids: encoder.decode_bytes(ids.tolist()).decode()
        for batch in batches:
            ids, loss = batch.column(2), batch.column(3)
            flat, mask = ids.flatten().to_numpy(), loss.flatten().to_numpy()
            ends = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            rows = [(i, *turn) for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist()))
                    for turn in parsed(flat[a:b], mask[a:b], names, decode, template)]
            if rows:
                row, *columns = zip(*rows)
                keep = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(keep), batch.column(1).take(keep), *(pa.array(c, pa.string()) for c in columns[:3]),
                     pa.array(columns[3], pa.int64())], names=["conv_id", "turn", "role", "text", "learned", "n_chars"])

    return formatted.mapInArrow(run, "conv_id long, turn long, role string, text string, learned string, n_chars long")


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation of ``read_turns``: conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn),
    loss_chars, loss_sha256 (the learned texts) and formatted_chars. A learned text that is the whole
    text is shuffled once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def ended():
            return (now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        as_batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        for batch in batches:
            done = []
            for conv, _, role, text, learned, chars in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != now:
                    if state is not None:
                        done.append(ended())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                learned = text if learned is None else learned
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += chars
            if done:
                yield as_batch(done)
        if state is not None:
            yield as_batch([ended()])

    once = F.when(F.col("learned") != F.col("text"), F.col("learned"))
    rows = turns.select("conv_id", "turn", "role", "text", once.alias("learned"), "n_chars").repartition("conv_id")
    return rows.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
