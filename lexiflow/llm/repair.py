"""Repair of the turn structure of conversations by rank-convergence parallel Viterbi.

The turns of a conversation are edited (kept, given another role, deleted, or empty turns inserted) at
least cost so that their roles read system?, (user, assistant)+, or nothing is left. A state
is what the edited turns end with: nothing yet, a system, a user or an assistant turn. The cost to
finish from each state, the cost vector, is worked out from the last turn to the first.

Turns are put in order by range partitions, and the part of a conversation in one partition is a
chunk of one byte a turn, so a conversation with a third of all turns is many chunks. All
chunks run at once from a speculative vector at their end (that of a conversation which ends there).
Fix-up passes then rerun a chunk from the vector that its right neighbour found, until a vector
differs from the one found before by a constant only: there the rest of the chunk stands. When no
chunk has to be rerun, the stitched vectors are the true backward costs up to constants, which
is all that comparing edits needs. Insertions keep the entries of a vector within a few units of each
other, so a vector without its constant is one of few numbers, and steps are remembered.

With these costs chunks are traced forwards: of all cheapest edits the letter that is least in ASCII
is taken at every place. Chunks are first traced for all four states they can begin with (exits
only), a pass over one short row per chunk finds the state each really begins with, and the second
trace writes its letters. The texts are shuffled once, to be hashed in order.

Defined cases: null roles, texts, and null parts of the damage key are one space; null turns come
first; equal turns are ordered by the digest of role and text; gaps beyond 64 bits are 2^63 - 1; repeated rows are turns each, all but the first
duplicates; a null ``conv_id`` is a conversation; texts of any length are read whole; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .clusters import LARGEST
from .common import SPACE, stored

#: Costs of the edits; Keep costs nothing. A truncated turn that stays adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns dealt to one range partition.
DEALT_TOGETHER = 50_000

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: First letters of roles as codes; a turn's code is 3 · letter + fault.
LETTERS = "sua"
SOUND, DELETED, CUT = range(3)
_ALL_DELETED = bytes(3 * letter + DELETED for letter in range(4))
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_SPACES = " \t\n\x0b\x0c\r"

# --- edits -----------------------------------------------------------------------------------

Vector = tuple[int, int, int, int]


def _next(state: int) -> int:
    """State after a user or assistant turn that fits: a user turn, behind a user turn an assistant's."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, letter: int) -> int | None:
    """State after keeping a turn with this first letter, if it may be kept."""
    if letter == 0:
        return SYSTEM if state == NOTHING else None
    return letter + 1 if letter < 3 and letter + 1 == _next(state) else None


def _closed(v: list[int]) -> Vector:
    """Costs with insertions before the turn, the least cost as 0."""
    user = min(v[USER], INSERT + v[ASSISTANT])
    out = (min(v[NOTHING], INSERT + user), min(v[SYSTEM], INSERT + user), user, min(v[ASSISTANT], INSERT + user))
    least = min(out)
    return tuple(x - least for x in out)


_FAR = 1 << 20
#: Costs at the end of a conversation: nothing or an assistant turn may end it.
END: Vector = _closed([0, _FAR, _FAR, 0])


def _packed(v: Vector) -> int:
    return v[0] | v[1] << 4 | v[2] << 8 | v[3] << 12


def _unpacked(x: int) -> Vector:
    return x & 15, x >> 4 & 15, x >> 8 & 15, x >> 12


def _moves(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one turn."""
    letter, fault = divmod(code, 3)
    out = [("D", DELETE, state)]
    if fault != DELETED:
        more = TRUNCATED * (fault == CUT)
        kept = _kept(state, letter)
        if kept is not None:
            out.append(("K", more, kept))
        out.append(("R", REROLE + more, _next(state)))
    return out


class Steps:
    """Remembered steps of cost vectors and traces."""

    def __init__(self) -> None:
        self.back: dict[int, int] = {}
        self.ahead: dict[int, tuple[str, int, int]] = {}

    def before(self, after: int, code: int) -> int:
        """Vector before a turn from the one behind it."""
        key = after << 8 | code
        if key not in self.back:
            v = _unpacked(after)
            self.back[key] = _packed(_closed([min(c + v[t] for _, c, t in _moves(code, s)) for s in range(4)]))
        return self.back[key]

    def trace(self, after: int, code: int, state: int) -> tuple[str, int, int]:
        """(letters, cost, next state) for one turn and the insertions before it: of the cheapest
        ways the one whose letters are least in ASCII."""
        key = (after << 8 | code) << 2 | state
        if key not in self.ahead:
            v = _unpacked(after)
            turn = [min(c + v[t] for _, c, t in _moves(code, s)) for s in range(4)]
            whole = list(turn)
            whole[USER] = min(turn[USER], INSERT + turn[ASSISTANT])
            for s in (NOTHING, SYSTEM, ASSISTANT):
                whole[s] = min(turn[s], INSERT + whole[USER])
            letters, cost, s = "", 0, state
            while True:
                ways = [w for w in _moves(code, s) if w[1] + v[w[2]] == whole[s]]
                if whole[s] == INSERT + whole[_next(s)]:
                    ways.append(("I", INSERT, _next(s)))
                letter, c, s = min(ways)
                letters, cost = letters + letter, cost + c
                if letter != "I":
                    break
            self.ahead[key] = (letters, cost, s)
        return self.ahead[key]


def tail(state: int) -> str:
    """Insertions behind the last turn."""
    return {USER: "I", SYSTEM: "II"}.get(state, "")


def backward(codes: bytes, steps: Steps, end: int) -> np.ndarray:
    """Vectors before each turn and behind the last, from the one at the end."""
    out = np.empty(len(codes) + 1, "<u2")
    out[-1] = v = end
    for i in range(len(codes) - 1, -1, -1):
        out[i] = v = steps.before(v, codes[i])
    return out


def fixed_up(codes: bytes, vectors: np.ndarray, steps: Steps, end: int) -> np.ndarray:
    """``vectors`` for another end: reruns until a vector is the one that stands there already."""
    out = vectors.copy()
    out[-1] = v = end
    for i in range(len(codes) - 1, -1, -1):
        v = steps.before(v, codes[i])
        if out[i] == v:
            break
        out[i] = v
    return out


def traced(codes: bytes, vectors: np.ndarray, steps: Steps, state: int) -> tuple[str, int, int]:
    """(letters, cost, last state) of a chunk that begins in ``state``."""
    letters, cost = [], 0
    for code, after in zip(codes, vectors[1:].tolist()):
        part, c, state = steps.trace(after, code, state)
        letters.append(part)
        cost += c
    return "".join(letters), cost, state


# --- the damaged table ---------------------------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage by crc32 of ``conv_id:turn``."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        part("role").alias("role"), part("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("copy")).drop("copy")


def _digest() -> Column:
    """16 bytes that stand for role and text."""
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def ordered(rows: DataFrame, n: int) -> DataFrame:
    """Stored narrow table of all turns in order: pos, conv_id, turn, digest, code (blank turns as
    deleted). Partitions are ranges, their numbers are the upper bits of ``pos``."""
    shown = F.rtrim(F.col("text"), F.lit(_SPACES))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == LETTERS[0], 0).when(initial == LETTERS[1], 1).when(initial == LETTERS[2], 2).otherwise(3)
    fault = (F.when(~F.col("text").rlike(f"[^{SPACE}]"), DELETED).when(~F.substring(shown, -1, 1).isin(".", "!", "?"), CUT)
             .otherwise(SOUND))
    narrow = rows.select("conv_id", "turn", _digest().alias("digest"), (3 * letter + fault).cast("int").alias("code"),
                         F.monotonically_increasing_id().alias("row"))  # tells equal rows apart, so they can be dealt
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, math.ceil(n / DEALT_TOGETHER), min(cores, n // 1000))
    keys = ["conv_id", "turn", "digest", "row"]
    dealt = narrow.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return stored(dealt.select(F.monotonically_increasing_id().alias("pos"), "conv_id", "turn", "digest", "code"), "ordered-turns")


def chunks(turns: DataFrame) -> DataFrame:
    """Stored chunks of ``ordered``: conv_id, part, codes (binary), first (turn and digest), blank, duplicate,
    truncated, illegal, head and last (letters)."""
    firsts = turns.groupBy("conv_id", "digest").agg(F.min("pos").alias("f_pos")).select("f_pos")  # a turn each: no key is hot
    marked = turns.join(firsts, F.col("pos") == F.col("f_pos"), "left")
    again = F.col("f_pos").isNull() & (F.col("code") % 3 != DELETED)
    marked = marked.select("pos", "conv_id", F.shiftright("pos", 33).cast("int").alias("part"), "turn", "digest",
                           (F.col("code") % 3 == DELETED).alias("blank"), again.alias("duplicate"), "code")
    code = F.when(F.col("duplicate"), F.col("code") - F.col("code") % 3 + DELETED).otherwise(F.col("code"))
    count = lambda c: F.sum(c.cast("long"))
    grouped = marked.groupBy("conv_id", "part").agg(
        F.min(F.struct("pos", "turn", "digest")).alias("first"), count(F.col("blank")).alias("blank"),
        count(F.col("duplicate")).alias("duplicate"), count((code % 3 == CUT)).alias("truncated"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", code.cast("int").alias("code")))), lambda x: x["code"]).alias("codes"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("codes")
            codes = [np.asarray(lists[i].values, np.uint8) for i in range(batch.num_rows)]
            pairs = [sum((a, b) not in _LEGAL for a, b in zip((c // 3).tolist(), (c[1:] // 3).tolist())) for c in codes]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(pairs, pa.int64()),
                 pa.array([int(c[0]) // 3 for c in codes], pa.int32()), pa.array([int(c[-1]) // 3 for c in codes], pa.int32())],
                names=["conv_id", "part", "first", "blank", "duplicate", "truncated", "codes", "illegal", "head", "last"])

    first = "struct<pos: long, turn: long, digest: binary>"
    return stored(grouped.select("conv_id", "part", "first", "blank", "duplicate", "truncated", "codes").mapInArrow(
        pack, f"conv_id long, part int, first {first}, blank long, duplicate long, truncated long, codes binary, illegal long, head int, last int"),
        "turn-chunks")


# --- cost vectors of all chunks ---------------------------------------------------------------------

def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["conv_id"].eqNullSafe(b["conv_id"]) & (a["part"] == b["part"])


def _run(rows: DataFrame) -> DataFrame:
    """conv_id, part, codes, end and vectors (null at first) → vectors for that end, their left one, and
    whether any turn of the chunk may stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            out = []
            for codes, end, old in zip(batch.column("codes"), batch.column("end").to_pylist(), batch.column("vectors")):
                codes = codes.as_py()
                out.append(backward(codes, steps, end) if not old.is_valid else
                           fixed_up(codes, np.frombuffer(old.as_py(), "<u2"), steps, end))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "part", "codes", "end")), pa.array([v.tobytes() for v in out], pa.binary()),
                 pa.array([int(v[0]) for v in out], pa.int32()), pa.array([len(c.as_py().translate(None, _ALL_DELETED)) > 0 for c in batch.column("codes")])],
                names=["conv_id", "part", "codes", "end", "vectors", "left", "some_stay"])

    return rows.select("conv_id", "part", "codes", "end", "vectors").mapInArrow(
        run, "conv_id long, part int, codes binary, end int, vectors binary, left int, some_stay boolean")


def cost_vectors(table: DataFrame) -> tuple[DataFrame, int]:
    """conv_id, part, codes, vectors of all chunks of ``table`` (conv_id, part, codes), and the
    number of fix-up passes."""
    start = table.select("conv_id", "part", "codes", F.lit(_packed(END)).alias("end"), F.lit(None).cast("binary").alias("vectors"))
    runs, passes = stored(_run(start), "cost-vectors"), 0
    own = ["codes", "end", "vectors", "left", "some_stay"]
    # a short row per chunk; one without a turn that may stay hands on the vector behind it
    order = W.partitionBy("conv_id").orderBy(F.col("part").desc()).rowsBetween(W.unboundedPreceding, -1)
    behind = F.coalesce(F.last(F.when(F.col("some_stay"), F.col("left")), ignorenulls=True).over(order), F.lit(_packed(END)))
    while True:
        right = runs.select("conv_id", "part", F.col("end").alias("old"), behind.alias("new")).where("new <> old")
        right = stored(right.select("conv_id", "part", "new"), "fix-up")
        if right.isEmpty():
            return runs, passes
        joined = runs.join(right, _same(runs, right), "left").select(runs["conv_id"], runs["part"], *own, "new")
        rerun = _run(joined.where("new IS NOT NULL").select("conv_id", "part", "codes", F.col("new").alias("end"), "vectors"))
        runs = stored(joined.where("new IS NULL").drop("new").select(*rerun.columns).unionByName(rerun), "cost-vectors")
        passes += 1


# --- edits of all chunks ------------------------------------------------------------------------------

def _entries(runs: DataFrame, table: DataFrame) -> DataFrame:
    """conv_id, part, state in which the chunk begins, is_last, joint (1 where the pair of turns
    across its left end is illegal)."""
    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            out = [[traced(c.as_py(), np.frombuffer(v.as_py(), "<u2"), steps, s)[2] for s in range(4)]
                   for c, v in zip(batch.column("codes"), batch.column("vectors"))]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(out, pa.list_(pa.int32()))],
                                             names=["conv_id", "part", "exits"])

    def walk(chain: pa.Table) -> pa.Table:
        chain = chain.sort_by("part")
        state, states, joints, before = NOTHING, [], [], None
        for exit_, head, last in zip(chain["exits"].to_pylist(), chain["head"].to_pylist(), chain["last"].to_pylist()):
            states.append(state)
            joints.append(int(before is not None and (before, head) not in _LEGAL))
            state, before = exit_[state], last
        n = len(states)
        return pa.table({"conv_id": chain["conv_id"], "part": chain["part"], "state": pa.array(states, pa.int32()),
                         "is_last": pa.array([i == n - 1 for i in range(n)]), "joint": pa.array(joints, pa.int64())})

    # a conversation that lies in one chunk begins with nothing; only the others are walked along
    parts = table.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    several = stored(parts.where("n > 1").select(F.col("conv_id").alias("s_conv")), "conversations-in-several-chunks")
    inside = lambda df, how: df.join(several, df["conv_id"].eqNullSafe(several["s_conv"]), how)
    maps = inside(runs, "left_semi").select("conv_id", "part", "codes", "vectors").mapInArrow(
        exits, "conv_id long, part int, exits array<int>").alias("m")
    heads = table.select("conv_id", "part", "head", "last").alias("h")
    chains = maps.join(heads, F.col("m.conv_id").eqNullSafe(F.col("h.conv_id")) & (F.col("m.part") == F.col("h.part")))
    walked = chains.select("m.conv_id", "m.part", "exits", "head", "last").groupBy("conv_id").applyInArrow(
        walk, "conv_id long, part int, state int, is_last boolean, joint long")
    alone = inside(table, "left_anti").select("conv_id", "part", F.lit(NOTHING).alias("state"), F.lit(True).alias("is_last"),
                                              F.lit(0).cast("long").alias("joint"))
    return alone.unionByName(walked)


def edits(table: DataFrame) -> DataFrame:
    """conv_id, part, letters, cost, joint of every chunk."""
    runs, _ = cost_vectors(table)
    entries = stored(_entries(runs, table), "chunk-entries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            letters, costs = [], []
            for codes, vectors, state, is_last in zip(*(batch.column(c).to_pylist() for c in ("codes", "vectors", "state", "is_last"))):
                part, cost, state = traced(codes, np.frombuffer(vectors, "<u2"), steps, state)
                end = tail(state) if is_last else ""
                letters.append(part + end)
                costs.append(cost + INSERT * len(end))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(letters, pa.string()),
                                              pa.array(costs, pa.int64()), batch.column("joint")],
                                             names=["conv_id", "part", "letters", "cost", "joint"])

    joined = runs.join(entries, _same(runs, entries)).select(runs["conv_id"], runs["part"], "codes", "vectors", "state", "is_last", "joint")
    return joined.mapInArrow(run, "conv_id long, part int, letters string, cost long, joint long")


def repaired_digests(rows: DataFrame, done: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 of every conversation. ``rows``: the damaged turns, ``done``: first, part and
    letters of the chunks. A chunk's letters come before its first turn in the sorted stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, state, waiting, lines, at = None, None, NOTHING, deque(), 0, 0

        def put(line: str) -> None:
            nonlocal lines
            sha.update(("\n" * (lines > 0) + line).encode())
            lines += 1

        def letter() -> str:
            nonlocal at
            while at == len(waiting[0]):
                waiting.popleft()
                at = 0
            at += 1
            return waiting[0][at - 1]

        def insert() -> None:
            nonlocal state
            state = _next(state)
            put("user:" if state == USER else "assistant:")

        def ended() -> tuple:
            left = sum(map(len, waiting)) - at
            for _ in range(left):  # insertions behind the last turn
                letter()
                insert()
            return now, sha.hexdigest()

        as_batch = lambda found: pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names=["conv_id", "repaired_sha256"])
        for batch in batches:
            found = []
            for conv, role, text, letters in zip(*(c.to_pylist() for c in batch.columns)):
                if sha is None or conv != now:
                    if sha is not None:
                        found.append(ended())
                    now, sha, state, waiting, lines, at = conv, hashlib.sha256(), NOTHING, deque(), 0, 0
                if letters is not None:
                    waiting.append(letters)
                    continue
                while (edit := letter()) == "I":
                    insert()
                if edit == "K":
                    put(f"{role}:{text}")
                    state = LETTERS.index(role[0]) + 1
                elif edit == "R":
                    state = _next(state)
                    put(f"{'user' if state == USER else 'assistant'}:{text}")
            if found:
                yield as_batch(found)
        if sha is not None:
            yield as_batch([ended()])

    text = rows.select("conv_id", "turn", _digest().alias("digest"), F.lit(-1).alias("part"), "role", "text", F.lit(None).cast("string").alias("letters"))
    heads = done.select("conv_id", F.col("first.turn").alias("turn"), F.col("first.digest").alias("digest"), "part",
                        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "letters")
    stream = text.unionByName(heads).repartition("conv_id")
    return (stream.sortWithinPartitions("conv_id", "turn", "digest", F.col("letters").isNull(), "part")
            .select("conv_id", "role", "text", "letters").mapInArrow(run, "conv_id long, repaired_sha256 string"))


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every
    conversation of ``turns`` (conv_id, turn, role, text), after the damage."""
    rows = damaged(turns)
    order = ordered(rows, turns.count())
    table = chunks(order)
    done = stored(edits(table), "chunk-edits")
    whole = done.join(table, _same(done, table)).select(done["conv_id"], done["part"], "letters", "cost", "joint", "first", "blank",
                                                       "duplicate", "truncated", "illegal")
    total = lambda c: F.sum(c).alias(c)
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "letters"))), lambda x: x["letters"]), "")
    found = whole.groupBy("conv_id").agg(total("blank"), total("duplicate"), total("truncated"),
                                         F.sum(F.col("illegal") + F.col("joint")).alias("illegal"), total("cost"), audit.alias("audit"))
    wide = lambda c: c.cast("decimal(38,0)")
    span = wide(F.max("turn")) - wide(F.min("turn")) + 1 - wide(F.count_distinct("turn"))
    gaps = order.groupBy("conv_id").agg(F.least(F.coalesce(span, wide(F.lit(0))), wide(F.lit(LARGEST))).cast("long").alias("gaps"))
    shas = repaired_digests(rows, whole)
    out = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for more in (gaps, found, shas):
        more = more.withColumnRenamed("conv_id", "own_id")
        out = out.join(more, out["conv_id"].eqNullSafe(more["own_id"]), "left").drop("own_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
