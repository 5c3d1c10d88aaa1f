"""Byte-pair merges over blocks of words, round by round.

A block holds some of the distinct words as arrays: the codes of all symbols one after another, and for each
word its frequency and its place in corpus order. A round is one Spark job: every task applies the same merges
to its block, and what leaves it is how the counts of pairs changed. Which merges share a round is
decided by ``bpe_rounds.chosen`` from the counts of all pairs; their number depends on the symbols, and
no word is sent anywhere.

A merge touches the words that hold one of its pairs. They are found by two look-ups per symbol; only these words are
taken out, merged one rule after another, and put back. Symbols that a round makes have codes of
the block's own until the next round tells everybody's codes. The counts of all pairs are sorted arrays (``_Pairs``).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bpe_rounds import LOOKED_AT, Pair, changed_by, chosen

#: Merges in a round (one bit each), and pairs whose first place is told ahead.
MOST_MERGES, TOLD_AHEAD = 64, 2 * LOOKED_AT
#: Of ``Rounds``: symbols are looked up by so many characters of their begin and end.
_EDGE = 3

_NOWHERE = 1 << 62


class Block(NamedTuple):
    codes: np.ndarray  # symbols of all words
    last: np.ndarray  # whether a symbol ends its word
    freq: np.ndarray  # of a word
    place: np.ndarray  # of a word, ascending
    known: int  # codes that all blocks share
    own: list[str]  # symbols of the codes behind them


class Changes(NamedTuple):
    """How the counts of pairs changed in a block."""

    known: int  # codes below are everybody's
    own: list[str]  # symbols of the codes behind them
    key: np.ndarray  # left code << 32 | right code
    amount: np.ndarray
    place: np.ndarray  # first new place (_NOWHERE: none) and characters before it
    before: np.ndarray


class Told(NamedTuple):
    """What all tasks are told in a round."""

    base: object  # holds as ``value`` the first symbols and their lengths; None: there are none
    symbols: pa.Array  # those behind them
    length: np.ndarray
    fresh: list[str]  # symbols that the last round made, and their codes
    fresh_codes: np.ndarray
    rules: list[Pair]
    lefts: list[np.ndarray]  # of each rule, codes that it matches on the left
    rights: list[np.ndarray]
    asked: list[tuple[int, int]]  # pairs of codes whose first places are wanted


def block_of(batches: Iterable[pa.RecordBatch], symbols: list[str]) -> Block:
    """Block of rows (syms, freq, place) sorted by place."""
    values, parts = pa.array(symbols, pa.string()), [[np.empty(0, t)] for t in (np.int32, bool, np.int64, np.int64)]
    for batch in batches:
        syms = batch.column("syms")
        ends = np.cumsum(pc.list_value_length(syms).to_numpy(zero_copy_only=False)) - 1  # no word is without symbols
        codes = pc.index_in(syms.flatten(), value_set=values).to_numpy(zero_copy_only=False).astype(np.int32)
        last = np.zeros(len(codes), bool)
        last[ends] = True
        for part, array in zip(parts, (codes, last, batch.column("freq").to_numpy(), batch.column("place").to_numpy())):
            part.append(array)
    return Block(*(np.concatenate(p) for p in parts), len(symbols), [])


class _Table:
    """Symbols of a block's codes in a round, and as bits the rules that match them on either side."""

    def __init__(self, told: Told, substring: bool) -> None:
        base, length = told.base.value if told.base is not None else (pa.array([], pa.string()), np.empty(0, np.int32))
        self.names = pa.concat_arrays([base, told.symbols]) if len(told.symbols) else base
        self.known = len(self.names)
        self.rules, self.substring = told.rules, substring
        self.own: list[str] = []
        self.index: dict[str, int] = {}
        self.length = np.append(length, told.length)
        self.left, self.right = np.zeros(self.known, np.uint64), np.zeros(self.known, np.uint64)
        self.sides: tuple[dict[str, int], dict[str, int]] = {}, {}
        for j, (rule, left, right) in enumerate(zip(told.rules, told.lefts, told.rights)):
            self.left[left] |= np.uint64(1 << j)
            self.right[right] |= np.uint64(1 << j)
            for side, text in zip(self.sides, rule):
                side[text] = side.get(text, 0) | 1 << j
        self.sizes = [sorted({len(text) for text in side}) for side in self.sides]

    def strings(self, codes: np.ndarray) -> list[str]:
        out = self.names.take(pa.array(np.where(codes < self.known, codes, 0))).to_pylist() if self.known else [""] * len(codes)
        for i in np.flatnonzero(codes >= self.known).tolist():
            out[i] = self.own[codes[i] - self.known]
        return out

    def _bits(self, s: str) -> tuple[int, int]:
        (ends, begins), (end_sizes, begin_sizes) = self.sides, self.sizes
        if not self.substring:
            return ends.get(s, 0), begins.get(s, 0)
        left = right = 0
        for n in end_sizes:
            if n <= len(s):
                left |= ends.get(s[len(s) - n:], 0)
        for n in begin_sizes:
            if n <= len(s):
                right |= begins.get(s[:n], 0)
        return left, right

    def codes(self, symbols: list[str]) -> np.ndarray:
        """Own codes, also of symbols that everybody knows."""
        fresh = [s for s in dict.fromkeys(symbols) if s not in self.index]
        if fresh:
            first, bits = self.known + len(self.own), [self._bits(s) for s in fresh]
            self.index.update(zip(fresh, range(first, first + len(fresh))))
            self.own += fresh
            need = first + len(fresh)
            if need > len(self.left):
                more = np.zeros(need // 4 + 1000, np.uint64)
                self.left, self.right = np.append(self.left, more), np.append(self.right, more)
                self.length = np.append(self.length, more.astype(self.length.dtype))
            self.left[first:need], self.right[first:need] = (np.array(side, np.uint64) for side in zip(*bits))
            self.length[first:need] = [len(s) for s in fresh]
        return np.array([self.index[s] for s in symbols], np.int32)


def _without_overlaps(at: np.ndarray, codes: np.ndarray, table: _Table, rule: Pair) -> np.ndarray:
    """Of the places ``at`` (symbols joined with the next one) those that matching from the left takes."""
    near = np.flatnonzero(np.diff(at) == 1)
    if not len(near):
        return at
    room = table.length[codes[at]] >= (len(rule[0]) + len(rule[1]) if table.substring else np.iinfo(np.int64).max)
    taken = np.ones(len(at), bool)
    for k in near.tolist():  # the symbol between is used up by the match before it
        if taken[k] and not room[k + 1]:
            taken[k + 1] = False
    return at[taken]


def _merged(codes: np.ndarray, last: np.ndarray, start: np.ndarray, j: int, table: _Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols after rule ``j``; ``start``: the place that a symbol had before the round."""
    fits = (table.left[codes[:-1]] & table.right[codes[1:]] & np.uint64(1 << j)) != 0
    at = _without_overlaps(np.flatnonzero(fits & ~last[:-1]), codes, table, table.rules[j])
    if not len(at):
        return codes, last, start
    begins = np.ones(len(codes), bool)
    begins[at + 1] = False
    begin = np.flatnonzero(begins)
    size = np.diff(np.append(begin, len(codes)))
    out = codes[begin]
    two = np.flatnonzero(size == 2)
    pairs, which = np.unique(codes[begin[two]].astype(np.int64) << 32 | codes[begin[two] + 1], return_inverse=True)
    out[two] = table.codes([x + y for x, y in zip(table.strings(pairs >> 32), table.strings(pairs & 0xFFFFFFFF))])[which]
    more = np.flatnonzero(size > 2).tolist()
    if more:
        out[more] = table.codes(["".join(table.strings(codes[begin[k]:begin[k] + size[k]])) for k in more])
    return out, last[begin + size - 1], start[begin]


def _changes(table: _Table, keys: np.ndarray, amounts: np.ndarray, places: tuple[np.ndarray, np.ndarray]) -> Changes:
    """Sums by key (left code << 32 | right code). ``places`` belong to the last keys, in order."""
    place, before = places
    at = np.full(len(keys), _NOWHERE)
    at[len(keys) - len(place):] = np.arange(len(place))
    sums = pa.table([keys, amounts, at], names=["key", "n", "at"]).group_by("key", use_threads=False).aggregate([("n", "sum"), ("at", "min")])
    key, total, first = (sums[c].to_numpy() for c in ("key", "n_sum", "at_min"))
    told = np.flatnonzero((total != 0) | (first < _NOWHERE))
    key, total, first = key[told], total[told], first[told]
    none = first == _NOWHERE
    p, b = (np.where(none, x, v[np.where(none, 0, first)]) if len(v) else np.full(len(first), x) for x, v in ((_NOWHERE, place), (0, before)))
    return Changes(table.known, table.own, key, total, p, b)


def _keys(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    return codes[at].astype(np.int64) << 32 | codes[at + 1]


def _pairs_at(codes: np.ndarray, last: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Places of the symbols that ``left`` is true for, where ``right`` is for the next symbol of the word."""
    at = np.flatnonzero(left[codes[:-1]] & ~last[:-1])
    return at[right[codes[at + 1]]]


def _characters_before(codes: np.ndarray, size: np.ndarray, table: _Table) -> np.ndarray:
    """Characters of the word before each symbol; ``size``: symbols of the words."""
    length = table.length[codes].astype(np.int64)
    before = np.cumsum(length) - length
    return before - np.repeat(before[np.cumsum(size) - size], size)


def _told(symbols: list[str]) -> Told:
    return Told(None, pa.array(symbols, pa.string()), np.array([len(s) for s in symbols], np.int32), [], np.empty(0, np.int32), [], [], [], [])


def all_pairs(block: Block, symbols: list[str]) -> Changes:
    """The counts of all pairs of a block, as changes."""
    table, ends, none = _Table(_told(symbols), False), np.flatnonzero(block.last), np.empty(0, np.int64)
    if not len(ends):
        return _changes(table, none, none, (none, none))
    size = np.diff(ends, prepend=-1)
    at = np.flatnonzero(~block.last[:-1])
    word = np.repeat(np.arange(len(ends)), size)[at]
    return _changes(table, _keys(block.codes, at), block.freq[word], (block.place[word], _characters_before(block.codes, size, table)[at]))


def first_places(block: Block, asked: list[tuple[int, int]], length: np.ndarray) -> list[tuple[int, int, int]]:
    """(place in ``asked``, place, characters before) of the asked pairs that the block holds."""
    if not asked or len(block.codes) < 2:
        return []
    lefts, rights = ({c: i for i, c in enumerate(dict.fromkeys(p[side] for p in asked))} for side in (0, 1))
    left, right = np.full(len(length), -1, np.int16), np.full(len(length), -1, np.int16)
    left[list(lefts)], right[list(rights)] = range(len(lefts)), range(len(rights))
    slots = np.full((len(lefts), len(rights)), -1)
    for i, (a, b) in enumerate(asked):
        slots[lefts[a], rights[b]] = i
    at = _pairs_at(block.codes, block.last, left >= 0, right >= 0)
    slot = slots[left[block.codes[at]], right[block.codes[at + 1]]]
    at, slot = at[slot >= 0], slot[slot >= 0]
    first = np.full(len(asked), -1)
    first[slot[::-1]] = at[::-1]
    ends, out = np.flatnonzero(block.last), []
    for i in np.flatnonzero(first >= 0).tolist():
        word = int(np.searchsorted(ends, first[i]))
        begin = ends[word - 1] + 1 if word else 0
        out.append((i, int(block.place[word]), int(length[block.codes[begin:first[i]]].sum())))
    return out


def run_round(block: Block, told: Told, substring: bool) -> tuple[Block, tuple[Changes, list[str], list[tuple[int, int, int]]]]:
    """The block after the rules that are told; changes of its counts, symbols that it made, first places asked for."""
    table, none = _Table(told, substring), np.empty(0, np.int64)
    codes, last = block.codes, block.last
    if block.own:
        index = dict(zip(told.fresh, told.fresh_codes.tolist()))  # of the round before
        everybodys = np.array([index[s] for s in block.own], np.int32)
        at = np.flatnonzero(codes >= block.known)
        codes = codes.copy()
        codes[at] = everybodys[codes[at] - block.known]
    hit = none
    if told.rules and len(codes) > 1:
        hit = _pairs_at(codes, last, table.left != 0, table.right != 0)
        hit = hit[(table.left[codes[hit]] & table.right[codes[hit + 1]]) != 0]
    if not len(hit):
        changes = Changes(table.known, [], none, none, none, none)
    else:
        ends = np.flatnonzero(last)
        words = np.unique(np.searchsorted(ends, hit))
        begin = np.where(words > 0, ends[words - 1] + 1, 0)
        size = ends[words] + 1 - begin
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        old, inside, word = codes[at], ~last[at], np.repeat(words, size)
        new, new_last, start = old, last[at], np.arange(len(old))
        for j in range(len(told.rules)):
            new, new_last, start = _merged(new, new_last, start, j, table)
        span = np.diff(np.append(start, len(old)))
        joined = span > 1
        used = np.repeat(joined, span)
        lost = np.flatnonzero(inside[:-1] & (used[:-1] | used[1:]))
        gained = np.flatnonzero(~new_last[:-1] & (joined[:-1] | joined[1:]))
        where = start[gained]
        before = _characters_before(old, size, table)[where]
        changes = _changes(table, np.concatenate([_keys(old, lost), _keys(new, gained)]),
                           np.concatenate([-block.freq[word[lost]], block.freq[word[where]]]), (block.place[word[where]], before))
        kept = np.ones(len(codes), bool)
        kept[at] = False
        kept[at[start]] = True
        codes, last = codes.copy(), last.copy()
        codes[at[start]], last[at[start]] = new, new_last
        codes, last = codes[kept], last[kept]
    done = Block(codes, last, block.freq, block.place, table.known, table.own)
    return done, (changes, table.own, first_places(done, told.asked, table.length))


def symbols_of(block: Block, symbols: list[str], rows: int = 50_000) -> Iterable[pa.RecordBatch]:
    """(place, syms) of the words of a block."""
    names, ends = pa.array([*symbols[:block.known], *block.own], pa.string()), np.flatnonzero(block.last)
    for lo in range(0, len(ends), rows):
        stop = ends[lo:lo + rows] + 1
        begin = int(ends[lo - 1]) + 1 if lo else 0
        offsets = pa.array(np.append(0, stop - begin).astype(np.int32))
        syms = pa.ListArray.from_arrays(offsets, names.take(pa.array(block.codes[begin:stop[-1]])))
        yield pa.RecordBatch.from_arrays([pa.array(block.place[lo:lo + rows]), syms], names=["place", "syms"])


class _Pairs:
    """Counts and first places of pairs in order of their keys. First places are lower bounds unless ``exact``; a pair
    with the count 0 is gone."""

    def __init__(self, *columns: np.ndarray) -> None:
        self.key, self.count, self.place, self.before, self.exact = columns or (
            np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.key, self.count, self.place, self.before, self.exact

    def with_rows(self, *columns: np.ndarray) -> _Pairs:
        """These pairs and others, without those that are gone."""
        live = self.count != 0
        both = [np.concatenate([own[live], new]) for own, new in zip(self.columns(), columns)]
        order = np.argsort(both[0], kind="stable")
        return _Pairs(*(c[order] for c in both))

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the keys stand, and whether they do."""
        at = np.minimum(np.searchsorted(self.key, key), max(0, len(self.key) - 1))
        return at, self.key[at] == key if len(self.key) else np.zeros(len(key), bool)

    def update(self, key: np.ndarray, amount: np.ndarray, place: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Changes of the pairs that are here; whether each one is."""
        at, here = self.find(key)
        at, n, place, before = at[here], amount[here], place[here], before[here]
        fresh = self.count[at] == 0
        first = fresh | (place < self.place[at]) | ((place == self.place[at]) & (before < self.before[at]))
        self.count[at] += n
        self.place[at[first]], self.before[at[first]] = place[first], before[first]
        self.exact[at] = fresh
        return here

    def behind(self, lefts: np.ndarray) -> np.ndarray:
        """Rows of the pairs with one of these codes on the left."""
        lo, hi = np.searchsorted(self.key, lefts << 32), np.searchsorted(self.key, (lefts + 1) << 32)
        size = hi - lo
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return at[self.count[at] != 0]


class Rounds:
    """The counts of all pairs and the choice of the merges of each round. Pairs that come up join a small table first."""

    def __init__(self, symbols: Iterable[str], substring: bool) -> None:
        self.substring = substring
        self.old, self.young = _Pairs(), _Pairs()
        self.symbols: list[str] = []
        self.index: dict[str, int] = {}
        self.ends: dict[str, list[int]] = defaultdict(list)
        self.begins: dict[str, list[int]] = defaultdict(list)
        self.fresh: list[str] = []
        self.base, self.based = None, 0  # a broadcast of the first symbols and their lengths, and how many they are
        self.merges: list[tuple[str, str, int]] = []
        self.add(symbols)

    def add(self, symbols: Iterable[str]) -> None:
        """The symbols that a round made."""
        self.fresh = list(symbols)
        for s in self.fresh:
            if s not in self.index:
                code = self.index[s] = len(self.symbols)
                self.symbols.append(s)
                for edge in {s[len(s) - i:] for i in range(min(_EDGE, len(s)) + 1)}:
                    self.ends[edge].append(code)
                for edge in {s[:i] for i in range(min(_EDGE, len(s)) + 1)}:
                    self.begins[edge].append(code)

    def ending(self, a: str) -> np.ndarray:
        """Codes of the symbols that end so."""
        found = self.ends.get(a[-_EDGE:], [])
        return np.array(found if len(a) <= _EDGE else [c for c in found if self.symbols[c].endswith(a)], np.int64)

    def beginning(self, b: str) -> np.ndarray:
        found = self.begins.get(b[:_EDGE], [])
        return np.array(found if len(b) <= _EDGE else [c for c in found if self.symbols[c].startswith(b)], np.int64)

    def changed(self, messages: Iterable[Changes]) -> None:
        keys = []
        for m in messages:
            own = np.array([self.index[s] for s in m.own], np.int64)
            sides = [np.where(c < m.known, c, own[np.maximum(c - m.known, 0)] if len(own) else 0) for c in (m.key >> 32, m.key & 0xFFFFFFFF)]
            keys.append((sides[0] << 32 | sides[1], m.amount, m.place, m.before))
        key, amount, place, before = (np.concatenate(c) for c in zip(*keys))
        order = np.lexsort((before, place, key))
        key = key[order]
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        if not len(begin):
            return
        key, amount, place, before = key[begin], np.add.reduceat(amount[order], begin), place[order][begin], before[order][begin]
        for table in (self.old, self.young):
            new = ~table.update(key, amount, place, before)
            key, amount, place, before = key[new], amount[new], place[new], before[new]
        some = amount != 0
        self.young = self.young.with_rows(key[some], amount[some], place[some], before[some], np.ones(int(some.sum()), bool))
        if len(self.young.key) > max(20_000, len(self.old.key) // 8):
            live = self.young.count != 0
            self.old, self.young = self.old.with_rows(*(c[live] for c in self.young.columns())), _Pairs()

    def placed(self, asked: list[Pair], answers: Iterable[list[tuple[int, int, int]]]) -> None:
        first: dict[Pair, tuple[int, int]] = {}
        for answer in answers:
            for i, *place in answer:
                first[asked[i]] = min(first.get(asked[i], (_NOWHERE, 0)), tuple(place))
        if first:
            key, place = self._keys(first), np.array(list(first.values()), np.int64)
            for table in (self.old, self.young):
                at, here = table.find(key)
                at = at[here]
                table.place[at], table.before[at], table.exact[at] = place[here, 0], place[here, 1], True

    def coded(self, pairs: Iterable[Pair]) -> list[tuple[int, int]]:
        return [(self.index[a], self.index[b]) for a, b in pairs]

    def _keys(self, pairs: Iterable[Pair]) -> np.ndarray:
        return np.array([a << 32 | b for a, b in self.coded(pairs)], np.int64)

    def _pair(self, key: int) -> Pair:
        return self.symbols[key >> 32], self.symbols[key & 0xFFFFFFFF]

    def _best(self, most: int) -> tuple[list[tuple], list[bool], bool]:
        """The best pairs as keys in order; whether their first places are exact; whether there are more pairs."""
        found, live = [], 0
        for table in (self.old, self.young):
            live += np.count_nonzero(table.count)
            n = len(table.count)
            least = max(1, int(np.partition(table.count, n - most)[n - most])) if n > most else 1
            at = np.flatnonzero(table.count >= least)
            found.append([c[at] for c in table.columns()])
        key, count, place, before, exact = (np.concatenate(c) for c in zip(*found))
        if self.substring:
            best = np.lexsort((before, place, -count))[:most]
            keys = sorted((-c, p, b, *self._pair(k)) for c, p, b, k in zip(*(v[best].tolist() for v in (count, place, before, key))))
            known = {self._pair(k) for k in key[best[exact[best]]].tolist()}
            return keys, [k[-2:] in known for k in keys], live > len(keys)
        if len(count) > most:  # of the least count that can be among the best, all stay for their names to decide
            at = np.flatnonzero(count >= np.partition(count, len(count) - most)[len(count) - most])
            key, count = key[at], count[at]
        keys = sorted((-c, *self._pair(k)) for c, k in zip(count.tolist(), key.tolist()))[:most]
        return keys, [True] * len(keys), live > len(keys)

    def ahead(self, rules: list[Pair]) -> list[Pair]:
        """Pairs whose first places the round after ``rules`` will ask for."""
        if not self.substring:
            return []
        keys, exact, _ = self._best(TOLD_AHEAD)
        return [k[-2:] for k, known in zip(keys, exact) if k[-2:] not in rules and (not known or changed_by(k[-2:], rules, True))]

    def _behind(self, lefts: np.ndarray, rights: np.ndarray) -> list[tuple[int, int, int]]:
        """(left, right, count) of the pairs of these codes."""
        out = []
        for table in (self.old, self.young):
            at = table.behind(lefts)
            right = table.key[at] & 0xFFFFFFFF
            fits = np.isin(right, rights)
            out += zip((table.key[at[fits]] >> 32).tolist(), right[fits].tolist(), table.count[at[fits]].tolist())
        return out

    def followed(self, symbol: str, count: int) -> bool:
        """Whether a pair that begins with the symbol has this count at least."""
        left = np.array([self.index[symbol]], np.int64)
        return any((table.count[table.behind(left)] >= count).any() for table in (self.old, self.young))

    def _made(self, p: Pair, least: int, fresh: set[str]) -> set[str]:
        """Symbols that a merge of the pair makes. One that exists too, which ends the round, where it may make one in two ways
        or of more than three, or where its new pairs may have the count ``least``: of matches "x y" and "y z" that
        overlap, one is left as (xy, z), which (y, z) bounds. ``fresh``: symbols that merges before it make."""
        rights, s = self.beginning(p[1]), self.symbols
        pairs = self._behind(self.ending(p[0]), rights)
        room = len(p[0]) + len(p[1])  # two matches in a symbol don't overlap
        both = {y for _, y, _ in pairs} & {x for x, _, _ in pairs}
        middle = {y for y in both if len(s[y]) >= room}
        after: dict[int, list[int]] = defaultdict(list)
        if middle:
            for y, z, _ in self._behind(np.array(sorted(middle), np.int64), rights):
                after[y].append(z)
        made = [s[x] + s[y] for x, y, _ in pairs] + [s[x] + s[y] + s[z] for x, y, _ in pairs if y in middle for z in after[y]]
        symbols = {"".join(p), *made}
        if (len(set(made)) < len(made) or any(x in middle and y in middle for x, y, _ in pairs)
                or any(x in both and x not in middle and count >= least for x, _, count in pairs)
                or any(s.startswith(p[1]) and s.endswith(p[0]) for s in fresh)):
            symbols.add(p[0])
        return symbols

    def candidates(self) -> tuple[list[tuple], tuple | None, list[Pair]]:
        """The best pairs as keys, a key that no other pair comes before, and pairs whose first
        places have to be asked for."""
        items, exact, more = self._best(LOOKED_AT)
        horizon = items[-1] if more else None
        at_count: dict[int, int] = defaultdict(int)
        for k in items:
            at_count[k[0]] += 1
        tied = [k[-2:] for k, known in zip(items, exact) if not known and (at_count[k[0]] > 1 or (horizon is not None and k[0] == horizon[0]))]
        return items, horizon, tied if self.substring else []

    def choose(self, items: list[tuple], horizon: tuple | None, most: int) -> list[Pair]:
        """The merges of the next round; none where a pair that is not in ``items`` may come first."""
        if self.substring:
            first: dict[int, tuple[int, int]] = {}
            asked = self._keys(k[-2:] for k in items)
            for table in (self.old, self.young):
                at, here = table.find(asked)
                at = at[here]
                first.update(zip(table.key[at].tolist(), zip(table.place[at].tolist(), table.before[at].tolist())))
            keys = sorted((k[0], *first[key], *k[-2:]) for k, key in zip(items, asked.tolist()))
            made: dict[Pair, set[str]] = {}
            fresh: set[str] = set()
            for k in keys:
                if changed_by(k[-2:], list(made), True):
                    break  # taking stops here at the latest
                made[k[-2:]] = symbols = self._made(k[-2:], -keys[-1][0], fresh)
                if symbols & self.index.keys():
                    break
                fresh |= symbols
        else:  # "a a a" leaves (aa, a)
            keys, made = items, {k[-2:]: {"".join(k[-2:]), *(k[-1:] if k[-1] == k[-2] else ())} for k in items}
        batch = chosen(keys, horizon, made, self.index.keys(), min(most, MOST_MERGES), self)
        self.merges += [(*k[-2:], -k[0]) for k in batch]
        return [k[-2:] for k in batch]

    def rebase(self, hold: Callable[[tuple], object]) -> None:
        """Once many symbols came up, what all are told again in every round is kept by ``hold``."""
        if len(self.symbols) - self.based > max(20_000, self.based // 4):
            value = pa.array(self.symbols, pa.string()), np.array([len(s) for s in self.symbols], np.int32)
            self.base, self.based = hold(value), len(self.symbols)

    def told(self, rules: list[Pair], asked: list[Pair]) -> Told:
        if self.substring:
            lefts, rights = [self.ending(a) for a, _ in rules], [self.beginning(b) for _, b in rules]
        else:
            lefts, rights = ([np.array([self.index[r[i]]], np.int64) for r in rules] for i in (0, 1))
        rest = self.symbols[self.based:]
        return Told(self.base, pa.array(rest, pa.string()), np.array([len(s) for s in rest], np.int32), self.fresh,
                    np.array([self.index[s] for s in self.fresh], np.int32), rules, lefts, rights, self.coded(asked))


class _Held(NamedTuple):
    value: tuple


def train_alone(block: Block, symbols: list[str], n: int, substring: bool) -> tuple[Block, list[tuple[str, str, int]]]:
    """All rounds of one block that holds all words: the block, with codes of its own only, and the merges."""
    rounds = Rounds(symbols, substring)
    rounds.changed([all_pairs(block, symbols)])
    while len(rounds.merges) < n:
        items, horizon, asked = rounds.candidates()
        if not items:
            break
        if asked:
            rounds.placed(asked, [run_round(block, rounds.told([], asked), substring)[1][2]])
        rules = rounds.choose(items, horizon, n - len(rounds.merges))
        if rules:
            rounds.rebase(_Held)
            asked = rounds.ahead(rules)
            block, (changes, own, places) = run_round(block, rounds.told(rules, asked), substring)
            rounds.add(own)
            rounds.changed([changes])
            rounds.placed(asked, [places])
    own, codes = block.codes >= block.known, block.codes.copy()
    codes[own] = np.array([rounds.index[s] for s in block.own], np.int32)[codes[own] - block.known]
    return block._replace(codes=codes, known=0, own=rounds.symbols), rounds.merges
