"""Rounds of byte-pair merges over words that lie in several tasks.

Every task holds a part of the distinct words, and the counts of all pairs (their number depends on
the symbols, not on the corpus). A round goes through messages that all tasks see:

1. all tasks look at the best pairs; in ``substring`` mode they tell where they see the tied ones
   first, and which symbols a merge would make in their words;
2. all tasks choose the same merges (``chosen``) and apply them, one after another, to their words
   that hold them;
3. they send the changes of the pair counts, and all add them up.

``chosen`` takes several merges only where taking them one by one would choose the same. Pairs are
taken in order while none is changed by a merge before it. A new pair (w, xy) or (xy, z) can't be
more frequent than the pair (w, x) or (y, z) that it replaces; these are pairs changed by the merge, so
they stand behind all that were taken. Where counts are equal the order decides: merges of the
count at which taking stopped are given back unless no new pair can come before them. A merge that
makes a symbol which exists already ends the round, since its pairs may gain.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections import defaultdict
from collections.abc import Generator

Pair = tuple[str, str]
#: Pairs that are looked at in a round.
LOOKED_AT = 96
_NOWHERE = (1 << 62, 0)


def merge_symbols(syms: tuple[str, ...], a: str, b: str) -> tuple[str, ...]:
    out: list[str] = []
    for s in syms:
        if out and out[-1] == a and s == b:
            out[-1] = a + b
        else:
            out.append(s)
    return tuple(out)


class WordPart:
    """The words of one task, in corpus order."""

    def __init__(self, substring: bool) -> None:
        self.substring = substring
        self.words: list = []  # joined symbols (substring) or tuples
        self.freq, self.place = array("q"), array("q")
        self.holders: dict[Pair, array] = {}  # also words that no longer hold the pair
        self.unsorted: set[Pair] = set()
        self.right: dict[str, set[str]] = defaultdict(set)
        self.ends: dict[str, set[str]] = defaultdict(set)  # left symbols by all their ends, right ones by beginnings
        self.begins: dict[str, set[str]] = defaultdict(set)

    def symbols(self, w: int):
        return self.words[w].split(" ") if self.substring else self.words[w]

    @staticmethod
    def _pairs(syms) -> dict[Pair, list[int]]:
        """pair → [times, characters before the first]."""
        out: dict[Pair, list[int]] = {}
        at = 0
        for p in zip(syms, syms[1:]):
            if p in out:
                out[p][0] += 1
            else:
                out[p] = [1, at]
            at += len(p[0])
        return out

    def _held(self, p: Pair, w: int) -> None:
        if p not in self.holders:
            self.holders[p] = array("i")
            if self.substring:
                self.right[p[0]].add(p[1])
                for i in range(len(p[0]) + 1):
                    self.ends[p[0][i:]].add(p[0])
                for i in range(len(p[1]) + 1):
                    self.begins[p[1][:i]].add(p[1])
        held = self.holders[p]
        if held and held[-1] >= w:
            self.unsorted.add(p)
        held.append(w)

    def add(self, syms: list[str], freq: int, place: int, changes: dict[Pair, list]) -> None:
        """``changes``: pair → [count, (place, characters before)], updated."""
        w = len(self.words)
        self.words.append(" ".join(syms) if self.substring else tuple(syms))
        self.freq.append(freq)
        self.place.append(place)
        for p, (times, at) in self._pairs(self.symbols(w)).items():
            self._held(p, w)
            c = changes.setdefault(p, [0, _NOWHERE])
            c[0] += times * freq
            c[1] = min(c[1], (place, at))

    def matching(self, a: str, b: str) -> list[Pair]:
        """Pairs here that a merge of (a, b) joins."""
        if not self.substring:
            return [(a, b)] if (a, b) in self.holders else []
        begins = self.begins[b]
        return [(x, y) for x in self.ends[a] for y in self.right[x] & begins]

    def first(self, p: Pair) -> tuple[int, int]:
        """Where the pair stands first here."""
        held = self.holders.get(p)
        if held is None:
            return _NOWHERE
        if p in self.unsorted:
            self.unsorted.discard(p)
            held = self.holders[p] = array("i", sorted(set(held)))
        for k, w in enumerate(held):
            at = self._pairs(self.symbols(w)).get(p)
            if at:
                del held[:k]
                return self.place[w], at[1]
        del held[:]
        return _NOWHERE

    def merge(self, a: str, b: str, changes: dict[Pair, list]) -> None:
        joined = set(self.matching(a, b))
        for w in sorted(set().union(*(self.holders[p] for p in joined))):
            old = self.symbols(w)
            self.words[w] = self.words[w].replace(f"{a} {b}", a + b) if self.substring else merge_symbols(old, a, b)
            new = self.symbols(w)
            if len(new) == len(old):
                continue
            before, after = self._pairs(old), self._pairs(new)
            for p in before.keys() | after.keys():
                (n, at), (m, now) = before.get(p, (0, -1)), after.get(p, (0, -1))
                if n == m and at == now:
                    continue
                c = changes.setdefault(p, [0, _NOWHERE])
                c[0] += (m - n) * self.freq[w]
                if m:
                    c[1] = min(c[1], (self.place[w], now))
                    if not n:
                        self._held(p, w)
            joined -= after.keys()  # "u u u" keeps a pair that ends with the first and begins with the second
        for p in joined:
            del self.holders[p]
            self.unsorted.discard(p)
            self.right[p[0]].discard(p[1])


class PairCounts:
    """Counts of all pairs; first places are lower bounds until they are asked for."""

    def __init__(self, substring: bool) -> None:
        self.substring = substring
        self.count: dict[Pair, int] = {}
        self.first: dict[Pair, tuple[int, int]] = {}
        self.behind: dict[str, set[str]] = defaultdict(set)
        self.heap: list[tuple] = []

    def followed(self, symbol: str, count: int) -> bool:
        """Whether a pair that begins with the symbol has this count at least."""
        return any(self.count[symbol, s] >= count for s in self.behind[symbol])

    def key(self, p: Pair) -> tuple:
        return (-self.count[p], *(self.first[p] if self.substring else ()), *p)

    def change(self, p: Pair, n: int, place: tuple[int, int]) -> None:
        now = self.count.get(p, 0) + n
        if not now:
            self.count.pop(p, None)
            self.first.pop(p, None)
            self.behind[p[0]].discard(p[1])
            return
        self.count[p] = now
        self.behind[p[0]].add(p[1])
        old = self.first.get(p, _NOWHERE)
        self.first[p] = min(old, place)
        if n > 0 or place < old:
            heapq.heappush(self.heap, self.key(p))

    def best(self, most: int) -> tuple[list[tuple], bool]:
        """The best pairs as keys in order, taken out of the heap; whether there are more."""
        out: dict[tuple, None] = {}
        while self.heap and len(out) < most:
            key = heapq.heappop(self.heap)
            p = key[-2:]
            if p in self.count and key not in out:
                if key == self.key(p):
                    out[key] = None
                elif key < self.key(p):  # lost some since: put right
                    heapq.heappush(self.heap, self.key(p))
        return list(out), bool(self.heap)

    def put_back(self, keys: list[tuple]) -> None:
        for key in keys:
            if key[-2:] in self.count:
                heapq.heappush(self.heap, self.key(key[-2:]))


def changed_by(p: Pair, batch: list[Pair], substring: bool) -> bool:
    """Whether a merge of the batch can change the count or the places of ``p``."""
    c, d = p
    if not substring:
        return any(c == b or d == a for a, b in batch)
    return any(d.endswith(a) or c.startswith(b) or (c.endswith(a) and d.startswith(b)) for a, b in batch)


def chosen(items: list[tuple], horizon: tuple | None, made: dict[Pair, set[str]], known: set[str], most: int, counts: PairCounts) -> list[tuple]:
    """Keys of ``items`` (sorted, exact) that may be merged in this round. ``horizon``: no pair that is not
    in ``items`` comes before it; ``made``: symbols that a merge makes (pairs without are not taken);
    ``known``: symbols there are."""
    substring = counts.substring
    batch: list[tuple] = []
    fresh: set[str] = set()
    stop = horizon
    for i, key in enumerate(items):
        p = key[-2:]
        if (horizon is not None and key > horizon) or len(batch) == most:
            stop = min(key, horizon) if horizon is not None else key
            break
        if changed_by(p, [k[-2:] for k in batch], substring) or made.get(p, fresh) & fresh or p not in made:
            stop = key
            break
        batch.append(key)
        fresh |= made[p]
        if made[p] & known:
            stop = items[i + 1] if i + 1 < len(items) else horizon
            break
    while len(batch) > 1 and stop is not None and batch[-1][0] == stop[0]:
        last = batch[-1]
        if substring and last[1] < stop[1]:
            break
        # (xy, z) comes before only if xy does, and has this count only if (y, z) has
        if not substring and all("".join(k[-2:]) > last[-2] or not counts.followed(k[-1], -last[0]) for k in batch[:-1]):
            break
        batch.pop()
    return batch


def _told(words: WordPart, items: list[tuple], horizon: tuple | None, known: set[str]) -> Generator[str, list[str], tuple[list[tuple], dict[Pair, set[str]]]]:
    """``items`` with the first places of tied pairs made exact, and the symbols that merges of pairs
    which don't change each other make: one message."""
    at_count: dict[int, int] = defaultdict(int)
    for k in items:
        at_count[k[0]] += 1
    tied = {k for k in items if at_count[k[0]] > 1 or (horizon is not None and k[0] == horizon[0])}
    apart: list[Pair] = []
    for k in items:
        if not changed_by(k[-2:], apart, True):
            apart.append(k[-2:])
    told = [[[*words.first(k[-2:])] if k in tied else None for k in items], [sorted({x + y for x, y in words.matching(*p)}) for p in apart]]
    answers = [json.loads(m) for m in (yield json.dumps(told))]
    made = {p: {"".join(p)}.union(*(a[1][i] for a in answers)) for i, p in enumerate(apart)}
    for p, symbols in made.items():
        if any(s.count("".join(p)) > 1 for s in symbols):  # may be made in two ways
            symbols |= known
    exact = [(k[0], *min(tuple(a[0][i]) for a in answers), *k[-2:]) if k in tied else k for i, k in enumerate(items)]
    return sorted(exact), made


def train_part(words: WordPart, changes: dict[Pair, list], n: int) -> Generator[str, list[str], list[tuple[str, str, int]]]:
    """The rounds of one task: yields messages, is sent those of all tasks, returns all merges.
    ``changes``: the counts of the pairs in its words."""
    substring = words.substring
    counts, known, merges = PairCounts(substring), set(), []
    while True:
        for message in (yield json.dumps([[*p, c, *at] for p, (c, at) in changes.items()])):
            for a, b, c, *at in json.loads(message):
                known |= {a, b}
                counts.change((a, b), c, tuple(at))
        changes, batch = {}, []
        while not batch:
            items, more = counts.best(LOOKED_AT)
            if not items or len(merges) == n:
                return merges
            looked, horizon = items, items[-1] if more else None
            if substring:
                items, made = yield from _told(words, items, horizon, known)
                counts.first.update((k[-2:], k[1:3]) for k in items)
            else:
                made = {k[-2:]: {"".join(k[-2:])} for k in items}
            batch = chosen(items, horizon, made, known, n - len(merges), counts)
            for key in batch:
                words.merge(*key[-2:], changes)
                merges.append((*key[-2:], -key[0]))
                known |= made[key[-2:]]
            counts.put_back(looked)
