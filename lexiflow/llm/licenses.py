"""License scans by phrases and by template markup.

A template is wording with markup: ``<<beginOptional>> ... <<endOptional>>`` may be left out,
``<<var;name=..;match=a b|c>>`` is one of the listed wordings, ``<<var;name=..;min=1;max=4>>`` is
any words, so many. It is compiled into an automaton over tokens; a place of a text is
accepted when a path reads its words one after another, so the mandatory wording must be there
exactly. The longest accepted reading counts.

Texts become arrays of word hashes batch by batch; all words outside the phrases and
templates are one token. Phrases are found by comparing neighbouring tokens of the whole
batch; automata run from words that can begin a template, or so many any-words before them, in texts that hold every word the
template can't do without.

``score`` is 0 without a label, 0.5 if only phrases were found, and else the largest share of
literal words in an accepted reading. Defined cases: a null text counts as empty; repeated
rows are scanned each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .shingles import chunks, utf8_buffers, word_hashes

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Openings and notices of public licenses, as templates.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license <<beginOptional>>version<<endOptional>> 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the "
           "following conditions are met",
    "cc-by-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<var;name=family;match=cc|creative commons>> "
                 "<<var;name=kind;match=by|attribution>> <<beginOptional>>international license<<endOptional>> 4 0",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<var;name=family;match=cc|creative commons>> "
                    "<<var;name=kind;match=by nc|attribution noncommercial>> 4 0",
    "cc-by-sa-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<var;name=family;match=cc|creative commons>> "
                    "<<var;name=kind;match=by sa|attribution sharealike>> 4 0",
    "copyright-notice": "copyright <<beginOptional>>c<<endOptional>> <<var;name=owner;min=1;max=8>> all rights reserved",
    "gpl-2.0": "<<beginOptional>>licensed under<<endOptional>> the <<beginOptional>>terms of the<<endOptional>> gnu general public license "
               "<<beginOptional>>as published by the free software foundation either<<endOptional>> version 2",
    "gpl-3.0": "<<beginOptional>>licensed under<<endOptional>> the <<beginOptional>>terms of the<<endOptional>> gnu general public license "
               "<<beginOptional>>as published by the free software foundation either<<endOptional>> version 3",
    "mit": "<<var;name=verb;match=released|licensed|distributed>> under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files <<beginOptional>>the software<<endOptional>> to deal in the software without restriction",
}
_IS_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_MARK = re.compile(r"<<(.*?)>>")


@dataclass
class Automaton:
    """States with literal steps, any-word steps and free steps; state 0 begins."""
    literal: list[dict[str, set[int]]] = field(default_factory=lambda: [{}])
    anyword: list[set[int]] = field(default_factory=lambda: [set()])
    free: list[set[int]] = field(default_factory=lambda: [set()])
    accept: int = 0
    needed: set[str] = field(default_factory=set)

    def add(self) -> int:
        for table, empty in ((self.literal, dict), (self.anyword, set), (self.free, set)):
            table.append(empty())
        return len(self.free) - 1

    def words(self, at: int, text: str) -> int:
        for w in text.split():
            to = self.add()
            self.literal[at].setdefault(w, set()).add(to)
            at = to
        return at

    def closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for x in self.free[todo.pop()] - out:
                out.add(x)
                todo.append(x)
        return out

    def starts(self) -> set[tuple[int, str]]:
        """(any-words before it, first literal word) of all readings."""
        out: set[tuple[int, str]] = set()
        now, before = self.closed({0}), 0
        while now:
            if before and self.accept in now:
                raise ValueError("a template that any words fulfil")
            out |= {(before, w) for s in now for w in self.literal[s]}
            now, before = self.closed({to for s in now for to in self.anyword[s]}), before + 1
        return out

    def read(self, tokens: list[str], at: int) -> tuple[int, int] | None:
        """(words, literal words) of the longest accepted reading from ``at``; of readings of
        that length the one with most literal words."""
        now = {s: 0 for s in self.closed({0})}
        best = (0, 0) if self.accept in now else None
        for n in range(1, len(tokens) - at + 1):  # no copy of what follows
            token = tokens[at + n - 1]
            after: dict[int, int] = {}
            for s, hits in now.items():
                for to, gain in [*((x, 1) for x in self.literal[s].get(token, ())), *((x, 0) for x in self.anyword[s])]:
                    for x in self.closed({to}):
                        after[x] = max(after.get(x, 0), hits + gain)
            if not after:
                break
            now = after
            if self.accept in now:
                best = (n, now[self.accept])
        return best


def compile_template(template: str) -> Automaton:
    a = Automaton()
    at, optional = 0, []
    for i, part in enumerate(_MARK.split(template)):
        if i % 2 == 0:
            if not optional:
                a.needed |= set(part.split())
            at = a.words(at, part)
        elif part == "beginOptional":
            optional.append(at)
            fresh = a.add()
            a.free[at].add(fresh)
            at = fresh
        elif part == "endOptional":
            end = a.add()
            a.free[at].add(end)
            a.free[optional.pop()].add(end)
            at = end
        elif part.startswith("var;"):
            options = dict(x.split("=", 1) for x in part.split(";")[1:])
            end = a.add()
            if "match" in options:
                for words in options["match"].split("|"):
                    fresh = a.add()
                    a.free[at].add(fresh)
                    a.free[a.words(fresh, words)].add(end)
            else:
                for k in range(int(options["max"]) + 1):
                    if k >= int(options["min"]):
                        a.free[at].add(end)
                    fresh = a.add()
                    a.anyword[at].add(fresh)
                    at = fresh
            at = end
        else:
            raise ValueError(f"unknown markup <<{part}>>")
    if optional:
        raise ValueError("beginOptional without endOptional")
    a.accept = at
    return a


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, str]) -> None:
        self.automata = {name: compile_template(t) for name, t in templates.items()}
        words = sorted({w for p in phrases for w in p.split()} | {w for a in self.automata.values() for s in a.literal for w in s})
        self.words = ["", *words]
        data = " ".join(words).encode()
        hashes, _ = word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]), _IS_WORD)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order + 1
        number = {w: i for i, w in enumerate(self.words)}
        self.phrases = [(label, np.array([number[w] for w in p.split()])) for p, label in phrases.items()]
        self.starts: dict[str, dict[int, np.ndarray]] = {}
        for name, a in self.automata.items():
            first = a.starts()
            self.starts[name] = {n: np.array(sorted(number[w] for m, w in first if m == n)) for n in sorted({m for m, _ in first})}
        self.needed = {name: [number[w] for w in sorted(a.needed)] for name, a in self.automata.items()}

    def tokens(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (0 for other words) and words per text."""
        hashes, count = word_hashes(raw, offsets, _IS_WORD)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ids[at], 0), count

    def scan(self, raw: np.ndarray, offsets: np.ndarray) -> list[dict]:
        token, count = self.tokens(raw, offsets)
        end = np.cumsum(count)
        begin = end - count
        out = [{"n_words": int(n), "places": [], "matches": []} for n in count]
        for label, words in self.phrases:
            hit = np.ones(max(0, len(token) - len(words) + 1), bool)
            for k, w in enumerate(words):
                hit &= token[k:len(hit) + k] == w
            for p in np.flatnonzero(hit).tolist():
                d = int(np.searchsorted(end, p, "right"))
                if p + len(words) <= end[d]:
                    out[d]["places"].append((label, p - int(begin[d])))
        known = np.flatnonzero(token)
        owner = np.searchsorted(end, known, "right")
        for d in np.unique(owner).tolist():
            ids = token[begin[d]:end[d]]
            there = set(ids.tolist())
            texts = None
            for name, a in self.automata.items():
                if there.issuperset(self.needed[name]):
                    texts = texts or [self.words[i] for i in ids.tolist()]
                    begins = [np.flatnonzero(np.isin(ids, first)) - n for n, first in self.starts[name].items()]
                    for p in np.unique(np.concatenate(begins)).tolist() if begins else ():
                        if p >= 0 and (found := a.read(texts, p)) and found[0]:
                            out[d]["matches"].append((name, p, *found))
        return out


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, places (label, word) of the phrases, matches (label, word, words, literal)
    of the templates, of every row."""
    scanner_of = (phrases or PHRASES, templates if templates is not None else TEMPLATES)
    schema = pa.schema([("n_words", pa.int64()), ("places", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
                        ("matches", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("words", pa.int64()), ("literal", pa.int64())])))])

    def run(batches):
        scanner = Scanner(*scanner_of)
        for batch in batches:
            raw, offsets = utf8_buffers(batch.column(1))
            for lo, hi in chunks(offsets):
                found = scanner.scan(raw, offsets[lo:hi + 1])
                columns = [pa.array([r["n_words"] for r in found], schema[0].type),
                           pa.array([[{"label": a, "word": b} for a, b in r["places"]] for r in found], schema[1].type),
                           pa.array([[dict(zip(("label", "word", "words", "literal"), m)) for m in r["matches"]] for r in found], schema[2].type)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], names=["doc_id", *schema.names])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).mapInArrow(
        run, "doc_id long, n_words long, places array<struct<label: string, word: long>>, "
             "matches array<struct<label: string, word: long, words: long, literal: long>>"))
