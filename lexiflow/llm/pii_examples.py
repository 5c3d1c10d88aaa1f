"""Labelled sentences by rule: personal data in forms that the patterns miss, among look-alikes.

The table is the same on every run (its random choices are seeded). A sentence is words around
one form; the label gives its kind and place. Forms without a kind are look-alikes that stay
unlabelled: dates, versions, ranges, amounts, assignments of plain words.
"""

from __future__ import annotations

import random
from collections.abc import Callable

_HEX, _LOWER, _UPPER, _DIGITS = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _forms(r: random.Random) -> list[tuple[str | None, Callable[[], str]]]:
    some = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    word = lambda: some(_LOWER, r.randrange(2, 9))
    digits = lambda n: some(_DIGITS, n)
    byte = lambda: str(r.randrange(256))
    mixed = lambda n: some(_LOWER + _UPPER + _DIGITS, n)
    named = lambda: r.choice(["token", "secret", "password", "key", "api_key", "pwd"])
    return [
        ("email", lambda: f"{word()} [at] {word()} [dot] {word()}"), ("email", lambda: f"{word()}[at]{word()}[dot]{word()}"),
        ("email", lambda: f"{word()}(at){word()}.{word()}"), ("email", lambda: f"{word()}.{word()}@{word()}"),
        ("email", lambda: f"{word()} @ {word()}.{word()}"),
        ("ip", lambda: " . ".join(byte() for _ in range(4))), ("ip", lambda: ":".join(some(_HEX, 4) for _ in range(8))),
        ("ip", lambda: "[.]".join(byte() for _ in range(4))),
        ("card", lambda: ".".join(digits(4) for _ in range(4))), ("card", lambda: "  ".join(digits(4) for _ in range(4))),
        ("card", lambda: "/".join(digits(4) for _ in range(4))),
        ("phone", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"),
        ("phone", lambda: f"({digits(3)}) {digits(4)} {digits(4)}"), ("phone", lambda: f"0{digits(3)}-{digits(7)}"),
        ("secret", lambda: some(_HEX, r.choice([32, 40, 64]))), ("secret", lambda: mixed(r.choice([24, 32, 40]))),
        ("secret", lambda: f"AKIA{some(_UPPER + _DIGITS, 16)}"), ("secret", lambda: f"ghp_{mixed(36)}"),
        ("secret", lambda: f"{named()}={mixed(r.randrange(16, 33))}"),
        (None, lambda: f"{digits(4)}-{digits(2)}-{digits(2)}"), (None, lambda: f"{digits(1)}.{digits(2)}.{digits(3)}"),
        (None, lambda: f"{digits(4)}-{digits(4)}"), (None, lambda: f"{digits(2)}:{digits(2)}"), (None, lambda: f"({digits(4)})"),
        (None, lambda: f'{word()} = "{word()}"'), (None, lambda: f"{word()}={digits(2)};"), (None, lambda: f"${digits(3)}.{digits(2)}"),
        (None, lambda: f"@{word()}"), (None, lambda: f"{digits(4)} {digits(4)}"), (None, lambda: f"{word()}.{word()}"),
        (None, lambda: f"https://{word()}.{word()}/{word()}/{word()}/{word()}/{word()}"), (None, lambda: f"{word()}-{word()}-{word()}"),
        (None, lambda: some(_LOWER, r.randrange(24, 40))), (None, lambda: f"{word()}_{word()}_{word()}_{word()}"),
        (None, lambda: " ".join([word().title()] * r.randrange(3, 12))), (None, lambda: " ".join(["."] * r.randrange(2, 6))),
        (None, lambda: f"{word()} {digits(3)} {word()} {digits(r.randrange(1, 5))}"),
        (None, lambda: "=" * r.randrange(3, 60)), (None, lambda: "-" * r.randrange(3, 60)), (None, lambda: digits(r.randrange(1, 9))),
    ]


def labelled_examples(n: int = 900, seed: int = 5) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(sentence, spans as (kind, start, end)); every form comes up equally often."""
    r = random.Random(seed)
    forms = _forms(r)
    word = lambda: "".join(r.choice(_LOWER) for _ in range(r.randrange(1, 11)))
    around = lambda: " ".join(word() for _ in range(r.randrange(1, 7)))
    out = []
    for i in range(n):
        kind, make = forms[i % len(forms)]
        form = make()
        before = around() + " "
        if kind == "secret" and "=" not in form and r.random() < 0.7:
            before += r.choice(['token = "', "password: ", 'api_key = "', "secret: ", "key = '"])
        quote = before[-1] if before[-1] in "\"'" else ""
        spans = [(kind, len(before), len(before) + len(form))] if kind else []
        out.append((before + form + quote + " " + around() + r.choice([".", "", "!"]), spans))
    return out
