"""Column expressions for cleaning and splitting text (all JVM-side, no UDF).

Semantics: the text is split on a *literal* separator (not a regex), a word is kept
when it is not a stop word (case-sensitive comparison) and, with ``only_alpha``,
when every character is a Unicode letter. The cleaned string is each kept word
followed by one space.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default stop-word list of the reference pipelines, in its order.
DEFAULT_STOP_WORDS: tuple[str, ...] = (
    "acaba", "ama", "ancak", "aslında", "az", "bazı", "belki", "biri", "birkaç", "birşey",
    "biz", "bu", "çok", "çünkü", "da", "daha", "de", "defa", "diye", "eğer", "en", "gibi",
    "hem", "hep", "hepsi", "her", "hiç", "ile", "ise", "kez", "ki", "kim", "mı", "mu",
    "mü", "nasıl", "ne", "neden", "nerde", "nerede", "nereye", "niçin", "niye", "o",
    "sanki", "şey", "siz", "şu", "tüm", "ve", "veya", "ya", "yani",
)

# Letters-only word splits that the public Treebank word tokenizer
# applies to lower-case text (its contraction rules; the others need an apostrophe,
# which a letters-only word cannot hold).
CONTRACTION_SPLITS: dict[str, tuple[str, str]] = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}

# \A and \z, not ^ and $: "$" would also accept a word ending in a newline.
LETTERS_ONLY = r"\A\p{L}+\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_split(text: str | Column, sep: str = " ") -> Column:
    """``str.split(sep)`` with a literal separator; keeps empty pieces. Null text -> ['']."""
    if sep == "":
        raise ValueError("empty separator")
    return F.split(F.coalesce(_col(text), F.lit("")), re.escape(sep), -1)


def _keep_word(w: Column, stop_words: Sequence[str], only_alpha: bool) -> Column:
    cond = F.lit(True)
    if stop_words:
        cond = ~w.isin(list(stop_words))
    if only_alpha:
        cond = cond & w.rlike(LETTERS_ONLY)
    return cond


def kept_words(text: str | Column, stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
               only_alpha: bool = True, sep: str = " ") -> Column:
    """array<string> of the words a document keeps after cleaning (P1's word list)."""
    return F.filter(literal_split(text, sep), lambda w: _keep_word(w, stop_words, only_alpha))


def sanitize_text(text: str | Column, stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
                  only_alpha: bool = True, sep: str = " ") -> Column:
    """Cleaned string: every kept word followed by one space ('' when none is kept)."""
    words = kept_words(text, stop_words, only_alpha, sep)
    return F.concat_ws("", F.transform(words, lambda w: F.concat(w, F.lit(" "))))


def sanitize_tokens(text: str | Column, stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
                    only_alpha: bool = True, sep: str = " ") -> Column:
    """Token list of the cleaned string split again on ``sep``, without the final empty piece."""
    if sep == " ":
        return kept_words(text, stop_words, only_alpha, sep)
    pieces = literal_split(sanitize_text(text, stop_words, only_alpha, sep), sep)
    return F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))


def sanitize_chars(text: str | Column, stop_words: Sequence[str] = DEFAULT_STOP_WORDS,
                   only_alpha: bool = True, sep: str = " ") -> Column:
    """Character-level cleaning: inside every word drop characters that are one-character
    stop words or (with ``only_alpha``) not letters; every word, even emptied, is followed
    by one space."""
    single = sorted({s for s in stop_words if len(s) == 1})
    parts = []
    if only_alpha:
        parts.append(r"[^\p{L}]")
    if single:
        parts.append("[" + "".join(re.escape(c) for c in single) + "]")
    words = literal_split(text, sep)
    if parts:
        pattern = "|".join(parts)
        words = F.transform(words, lambda w: F.regexp_replace(w, pattern, ""))
    return F.concat_ws("", F.transform(words, lambda w: F.concat(w, F.lit(" "))))


def vocabulary_parts(lower_token: Column, split_contractions: bool = True) -> Column:
    """array<string>: the word-tokenizer output for one lower-case letters-only word."""
    if not split_contractions:
        return F.array(lower_token)
    expr = None
    for word, (a, b) in CONTRACTION_SPLITS.items():
        cond = lower_token == F.lit(word)
        expr = F.when(cond, F.array(F.lit(a), F.lit(b))) if expr is None else expr.when(cond, F.array(F.lit(a), F.lit(b)))
    return expr.otherwise(F.array(lower_token))


def lower_stop_set(stop_words: Iterable[str], extra_stop_words: Iterable[str] = ()) -> list[str]:
    """Stop words compared lower-case against vocabulary candidates (configured ∪ extra list)."""
    return sorted(set(stop_words) | set(extra_stop_words))
