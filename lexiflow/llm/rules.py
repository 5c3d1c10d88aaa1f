"""Quality rules with host-level verdicts.

Each document gets exact counts and a verdict per rule. Failures are added up per host,
every host's failure rate of a rule is shrunk towards the rate of all hosts with a beta
prior fitted to the spread between hosts, and the host verdicts go back to the documents:
a document is rejected by a base rule, or by a soft rule that its host fails as a habit, that is
with posterior odds of more than ``HOST_ODDS`` times the prior odds. A soft failure on a host
like the others is forgiven, and a document without any failure stays whatever its host.

Only DataFrame functions are used. The one pass over the texts writes a narrow table
(one row of numbers per document); hosts are added up with partial aggregation, so a host
with a third of all rows costs one row per task.

Defined cases: a null text counts as empty (no words, base failure); texts of any length are
counted whole; a null host is a host of its own; repeated rows count each; a host whose odds equal
the bound is not strict; an empty table gives an empty result; other columns of the input are
ignored, and ``kept_documents`` keeps them, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, free_name, let, row_key, stored, text_or_empty

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: Soft rules: SQL condition of a failure over the counted columns.
SOFT_RULES = {
    "repeat": "100 * n_repeat_words > 30 * n_words",
    "symbol": "100 * n_symbols > 10 * n_words",
    "lines": "100 * n_dup_lines > 30 * n_lines",
    "length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
}
#: A host is strict for a rule if the odds of its shrunk failure rate exceed the prior's this many times.
HOST_ODDS = 2.0


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in ``words``.

    The windows are sorted as ``w1 \\t w2 \\t w3 \\t position`` (no word holds a tab), so equal
    windows are neighbours; the places of those with an equal neighbour are then swept in
    order, each adding the words that the place before does not cover already.
    """
    def place(w: Column) -> Column:
        window = lambda i: F.concat_ws("\t", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2), i.cast("string"))
        return F.when(F.size(w) < 4, F.array().cast("array<string>")).otherwise(
            F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)))

    def repeated(s: Column) -> Column:
        head = F.transform(s, lambda x: F.substring_index(x, "\t", 3))
        def keep(h: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(h, i) == F.get(h, j), F.lit(False))  # noqa: E731  get() is null outside
            return F.transform(F.filter(s, lambda x, i: same(i, i - 1) | same(i, i + 1)),
                               lambda x: F.substring_index(x, "\t", -1).cast("int"))
        return let(head, keep)

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        step = lambda a, p: F.struct((a["n"] + F.least(p - a["last"], F.lit(3))).alias("n"), p.alias("last"))
        return F.aggregate(F.sort_array(places), start, step, lambda a: a["n"])

    return let(let(place(words), repeated), covered)


def _counts() -> list[Column]:
    """host and the counts of a document."""
    text = text_or_empty()
    words = F.array_remove(F.split(text, f"[{SPACE}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    counts = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words")))
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return [F.col("source").alias("host"), counts.alias("c"), line_counts.alias("l"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols")]


def rule_counts(docs: DataFrame) -> DataFrame:
    """k_id, k_text, host and the counts of every document (one pass, no shuffle)."""
    return docs.select(*row_key(), *_counts()).select("k_id", "k_text", "host", "c.*", "l.*", "n_symbols")


def with_verdicts(counts: DataFrame) -> DataFrame:
    """Adds base_failed and fail_<rule> per soft rule."""
    out = counts.withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words"))
    for rule, sql in SOFT_RULES.items():
        out = out.withColumn(f"fail_{rule}", F.expr(sql))
    return out


def host_verdicts(judged: DataFrame, host_odds: float = HOST_ODDS) -> DataFrame:
    """host, n, and per soft rule rate_<rule> (shrunk) and strict_<rule>.

    The beta prior of a rule has the mean m of all documents and the strength
    s = m(1-m)/v - 1, v being the spread of the host rates beyond binomial noise;
    the shrunk rate of a host with k failures in n documents is (k + m s) / (n + s).
    """
    rules = list(SOFT_RULES)
    hosts = stored(judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.col(f"fail_{r}").cast("long")).alias(f"k_{r}") for r in rules)),
        "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("h"),
                      *(F.sum(f"k_{r}").alias(f"k_{r}") for r in rules)).first()
    n_all, h_all = total["n"] or 0, total["h"]
    mean = {r: (total[f"k_{r}"] or 0) / n_all if n_all else 0.0 for r in rules}
    spread = hosts.agg(*(F.sum(F.col("n") * F.pow(F.col(f"k_{r}") / F.col("n") - F.lit(mean[r]), F.lit(2.0)))
                         .alias(r) for r in rules)).first()
    out = [F.col("host"), F.col("n")]
    for r in rules:
        m = mean[r]
        noise = m * (1 - m) * h_all / n_all if n_all else 0.0
        between = (spread[r] or 0.0) / n_all - noise if n_all else 0.0
        strength = prior_strength(m, between)
        rate = (F.col(f"k_{r}") + F.lit(m * strength)) / (F.col("n") + F.lit(strength))
        out += [rate.alias(f"rate_{r}"), (rate * F.lit(1 - m) > F.lit(host_odds * m) * (1 - rate)).alias(f"strict_{r}")]
    return hosts.select(*out)


def prior_strength(mean: float, between: float) -> float:
    """Pseudo-documents of the beta prior, from 2 to 1,000,000."""
    if between <= 0:
        return 1e6
    return min(1e6, max(2.0, mean * (1 - mean) / between - 1))


def _strict_hosts(judged: DataFrame, host_odds: float) -> DataFrame:
    strict = [f"strict_{r}" for r in SOFT_RULES]
    return stored(host_verdicts(judged, host_odds).where(" OR ".join(strict))
                  .select(F.col("host").alias("v_host"), *strict), "host-verdicts")


def _any(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def host_rules(docs: DataFrame, host_odds: float = HOST_ODDS) -> DataFrame:
    """One row per document: k_id, k_text, host, the counts, base_failed, soft_failed, kept."""
    judged = with_verdicts(stored(rule_counts(docs), "rule-counts"))
    hosts = _strict_hosts(judged, host_odds)
    failed = _any([F.col(f"fail_{r}") & F.coalesce(F.col(f"strict_{r}"), F.lit(False)) for r in SOFT_RULES])
    joined = judged.join(hosts, judged["host"].eqNullSafe(hosts["v_host"]), "left")
    return (joined.withColumn("soft_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & ~F.col("soft_failed"))
            .select("k_id", "k_text", judged["host"], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "soft_failed", "kept"))


def kept_documents(docs: DataFrame, host_odds: float = HOST_ODDS) -> DataFrame:
    """The rows of ``docs`` that ``host_rules`` keeps; columns unchanged. The counts are stored beside
    their documents, so a verdict needs no shuffle of texts: only a document that fails a soft rule
    and no base rule is looked up among the strict hosts."""
    name = free_name(docs, "rule_counts")
    counted = stored(docs.withColumn(name, F.struct(*_counts())), "counted-documents")
    flat = counted.select(f"{name}.host", f"{name}.c.*", f"{name}.l.*", f"{name}.n_symbols")
    site = free_name(docs, "strict_host")
    hosts = _strict_hosts(with_verdicts(flat), host_odds)
    hosts = hosts.select(F.struct(*hosts.columns).alias(site))
    fields = {c: f"`{name}`.{part}{c}" for part, names in (("c.", ("n_words", "word_chars", "n_repeat_words")), ("l.", ("n_lines", "n_dup_lines")),
                                                         ("", ("n_symbols",))) for c in names}
    def held(sql: str) -> Column:
        return F.expr(re.sub(r"\b(" + "|".join(fields) + r")\b", lambda m: fields[m[0]], sql))

    base = held(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words")
    soft = {r: held(sql) for r, sql in SOFT_RULES.items()}
    passed = counted.where(~base)
    doubtful = passed.where(_any(list(soft.values())))
    habit = _any([soft[r] & F.col(f"{site}.strict_{r}") for r in SOFT_RULES])
    forgiven = doubtful.join(hosts, F.col(f"{name}.host").eqNullSafe(F.col(f"{site}.v_host")) & habit, "left_anti")
    return passed.where(~_any(list(soft.values()))).unionByName(forgiven).drop(name)
