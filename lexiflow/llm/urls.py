"""URL filters by hashed expressions.

A rule is ``host`` + ``path`` with an action. It fits a url whose host is the rule's or a
subdomain of it and whose path starts with the rule's. Every url is expanded into
(host suffix, path prefix) expressions, as far as some rule could equal one of them: no
more labels than the longest rule host has, and only prefix lengths that rule paths have.
The expressions meet the rules in an equi-join on the first 4 bytes of their SHA-256; the
full digests are then compared, and of the rules that fit, the longest wins (at the same
length block before allow).

The work is done once per distinct (host, path) and joined back. All of it is DataFrame
functions; whether the rule table is broadcast is left to Spark's size threshold.

Defined cases: a null url, or one without ``://``, has an empty host and path and takes the
default verdict; repeated rows are judged each; an empty table gives an empty result; without
rules every url takes the default verdict; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    scheme = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1))
    after = F.coalesce(F.substring(url, F.length(scheme) + F.lit(4), F.length(url)), F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + F.lit(1), F.length(after)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """rules (action, rule) with host and path parts, digest and short prefix."""
    slash = F.instr("rule", "/")
    host = ascii_lower(F.when(slash > 0, F.substring_index("rule", "/", 1)).otherwise(F.col("rule")))
    path = F.when(slash > 0, F.substring(F.col("rule"), slash, F.length("rule"))).otherwise(F.lit(""))
    return (rules.where("rule IS NOT NULL AND action IS NOT NULL")
            .select("action", "rule", host.alias("r_host"), path.alias("r_path"))
            .withColumn("r_digest", digest(F.concat("r_host", "r_path")))
            .withColumn("r_short", F.substring("r_digest", 1, 8)))


def expressions(hosts: DataFrame, labels: int, lengths: list[int]) -> DataFrame:
    """host, path → one row per expression with its digest and short prefix."""
    n_labels = F.size(F.split("host", r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n_labels, F.lit(max(labels, 1)))),
                           lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    fitting = F.filter(F.array(*(F.lit(x) for x in lengths)) if lengths else F.array().cast("array<int>"),
                       lambda n: n <= F.length("path"))
    out = (hosts.select("host", "path", F.explode(suffixes).alias("suffix"))
           .select("host", "path", "suffix", F.explode(fitting).alias("n"))
           .withColumn("digest", digest(F.concat("suffix", F.substring(F.col("path"), F.lit(1), F.col("n"))))))
    return out.select("host", "path", "digest", F.substring("digest", 1, 8).alias("short"))


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages (page_id, url) and rules (action, rule) → page_id, host, path, rule, verdict."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = stored(prepared_rules(rules), "url-rules")
    # bounded by the length of the longest rule, not by their number
    bounds = known.agg(F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
                       F.collect_set(F.length("r_path")).alias("lengths")).first()
    found = expressions(urls.select("host", "path").distinct(), bounds["labels"] or 0, sorted(bounds["lengths"] or []))
    fits = found.join(known, (found["short"] == known["r_short"]) & (found["digest"] == known["r_digest"]))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        F.length("rule").alias("len"), (F.col("action") == "block").alias("blocks"), "rule", "action")).alias("best"))
    best = best.select(F.col("host").alias("b_host"), F.col("path").alias("b_path"), "best")
    joined = urls.join(best, (urls["host"] == best["b_host"]) & (urls["path"] == best["b_path"]), "left")
    return joined.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce("best.action", F.lit(default)).alias("verdict"))
