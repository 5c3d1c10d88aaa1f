"""Columns named like the operators' own, and names that need quotes, change no result."""

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import bpe, exact_dedup, langid, licenses, minhash, packing, pii, quality, queries, rules

from .conftest import texts_frame

NAMES = ["k_id", "k_text", "t", "h", "n", "sha", "whole_text_key", "row", "found", "node", "items", "band", "x", "y", "p", "ids", "length",
         "part", "host", "path", "times", "a b", "c.d", "`q`"]
ROWS = [(1, "a short text with words " * 20, "en", "a"), (2, "a short text with words " * 20, "en", "b"), (3, None, None, None),
        (4, "me a@b.org and 10.0.0.1 " + " ".join(f"w{i}" for i in range(60)), "fr", "a"), (None, "all rights reserved", "en", "a")]


@pytest.mark.parametrize("name", ["exact", "near", "rules", "pii", "quality", "licenses", "langid", "packing", "bpe"])
def test_other_columns_change_nothing(spark, name):
    ranks, pattern = queries._vocabulary()
    labels = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, quality int")
    run = {
        "exact": exact_dedup.exact_dedup, "near": minhash.near_duplicates, "rules": rules.host_rules, "pii": pii.find_spans,
        "quality": lambda d: quality.quality_scores(d, labels), "licenses": licenses.scan_licenses,
        "langid": lambda d: langid.identify(d, langid.fit(langid.language_counts(d, F.lit(True)))),
        "packing": lambda d: packing.pack(d, ranks, pattern), "bpe": lambda d: bpe.encode(d, ranks, pattern)}[name]
    plain = texts_frame(spark, ROWS).drop("host")
    more = plain
    for c in NAMES:
        more = more.withColumn(c, F.lit("other"))
    rows = lambda d: sorted(str({k: v for k, v in r.asDict().items() if k not in ("sequence_id", "offset")}) for r in run(d).collect())
    assert rows(more) == rows(plain)
