"""Benchmark: run the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and print
one JSON line. Each query is executed to completion with the no-op sink (every row is
produced, nothing is collected to the driver)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "tfidf",
    "tfidf_smooth_max_features",
    "stratified_folds",
    "quota_folds",
    "bpe_pair_counts",
    "query_similarity",
    "knn_library",
    "knn_cross_validate",
    "all_pairs_similarity",
    "knn_embeddings",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    from lexiflow.plans.catalog import QUERIES
    from lexiflow.session import build_session

    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    # session start-up (JVM, first planning) is not charged to the first query
    spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]} s", file=sys.stderr, flush=True)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
