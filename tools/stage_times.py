"""Run one registered query with Spark's event log in a scratch folder and print the
slowest stages (duration, tasks, shuffle read/write)."""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    name, sf = sys.argv[1], (sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1")
    from lexiflow.plans.catalog import QUERIES
    from lexiflow.session import build_session

    ev = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("local[8]", 8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": ev,
                                                "spark.eventLog.compress": "false"})
    t0 = time.time()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    print("total", round(time.time() - t0, 2))
    spark.stop()
    rows = []
    for f in glob.glob(f"{ev}/*/events*") + glob.glob(f"{ev}/events*") + glob.glob(f"{ev}/local-*"):
        if os.path.isdir(f):
            continue
        for line in open(f):
            e = json.loads(line)
            if e["Event"] != "SparkListenerStageCompleted":
                continue
            i = e["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in i.get("Accumulables", [])}
            rows.append(((i["Completion Time"] - i["Submission Time"]) / 1000, i["Submission Time"] / 1000, i["Stage ID"], i["Number of Tasks"],
                         acc.get("internal.metrics.shuffle.read.recordsRead"),
                         acc.get("internal.metrics.shuffle.write.recordsWritten"), i["Stage Name"][:40]))
    t_first = min(r[1] for r in rows) if rows else 0
    for r in sorted(rows, key=lambda r: r[1]):
        if r[0] >= 0.5:
            print(f"start+{r[1] - t_first:7.1f}s dur {r[0]:6.1f}s stage {r[2]:4d} tasks {r[3]:4d} read {r[4]} write {r[5]}")


if __name__ == "__main__":
    main()
