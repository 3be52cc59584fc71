"""Times every catalogue query and prints one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1); BENCH_CPUS: local cores (default 8).
Each query runs once to warm up and then BENCH_RUNS times (default 2); the best time counts. Streams
run once: they start from an empty checkpoint and write their tables every time.
"""

from __future__ import annotations

import json
import os
import time

from plantspark.plans.catalog import QUERIES
from plantspark.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def seconds(spark, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    seconds(spark, "alert_counts")
    took = {}
    for name in QUERIES:
        streams = "stream" in name
        if not streams:
            seconds(spark, name)
        took[name] = round(min(seconds(spark, name) for _ in range(1 if streams else RUNS)), 3)
    batch = [s for name, s in took.items() if "stream" not in name]
    print(json.dumps({
        "metric": "total seconds of all queries",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "batch_mean_ms": round(1000 * sum(batch) / len(batch), 1),
        "batch_under_500ms": sum(s < 0.5 for s in batch),
        "batch_queries": len(batch),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
