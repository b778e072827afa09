"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local[N] threads (default 8)

Each query is built from scratch and all its rows are fetched (as Arrow
batches); it runs BENCH_RUNS times (default 3) and the median is reported.
Nothing is cached between runs.  Untimed warm-up runs on the smallest tables come first so JVM
start-up and JIT compilation are not charged to the measured queries
(BENCH_WARM_DIR, default sf0.01; never the measured folder).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayflow.plans.catalog import BENCH_QUERIES, QUERIES  # noqa: E402
from stayflow.session import build_session  # noqa: E402


RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="stayflow-bench", shuffle_partitions=cpus)
    # Warm-up: every headline query once on the smallest tables (JIT and code
    # paths; nothing of the measured tables is read or cached).
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.realpath(warm_dir) == os.path.realpath(sf_dir):
        warm_dir = ""
    for _ in range(2):
        for name in BENCH_QUERIES if warm_dir and os.path.isdir(warm_dir) else []:
            QUERIES[name](spark, warm_dir).toArrow()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in BENCH_QUERIES:
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            n = QUERIES[name](spark, sf_dir).toArrow().num_rows
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        rows[name] = n
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs_per_query": RUNS,
        "stat": "median",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
