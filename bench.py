"""Benchmark: headline queries over the driver tables.

Runs each query ``BENCH_RUNS`` times (after a JVM warm-up) with a no-op sink, so
the whole plan executes without collecting rows to Python, and prints one JSON
line with the best time of each.  ``featured_stage`` is the stage write that all
analyses share, timed once.  ``loop`` is a fixed loop of plain Python before and after
the queries: the machine's own speed, to hold two runs against each other.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2), BENCH_QUERIES (comma list, default the headline set below).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "working_days_delta",
    "stage_durations",
    "featured_parts",
    "time_analysis_by_type",
    "process_analysis",
    "part_ranking",
    "frequent_itemsets",
    "association_rules",
    "part_features",
    "critical_parts",
    "k_sweep",
    "top_contributors",
    "demand_sequences",
    "parse_dates",
    "decimal_comma",
    "delimiter_profile",
]


def loop() -> float:
    t0 = time.perf_counter()
    sum(i * i for i in range(5_000_000))
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from servicelens.session import local_session
    from servicelens.plans.queries import QUERIES
    from servicelens.plans.workload import Workload

    spark = local_session(cpus=cpus, shuffle_partitions=max(2 * cpus, 8))
    # Warm-up: JVM, parquet reader and codegen caches.
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()

    loops = [loop()]
    t0 = time.perf_counter()
    Workload(spark, sf_dir).featured
    stage = round(time.perf_counter() - t0, 3)
    print(f"# featured_stage: {stage}s", file=sys.stderr, flush=True)
    times = {}
    for name in names:
        each = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            each.append(round(time.perf_counter() - t0, 3))
        times[name] = min(each)
        print(f"# {name}: {each}s", file=sys.stderr, flush=True)
    loops.append(loop())

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "featured_stage": stage,
                "loop": loops,
                "sf": float(m.group(1)) if m else None,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
