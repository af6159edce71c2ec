"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "headline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully materialised (``noop`` sink: every row and column is
computed, nothing is collected) and timed; the per-query figure is the
median of $BENCH_REPEAT runs after one warm-up of the session.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "l1_clean",            # L1: parse + reject routing of raw listings
    "n6_counts",           # N6: five normalised tables from one input
    "j1_ticket_schedule",  # J1: fact x schedule join
    "j2_ticket_policy",    # J2: fact x policy join
    "a13_value_ratios",    # A13: per-column value percentages
    "m10_features",        # M10: feature table (scale, one-hot, multi-label, calendar)
    "l5_reviews",          # L5: review ETL (text normalisation, ids)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))

    from listinglab.plans.registry import QUERIES, load_all
    from listinglab.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16,
                          app="listinglab-bench")
    load_all()

    def run(name: str) -> float:
        spark.catalog.clearCache()   # every repeat is cold
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("l1_clean")   # warm-up (JIT, file listing)
    times = {}
    for name in HEADLINE:
        times[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
