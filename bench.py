"""Benchmark the headline queries.

Runs each query to completion (noop sink: every row is produced, nothing is
collected to the driver) on local[$BENCH_CPUS] over $BENCH_SF_DIR and prints
one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sideline.plans import catalog  # noqa: E402
from sideline.session import build_session  # noqa: E402

HEADLINE = [
    "pre_incident_pairs",      # F5 interval join, pairs materialised
    "pre_incident_share",      # J5 on events (pre-aggregated window counts)
    "pre_vs_all_delta",        # J6 on events
    "pre_incident_profile",    # J5 on incidents x activity
    "season_vs_window",        # J6 on incidents x activity
    "clean_incidents",         # J1 (title case, dedup)
    "fact_injury",             # J3 fact with in-row keys
    "dim_player",              # J3 dimension
    "analysis_ready",          # J4
    "league_vs_group",         # J7 comparison
    "document_labels",         # rule classifiers over whole documents
    "star_job_fact",           # J3 as a job: CSV in, five tables written, the fact read back
    "parquet_partition_roundtrip",  # A9 rebalanced partitioned write
    "analysis_ready_incremental",   # daily run, two days: landing and J4 rebuild
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(f"local[{cpus}]", app="sideline-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # JVM / reader warm-up, not timed.
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(reps):
            t0 = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "reps": reps,
        "stat": "min over reps per query",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
