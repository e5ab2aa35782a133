"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up, then two timed runs; each run executes the whole plan
into Spark's ``noop`` sink (no collection to the driver).  Prints one JSON line with the
per-query warm medians and their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "hour_rollup",
    "trip_enrich",
    "hour_rollup_filled",
    "distance_by_bike",
    "partition_stats",
    "partition_quartiles",
    "category_counts",
    "corr_matrix",
    "station_share",
    "time_functions",
    "region_tag",
    "dbscan_sweep",
    "k_distance",
    "dbscan",
    "davies_bouldin",
    "silhouette",
    "partition_reload",
    "csv_roundtrip",
    "mean_ci_bootstrap",
    "hourly_describe",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tripflow.queries import QUERIES
    from tripflow.session import build_local_session

    spark = build_local_session(cpus, app="tripflow-bench", shuffle_partitions=int(cpus) * 2)
    times = {}
    failed: list[str] = []
    for name in only or HEADLINE:
        fn = QUERIES[name]
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                if i > 0:
                    samples.append(dt)
        except Exception as e:  # noqa: BLE001 - record the failure, keep benchmarking the rest
            print(f"# {name}: FAILED {type(e).__name__}: {str(e)[:200]}", file=sys.stderr, flush=True)
            failed.append(name)
            continue
        times[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs, "failed": failed}))
    spark.stop()


if __name__ == "__main__":
    main()
