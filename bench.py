"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

One query warms the session up; each query then gets $BENCH_RUNS timed runs (1 unless
set), of which the median counts.
A query's time includes building and storing every table it loads on the way.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from strataload.plans.queries import QUERIES
from strataload.session import local_session

HEADLINE = [
    "stage_vehicle", "scd2_initial", "scd2_incremental", "scd2_backdated", "dim_policy", "point_in_time_join",
    "fact_build", "agg_latest_month", "load_cycle_two_batches",
]


def run(name: str, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    run("fact_build", spark, sf_dir)
    seconds = {}
    for name in only.split(",") if only else HEADLINE:
        seconds[name] = round(statistics.median(run(name, spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus, "runs": runs,
    }))


if __name__ == "__main__":
    main()
