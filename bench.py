"""Benchmark: headline queries on one machine, one JSON line on stdout.

Each query runs twice, and the faster run counts, so that compiling the first
plan of its kind is not measured.

BENCH_SF_DIR names the input folder, BENCH_CPUS the number of cores, and
BENCH_QUERIES (comma-separated, optional) other registered queries to time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterline.registry import QUERIES  # noqa: E402
from meterline.session import local_session  # noqa: E402

HEADLINE = [
    "c03_dedup_rows",            # staging and whole-row de-duplication
    "c08_fact_trips",            # the mart
    "c10_monthly_zone_revenue",  # the flagship aggregate
    "e02_derive_and_guard",      # preparation: derive and guard
    "g04_compute_caps",          # sketched caps
    "g05_exact_caps",            # exact caps
    "b06_run_prep",              # the whole preparation job, samples written
    "n04_reconcile",             # raw against mart
    "h01_sequence_trips",        # global row numbers
    "j08_carve_holdout",         # exact stratified holdout
    "l05_heatmap",               # dashboard pivot
    "l14_corridors",             # dashboard top corridors
    "m01_oof_target_encode",     # out-of-fold encoding, one pass
    "m09_gbt_fit",               # boosting fit and score
    "m10_cross_validate",        # cross-validation loop
]


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to build the query and produce every row of it."""
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, shuffle_partitions=8 if cpus == "*" else max(int(cpus), 1))
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "c10_monthly_zone_revenue", sf_dir)  # start the JVM's compilers
    times = {}
    for name in names:
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    trips = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    out = {
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"), "trips": trips,
    }
    if "b06_run_prep" in times:
        out["prep_rows_per_sec"] = round(trips / times["b06_run_prep"])
    spark.stop()
    print(json.dumps(out), flush=True)


if __name__ == "__main__":
    main()
