"""Benchmark the headline queries and print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full (``noop`` sink: every row produced, nothing collected)
indicator medians (the kata's seven results).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

INDICATORS = ["q1_airline_most_active", "q2_regional_leader", "q3_longest_active_route",
              "q4_avg_route_by_continent", "q5_manufacturer_leader", "q6_top3_models_by_country",
              "airport_flow_imbalance"]
OPERATORS = ["route_length", "continent_assign", "airline_bridge", "exclude_flagged_groups",
             "distinct_callsigns", "models_per_country", "regional_flights", "latest_per_flight",
             "snapshot_ingest", "stream_ingest", "scheduled_run"]


def timed(fn, reps: int, warmup: int = 1) -> float:
    for _ in range(warmup):  # JIT, file listings, size proofs: measured runs are warm
        fn().write.format("noop").mode("overwrite").save()
    out = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        out.append(time.perf_counter() - t0)
    return statistics.median(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    from contrail.plans.catalog import QUERIES
    from contrail.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 1),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "4g")})
    # Warm-up: JIT, file listing caches, Python workers.
    QUERIES["q1_airline_most_active"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in INDICATORS + OPERATORS:
        heavy = name == "scheduled_run"
        times[name] = round(timed(lambda: QUERIES[name](spark, sf_dir), 1 if heavy else reps, 0 if heavy else 1), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "indicator_suite_wall_clock",
        "value": round(sum(times[n] for n in INDICATORS), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
