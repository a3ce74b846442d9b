"""Benchmark: time headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full with a no-op sink (every row computed, nothing
collected to the driver).  Times are wall-clock seconds per query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "entry_corridor_pressure",
    "x1_feature_table",
    "l4_multi_window_corridor",
    "l6_point_in_time_cause_means",
    "d1_cause_stats",
    "d3_d5_estimates",
    "d8_spillover",
    "f6_correction_factors",
    "r8_estimated_cost",
    "a9_box_stats_top_causes",
    "v2_severity_auc",
    "c10_quality_summary",
    "k2_dbscan_clusters",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from roadpulse.session import local_session
    from roadpulse.registry import queries

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="roadpulse-bench")
    qs = queries()
    names = [n for n in HEADLINE if n in qs]
    # Warm-up: JVM start-up and code generation are not part of any query's time.
    qs["c3_flag_bbox"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
