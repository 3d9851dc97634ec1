"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected to the driver) and timed wall-clock. Prints
one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "monthly_series", "summary_stats", "top_intersections", "hex_heatmap", "near_school_flag",
    "hot_spots", "emerging_hot_spots", "kernel_density", "road_match", "danger_corridors",
    "simplify_roads", "road_totals", "export_crashes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from roadrisk.plans.registry import QUERIES
    from roadrisk.session import local_session

    spark = local_session(cpus)
    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # report it and keep timing the others
            timings[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
        print(f"# {name}: {timings[name]} s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(t for t in timings.values() if t is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
