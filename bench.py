"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the no-op sink (full plan, no
collect).  Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "monthly_climatology", "scan_table", "prepare_features", "append_rows", "find_duplicates",
    "landing_fetch", "update_observations", "describe_numeric", "mean_abs_dev_median", "correlation_matrix",
    "boxplot_stats", "season_day_profile", "kde_curve", "forecast_vs_actual", "regression_metrics",
    "supervised_windows", "catchup_windows", "apply_scaler", "model_comparison", "forecast_next_day",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from climark.plans import catalog
    from climark.session import build_session
    spark = build_session(f"local[{cpus}]", app="climark-bench", shuffle_partitions=int(cpus) * 2)
    catalog.load_all()
    # warm-up: JVM, parquet footers, codegen caches
    catalog.QUERIES["monthly_climatology"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
