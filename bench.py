"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully computed with the ``noop`` sink (no collect to the
driver), $BENCH_RUNS times (default 2); the best run is reported, the first
run is kept under "first_run". Prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
Extra keys: rows_in (driver-table rows each query reads, summed) and
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "monthly_observed", "excess_label", "excess_by_region", "stage_deaths", "stage_cases",
    "stage_covid_local", "stage_mortality_world", "stage_covid_world", "fact_deaths", "fact_cases",
    "dim_cause", "drill_across", "dedup_keep_first", "weekly_to_monthly", "wide_to_long",
    "quarantine_html", "threshold_sweep", "scan_csv_typed",
]
# driver tables each headline query reads (for the rows/s figure)
INPUTS = {
    "monthly_observed": ["lineitem", "orders", "customer"], "excess_label": ["lineitem", "orders", "customer"],
    "excess_by_region": ["lineitem", "orders", "customer"], "stage_deaths": ["lineitem", "orders", "customer"],
    "stage_cases": ["lineitem", "orders", "customer"], "stage_covid_local": ["orders", "customer"],
    "stage_mortality_world": ["orders", "customer"], "stage_covid_world": ["orders", "customer"],
    "fact_deaths": ["lineitem", "orders", "customer"], "fact_cases": ["lineitem", "orders", "customer"],
    "dim_cause": ["lineitem", "orders", "customer"], "drill_across": ["lineitem", "orders", "customer"],
    "dedup_keep_first": ["lineitem"], "weekly_to_monthly": ["orders", "customer"],
    "wide_to_long": ["orders", "customer"], "quarantine_html": ["pages", "documents"],
    "threshold_sweep": ["labels", "documents"], "scan_csv_typed": ["orders"],
}


RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    from vitals.session import get_session
    spark = get_session(f"local[{cpus}]", int(cpus) * 2, app_name="vitals-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g"),
                               "spark.ui.showConsoleProgress": "false"})
    import pyarrow.parquet as pq

    from vitals.queries import load_all
    qs = load_all()
    rows = {t: pq.ParquetFile(f"{sf_dir}/{t}.parquet").metadata.num_rows
            for t in {t for ts in INPUTS.values() for t in ts}}
    # warm-up: JVM class loading and codegen caches, not counted
    qs["year_profile"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, rates, first = {}, {}, {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        dt = min(runs)
        times[name] = round(dt, 3)
        first[name] = round(runs[0], 3)
        n_in = sum(rows[t] for t in INPUTS[name])
        rates[name] = round(n_in / dt, 1) if dt > 0 else None
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total_time", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "stat": f"best of {RUNS} runs",
                      "first_run": first, "first_run_total": round(sum(first.values()), 3),
                      "rows_per_sec": rates}))
    spark.stop()


if __name__ == "__main__":
    main()
