"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3).
Each query is executed in full with the ``noop`` sink (no collect), and the
median of the timed runs is reported.
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
    "mediate_validate",
    "mediate_valid_dedup",
    "rated_records",
    "rating_new_records",
    "billing_invoices",
    "report_revenue_by_region",
    "report_revenue_by_service",
    "report_dead_records",
    "invoice_view",
    "invoice_documents",
    "customer_profile",
    "quality_keys",
    "stage_counts",
    "rated_records_orders",
    "billing_invoices_orders",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from chargeline.session import build_session
    from chargeline.plans.queries import REGISTRY

    spark = build_session(f"local[{cpus}]", max(cpus, 4) * 2, app_name="chargeline-bench",
                          extra={"spark.driver.memory": "4g"})
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in HEADLINE:
        if name not in REGISTRY:
            continue
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 -- report, keep benchmarking the rest
            errors[name] = str(e).splitlines()[0][:300]
            continue
        timings[name] = round(statistics.median(samples), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "errors": errors,
        "records_per_sec": {
            "rating_events": round(events / timings["rated_records"], 1) if "rated_records" in timings else None,
            "rating_orders": round(lines / timings["rated_records_orders"], 1)
            if "rated_records_orders" in timings else None,
        },
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
