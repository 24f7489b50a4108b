"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from duesight.plans.catalog import QUERIES
from duesight.session import local_session

HEADLINE = [
    "dedupe_events",
    "validate_invoices",
    "dq_metrics",
    "outcomes",
    "customer_timeline",
    "asof_history",
    "event_asof",
    "gold_customer",
    "feature_matrix",
    "prediction_log",
    "collection_queue",
    "call_list",
    "strategy_comparison",
    "segments",
    "model_metrics",
    "calibration_quantile",
    "drift_report",
    "live_performance",
    "v_invoice_detail",
    "bronze_stream",
]

WARM_UP = ["call_list", "drift_report", "customer_timeline"]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    # Discarded warm-up: starts the workers and lets the JVM compile the common code paths.
    for name in WARM_UP:
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
