"""Times the headline queries over whole tables and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query is computed in full: its result goes to Spark's no-op sink, nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from merchlake.catalog import QUERIES
from merchlake.plans.shop import open_shop
from merchlake.session import local_session

HEADLINE = [
    # per-session and per-item digests, dimensions and facts
    "pageviews_by_session",
    "orders_by_session",
    "surrogate_keys",
    "fact_sales",
    "fact_sessions",
    "reconciliation",
    # marts and analyses on the event-derived shop
    "daily_performance",
    "marketing_performance",
    "product_performance",
    "customer_summary",
    "funnel_performance",
    "refunds_performance",
    "analysis_sales_monthly",
    "analysis_marketing_channels",
    "headline_metrics",
    # validation, upserts and increments
    "validation_counts_volume",
    "dim_upsert_preserves_keys",
    "incremental_orders_two_runs",
    # facts and marts on the larger, validated order lines
    "fact_sales_volume",
    "fact_sessions_volume",
    "daily_performance_volume",
    "marketing_performance_volume",
    "product_performance_volume",
    "customer_summary_volume",
    "refunds_performance_volume",
]


def _scale(sf_dir: str) -> float | str:
    name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "merchlake-bench")

    def compute(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    def build(entity_set: str) -> float:
        started = time.perf_counter()
        open_shop(spark, sf_dir, entity_set).build()
        return round(time.perf_counter() - started, 3)

    compute("orders_by_session")  # starts the workers and warms the code paths
    # Staging, dimensions and facts are written once; marts and analyses then read them.
    timings = {f"build_warehouse_{name}": build(name) for name in ("web", "volume")}
    for name, seconds in timings.items():
        print(f"{name}: {seconds}", file=sys.stderr)
    for name in HEADLINE:
        timings[name] = compute(name)
        print(f"{name}: {timings[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": _scale(sf_dir),
            }
        )
    )


if __name__ == "__main__":
    main()
