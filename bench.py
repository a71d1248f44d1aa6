"""Time the headline queries: python bench.py -> one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default all headline queries).  Building the clean
layer and the star is timed on its own; the metrics then read the stored tables, each
once without a warm-up, and every result is computed in full.
"""

from __future__ import annotations

import json
import os
import sys
import time

from oracles import queries as workload
from tradewind.plans.catalog import METRICS
from tradewind.session import open_session

CLEANING = [
    "clean_customers",
    "clean_orders",
    "clean_order_items",
    "clean_payments",
    "clean_reviews",
    "quarantine_rejects",
]
STAR = ["build_dim_order", "build_dim_payment", "build_dim_review", "build_fact_order_items"]


def run_fully(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = open_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    plans = workload.queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else [*CLEANING, *STAR, *METRICS]

    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {times[name]}", file=sys.stderr)

    layers = workload.inputs(spark, sf_dir)
    timed("warm_up", lambda: run_fully(spark.range(1000)))
    timed("store_raw_layer", layers.raw)
    timed("store_cleaned_parents", layers.parents)
    timed("store_clean_layer", layers.clean)
    timed("store_star", layers.star)
    for name in names:
        timed(name, lambda name=name: run_fully(plans[name](spark, sf_dir)))
    # Deriving raw text from the test tables is input preparation, not a query.
    times.pop("warm_up")
    times.pop("store_raw_layer")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
