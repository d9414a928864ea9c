"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data directory, ``BENCH_CPUS`` the number of cores, ``BENCH_REPEAT`` how often each
query is timed (the median counts). Making the retail tables and loading the star schema are timed once each;
queries write to a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from orderloom.registry import all_queries
from orderloom.session import build_session
from orderloom.sources.workspace import workspace

DIRECTORY = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))

HEADLINE = [
    "monthly_sales", "top_customers_by_region", "org_hierarchy", "category_quarter_pivot", "order_islands",
    "churn_gap_counts", "churn_gaps_adjacent", "segment_set_ops", "segment_one_pass", "dim_customer_scd2",
    "dim_product_scd1", "inventory_snapshot_merge", "order_totals", "place_orders", "process_returns",
    "replenish_inventory", "line_audit", "customer_ltv", "order_history", "orders_by_status",
    "constraint_violations", "star_constraint_violations", "customer_functions", "place_orders_stored",
]
# Jobs whose result is kept for other queries; each timing has to start without it.
KEPT = {"place_orders": "placed orders", "process_returns": "processed returns"}


def seconds(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", int(CPUS), **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"), "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    w = workspace(spark, DIRECTORY)
    seconds(lambda: spark.range(1000).selectExpr("sum(id)").collect())
    times = {"retail_tables": seconds(w.oltp), "full_load": seconds(lambda: w.star("FactSales"))}
    for name in ("Payments", "Returns"):
        w.table(name)
    for name in HEADLINE:
        def run() -> None:
            registered[name](spark, DIRECTORY).write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(REPEAT + 1):
            if name in KEPT:
                w.forget(KEPT[name])
            runs.append(seconds(run))
        times[name] = statistics.median(runs[1:])  # the first run warms up
        print(f"{name}: {times[name]:.2f}", file=sys.stderr)
    print(json.dumps({
        "metric": "total seconds of the headline queries, tables and full load included",
        "value": round(sum(times.values()), 2), "unit": "sec",
        "queries": {name: round(value, 3) for name, value in times.items()},
        "sf": os.path.basename(DIRECTORY.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
