"""Times the product requests over written bronze, silver and gold tables.

Prints one JSON line. Each figure is the median of the timed runs after a
warm-up; the ``build_*`` figures are single full refreshes of a layer.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from tallyhouse.operators import analytics
from tallyhouse.plans import paths, refresh
from tallyhouse.plans.bundle import products_response
from tallyhouse.plans.medallion import REQUEST_MARTS, silver_over
from tallyhouse.session import local_session
from checks.testbed import Testbed
from tallyhouse.sources.warehouse import Warehouse

RUNS = 7
REQUESTS = ("summary", "revenue_over_time", "top_products")
# Bronze tables the requests and the marts need.
BRONZE_NEEDED = (
    "orders", "order_items", "payments", "refunds", "products", "product_variants",
    "product_reviews",
)
SILVER_NEEDED = (
    "dim_products", "dim_variants", "fct_orders", "fct_order_items", "fct_payments",
    "fct_refunds", "fct_reviews",
)


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def median_of(action, runs: int = RUNS) -> float:
    action()
    return statistics.median(timed(action) for _ in range(runs))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    root = tempfile.mkdtemp(prefix="tallyhouse-bench-")
    warehouse = Warehouse(spark, root, "bench_")
    source = Testbed(spark, folder)

    # Refreshes write one file per month; small data would all go to one task.
    smallest = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(smallest, "16k")
    seconds: dict[str, float] = {}
    seconds["build_bronze"] = timed(
        lambda: refresh.refresh_bronze(warehouse, source, BRONZE_NEEDED)
    )
    seconds["build_silver"] = timed(lambda: refresh.refresh_silver(warehouse, SILVER_NEEDED))
    seconds["build_gold"] = timed(lambda: refresh.refresh_gold(warehouse, REQUEST_MARTS))

    spark.conf.unset(smallest)

    span = analytics.resolve_range("1998-01-01", "1998-03-01")
    bronze, silver, gold = (warehouse.layer(name) for name in ("bronze", "silver", "gold"))
    # Frames are built anew for every run, as a request would do.
    makers = {
        "bronze": lambda: paths.SilverRequests(silver_over(bronze), span, 15),
        "silver": lambda: paths.SilverRequests(silver, span, 15),
        "gold": lambda: paths.GoldRequests(gold, span, 15),
    }
    for layer, make in makers.items():
        for request in REQUESTS:
            seconds[f"{layer}_{request}"] = median_of(
                lambda: getattr(make(), request)().collect()
            )
        seconds[f"{layer}_bundle"] = sum(seconds[f"{layer}_{request}"] for request in REQUESTS)

    # All eight sections of one request, run side by side and collected.
    seconds["gold_response"] = median_of(
        lambda: products_response(
            gold.table("mart_product_sales"),
            gold.table("mart_daily_sales"),
            span.start.isoformat(),
            span.end.isoformat(),
            15,
        )
    )
    print(
        json.dumps(
            {
                "metric": "median seconds of the gold request bundle",
                "value": round(seconds["gold_bundle"], 4),
                "unit": "sec",
                "queries": {name: round(value, 4) for name, value in seconds.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "bronze_over_gold": round(seconds["bronze_bundle"] / seconds["gold_bundle"], 2),
                "silver_over_gold": round(seconds["silver_bundle"] / seconds["gold_bundle"], 2),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
