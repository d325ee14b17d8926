"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from tillwright.plans.queries import build

HEADLINE = (
    "daily_sales_by_country", "weekly_running_totals", "customer_ltv", "product_performance",
    "cohort_retention", "session_attribution", "active_member_panel", "sales_rollup",
    "category_tree", "carrier_otd", "panel_continuity", "orders_with_consent", "returns_pending",
    "cdc_merge", "sessionise", "points_ledger", "address_history", "sales_cube",
    "top_countries", "inventory_snapshot", "daily_sales_by_product", "supplier_performance",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # the first query of a session pays for class loading; that is not the query's time
    build("carrier_otd")(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        build(name)(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "retail_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
