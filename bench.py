"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of Parquet tables, BENCH_CPUS the number of local cores. Each
query runs twice from the files; ``queries`` has the second time, ``first_run`` the first,
which includes the compilation of its plan. Building the plan counts in both.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402

from ledgerloom.plans import queries  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

HEADLINE = [
    "kpi_revenue_totals",
    "kpi_sales_summary",
    "kpi_product_profitability",
    "kpi_cogs_detail",
    "kpi_new_vs_returning",
    "kpi_customer_segments",
    "fact_order",
    "discount_allocation",
    "fact_order_line",
    "fact_cogs_estimate",
    "stg_orders_dedupe",
    "stg_order_lines",
    "dq_referential",
]


def timed(name: str, spark, folder: str) -> float:
    start = time.perf_counter()
    queries.run(name, spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    timed("kpi_revenue_totals", spark, folder)  # start-up is not part of any query
    names = sys.argv[1:] or HEADLINE
    first = {name: timed(name, spark, folder) for name in names}
    seconds = {name: timed(name, spark, folder) for name in names}
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "first_run": first,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "spark": pyspark.__version__,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
