"""Time the headline queries and print one JSON line.

One warm-up, then the median of three runs into a no-op sink. ``BENCH_SF_DIR``
and ``BENCH_CPUS`` choose the data and the cores; ``BENCH_QUERIES`` (names
separated by commas) and ``BENCH_RUNS`` narrow a trial run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from dimspark.checks.literal import literal_lookup
from dimspark.checks.queries import QUERIES
from dimspark.session import local_session

HEADLINE = [
    "q_stage_order",
    "q_stage_sale",
    "q_stage_transaction",
    "q_enrich_city",
    "q_enrich_customer",
    "q_scd2_close",
    "q_dense_key",
    "q_dim_city",
    "q_dim_customer",
    "q_dim_employee",
    "q_dim_stock_item",
    "q_dim_supplier",
    "q_dim_city_incremental",
    "q_lookup_broadcast",
    "q_lookup_union_window",
    "q_lookup_ranked",
    "q_lookup_long_history",
    "q_fct_order",
    "q_fct_sale",
    "q_fct_transaction",
    "q_fct_movement",
    "q_fct_purchase",
    "q_fct_stock_holding",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    queries = QUERIES | {"literal_lookup": literal_lookup}
    names = os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else [*HEADLINE, "literal_lookup"]
    spark = local_session()

    def seconds(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times = {}
    for name in names:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
        print(f"{name:28} {times[name]:8.3f}", file=sys.stderr, flush=True)
    headline = {name: t for name, t in times.items() if name != "literal_lookup"}
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median run times",
                "value": round(sum(headline.values()), 3),
                "unit": "sec",
                "queries": headline,
                "comparison": {k: v for k, v in times.items() if k not in headline},
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cores": spark.sparkContext.defaultParallelism,
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
