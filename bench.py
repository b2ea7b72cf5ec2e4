"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores.
Every query runs to the end into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tidemark.workload import QUERIES

HEADLINE = [
    "monthly_customer_loans",
    "orders_value_range",
    "customers_multi_city",
    "products_above_avg",
    "join_customer_orders",
    "loan_summary",
    "join_generic_full",
    "customer_category",
    "scd1_merge",
    "scd1_evolve",
    "scd2_merge",
    "scd2_third_load",
    "scd2_stored",
    "scd4_history",
    "scd4_current",
    "scd4_classify",
    "change_feed",
    "change_feed_apply",
    "gate_dependencies",
    "gate_inputs",
    "pipeline_config",
    "sink_partitioned",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed(names[0])  # starts the JVM's compilers; not counted
    seconds = {name: round(timed(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
