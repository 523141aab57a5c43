"""Time the headline queries on the tables of one folder and print one JSON line.

Environment: ``BENCH_SF_DIR`` (folder of the tables), ``BENCH_CPUS`` (threads of the local master),
``BENCH_KEYS`` (comma-separated query names, or ``all``).
"""

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

import bindings  # noqa: E402

HEADLINE = (
    "suspicious_flag", "suspicious_flag_history", "rolling_std",
    "dedup_business_key", "dedup_exact", "mask_sha256", "standardize_types",
    "reject_first_rule", "reject_cross_column", "fk_valid", "constraint_unique",
    "upsert_by_key", "impute_median", "silver_movements",
    "fact_transactions", "fact_portfolio", "customer_profitability", "kpi_portfolio_daily",
    "null_profile", "check_summary", "volume_anomaly",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_KEYS", "")
    keys = list(bindings.QUERIES) if wanted == "all" else [k for k in wanted.split(",") if k] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lamina-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the engine before the clock: class loading is not part of any query.
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for key in keys:
        start = time.perf_counter()
        # Planning, including the size and skew checks, is part of the time; every row is computed.
        bindings.QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
