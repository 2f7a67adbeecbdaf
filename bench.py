"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from conformance.queries import QUERIES

HEADLINE = (
    "loan_score",
    "table_customers",
    "table_loans",
    "table_repayments",
    "table_delinquency",
    "table_records_enquiries",
    "table_bad_members",
    "table_good_customers",
    "table_verification",
    "join_repayment_member",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    """Seconds to build the query and produce all of its rows and columns."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("creditgrade-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "src_row_count", sf_dir)  # start the session and warm the file cache
    seconds = {}
    for name in HEADLINE:
        # The first runs of a query are mostly code generation and class loading.
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(3)), 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
