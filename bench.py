"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder with the tables (default /root/testdata/sf0.1), BENCH_CPUS the
number of local threads (default 8). The first entry is the whole daily work: both batches
from the raw tables to the published star. The reports then read that star.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES
from checks.warehouse import warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "daily_batch", "scan_sales", "csv_roundtrip", "write_once", "content_digest", "contract_check", "dq_prepared",
    "dq_evaluate", "dq_issues_long", "dq_summary", "dq_rule_counts", "valid_rows", "rejects",
    "new_products", "new_facts", "fact_sales", "fk_orphans", "uk_violations", "batch_control",
    "vw_sales", "rls_sales", "olap_region", "olap_month_category", "olap_rollup", "olap_cube",
    "olap_grouping_sets", "matrix_category_region", "monthly_sales", "kpi_cards", "sliced_kpis",
    "mom_sales", "mom_by_product", "regional_share", "product_ranking",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("saleskeep-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    start = time.time()
    warehouse(spark, SF_DIR).mart
    seconds["two_batches"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
