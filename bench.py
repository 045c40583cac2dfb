"""Time the registered queries and print one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     cores (default 8)
BENCH_QUERIES  comma-separated names (default: the headline set; "all" for every query)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from wharfline import suite
from wharfline.session import clear_scratch, local_session

HEADLINE = (
    "supplier_delivery",
    "inventory_health",
    "sales_rolling",
    "daily_sales",
    "extract_full",
    "extract_date_range",
    "load_quarantine",
    "insert_ignore",
    "assign_surrogate_ids",
    "clean_nulls_median",
    "clean_nulls_ffill",
    "dedup_rows",
    "dedup_subset",
    "etl_orders",
    "etl_sales",
    "fk_orphans",
    "validate_table",
    "quality_summary",
    "rules_all_tables",
    "profile_numeric",
    "profile_categorical",
    "profile_table",
    "outliers_iqr",
    "outliers_zscore",
    "outliers_iforest",
    "anomaly_scan",
    "etl_run_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(suite.QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = local_session("bench", cpus, partitions=int(cpus) if cpus.isdigit() else 8, scratch=scratch)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        suite.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("supplier_delivery")  # start the JVM's code generation and the parquet reader once
    seconds: dict[str, float] = {}
    for name in names:
        seconds[name] = round(run(name), 3)
        clear_scratch(spark)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
