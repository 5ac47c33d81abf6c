"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local threads,
``BENCH_QUERIES`` (optional, comma-separated) a subset.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.catalog import ENTRIES  # noqa: E402
from tidemark.session import get_session  # noqa: E402

HEADLINE = [
    "final_monthly_report", "group_by_two_keys", "group_many_aggregates", "group_without_sort", "group_by_month_text",
    "resample_workdays_daily", "pivot_region_by_category", "stack_and_unstack", "quantiles_by_region",
    "describe_lineitem", "outlier_rows", "clean_documents", "standardize_all_strings", "trim_text", "search_keyword",
    "parse_dates_or_null", "evaluate_arithmetic", "join_by_index", "merge_with_key_types", "merge_on_two_keys",
    "rolling_mean_over_orders", "cumulative_quantity", "rank_lines_with_ties", "rank_customers_in_region",
    "rank_in_trailing_window", "growth_by_category", "distinct_per_column", "narrow_column_types",
    "csv_with_given_types", "parquet_round_trip", "chunked_ingest",
]


def run_once(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    ENTRIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = get_session("bench", **{
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run_once(spark, name, folder)  # warm-up: class loading and code generation
        seconds[name] = round(statistics.median(run_once(spark, name, folder) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
