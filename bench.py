"""Times headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of cores. Each query is planned and run
to the end (all columns of all rows are computed, nothing is written); the best of the measured
runs counts, after one warm-up run. ``planning`` has the seconds of that run until its physical
plan stood, which for queries that store or stream something includes that work.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = (
    "a20_aggregate_by_user",
    "a24_category_country_performance",
    "a25_daily_sales_summary",
    "a26_sales_by_category_summary",
    "a27_sales_by_country",
    "a29_customer_metrics",
    "a31_top_customer_categories",
    "a33_product_stock_analysis",
    "a37_executive_summary",
    "a40_sales_by_category",
    "a42_fct_daily_sales",
    "a43_fct_order_performance",
    "a44_fct_product_sales",
    "a45_dim_customer_metrics",
    "a46_dim_user_metrics",
    "a48_stg_user_events",
    "a50_stg_order_details",
    "j01_order_context",
    "j04_enrich_transactions",
    "k07_published_tables",
    "q02_referential_integrity",
    "q03_business_rules",
    "q16_test_suite",
    "s06_topic_stream",
    "t01_decode_events",
    "t04_order_counters",
    "w08_global_quartile",
    "w09_all_transaction_windows",
)
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main():
    from pyspark.sql import SparkSession

    import registry

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(key):
        started = time.perf_counter()
        df = registry.QUERIES[key](spark, folder)
        df._jdf.queryExecution().executedPlan()
        planned = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started, planned - started

    seconds, planning = {}, {}
    for key in HEADLINES:
        run(key)
        best = min(run(key) for _ in range(RUNS))
        seconds[key], planning[key] = (round(x, 3) for x in best)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "planning": planning,
        "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
