"""Whole runs: read, compute, store. Each is what one scheduled job does.

python -m tillworks.plans.runs aggregation --input <folder> --output <folder>
"""

import argparse

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.operators import joins, quality, windows
from tillworks.plans import jobs, marts, staging
from tillworks.session import build_session
from tillworks.sinks import tables as sinks
from tillworks.sources import readers
from tillworks.sources.tables import RetailTables

TRANSACTIONS = (
    "transaction_id bigint, user_id bigint, product_id bigint, amount decimal(12,2),"
    " currency string, transaction_date timestamp_ntz, status string"
)
USERS = "user_id bigint, username string, email string, registration_date string, country string"
PRODUCTS = "product_id bigint, product_name string, category string, price decimal(12,2)"


def run_aggregation(spark: SparkSession, source: str, target: str, format: str = "parquet") -> None:
    """Sales by user, by product and by day, from the transactions under ``source``."""
    sales = readers.raw_zone(spark, f"{source}/transactions", TRANSACTIONS, format)
    sinks.write_files(jobs.aggregate_by_user(sales), f"{target}/user_aggregations")
    sinks.write_files(jobs.aggregate_by_product(sales), f"{target}/product_aggregations")
    sinks.write_files(
        jobs.aggregate_by_time(sales),
        f"{target}/time_aggregations",
        partition_by=["year", "month"],
    )


def run_transformation(
    spark: SparkSession, source: str, target: str, format: str = "parquet"
) -> None:
    """Enriched and windowed transactions, user segments and the country summary.

    The enriched table is stored first, and the windows read what was stored.
    """
    transactions = readers.raw_zone(spark, f"{source}/transactions", TRANSACTIONS, format)
    users = readers.raw_zone(spark, f"{source}/users", USERS, format)
    products = readers.raw_zone(spark, f"{source}/products", PRODUCTS, format)
    enriched = joins.enrich_transactions(transactions, users, products)
    sinks.write_files(enriched, f"{target}/enriched_transactions")
    stored = spark.read.parquet(f"{target}/enriched_transactions")
    sinks.write_files(windows.apply_window_functions(stored), f"{target}/windowed_transactions")
    sinks.write_files(
        jobs.user_segments(transactions, users, products), f"{target}/user_segments"
    )
    sinks.write_files(
        jobs.country_category_summary(transactions, users, products),
        f"{target}/country_category_summary",
    )


def run_daily_etl(tables: RetailTables, database: str, as_of: str) -> None:
    """The three daily result tables over the orders shipped the day before (or in the week)."""
    sinks.create_result_tables(tables.spark, database)
    orders = jobs.orders_to_process(tables.orders, as_of).persist(StorageLevel.MEMORY_AND_DISK)
    details = joins.details_of(tables.order_details, orders).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        results = {
            "daily_sales_summary": jobs.daily_sales_summary(orders, details, as_of),
            "daily_category_sales": jobs.sales_by_category_summary(
                details, tables.products, tables.categories
            ),
            "daily_country_sales": jobs.sales_by_country(orders, details, tables.customers),
        }
        for name, result in results.items():
            sinks.load_result_table(result, database, name, as_of)
    finally:
        details.unpersist()
        orders.unpersist()


def run_models(
    tables: RetailTables, base: str, as_of: str, start_date: str, production: bool = False
) -> dict[str, DataFrame]:
    """Publish the staging models as views and the marts as tables; returns all of them."""
    staged = {
        "stg_sales_transactions": staging.stg_sales_transactions(tables.sales_transactions),
        "stg_user_events": staging.stg_user_events(tables.user_events),
        "stg_orders": staging.stg_orders(tables.orders),
        "stg_order_details": staging.stg_order_details(tables.order_details),
        "stg_customers": staging.stg_customers(tables.customers),
        "stg_products": staging.stg_products(
            tables.products, tables.categories, tables.suppliers
        ),
    }
    for name, model in staged.items():
        sinks.publish_view(model, name)
    transactions, events = staged["stg_sales_transactions"], staged["stg_user_events"]
    orders, details = staged["stg_orders"], staged["stg_order_details"]
    customers, products = staged["stg_customers"], staged["stg_products"]
    built = {
        "fct_daily_sales": marts.fct_daily_sales(transactions, start_date),
        "fct_order_performance": marts.fct_order_performance(orders, details),
        "fct_product_sales": marts.fct_product_sales(products, details, orders, customers, as_of),
        "dim_customer_metrics": marts.dim_customer_metrics(
            customers, orders, tables.order_details, as_of
        ),
        "dim_user_metrics": marts.dim_user_metrics(transactions, events, as_of),
    }
    database = sinks.layer_name(base, "marts", production)
    stored = {}
    for name, model in built.items():
        stamped = model.withColumn("updated_at", F.current_timestamp())
        sinks.publish_table(stamped, name, database)
        stored[name] = tables.spark.table(f"{database}.{name}")
    return {**staged, **stored}


def run_model_tests(tables: RetailTables, models: dict[str, DataFrame]) -> DataFrame:
    """The declared column tests over the sources and the published models."""
    sources = {
        name: tables.table("raw", name) for name in RetailTables.SOURCES["raw"]
    }
    return quality.run_suite({**sources, **models}, quality.declared_tests())


def run_quality(tables: RetailTables, as_of: str, target: str, database: str) -> DataFrame:
    """Run the order checks, append the metrics record and return the verdict."""
    checks = quality.all_checks(
        [
            quality.check_order_integrity(tables.orders, tables.order_details, as_of),
            quality.check_referential_integrity(
                tables.orders,
                tables.order_details,
                tables.products,
                tables.customers,
                tables.employees,
                tables.categories,
            ),
            quality.check_business_rules(tables.orders, tables.order_details, tables.products),
            quality.check_order_freshness(tables.orders, as_of),
        ]
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        record = quality.metrics_record(checks, as_of, database)
        sinks.write_files(record, f"{target}/quality_metrics", mode="append")
        sinks.write_files(quality.alert(checks), f"{target}/quality_alerts/run={as_of}")
        sinks.write_files(quality.verdict(checks), f"{target}/quality_verdict/run={as_of}")
    finally:
        checks.unpersist()
    return tables.spark.read.parquet(f"{target}/quality_verdict/run={as_of}")


def main() -> None:
    parser = argparse.ArgumentParser(description="Run one of the file jobs")
    parser.add_argument("job", choices=("aggregation", "transformation"))
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--input-bytes", type=int, default=0)
    args = parser.parse_args()
    spark = build_session(f"tillworks-{args.job}", args.input_bytes)
    run = run_aggregation if args.job == "aggregation" else run_transformation
    run(spark, args.input, args.output, args.format)
    spark.stop()


if __name__ == "__main__":
    main()
