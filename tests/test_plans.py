"""What reaches the scan, what is shuffled, and what is broadcast."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

import registry
from tillworks.operators import joins, windows
from tillworks.plans import jobs, marts, staging
from tillworks.sources.tables import RetailTables


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    return RetailTables(spark, sf_dir)


@pytest.fixture()
def large(spark):
    """Plan as for large tables: no side is small enough for an automatic broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(registry.QUERIES["s04_raw_zone_scan"](spark, sf_dir))
    assert "EqualTo(event_type,purchase)" in text
    text = plan(registry.QUERIES["p06_start_date"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts," in text and "props" not in text
    text = plan(registry.QUERIES["a38_order_subtotals"](spark, sf_dir))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(re.findall(r"(\w+):", read)) == {"l_orderkey", "l_extendedprice", "l_discount"}


def reduced_before_shuffle(text, column):
    """Every scan that reads the column is aggregated before its rows are exchanged."""
    scans = [m.start() for m in re.finditer(rf"FileScan parquet \[[^\]]*{column}", text)]
    return scans and all(
        "HashAggregate" in text[text.rindex("Exchange", 0, at) : at] for at in scans
    )


def test_revenue_by_country_joins_reduced_sides(t, large):
    text = plan(jobs.sales_by_country(t.orders, t.order_details, t.customers))
    assert text.count("SortMergeJoin") >= 2
    assert reduced_before_shuffle(text, "l_orderkey")


def test_only_fixed_dimensions_carry_a_broadcast_hint(t, large):
    text = plan(joins.order_context(t.orders, t.customers, t.employees, t.shippers))
    assert text.count("BroadcastExchange") == 2  # employees and shippers
    assert "SortMergeJoin" in text  # customers
    text = plan(staging.stg_products(t.products, t.categories, t.suppliers))
    assert text.count("BroadcastExchange") == 1  # categories


def test_order_performance_shuffles_sums_and_two_ids_of_a_line(t, large):
    df = marts.fct_order_performance(
        staging.stg_orders(t.orders), staging.stg_order_details(t.order_details)
    )
    text = plan(df)
    for scan in re.finditer(r"FileScan parquet \[[^\]]*l_orderkey.*?ReadSchema: struct<([^>]*)>", text):
        ids_only = set(re.findall(r"(\w+):", scan.group(1))) == {"l_orderkey", "l_partkey"}
        assert ids_only or "HashAggregate" in text[text.rindex("Exchange", 0, scan.start()) : scan.start()]


def test_hot_side_of_outer_joins_can_be_split(t, large):
    text = plan(
        joins.customer_orders(t.customers.select("customer_id"), t.orders, t.order_details)
    )
    assert re.search(r"SortMergeJoin \[customer_id#\d+L?\], \[customer_id#\d+L?\], Inner", text)
    assert not re.search(r"SortMergeJoin \[customer_id#\d+L?\].*LeftOuter", text)


def test_id_lists_carry_no_hint(t, large):
    ids = t.orders.limit(500)
    assert "BroadcastHashJoin" not in plan(joins.details_of(t.order_details, ids))


def scans(df, table):
    return plan(df).count(f"/{table}.parquet")


def test_category_summary_reads_the_lines_once(t, large):
    df = jobs.sales_by_category_summary(t.order_details, t.products, t.categories)
    assert scans(df, "lineitem") == 1


def test_customer_categories_and_product_metrics_read_the_lines_in_few_passes(t, large):
    df = jobs.customer_category_sales(
        t.orders, t.order_details, t.customers, t.products, t.categories
    )
    assert scans(df, "lineitem") == 1
    df = marts.product_metrics(
        staging.stg_products(t.products, t.categories, t.suppliers),
        staging.stg_order_details(t.order_details),
        staging.stg_orders(t.orders),
        staging.stg_customers(t.customers),
    )
    assert scans(df, "lineitem") == 2


def test_daily_revenue_reads_the_lines_twice_and_does_not_exchange_them_for_repeats(t, large):
    df = marts.daily_revenue(staging.stg_orders(t.orders), staging.stg_order_details(t.order_details))
    assert scans(df, "lineitem") == 2
    assert "hashpartitioning(order_id#" in plan(df)
    # No exchange by order and product together: repeats go in the distinct count.
    assert not re.search(r"hashpartitioning\(order_id#\d+L?, product_id", plan(df))


def test_window_pass_has_one_full_exchange_and_stores_nothing(spark, t, large, monkeypatch):
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.checkpoint", None)
    sales = t.sales_transactions.select(
        "transaction_id", "user_id", "amount", "transaction_date", F.lit("x" * 9).alias("rest")
    )
    text = plan(windows.user_sequence(sales, partitions=4))
    assert "rangepartitioning" not in text and "CheckpointRDD" not in text
    full = [m for m in re.finditer(r"Exchange hashpartitioning\(_part", text)]
    # One with all columns; the carry table's own has the keys and the value only.
    assert len(full) <= 2


def test_global_rank_sends_only_carries_to_one_task(t, large):
    ranked = jobs.ranked_customers(
        t.orders.groupBy("customer_id").agg(F.sum("freight").alias("total_revenue")), partitions=4
    )
    for part in plan(ranked).split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in part or "SortAggregate" in part


def test_hot_keys_are_split_at_run_time(spark, large):
    """One customer holds a third of the orders; thresholds are lowered to the size of a test."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = 60_000
        hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
        orders = spark.range(0, rows, 1, 8).select(
            F.col("id").alias("order_id"),
            hot.alias("customer_id"),
            F.md5(F.col("id").cast("string")).alias("note"),
        )
        customers = spark.range(0, 600, 1, 4).select(
            F.col("id").alias("customer_id"), F.concat(F.lit("c"), "id").alias("company_name")
        )
        joined = joins.with_children(customers, orders, "customer_id")
        collected = joined.collect()
        assert "skew=true" in plan(joined)
        assert len(collected) == rows + 100  # the customers 500 to 599 have no orders
        assert sum(r.customer_id == 7 for r in collected) >= rows // 3
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_pairs_of_products_and_orders_are_not_gathered_into_few_tasks(spark):
    lines = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 3), (3, None)], "product_id bigint, order_id bigint")
    orders = spark.createDataFrame(
        [(1, datetime.date(2000, 1, 1), 7), (2, datetime.date(2000, 3, 1), 8)],
        "order_id bigint, order_date date, customer_id bigint",
    )
    customers = spark.createDataFrame([(7, "Peru"), (8, None)], "customer_id bigint, country string")
    reach = marts._product_reach(lines, orders, customers)
    first, last = datetime.date(2000, 1, 1), datetime.date(2000, 3, 1)
    assert sorted(map(tuple, reach.collect())) == [
        (1, 2, 2, 1, first, last, 2), (2, 1, 0, 0, None, None, 0), (3, 0, 0, 0, None, None, 0),
    ]
    plan = reach._jdf.queryExecution().executedPlan().toString()
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spread = [x for x in plan.splitlines() if "REPARTITION_BY_NUM" in x]
    assert spread and all(f", {tasks})" in x for x in spread)
