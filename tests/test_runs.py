"""Whole runs on small inputs, with results worked out by hand."""

from datetime import datetime
from decimal import Decimal

import pytest

from tillworks import session
from tillworks.plans import runs
from tillworks.sources.tables import RetailTables


def D(text):
    return Decimal(text)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    rows = [
        (1, 7, 1, "900.00", "2024-01-01 10:00:00", "completed"),
        (2, 7, 2, "50.00", "2024-01-01 12:00:00", "completed"),
        (3, 7, 1, "60.00", "2024-02-03 09:00:00", "completed"),
        (4, 8, 2, "50.00", "2024-02-03 10:00:00", "failed"),
        (5, 9, 2, "70.00", "2024-02-04 10:00:00", "completed"),
    ]
    sales = [(a, b, c, D(d), "USD", datetime.fromisoformat(e), f) for a, b, c, d, e, f in rows]
    spark.createDataFrame(sales, runs.TRANSACTIONS).write.parquet(f"{folder}/transactions")
    users = [(7, "ann", "a@x", "2023-12-31", "UK"), (8, "bob", "b@x", "2023-01-01", "USA")]
    spark.createDataFrame(users, runs.USERS).write.parquet(f"{folder}/users")
    goods = [(1, "pad", "Electronics", D("900.00")), (2, "desk", "Furniture", D("50.00"))]
    spark.createDataFrame(goods, runs.PRODUCTS).write.parquet(f"{folder}/products")
    return folder


def test_aggregation(spark, lake, tmp_path):
    out = str(tmp_path)
    for _ in range(2):  # a rerun overwrites
        runs.run_aggregation(spark, lake, out)
    users = {r.user_id: r for r in spark.read.parquet(f"{out}/user_aggregations").collect()}
    assert sorted(users) == [7, 9]
    top = users[7]
    assert (top.total_transactions, top.total_spent, top.min_transaction) == (3, D("1010.00"), D("50.00"))
    assert top.avg_transaction_value == pytest.approx(1010 / 3)
    products = spark.read.parquet(f"{out}/product_aggregations").collect()
    assert {r.product_id: r.total_revenue for r in products} == {1: D("960.00"), 2: D("120.00")}
    days = spark.read.parquet(f"{out}/time_aggregations")
    assert {(r.year, r.month, r.day): r.daily_transactions for r in days.collect()} == {
        (2024, 1, 1): 2, (2024, 2, 3): 1, (2024, 2, 4): 1}


def test_transformation(spark, lake, tmp_path):
    out = str(tmp_path)
    runs.run_transformation(spark, lake, out)
    assert spark.read.parquet(f"{out}/enriched_transactions").count() == 5
    rows = {r.transaction_id: r for r in spark.read.parquet(f"{out}/windowed_transactions").collect()}
    # Both transactions of a day carry the day's running total.
    assert [rows[i].user_running_total for i in (1, 2, 3)] == [D("950.00"), D("950.00"), D("1010.00")]
    assert [rows[i].user_transaction_number for i in (1, 2, 3)] == [1, 2, 3]
    assert (rows[2].previous_transaction_amount, rows[2].next_transaction_amount) == (D("900.00"), D("60.00"))
    assert rows[1].previous_transaction_amount is None and rows[3].next_transaction_amount is None
    assert [rows[i].category_sales_rank for i in (1, 3, 5, 2, 4)] == [1, 2, 1, 2, 2]
    assert [rows[i].monthly_transaction_rank for i in (5, 3, 4)] == [1, 2, 3]
    segments = {r.user_id: r for r in spark.read.parquet(f"{out}/user_segments").collect()}
    assert (segments[7].spending_segment, segments[7].purchase_frequency) == ("High Value", "Regular")
    assert segments[7].product_preference == "Mixed Buyer" and segments[9].username is None
    summary = spark.read.parquet(f"{out}/country_category_summary").collect()
    assert {(r.country, r.category): r.transactions for r in summary} == {
        ("UK", "Electronics"): 2, ("UK", "Furniture"): 1, ("USA", "Furniture"): 1,
        (None, "Furniture"): 1}


def test_models_and_their_tests(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    models = runs.run_models(t, "shop", "2001-08-02", "2024-01-05")
    assert spark.table("shop_marts.fct_product_sales").count() == t.products.count()
    assert "updated_at" in spark.table("shop_marts.dim_user_metrics").columns
    assert spark.table("stg_orders").count() == t.orders.count()
    results = runs.run_model_tests(t, models)
    assert results.filter("not passed").count() == 0 and results.count() > 50


def test_quality_run_keeps_a_record_per_run(spark, sf_dir, tmp_path):
    t = RetailTables(spark, sf_dir)
    for day in ("2001-08-02", "2001-12-24"):
        outcome = runs.run_quality(t, day, str(tmp_path), "shop").first().outcome
        assert outcome == "quality_failed"
    records = spark.read.parquet(f"{tmp_path}/quality_metrics")
    assert sorted(r.data_age_days for r in records.collect())[1] > 90
    alerts = spark.read.parquet(f"{tmp_path}/quality_alerts")
    assert alerts.filter("check_name = 'data_freshness'").count() == 1


def test_daily_etl(spark, sf_dir):
    t = RetailTables(spark, sf_dir)
    for _ in range(2):
        runs.run_daily_etl(t, "etl", "2001-08-02")
    runs.run_daily_etl(t, "etl", "2030-01-01")  # no orders at all
    days = {str(r.date): r for r in spark.table("etl.daily_sales_summary").collect()}
    assert sorted(days) == ["2001-08-02", "2030-01-01"]
    assert days["2001-08-02"].total_orders > 0
    assert (days["2030-01-01"].total_orders, days["2030-01-01"].total_revenue) == (0, None)
    assert spark.table("etl.daily_country_sales").filter("date = '2030-01-01'").count() == 0


def test_shuffle_partitions_follow_the_input():
    assert session.shuffle_partitions(0) == 200
    assert session.shuffle_partitions(1 << 40) == 4096
    assert session.shuffle_partitions(100 << 40) == 409_600


def test_a_running_session_is_left_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert session.build_session("other", input_bytes=1 << 50) is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
