"""Joins, filters, scalars and checks on rows that the given tables lack."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillworks.functions import scalars
from tillworks.operators import aggregates, filters, joins, ordering, quality, windows
from tillworks.plans import jobs, marts, staging
from tillworks.sources import readers


def D(text):
    return Decimal(text)


@pytest.fixture(scope="module")
def shop(spark):
    """A tiny shop with a hot customer, orders without lines, orphans and nulls."""
    orders = [(i, 1 if i <= 6 else i, 1, date(2024, 1, 1 + i % 3),
               date(2024, 1, 10), date(2024, 1, 5) if i % 2 else None, 1, D("10.50"))
              for i in range(1, 10)]
    orders += [(10, None, None, date(2024, 1, 9), None, None, 1, D("1.00")),
               (11, 99, 77, date(2024, 1, 9), date(2024, 1, 1), date(2024, 1, 1), 1, D("2.00"))]
    details = [(i, p, D("10.00"), p, D("0.100")) for i in range(1, 9) for p in (1, 2)]
    details += [(1, 55, D("0.00"), 0, D("1.500"))]
    products = [(1, "tea", 1, 1, "box", D("10.0000"), 5, 0, 5, False),
                (2, "ink", 1, 2, "jar", D("60.0000"), 40, 0, 5, True),
                (3, "cup", 2, None, "box", D("25.0000"), 0, 0, 5, False),
                (4, "pen", 2, 9, "box", D("25.0000"), 0, 0, 5, False)]
    customers = [(i, f"C{i}", f"P{i}", "Owner", None, " Oslo ", None, None, "Norway", None, None)
                 for i in [1, *range(7, 10), 50]]
    return {
        "orders": spark.createDataFrame(
            orders, "order_id long, customer_id long, employee_id int, order_date date,"
            " required_date date, shipped_date date, ship_via int, freight decimal(18,6)"),
        "details": spark.createDataFrame(
            details, "order_id long, product_id long, unit_price decimal(10,2), quantity int,"
            " discount decimal(5,3)"),
        "products": spark.createDataFrame(
            products, "product_id long, product_name string, supplier_id long, category_id int,"
            " quantity_per_unit string, unit_price decimal(18,4), units_in_stock int,"
            " units_on_order int, reorder_level int, discontinued boolean"),
        "customers": spark.createDataFrame(
            customers, "customer_id long, company_name string, contact_name string,"
            " contact_title string, address string, city string, region string,"
            " postal_code string, country string, phone string, fax string"),
        "employees": spark.createDataFrame([(1, "Ann", "Lee")],
                                           "employee_id int, first_name string, last_name string"),
        "categories": spark.createDataFrame([(1, "Food"), (2, "Office")],
                                            "category_id int, category_name string"),
        "suppliers": spark.createDataFrame([(1, "S1", "Peru")],
                                           "supplier_id long, company_name string, country string"),
    }


def test_literal_sources(spark):
    typed = readers.literal_rows(spark, [(1, "a", 1.5)], "id int, name string, price double")
    assert typed.dtypes == [("id", "int"), ("name", "string"), ("price", "double")]
    guessed = readers.inferred_rows(spark, [(1, "a", 1.5)], ["id", "name", "price"])
    assert guessed.dtypes == [("id", "bigint"), ("name", "string"), ("price", "double")]


def test_raw_zone_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    for format in ("parquet", "json", "csv", "orc"):
        path = str(tmp_path / format)
        df.write.format(format).save(path)
        got = readers.raw_zone(spark, path, "id int, name string", format)
        assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "b")]


def test_referential_integrity_counts_orphans(shop):
    s = shop
    issues = quality.referential_issues(
        s["orders"], s["details"], s["products"], s["customers"], s["employees"], s["categories"])
    assert {r.relation: r.issues for r in issues.collect()} == {
        # Null counts for customers and products, not for employees and categories.
        "Orphaned customers": 2, "Orphaned employees": 1,
        "Orphaned products": 1, "Orphaned categories": 1,
    }
    check = quality.check_referential_integrity(
        s["orders"], s["details"], s["products"], s["customers"], s["employees"], s["categories"])
    assert check.first().passed is False


def test_business_rules_count_each_violation(shop):
    s = shop
    got = quality.business_rule_violations(s["orders"], s["details"], s["products"])
    assert {r.rule: r.violations for r in got.collect()} == {
        "Negative/zero unit prices": 1, "Negative/zero quantities": 1, "Invalid discounts": 1,
        "Shipped before ordered": 1, "Required before ordered": 1, "Discontinued with stock": 1,
    }
    check = quality.check_business_rules(s["orders"], s["details"], s["products"], at_most=5)
    assert (check.first().value, check.first().passed) == (6.0, False)


def test_integrity_without_orders_is_zero(shop):
    check = quality.check_order_integrity(shop["orders"], shop["details"], "2030-01-01")
    assert tuple(check.first()) == ("order_integrity", 0.0, False)


def test_order_integrity_share(shop):
    row = quality.order_integrity(shop["orders"], shop["details"], "2024-01-08").first()
    assert (row.total_orders, row.orders_with_items, row.orders_without_items) == (11, 8, 3)


def test_verdict_alert_and_metrics(spark):
    checks = spark.createDataFrame(
        [("order_integrity", 97.0, True), ("referential_integrity", 3.0, False),
         ("business_rules", 0.0, True), ("data_freshness", 1.0, True)],
        "check_name string, value double, passed boolean")
    assert tuple(quality.verdict(checks).first()) == (4, 1, "quality_failed")
    assert tuple(quality.verdict(checks.filter("passed")).first()) == (3, 0, "quality_passed")
    assert [tuple(r) for r in quality.alert(checks).collect()] == [("referential_integrity", 3.0)]
    record = quality.metrics_record(checks, "2024-01-01 00:00:00", "shop").first()
    assert (record.database, record.integrity_score_pct, record.referential_issues) == (
        "shop", 97.0, 3.0)


def test_event_checks_at_their_thresholds(spark):
    now = "2024-01-01 12:00:00"
    rows = [(i, i if i % 10 else None, "view", datetime(2024, 1, 1, 11, 0, i), ) for i in range(50)]
    events = spark.createDataFrame(
        rows, "event_id int, user_id int, event_type string, created_at timestamp_ntz"
    ).withColumn("event_timestamp", F.col("created_at"))
    fresh = quality.check_event_freshness(events, now).first()
    assert fresh.passed is True and fresh.value == pytest.approx(3551 / 60)
    stale = quality.check_event_freshness(events, "2024-01-01 12:00:49").first()
    assert (stale.value, stale.passed) == (60.0, False)
    complete = quality.check_event_completeness(events, now).first()
    assert complete.value == pytest.approx((1 - 5 / 150) * 100) and complete.passed
    assert tuple(quality.check_event_volume(events, now).first()) == ("event_volume", 50.0, False)
    none = quality.check_event_completeness(events, "2024-01-02 12:00:00").first()
    assert (none.value, none.passed) == (0.0, False)
    assert quality.check_event_freshness(events.limit(0), now).first().passed is False


def test_column_tests(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 5), (None, None, None), (None, "z", 9)], "k int, s string, n int")
    count = lambda test: quality.failures(df, test).first().failures
    assert count(quality.unique("t", "k")) == 1
    assert count(quality.not_null("t", "k")) == 2
    assert count(quality.accepted_values("t", "s", ["a", "b"])) == 1
    assert count(quality.accepted_range("t", "n", 1, 5)) == 1
    assert count(quality.expression_is_true("t", "n < 9")) == 2
    suite = quality.run_suite({"t": df}, [
        quality.unique("t", "k"), quality.not_null("t", "k"), quality.not_null("t", "n"),
        quality.accepted_range("t", "n", 0, 100)])
    assert {(r.test_name, r.column_name): (r.failures, r.passed) for r in suite.collect()} == {
        ("unique", "k"): (1, False), ("not_null", "k"): (2, False), ("not_null", "n"): (1, False),
        ("accepted_range", "n"): (0, True)}


def test_customers_without_orders_are_kept(shop):
    rows = marts.dim_customer_metrics(
        staging.stg_customers(shop["customers"]),
        staging.stg_orders(shop["orders"].withColumn("ship_country", F.lit("x"))),
        shop["details"], "2024-02-01").collect()
    idle = next(r for r in rows if r.customer_id == 50)
    assert (idle.total_orders, idle.lifetime_value, idle.avg_order_value) == (0, None, 0.0)
    assert (idle.value_segment, idle.frequency_segment) == ("No Orders", "Never Ordered")
    assert (idle.activity_status, idle.customer_tier) == ("Never Ordered", "New Customer")
    assert (idle.active_days, idle.active_months) == (0, 0)
    busy = next(r for r in rows if r.customer_id == 1)
    # Six orders with two lines each and one with an extra line: freight counts per line.
    assert busy.total_orders == 6 and busy.total_freight_paid == D("136.500000")
    assert busy.active_days == 3 and busy.city == " Oslo "


def test_freight_once_per_order(shop):
    rows = marts.customer_aggregates(
        staging.stg_customers(shop["customers"]), staging.stg_orders(shop["orders"]),
        shop["details"], freight_grain="order").collect()
    busy = next(r for r in rows if r.customer_id == 1)
    assert busy.total_freight_paid == D("63.000000") and busy.avg_freight_per_order == 10.5


def test_unsold_products_are_kept(shop):
    s = shop
    rows = marts.fct_product_sales(
        staging.stg_products(s["products"], s["categories"], s["suppliers"]),
        staging.stg_order_details(s["details"]), staging.stg_orders(s["orders"]),
        staging.stg_customers(s["customers"]), "2024-02-01").collect()
    pen = next(r for r in rows if r.product_id == 4)
    assert (pen.times_ordered, pen.total_revenue, pen.performance_tier) == (0, None, "Never Sold")
    assert (pen.units_per_month, pen.days_of_stock_remaining, pen.pct_of_category_revenue) == (
        0.0, None, 0.0)
    tea = next(r for r in rows if r.product_id == 1)
    assert (tea.times_ordered, tea.unique_customers, tea.countries_sold_to) == (8, 3, 1)
    assert tea.total_revenue == D("72.0000000") and tea.pct_of_category_revenue == 100.0


def test_right_join_keeps_unknown_customer_once(shop):
    got = joins.customers_who_ordered(shop["customers"], shop["orders"], "2024-01-09", "2024-01-09")
    assert [tuple(r) for r in got.collect()] == [(None, None, None, None)]


def test_zero_totals_and_semi_joins(shop):
    totals = {r.order_id: r.order_total for r in joins.orders_with_zero_totals(
        shop["orders"].select("order_id"), shop["details"]).collect()}
    assert totals[9] == 0 and totals[2] == D("27.0000000") and len(totals) == 11
    newest = ordering.latest(shop["orders"], "order_date", "order_id", 3)
    assert [r.order_id for r in newest.orderBy("order_id").collect()] == [8, 10, 11]
    assert joins.details_of(shop["details"], newest).count() == 2
    assert joins.details_of(shop["details"], newest).count() == 2


def test_enrich_keeps_unmatched_and_flags_unknown_as_false(spark):
    t = spark.createDataFrame(
        [(1, 1, 1, D("5.00"), "2024-01-05", "completed"), (2, 9, 9, D("6.00"), "2024-01-06", "x")],
        "transaction_id int, user_id int, product_id int, amount decimal(12,2),"
        " transaction_date string, status string")
    u = spark.createDataFrame([(1, "ann", "e", "2024-01-01", "UK")],
                              "user_id int, username string, email string,"
                              " registration_date string, country string")
    p = spark.createDataFrame([(1, "pad", "Electronics", 5.0)],
                              "product_id int, product_name string, category string, price double")
    rows = {r.transaction_id: r for r in joins.enrich_transactions(t, u, p).collect()}
    assert (rows[1].user_full_name, rows[1].days_since_registration) == ("ann (UK)", 4)
    assert (rows[1].is_electronics, rows[1].transaction_year_month) == (True, "2024-01")
    assert (rows[2].user_full_name, rows[2].is_electronics) == (None, False)


def test_previous_day_or_week(spark):
    rows = [(i, date(2024, 1, d)) for i, d in enumerate([1, 3, 8, 9, 10, 11])] + [(9, None)]
    df = spark.createDataFrame(rows, "order_id int, shipped_date date")
    pick = lambda d: sorted(
        r.order_id for r in filters.previous_day_or_week(df, "shipped_date", d).collect())
    assert pick("2024-01-10") == [3]
    assert pick("2024-01-15") == [2, 3, 4, 5]
    assert pick("2024-03-01") == []


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.pair_name(F.lit("7:tea:x")).alias("pair"),
        scalars.pair_name(F.lit("plain")).alias("plain"),
        scalars.full_name(F.lit("a"), F.lit(None).cast("string")).alias("no_name"),
        scalars.epoch_millis_date(F.lit(1704067200000)).alias("day"),
        scalars.cents_to_dollars(F.lit(12345)).alias("dollars"),
        scalars.half_up(F.lit(1.005), 2).alias("up"),
        scalars.ratio(F.lit(1), F.lit(0), 2).alias("zero"),
        scalars.ratio(F.lit(1), F.lit(0), 2, otherwise=None).alias("none"),
        scalars.percent(F.lit(1), F.lit(3)).alias("third"),
        scalars.weekday(F.lit("2024-01-07").cast("date")).alias("sunday"),
        scalars.truncated("hour", F.lit("2024-01-07 13:45:01").cast("timestamp_ntz")).alias("h"),
        scalars.json_text(F.lit('{"a":{"b":"c"}}'), "a", "b").alias("json"),
    ).first()
    assert (row.pair, row.plain, row.no_name, row.day) == ("tea", "plain", None, date(2024, 1, 1))
    assert (row.dollars, row.up, row.zero, row.none, row.third) == (D("123.45"), 1.01, 0.0, None, 33.33)
    assert (row.sunday, row.h, row.json) == (0, datetime(2024, 1, 7, 13), "c")


def test_rounding_is_exact_and_has_no_cap(spark):
    def of(x):
        return F.lit(x).cast("double")

    money = "decimal(28,7)"
    row = spark.range(1).select(
        scalars.half_up(of(2.3449996), 2).alias("a"),
        scalars.half_up(of(-2.345), 2).alias("b"),
        scalars.half_up(of(2.5e12), 2).alias("c"),
        scalars.ratio(F.lit("2.3449999").cast(money), F.lit(1), 2).alias("d"),
        scalars.ratio(F.lit("-2.345").cast(money), F.lit(1), 2).alias("e"),
        scalars.ratio(F.lit("2500000000000").cast(money), F.lit(1), 2).alias("f"),
        scalars.ratio(F.lit("2.345").cast(money), F.lit(1), 2).alias("g"),
        scalars.ratio(F.lit(7), F.lit(3).cast("bigint"), 1).alias("h"),
        scalars.percent(F.lit("0.0234499").cast(money), F.lit(100), 4).alias("i"),
        scalars.ratio(F.lit(None).cast(money), F.lit(3), 1).alias("j"),
        scalars.ratio(F.lit(3), F.lit(None).cast("int"), 1).alias("k"),
    ).first()
    assert tuple(row) == (2.34, -2.35, 2.5e12, 2.34, -2.35, 2.5e12, 2.35, 2.3, 0.0234, None, 0.0)


def test_ranked_customers_quartiles(spark):
    rows = [(i, D(f"{100 - i // 2}.00")) for i in range(10)]
    df = spark.createDataFrame(rows, "customer_id long, total_revenue decimal(12,2)")
    got = {r.customer_id: (r.revenue_rank, r.revenue_quartile)
           for r in jobs.ranked_customers(df, partitions=4).collect()}
    assert [got[i] for i in range(10)] == [
        (1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 2), (7, 3), (8, 3), (9, 4), (10, 4)]


def test_windows_refuse_unknown_function(spark):
    df = spark.createDataFrame([(1, 2)], "id int, x int")
    with pytest.raises(ValueError):
        windows.spread_window(df, [], windows.ascending("x"), ["id"], {"y": "median"})


def test_value_set_and_null_profile(spark):
    df = spark.createDataFrame([("b", 1), ("a", None), ("b", 3)], "k string, v int")
    assert [r.ks for r in aggregates.value_set(df, "k", "ks").collect()] == ["a", "b"]
    row = aggregates.null_profile(df, {"v": "null_v"}).first()
    assert (row.total_records, row.null_v) == (3, 1)
