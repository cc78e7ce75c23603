"""Functions that are stored in a layer and called from SQL."""

import datetime
import uuid
from decimal import Decimal

import pytest
from tillworks.functions import published
from tillworks.sinks import tables as sinks


@pytest.fixture
def layer(spark):
    name = f"layer_{uuid.uuid4().hex}"
    published.publish_functions(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_scalars(spark, layer):
    published.publish_functions(spark, layer)  # again: they are replaced
    row = spark.sql(
        f"""SELECT {layer}.cents_to_dollars(1234) AS a, {layer}.cents_to_dollars(0.50) AS half,
                   {layer}.cents_to_dollars(NULL) AS none,
                   {layer}.net_price(10.00, 3, 0.25) AS net,
                   {layer}.layer_name('retail', ' marts ', false) AS apart,
                   {layer}.layer_name('retail', ' marts ', true) AS live,
                   {layer}.layer_name('retail', 'marts', NULL) AS unset,
                   {layer}.layer_name('retail', NULL, true) AS base"""
    ).first()
    assert (row.a, row.half, row.none) == (Decimal("12.34"), Decimal("0.01"), None)
    assert row.net == Decimal("22.5")
    assert (row.apart, row.live, row.unset, row.base) == ("retail_marts", "marts", "retail_marts", "retail")


def test_scalars_are_part_of_the_plan(spark, layer):
    spark.range(5).selectExpr("CAST(id * 100 AS DECIMAL(18,2)) AS cents").createOrReplaceTempView("amounts")
    out = spark.sql(f"SELECT {layer}.cents_to_dollars(cents) AS d FROM amounts")
    assert [r.d for r in out.collect()] == [Decimal(k) for k in range(5)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "round(" in plan


def test_period_functions(spark, layer):
    day = datetime.date
    orders = [(1, 7, day(1997, 1, 1)), (2, 7, day(1997, 1, 1)), (3, 8, day(1997, 3, 31)), (4, 9, day(1997, 4, 1))]
    orders += [(5, None, None), (6, 99, day(1997, 2, 1))]
    customers = [(7, "a", "x", "C"), (8, "b", "y", "C"), (9, "c", "z", "D")]
    for name, rows, schema in (
        ("orders", orders, "order_id bigint, customer_id bigint, order_date date"),
        ("customers", customers, "customer_id bigint, company_name string, city string, country string"),
    ):
        sinks.publish_table(spark.createDataFrame(rows, schema), name, layer)
    published.publish_period_functions(spark, layer)
    quarter = spark.sql(f"SELECT * FROM {layer}_quarterly_orders(DATE '1997-01-01', DATE '1997-03-31')")
    # An order of an unknown customer gives a row of nulls.
    assert sorted((r.company_name for r in quarter.collect()), key=str) == sorted(["a", "b", None], key=str)
    days = spark.sql(f"SELECT * FROM {layer}_daily_orders(DATE '1997-01-01', DATE '1997-02-28')")
    assert sorted(map(tuple, days.collect())) == [(day(1997, 1, 1), 2, 1), (day(1997, 2, 1), 1, 1)]
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date" in plan
    for a, b in (("DATE '1997-03-31'", "DATE '1997-01-01'"), ("NULL", "DATE '1997-01-01'")):
        assert spark.sql(f"SELECT * FROM {layer}_quarterly_orders({a}, {b})").count() == 0
