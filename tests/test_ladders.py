"""Each ladder at its exact thresholds, just beside them, at zero and at null."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillworks.functions import ladders as lad

EDGES = [
    (lad.spending_segment, "double",
     [(1000, "High Value"), (999.99, "Medium Value"), (500, "Medium Value"),
      (499.99, "Low Value"), (None, "Low Value")]),
    (lad.purchase_frequency, "int",
     [(5, "Frequent"), (4, "Regular"), (3, "Regular"), (2, "Occasional"), (None, "Occasional")]),
    (lad.product_preference, "double",
     [(0.7, "Electronics Enthusiast"), (0.69, "Mixed Buyer"), (0.3, "Mixed Buyer"),
      (0.29, "Furniture Focused"), (None, "Furniture Focused")]),
    (lad.transaction_tier, "double",
     [(1000, "high"), (999.99, "medium"), (100, "medium"), (99.99, "low"), (None, "low")]),
    (lad.transaction_value_label, "double",
     [(1000, "High Value"), (100, "Medium Value"), (0, "Low Value")]),
    (lad.freight_tier, "double",
     [(100, "High Freight"), (99.99, "Medium Freight"), (20, "Medium Freight"),
      (19.99, "Low Freight"), (None, "Low Freight")]),
    (lad.quantity_tier, "int",
     [(50, "Bulk Order"), (49, "Large Order"), (20, "Large Order"), (19, "Standard Order"),
      (5, "Standard Order"), (4, "Small Order"), (None, "Small Order")]),
    (lad.price_tier, "double",
     [(50, "Premium"), (49.99, "Mid-Range"), (20, "Mid-Range"), (19.99, "Economy"),
      (None, "Economy")]),
    (lad.customer_value, "double",
     [(10000, "VIP"), (5000, "High Value"), (1000, "Medium Value"), (0.01, "Low Value"),
      (0, "No Orders"), (None, "No Orders")]),
    (lad.customer_frequency, "int",
     [(20, "Frequent"), (19, "Regular"), (10, "Regular"), (5, "Occasional"), (1, "One-Time"),
      (0, "Never Ordered")]),
    (lad.customer_activity, "int",
     [(None, "Never Ordered"), (30, "Active"), (31, "At Risk"), (90, "At Risk"),
      (91, "Dormant"), (180, "Dormant"), (181, "Churned")]),
    (lad.user_segment, "double",
     [(1000, "VIP"), (500, "High Value"), (100, "Medium Value"), (0.01, "Low Value"),
      (0, "No Purchase")]),
    (lad.user_activity, "int",
     [(7, "Active"), (8, "At Risk"), (30, "At Risk"), (90, "Dormant"), (91, "Churned"),
      (None, "Churned")]),
    (lad.performance_tier, "double",
     [(10000, "Star Product"), (5000, "High Performer"), (1000, "Solid Performer"),
      (0.01, "Low Performer"), (0, "Never Sold"), (None, "Never Sold")]),
    (lad.region_group, "string",
     [("USA", "North America"), ("Portugal", "Europe"), ("Venezuela", "South America"),
      ("Japan", "Other"), (None, "Other")]),
    (lad.contact_type, "string",
     [("OWNER/Marketing manager", "Owner"), ("Sales MANAGER", "Manager"),
      ("Sales Representative", "Sales Rep"), ("Sales Agent", "Agent"), ("Clerk", "Other"),
      (None, "Other")]),
    (lad.is_high_value_line, "double", [(1000, True), (999.99, False), (None, False)]),
]


@pytest.mark.parametrize("ladder,kind,cases", EDGES, ids=[e[0].__name__ for e in EDGES])
def test_one_value_ladder(spark, ladder, kind, cases):
    values = [(float(v) if kind == "double" and v is not None else v, want) for v, want in cases]
    label = "boolean" if isinstance(cases[0][1], bool) else "string"
    df = spark.createDataFrame(values, f"x {kind}, want {label}")
    rows = df.select("x", "want", ladder(F.col("x")).alias("got")).collect()
    assert [(r.x, r.got) for r in rows] == [(r.x, r.want) for r in rows]


def test_discount_tier_compares_decimals_exactly(spark):
    rows = [(Decimal(v), want) for v, want in [
        ("0.200", "High Discount"), ("0.199", "Medium Discount"), ("0.100", "Medium Discount"),
        ("0.099", "Low Discount"), ("0.001", "Low Discount"), ("0.000", "No Discount")]]
    df = spark.createDataFrame(rows, "x decimal(5,3), want string")
    assert df.filter(lad.discount_tier(F.col("x")) != F.col("want")).count() == 0


def test_shipping_performance(spark):
    rows = [
        (None, "2024-01-10", "Not Shipped"), ("2024-01-10", "2024-01-10", "On Time"),
        ("2024-01-11", "2024-01-10", "Slightly Late"),
        ("2024-01-13", "2024-01-10", "Slightly Late"), ("2024-01-14", "2024-01-10", "Late"),
        ("2024-01-14", None, "Late"),
    ]
    df = spark.createDataFrame(rows, "s string, r string, want string").select(
        F.col("s").cast("date").alias("s"), F.col("r").cast("date").alias("r"), "want"
    )
    got = df.select("want", lad.shipping_performance(F.col("s"), F.col("r")).alias("got"))
    assert all(r.want == r.got for r in got.collect())


def test_stock_ladders(spark):
    rows = [
        (0, 5, False, "Out of Stock", "Out of Stock", True, "LOW STOCK"),
        (5, 5, False, "Low Stock", "Low Stock", True, "LOW STOCK"),
        (15, 5, False, "Normal", "Available", False, "NORMAL"),
        (16, 5, False, "Overstocked", "Available", False, "OVERSTOCKED"),
        (0, 5, True, "Normal", "Discontinued", False, "LOW STOCK"),
        (16, 5, True, "Overstocked", "Discontinued", False, "OVERSTOCKED"),
        (None, 5, False, "Normal", "Available", False, "NORMAL"),
    ]
    df = spark.createDataFrame(
        rows, "s int, r int, d boolean, w1 string, w2 string, w3 boolean, w4 string"
    )
    s, r, d = F.col("s"), F.col("r"), F.col("d")
    got = df.select(
        "*",
        lad.stock_status(s, r, d).alias("g1"),
        lad.product_status(s, r, d).alias("g2"),
        lad.needs_reorder(s, r, d).alias("g3"),
        lad.inventory_status(s, r).alias("g4"),
    ).collect()
    for x in got:
        assert (x.g1, x.g2, x.g3, x.g4) == (x.w1, x.w2, x.w3, x.w4)


def test_customer_tier_order(spark):
    rows = [
        ("VIP", "Frequent", 25, 30, "Champion"), ("VIP", "Frequent", 25, None, "Champion"),
        ("VIP", "Frequent", 25, 31, "Loyal"), ("High Value", "Regular", 12, 300, "Loyal"),
        ("VIP", "Occasional", 6, 91, "At Risk VIP"), ("VIP", "Occasional", 6, 90, "Standard"),
        ("Low Value", "One-Time", 2, 90, "New Customer"), ("Low Value", "One-Time", 2, 181, "Lost"),
        ("Low Value", "One-Time", 2, 100, "Standard"), ("Low Value", "One-Time", 3, 181, "Lost"),
        ("No Orders", "Never Ordered", 0, None, "New Customer"),
    ]
    df = spark.createDataFrame(rows, "v string, f string, n int, d int, want string")
    tier = lad.customer_tier(F.col("v"), F.col("f"), F.col("n"), F.col("d"))
    assert [(r.want, r.got) for r in df.select("want", tier.alias("got")).collect()] == [
        (r[4], r[4]) for r in rows
    ]


def test_inventory_action_order(spark):
    rows = [
        (True, "Out of Stock", 9999.0, 1, "Discontinued"),
        (False, "Out of Stock", 1000.01, 1, "URGENT: Restock High Seller"),
        (False, "Out of Stock", 1000.0, 1, "Normal"),
        (False, "Low Stock", 5000.01, 1, "High Priority Restock"),
        (False, "Low Stock", 5000.0, 1, "Monitor Stock"),
        (False, "Low Stock", None, None, "Monitor Stock"),
        (False, "Overstocked", 1.0, 91, "Liquidate Excess"),
        (False, "Overstocked", 1.0, 90, "Reduce Inventory"),
        (False, "Overstocked", None, None, "Reduce Inventory"),
        (False, "Normal", 1.0, 1, "Normal"),
    ]
    df = spark.createDataFrame(rows, "x boolean, s string, r double, d int, want string")
    action = lad.inventory_action(F.col("x"), F.col("s"), F.col("r"), F.col("d"))
    got = df.select("want", action.alias("got")).collect()
    assert all(r.want == r.got for r in got)
