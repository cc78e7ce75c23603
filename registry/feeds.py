"""Events as the two topics carry them, from the rows of the given tables.

An order gives a ``new_order`` event with its lines as items, an ``order_shipped`` event once it
has been sent, an ``order_delivered`` event when its status is F, and an ``order_returned`` event
when a line was sent back. What the tables do not say (payments, reasons for cancelling) is null.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.plans import staging
from tillworks.sources.tables import RetailTables
from tillworks.streaming.events import MONEY, ORDER_EVENT, USER_EVENT


def _shaped(rows: DataFrame, schema: str) -> DataFrame:
    """All columns of the schema, those that the rows lack as nulls."""
    empty = rows.sparkSession.createDataFrame([], schema)
    return empty.unionByName(rows, allowMissingColumns=True)


def _new_orders(t: RetailTables) -> DataFrame:
    names = t.products.select("product_id", "product_name")
    item = F.struct(
        "product_id",
        "product_name",
        F.round("unit_price", 2).cast(MONEY).alias("unit_price"),
        "quantity",
        F.col("discount").cast("decimal(5,3)").alias("discount"),
        F.round("extended_price", 2).cast(MONEY).alias("line_total"),
    )
    # Gathered per order: an array is as long as one order has lines.
    items = (
        staging.stg_order_details(t.order_details)
        .join(names, "product_id", "left")
        .groupBy("order_id")
        .agg(
            F.array_sort(F.collect_list(item)).alias("order_items"),
            F.sum(item["line_total"]).cast(MONEY).alias("order_total"),
            F.count(F.lit(1)).cast("int").alias("item_count"),
            F.sum("quantity").cast("int").alias("units_ordered"),
        )
    )
    buyers = t.customers.select(
        "customer_id", F.col("company_name").alias("customer_name"),
        F.col("country").alias("customer_country"), F.col("city").alias("customer_city"),
    )
    freight = F.round("freight", 2).cast(MONEY)
    total = F.coalesce("order_total", F.lit(0).cast(MONEY))
    return (
        t.orders.join(items, "order_id", "left")
        .join(buyers, "customer_id", "left")
        .select(
            "order_id",
            F.lit("new_order").alias("event_type"),
            F.col("order_date").cast("string").alias("timestamp"),
            F.col("customer_id").cast("string").alias("customer_id"),
            "customer_name",
            "customer_country",
            "customer_city",
            "employee_id",
            F.col("ship_via").alias("shipper_id"),
            F.col("order_date").cast("string").alias("order_date"),
            F.col("required_date").cast("string").alias("required_date"),
            freight.alias("freight"),
            F.coalesce("order_items", F.array().cast(items.schema["order_items"].dataType)).alias(
                "order_items"
            ),
            total.alias("order_total"),
            (total + freight).cast(MONEY).alias("grand_total"),
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
            F.coalesce("units_ordered", F.lit(0)).alias("units_ordered"),
        )
    )


def order_events(t: RetailTables) -> DataFrame:
    """The events of all orders."""
    carriers = t.shippers.select(
        F.col("shipper_id").alias("ship_via"), F.col("company_name").alias("shipper")
    )
    shipped = (
        t.orders.where("shipped_date is not null")
        .join(carriers, "ship_via", "left")
        .select(
            "order_id",
            F.lit("order_shipped").alias("event_type"),
            F.col("shipped_date").cast("string").alias("timestamp"),
            F.col("shipped_date").cast("string").alias("shipped_date"),
            "shipper",
        )
    )
    delivered = (
        t.file("orders")
        .where(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").alias("order_id"), F.lit("order_delivered").alias("event_type"))
    )
    returned = (
        t.file("lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(F.col("l_orderkey").alias("order_id"), F.lit("order_returned").alias("event_type"))
        .distinct()
    )
    rows = _new_orders(t)
    for more in (shipped, delivered, returned):
        rows = rows.unionByName(more, allowMissingColumns=True)
    name = F.concat_ws("-", "event_type", F.col("order_id").cast("string"))
    return _shaped(rows.withColumn("event_id", name), ORDER_EVENT)


def user_events(t: RetailTables) -> DataFrame:
    """One event per row of the event table. A failed view is what its user searched for."""
    kind = (
        F.when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "error", "search")
        .otherwise(F.col("event_type"))
    )
    place = F.get_json_object("props", "$.k")
    purchase = F.struct(
        place.cast("bigint").alias("product_id"),
        F.col("value").cast("decimal(10,2)").cast(MONEY).alias("amount"),
        F.lit(None).cast("string").alias("currency"),
    )
    rows = t.file("events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "user_id",
        kind.alias("event_type"),
        F.col("ts").cast("string").alias("timestamp"),
        F.concat(F.lit("/p"), place).alias("page"),
        F.when(kind == "purchase", purchase).alias("purchase_data"),
        F.when(kind == "search", place).alias("search_query"),
    )
    return _shaped(rows, USER_EVENT)
