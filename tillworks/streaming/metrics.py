"""Live figures and feeds over decoded events.

Every function takes a batch or a streaming DataFrame. Tallies return mergeable counts and
sums per key; reports turn tallies into the figures that are shown.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import ladders, scalars
from tillworks.operators import ordering

ORDER_TYPES = (
    "new_order",
    "payment_confirmed",
    "order_shipped",
    "order_delivered",
    "order_cancelled",
)


def _kind(events: DataFrame):
    return F.coalesce(F.col("event_type"), F.lit("unknown"))


def of_type(events: DataFrame, kind: str) -> DataFrame:
    return events.filter(F.col("event_type") == kind)


# Tallies: mergeable per key


def tally_types(events: DataFrame) -> DataFrame:
    return events.groupBy(_kind(events).alias("event_type")).agg(
        F.count(F.lit(1)).alias("events")
    )


def tally_users(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))


def tally_orders(events: DataFrame, high_value: float = 1000) -> DataFrame:
    """Counters over all events: orders, money, items, units and outcomes."""
    kind, total = F.col("event_type"), F.col("order_total")
    new = kind == "new_order"

    def added(column: str):
        return F.coalesce(F.sum(F.when(new, F.col(column))), F.lit(0))

    return events.groupBy().agg(
        F.count(F.lit(1)).alias("total_events"),
        scalars.count_where(new).alias("total_orders"),
        added("order_total").alias("total_revenue"),
        added("item_count").alias("total_items_sold"),
        added("units_ordered").alias("units_ordered"),
        scalars.count_where(new & (total > high_value)).alias("high_value_orders"),
        scalars.count_where(kind == "order_delivered").alias("delivered_orders"),
        scalars.count_where(kind == "order_cancelled").alias("cancelled_orders"),
    )


def tally_countries(events: DataFrame) -> DataFrame:
    country = F.coalesce(F.col("customer_country"), F.lit("Unknown")).alias("country")
    return of_type(events, "new_order").groupBy(country).agg(
        F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum("order_total"), F.lit(0)).alias("revenue"),
    )


def order_items(events: DataFrame) -> DataFrame:
    """One row per ordered item."""
    return of_type(events, "new_order").select(
        "order_id", F.explode("order_items").alias("item")
    ).select("order_id", "item.*")


def tally_products(events: DataFrame) -> DataFrame:
    return order_items(events).groupBy("product_id", "product_name").agg(
        F.sum(F.coalesce(F.col("quantity"), F.lit(0))).alias("units")
    )


def tally_customers(events: DataFrame) -> DataFrame:
    return of_type(events, "new_order").groupBy("customer_id", "customer_name").agg(
        F.count(F.lit(1)).alias("orders")
    )


def tally_searches(events: DataFrame) -> DataFrame:
    return of_type(events, "search").groupBy("search_query").agg(
        F.count(F.lit(1)).alias("searches")
    )


# Reports over tallies


def type_shares(tally: DataFrame) -> DataFrame:
    total = tally.agg(F.sum("events")).scalar()
    return tally.withColumn("share_pct", scalars.percent(F.col("events"), total))


def top_users(tally: DataFrame, rows: int = 5) -> DataFrame:
    return ordering.top(tally, "events", rows, "user_id")


def order_report(tally: DataFrame) -> DataFrame:
    orders = F.col("total_orders")
    average = F.col("total_revenue").cast("double") / orders
    return tally.withColumn(
        "average_order_value", F.when(orders > 0, average).otherwise(F.lit(0.0))
    )


def top_countries(tally: DataFrame, rows: int = 5) -> DataFrame:
    return ordering.top(tally, "revenue", rows, "country").withColumn(
        "average_order", F.try_divide(F.col("revenue").cast("double"), F.col("orders"))
    )


def top_products(tally: DataFrame, rows: int = 5) -> DataFrame:
    return ordering.top(tally, "units", rows, "product_id", "product_name")


def top_customers(tally: DataFrame, rows: int = 5) -> DataFrame:
    return ordering.top(tally, "orders", rows, "customer_id", "customer_name")


# Feeds: row by row


def high_value_orders(events: DataFrame, above: float = 1000) -> DataFrame:
    country = F.coalesce(F.col("customer_country"), F.lit("Unknown")).alias("customer_country")
    return of_type(events, "new_order").filter(F.col("order_total") > above).select(
        "order_id",
        "customer_id",
        "customer_name",
        country,
        "order_total",
        "item_count",
        "units_ordered",
    )


def high_value_purchases(events: DataFrame, above: float = 500) -> DataFrame:
    return (
        of_type(events, "purchase")
        .filter(F.col("purchase_data.amount") > above)
        .select("event_id", "user_id", F.col("purchase_data.amount").alias("amount"))
    )


def signups(events: DataFrame) -> DataFrame:
    return of_type(events, "signup").select("event_id", "user_id", "timestamp")


def searches(events: DataFrame) -> DataFrame:
    return of_type(events, "search").select("event_id", "user_id", "search_query")


def stock_cancellations(events: DataFrame, reason: str = "Out of stock") -> DataFrame:
    return (
        of_type(events, "order_cancelled")
        .filter(F.col("cancellation_reason") == reason)
        .select("event_id", "order_id", "cancellation_reason", "refund_status")
    )


def unconfirmed_payments(events: DataFrame) -> DataFrame:
    """Payments with any status but confirmed, none included."""
    return (
        of_type(events, "payment_confirmed")
        .filter(~F.col("payment_status").eqNullSafe(F.lit("confirmed")))
        .select("event_id", "order_id", "payment_method", "payment_status")
    )


def shipment_feed(events: DataFrame) -> DataFrame:
    moved = F.col("event_type").isin("order_shipped", "order_delivered")
    return events.filter(moved).select(
        "event_type", "order_id", "shipper", "tracking_number", "shipped_date", "delivered_date"
    )


def routed(events: DataFrame, known: tuple[str, ...] = ORDER_TYPES) -> DataFrame:
    """Events with the route they take: their type, or ``unknown``."""
    route = ladders.ladder([(F.col("event_type").isin(*known), "known")], "unknown")
    return events.withColumn(
        "route", F.when(route == "known", F.col("event_type")).otherwise("unknown")
    )


def flow_types(events: DataFrame) -> DataFrame:
    """Messages and value of new orders per event type."""
    return events.groupBy(_kind(events).alias("event_type")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.when(F.col("event_type") == "new_order", F.col("order_total"))).alias("value"),
    )


def flow_report(events: DataFrame) -> DataFrame:
    """One row: messages, how many types, value of new orders, and whether anything flows."""
    return flow_types(events).agg(
        F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"),
        F.count("event_type").alias("event_types"),
        F.coalesce(F.sum("value"), F.lit(0)).alias("order_value"),
    ).withColumn("flowing", F.col("messages") > 0)
