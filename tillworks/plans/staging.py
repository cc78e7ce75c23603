"""Staging models: cleaned tables with derived columns. Row-local, so they never shuffle
(products join two dimensions)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import ladders, scalars


def stg_sales_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "transaction_id",
        "user_id",
        "product_id",
        "amount",
        "currency",
        "transaction_date",
        "status",
        "created_at",
        scalars.truncated("day", "transaction_date").alias("transaction_day"),
        scalars.truncated("month", "transaction_date").alias("transaction_month"),
        scalars.truncated("year", "transaction_date").alias("transaction_year"),
        scalars.flag(F.col("status") == "completed").alias("is_completed"),
        ladders.transaction_tier(F.col("amount")).alias("transaction_tier"),
    )


def stg_user_events(events: DataFrame) -> DataFrame:
    data = F.col("event_data")
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        "event_timestamp",
        "event_data",
        "created_at",
        scalars.json_text(data, "page").alias("page_url"),
        scalars.json_text(data, "session_id").alias("session_id"),
        scalars.json_text(data, "metadata", "browser").alias("browser"),
        scalars.json_text(data, "metadata", "device").alias("device"),
        scalars.truncated("hour", "event_timestamp").alias("event_hour"),
        scalars.truncated("day", "event_timestamp").alias("event_day"),
        F.hour("event_timestamp").alias("hour_of_day"),
        scalars.weekday("event_timestamp").alias("day_of_week"),
    )


def stg_orders(orders: DataFrame, grace_days: int = 3) -> DataFrame:
    ordered, required = F.col("order_date"), F.col("required_date")
    shipped = F.col("shipped_date")
    starts = {
        f"order_{unit}": scalars.truncated(unit, ordered)
        for unit in ("day", "week", "month", "quarter", "year")
    }
    return orders.withColumnRenamed("ship_via", "shipper_id").withColumns(
        {
            **starts,
            "order_year_num": F.year(ordered),
            "order_month_num": F.month(ordered),
            "order_day_of_week": scalars.weekday(ordered),
            "is_shipped": shipped.isNotNull(),
            "days_to_ship": scalars.days_between(ordered, shipped),
            "shipping_delay_days": scalars.days_between(required, shipped),
            "shipping_performance": ladders.shipping_performance(shipped, required, grace_days),
            "freight_tier": ladders.freight_tier(F.col("freight")),
        }
    )


def stg_order_details(details: DataFrame) -> DataFrame:
    """Lines with money columns. ``line_subtotal`` is taken from the table when it is there."""
    if "line_subtotal" in details.columns:
        subtotal = F.col("line_subtotal")
    else:
        subtotal = scalars.line_subtotal("unit_price", "quantity")
    quantity, discount = F.col("quantity"), F.col("discount")
    net = scalars.net_price(subtotal, discount)
    return details.select(
        "order_id",
        "product_id",
        "unit_price",
        "quantity",
        "discount",
        subtotal.alias("line_subtotal"),
        net.alias("extended_price"),
        scalars.discount_amount(subtotal, discount).alias("discount_amount"),
        ladders.quantity_tier(quantity).alias("quantity_tier"),
        scalars.flag(discount > 0).alias("has_discount"),
        ladders.discount_tier(discount).alias("discount_tier"),
        ladders.is_high_value_line(net).alias("is_high_value_line"),
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.withColumns(
        {
            "country_code": scalars.code("country"),
            "city_normalized": scalars.normalized("city"),
            "region_group": ladders.region_group(F.col("country")),
            "contact_type": ladders.contact_type(F.col("contact_title")),
        }
    )


def stg_products(products: DataFrame, categories: DataFrame, suppliers: DataFrame) -> DataFrame:
    named = products.join(
        categories.select("category_id", "category_name"), "category_id", "left"
    ).join(
        suppliers.select(
            "supplier_id",
            F.col("company_name").alias("supplier_name"),
            F.col("country").alias("supplier_country"),
        ),
        "supplier_id",
        "left",
    )
    stock, reorder = F.col("units_in_stock"), F.col("reorder_level")
    discontinued = F.col("discontinued")
    return named.select(
        "product_id",
        "product_name",
        "supplier_id",
        "supplier_name",
        "supplier_country",
        "category_id",
        "category_name",
        "quantity_per_unit",
        "unit_price",
        "units_in_stock",
        "units_on_order",
        "reorder_level",
        "discontinued",
        (stock + F.col("units_on_order")).alias("total_available_units"),
        ladders.needs_reorder(stock, reorder, discontinued).alias("needs_reorder"),
        ladders.stock_status(stock, reorder, discontinued).alias("stock_status"),
        ladders.price_tier(F.col("unit_price")).alias("price_tier"),
        ladders.product_status(stock, reorder, discontinued).alias("product_status"),
    )
