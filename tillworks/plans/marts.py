"""Mart models. Results are unsorted: order belongs to the report, not to a stored table."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import ladders, scalars
from tillworks.operators import aggregates, filters, joins


def _per_day(
    df: DataFrame, day: str, reach: Mapping[str, Column], measures: Mapping[str, Column]
) -> DataFrame:
    """Distinct counts and measures per day, in two aggregates.

    Distinct counts copy each row once per counted column. Apart from the measures those copies
    hold only the ids, and the measures shrink to one row per day before their shuffle.
    """
    date = F.col(day).alias("date")
    parts = [
        df.groupBy(date).agg(*[form.alias(name) for name, form in forms.items()])
        for forms in (reach, measures)
    ]
    return aggregates.merged_by(["date"], parts)


def fct_daily_sales(stg_transactions: DataFrame, start_date: str) -> DataFrame:
    """Daily measures of all transactions from the start date on."""
    amount, tier = F.col("amount"), F.col("transaction_tier")
    done = F.col("is_completed")
    by_tier = {
        f"{name}_value_transactions": scalars.count_where(tier == name)
        for name in ("high", "medium", "low")
    }
    revenue = {
        f"{name}_tier_revenue": scalars.sum_where((tier == name) & done, amount)
        for name in ("high", "medium", "low")
    }
    reach = {
        "total_transactions": F.count_distinct("transaction_id"),
        "unique_users": F.count_distinct("user_id"),
        "unique_products": F.count_distinct("product_id"),
    }
    measures = {
        "total_revenue": F.sum(amount),
        "avg_transaction_value": scalars.exact_mean(amount),
        "max_transaction_value": F.max(amount),
        "min_transaction_value": F.min(amount),
        "completed_transactions": scalars.count_where(done),
        "failed_transactions": scalars.count_where(~done),
        **by_tier,
        **revenue,
    }
    recent = filters.since(stg_transactions, "transaction_date", start_date)
    return _per_day(recent, "transaction_day", reach, measures).withColumn(
        "completion_rate",
        scalars.percent(F.col("completed_transactions"), F.col("total_transactions")),
    )


def daily_orders(stg_orders: DataFrame) -> DataFrame:
    """Orders, shipping and freight per day. ``order_id`` is the key of orders, so counting
    rows counts orders."""
    performance, days = F.col("shipping_performance"), F.col("days_to_ship")
    shipped = F.col("is_shipped")
    reach = {
        "unique_customers": F.count_distinct("customer_id"),
        "unique_employees": F.count_distinct("employee_id"),
    }
    measures = {
        "total_orders": F.count("order_id"),
        "shipped_orders": scalars.count_where(shipped),
        "unshipped_orders": scalars.count_where(~shipped),
        "on_time_orders": scalars.count_where(performance == "On Time"),
        "late_orders": scalars.count_where(performance == "Late"),
        "avg_days_to_ship": scalars.exact_mean(days),
        "max_days_to_ship": F.max(days),
        "min_days_to_ship": F.min(days),
        "total_freight": F.sum("freight"),
        "avg_freight_per_order": scalars.exact_mean("freight"),
        "high_freight_orders": scalars.count_where(F.col("freight_tier") == "High Freight"),
    }
    per_day = _per_day(stg_orders, "order_day", reach, measures)
    return per_day.select(
        "date",
        scalars.truncated("month", "date").alias("order_month"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        "total_orders",
        *reach,
        *[name for name in measures if name != "total_orders"],
    )


def daily_revenue(stg_orders: DataFrame, stg_details: DataFrame) -> DataFrame:
    """Revenue per order day. The sums shrink to one row per order before they meet the orders;
    the distinct products take a path of their own, two short columns wide: the lines meet their
    orders as they are, and repeats go in the one distinct count."""
    sums = {
        "total_units_sold": "quantity",
        "total_revenue": "extended_price",
        "gross_revenue": "line_subtotal",
        "total_discounts": "discount_amount",
    }
    counts = {
        "priced_lines": F.count("extended_price"),
        "discounted_line_items": scalars.count_where(F.col("has_discount")),
        "high_value_line_items": scalars.count_where(F.col("is_high_value_line")),
    }
    per_order = stg_details.groupBy("order_id").agg(
        *[F.sum(column).alias(name) for name, column in sums.items()],
        *[form.alias(name) for name, form in counts.items()],
    )
    days = stg_orders.select("order_id", F.col("order_day").alias("date"))
    money = (
        per_order.join(days, "order_id")
        .groupBy("date")
        .agg(*[F.sum(name).alias(name) for name in (*sums, *counts)])
    )
    variety = (
        stg_details.select("order_id", "product_id")
        .join(days, "order_id")
        .groupBy("date")
        .agg(F.count_distinct("product_id").alias("unique_products_sold"))
    )
    mean_line = F.try_divide(F.col("total_revenue").cast("double"), F.col("priced_lines"))
    return money.join(variety, "date").select(
        "date",
        "unique_products_sold",
        *sums,
        mean_line.alias("avg_line_item_value"),
        "discounted_line_items",
        "high_value_line_items",
    )


def fct_order_performance(stg_orders: DataFrame, stg_details: DataFrame) -> DataFrame:
    """Daily orders with revenue and rates. Two aggregates meet on the day."""
    orders, shipped = F.col("total_orders"), F.col("shipped_orders")
    return (
        daily_orders(stg_orders)
        .join(daily_revenue(stg_orders, stg_details), "date", "left")
        .withColumns(
            {
                "shipping_rate_pct": scalars.percent(shipped, orders),
                "on_time_rate_pct": scalars.percent(F.col("on_time_orders"), shipped),
                "avg_order_value": scalars.ratio(F.col("total_revenue"), orders, 2),
                "discount_rate_pct": scalars.percent(
                    F.col("total_discounts"), F.col("gross_revenue")
                ),
                # At 38 digits the sum would lose a decimal place, so both get room to grow.
                "grand_total_with_freight": F.col("total_revenue").cast("decimal(30,7)")
                + F.col("total_freight").cast("decimal(30,7)"),
            }
        )
    )


def _product_sums(stg_details: DataFrame) -> DataFrame:
    """Measures of the lines of each product: combined on the map side, so that only one row
    per product and task is shuffled."""
    tier, units = F.col("quantity_tier"), F.col("quantity")
    tiers = {
        "bulk": "Bulk Order",
        "large": "Large Order",
        "standard": "Standard Order",
        "small": "Small Order",
    }
    measures = {
        "total_units_sold": F.sum(units),
        "total_revenue": F.sum("extended_price"),
        "total_discounts_given": F.sum("discount_amount"),
        "avg_selling_price": scalars.exact_mean("unit_price"),
        "max_selling_price": F.max("unit_price"),
        "min_selling_price": F.min("unit_price"),
        "avg_discount_rate": scalars.exact_mean("discount"),
        **{
            f"{name}_order_units": scalars.sum_where(tier == label, units)
            for name, label in tiers.items()
        },
    }
    return stg_details.groupBy("product_id").agg(
        *[form.alias(name) for name, form in measures.items()]
    )


def _product_reach(
    stg_details: DataFrame, stg_orders: DataFrame, stg_customers: DataFrame
) -> DataFrame:
    """Orders, customers, countries, months and dates of each product.

    Works on the distinct (product, order) pairs, two numbers wide: after that step orders are
    counted by rows, and the other distinct counts run in one aggregate. That aggregate holds each
    pair four times over. So the pairs go to as many tasks as the session has shuffle partitions:
    adaptive execution would gather them by the small size that they have before it.
    """
    tasks = int(stg_details.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = stg_details.select("product_id", "order_id").distinct()
    placed = stg_orders.select("order_id", "order_date", "customer_id").join(
        stg_customers.select("customer_id", "country"), "customer_id", "left"
    )
    month = scalars.truncated("month", "order_date")
    return (
        pairs.repartition(tasks, "order_id")
        .join(placed, "order_id", "left")
        .groupBy("product_id")
        .agg(
            F.count("order_id").alias("times_ordered"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_distinct("country").alias("countries_sold_to"),
            F.min("order_date").alias("first_sale_date"),
            F.max("order_date").alias("last_sale_date"),
            F.count_distinct(month).alias("months_with_sales"),
        )
    )


def product_metrics(
    stg_products: DataFrame,
    stg_details: DataFrame,
    stg_orders: DataFrame,
    stg_customers: DataFrame,
) -> DataFrame:
    """Sales measures of every product, sold or not."""
    measures = (
        "times_ordered", "unique_customers", "countries_sold_to", "total_units_sold",
        "total_revenue", "total_discounts_given", "avg_selling_price", "max_selling_price",
        "min_selling_price", "avg_discount_rate", "first_sale_date", "last_sale_date",
        "months_with_sales", "bulk_order_units", "large_order_units", "standard_order_units",
        "small_order_units",
    )
    sold = _product_sums(stg_details).join(
        _product_reach(stg_details, stg_orders, stg_customers), "product_id", "left"
    )
    counters = (
        "times_ordered", "unique_customers", "countries_sold_to", "months_with_sales",
        "bulk_order_units", "large_order_units", "standard_order_units", "small_order_units",
    )
    return stg_products.join(sold, "product_id", "left").select(
        "product_id",
        "product_name",
        "category_id",
        "category_name",
        "supplier_id",
        "supplier_name",
        "supplier_country",
        F.col("unit_price").alias("current_unit_price"),
        "units_in_stock",
        "units_on_order",
        "reorder_level",
        "stock_status",
        "price_tier",
        "product_status",
        "discontinued",
        *[
            F.coalesce(name, F.lit(0)).alias(name) if name in counters else F.col(name)
            for name in measures
        ],
        F.col("last_sale_date").alias("last_sale_day"),
    )


def fct_product_sales(
    stg_products: DataFrame,
    stg_details: DataFrame,
    stg_orders: DataFrame,
    stg_customers: DataFrame,
    as_of: str,
    star: float = 10000,
    high: float = 5000,
    solid: float = 1000,
) -> DataFrame:
    """Product grain: sales, share of category, stock cover, tier and inventory action."""
    metrics = product_metrics(stg_products, stg_details, stg_orders, stg_customers)
    return product_standing(metrics, as_of, star, high, solid)


def product_standing(
    metrics: DataFrame,
    as_of: str,
    star: float = 10000,
    high: float = 5000,
    solid: float = 1000,
) -> DataFrame:
    """What follows from the sales measures of the products. They are read twice, for the totals
    per category and for the products: store them first where they come from many lines."""
    shared = joins.with_group_share(
        metrics, "category_name", "total_revenue", "category_total_revenue",
        "pct_of_category_revenue",
    )
    revenue, units = F.col("total_revenue"), F.col("total_units_sold")
    months, times = F.col("months_with_sales"), F.col("times_ordered")
    discounts = F.col("total_discounts_given")
    return shared.withColumns(
        {
            "revenue_per_unit": scalars.ratio(revenue, units, 2),
            "avg_quantity_per_order": scalars.ratio(units, times, 2),
            "discount_rate_pct": F.when(
                revenue > 0, scalars.percent(discounts, revenue + discounts)
            ).otherwise(F.lit(0.0)),
            "days_since_last_sale": scalars.age_days("last_sale_day", as_of),
            "days_of_stock_remaining": F.when(
                (units > 0) & (months > 0),
                scalars.ratio(F.col("units_in_stock") * months * 30, units, 1),
            ),
        }
    ).withColumns(
        {
            "performance_tier": ladders.performance_tier(revenue, star, high, solid),
            "inventory_action": ladders.inventory_action(
                F.col("discontinued"), F.col("stock_status"), revenue,
                F.col("days_since_last_sale"),
            ),
            "units_per_month": scalars.ratio(units, months, 1),
        }
    )


def _active_periods(stg_orders: DataFrame) -> DataFrame:
    """Active days and months per customer. Days nest in months, so each count is a row count
    of one grouping after the other."""
    days = stg_orders.groupBy("customer_id", "order_day").agg(F.count(F.lit(1)))
    month = scalars.truncated("month", "order_day").alias("order_month")
    months = days.groupBy("customer_id", month).agg(F.count("order_day").alias("days"))
    return months.groupBy("customer_id").agg(
        F.sum("days").alias("days"), F.count("order_month").alias("months")
    )


def customer_aggregates(
    stg_customers: DataFrame,
    stg_orders: DataFrame,
    details: DataFrame,
    freight_grain: str = "line",
) -> DataFrame:
    """Lifetime measures of every customer.

    Order lines shrink to one row per order before they meet the orders. Freight is weighted by
    the lines of its order, as a join to the lines would do; ``freight_grain="order"`` counts
    it once per order.
    """
    weight = F.coalesce("line_count", F.lit(1)) if freight_grain == "line" else F.lit(1)
    weight = weight.cast("int")
    measures = stg_orders.join(joins.order_line_sums(details), "order_id", "left").groupBy(
        "customer_id"
    ).agg(
        F.count("order_id").alias("orders"),
        scalars.count_where(F.col("is_shipped")).alias("shipped"),
        scalars.count_where(F.col("shipping_performance") == "On Time").alias("on_time"),
        F.sum("extended_price").alias("value"),
        F.sum("line_count").alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum("discount_amount").alias("discounts"),
        F.sum(F.col("freight") * weight).alias("freight_sum"),
        F.sum(F.when(F.col("freight").isNotNull(), weight)).alias("freight_rows"),
        F.min("order_day").alias("first_day"),
        F.max("order_day").alias("last_day"),
    )
    per_customer = measures.join(_active_periods(stg_orders), "customer_id", "left")
    zero = F.lit(0)
    return stg_customers.join(per_customer, "customer_id", "left").select(
        "customer_id",
        "company_name",
        "contact_name",
        "country",
        "city",
        "region_group",
        "contact_type",
        F.coalesce("orders", zero).alias("total_orders"),
        F.coalesce("shipped", zero).alias("shipped_orders"),
        F.coalesce("on_time", zero).alias("on_time_orders"),
        F.col("value").alias("lifetime_value"),
        F.try_divide(F.col("value").cast("double"), F.col("lines")).alias("avg_line_item_value"),
        F.col("units").alias("total_units_purchased"),
        F.col("discounts").alias("total_discounts_received"),
        F.col("freight_sum").alias("total_freight_paid"),
        F.try_divide(F.col("freight_sum").cast("double"), F.col("freight_rows")).alias(
            "avg_freight_per_order"
        ),
        F.col("first_day").alias("first_order_date"),
        F.col("last_day").alias("last_order_date"),
        F.col("last_day").alias("last_order_day"),
        F.coalesce("months", zero).alias("active_months"),
        F.coalesce("days", zero).alias("active_days"),
    )


def dim_customer_metrics(
    stg_customers: DataFrame,
    stg_orders: DataFrame,
    details: DataFrame,
    as_of: str,
    freight_grain: str = "line",
) -> DataFrame:
    base = customer_aggregates(stg_customers, stg_orders, details, freight_grain)
    orders, value = F.col("total_orders"), F.col("lifetime_value")
    shipped, days = F.col("shipped_orders"), F.col("days_since_last_order")
    return base.withColumns(
        {
            "avg_order_value": scalars.ratio(value, orders, 2),
            "fulfillment_rate_pct": scalars.percent(shipped, orders),
            "on_time_delivery_rate_pct": scalars.percent(F.col("on_time_orders"), shipped),
            "days_since_last_order": scalars.age_days("last_order_day", as_of),
            "customer_lifespan_days": scalars.days_between("first_order_date", "last_order_day"),
            "value_segment": ladders.customer_value(value),
            "frequency_segment": ladders.customer_frequency(orders),
        }
    ).withColumns(
        {
            "activity_status": ladders.customer_activity(days),
            "customer_tier": ladders.customer_tier(
                F.col("value_segment"), F.col("frequency_segment"), orders, days
            ),
        }
    )


def user_transactions(stg_transactions: DataFrame) -> DataFrame:
    """Transaction measures per user; active days are counted as rows of a daily step."""
    amount = F.when(F.col("is_completed"), F.col("amount"))
    per_day = stg_transactions.groupBy("user_id", "transaction_day").agg(
        F.count(F.lit(1)).alias("transactions"),
        scalars.count_where(F.col("is_completed")).alias("completed"),
        F.sum(amount).alias("value"),
        F.count(amount).alias("amounts"),
        F.max(amount).alias("max_value"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
    )
    zero = F.lit(0).cast("decimal(1,0)")
    return per_day.groupBy("user_id").agg(
        F.sum("transactions").alias("total_transactions"),
        F.count("transaction_day").alias("active_days"),
        F.sum("completed").alias("completed_transactions"),
        F.coalesce(F.sum("value"), zero).alias("lifetime_value"),
        F.try_divide(F.sum("value").cast("double"), F.sum("amounts")).alias(
            "avg_transaction_value"
        ),
        F.max("max_value").alias("max_transaction_value"),
        F.min("first_date").alias("first_transaction_date"),
        F.max("last_date").alias("last_transaction_date"),
        F.max("transaction_day").alias("last_transaction_day"),
    )


def user_activity(stg_events: DataFrame) -> DataFrame:
    """Event measures per user. Events shrink to one row per user, day and session before the
    two distinct counts."""
    visits = stg_events.groupBy("user_id", "event_day", "session_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )
    return visits.groupBy("user_id").agg(
        F.sum("events").alias("total_events"),
        F.count_distinct("event_day").alias("active_event_days"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.min("first_event").alias("first_event_date"),
        F.max("last_event").alias("last_event_date"),
    )


def dim_user_metrics(stg_transactions: DataFrame, stg_events: DataFrame, as_of: str) -> DataFrame:
    """Users with transactions, events or both. Recency looks at the last transaction first."""
    zero = F.lit(0)
    both = user_transactions(stg_transactions).join(
        user_activity(stg_events), "user_id", "full"
    )
    value = F.coalesce("lifetime_value", zero)
    transactions = F.coalesce("total_transactions", zero)
    sessions = F.coalesce("total_sessions", zero)
    last_active = F.coalesce("last_transaction_day", F.col("last_event_date").cast("date"))
    return both.select(
        "user_id",
        transactions.alias("total_transactions"),
        F.coalesce("completed_transactions", zero).alias("completed_transactions"),
        value.alias("lifetime_value"),
        "avg_transaction_value",
        "max_transaction_value",
        "first_transaction_date",
        "last_transaction_date",
        F.col("active_days").alias("transaction_active_days"),
        F.coalesce("total_events", zero).alias("total_events"),
        sessions.alias("total_sessions"),
        "active_event_days",
        "first_event_date",
        "last_event_date",
        (transactions * 10 + sessions).alias("engagement_score"),
        scalars.age_days(last_active, as_of).alias("days_since_last_activity"),
        ladders.user_segment(value).alias("user_segment"),
    ).withColumn("activity_status", ladders.user_activity(F.col("days_since_last_activity")))
