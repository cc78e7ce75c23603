"""Aggregate forms."""

from pyspark.sql import functions as F

from registry.core import AS_OF, EVENTS_NOW, big, dbl, mean, query
from tillworks.functions import scalars
from tillworks.operators import aggregates, filters
from tillworks.plans import staging


@query(
    "a01_five_numbers",
    f"""SELECT customer_id, count(freight) AS n, {dbl("sum(freight)")} AS total,
               {mean("freight")} AS mean, {dbl("max(freight)")} AS largest,
               {dbl("min(freight)")} AS smallest
        FROM sale_orders GROUP BY customer_id""",
)
def five_numbers(t):
    names = ("n", "total", "mean", "largest", "smallest")
    return t.orders.groupBy("customer_id").agg(*aggregates.five_numbers("freight", names))


@query(
    "a02_several_keys",
    f"""SELECT ship_country, employee_id, count(*) AS orders, {dbl("sum(freight)")} AS freight
        FROM sale_orders GROUP BY 1, 2""",
)
def several_keys(t):
    return t.orders.groupBy("ship_country", "employee_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("freight").alias("freight")
    )


@query(
    "a03_distinct_counts",
    """SELECT product_id, count(DISTINCT order_id) AS orders,
              count(DISTINCT quantity) AS quantities
       FROM lines GROUP BY product_id""",
)
def distinct_counts(t):
    return aggregates.distinct_counts(
        t.order_details, ["product_id"], {"orders": "order_id", "quantities": "quantity"}
    )


@query(
    "a04_conditional_distinct",
    """SELECT customer_id,
              count(DISTINCT CASE WHEN shipped_date IS NOT NULL THEN order_id END) AS shipped_orders,
              count(DISTINCT CASE WHEN shipping_performance = 'On Time' THEN order_id END)
                  AS on_time_orders
       FROM s_orders GROUP BY customer_id""",
)
def conditional_distinct(t):
    order, on_time = F.col("order_id"), F.col("shipping_performance") == "On Time"
    return aggregates.distinct_counts(
        staging.stg_orders(t.orders),
        ["customer_id"],
        {
            "shipped_orders": F.when(F.col("is_shipped"), order),
            "on_time_orders": F.when(on_time, order),
        },
    )


@query(
    "a05_active_periods",
    """SELECT customer_id, count(DISTINCT date_trunc('month', order_date)) AS active_months,
              count(DISTINCT order_date) AS active_days
       FROM sale_orders GROUP BY customer_id""",
)
def active_periods(t):
    # Days nest in months, so both counts are row counts of one grouping after the other.
    days = t.orders.groupBy("customer_id", "order_date").agg(F.count(F.lit(1)))
    month = scalars.truncated("month", "order_date").alias("month")
    months = days.groupBy("customer_id", month).agg(F.count("order_date").alias("days"))
    return months.groupBy("customer_id").agg(
        F.count("month").alias("active_months"), F.sum("days").alias("active_days")
    )


@query(
    "a06_conditional_counts",
    f"""SELECT user_id, {big("sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END)")} AS completed,
               {big("sum(CASE WHEN status <> 'completed' THEN 1 ELSE 0 END)")} AS failed
        FROM transactions GROUP BY user_id""",
)
def conditional_counts(t):
    done = F.col("status") == "completed"
    return t.sales_transactions.groupBy("user_id").agg(
        scalars.count_where(done).alias("completed"), scalars.count_where(~done).alias("failed")
    )


@query(
    "a07_conditional_sums",
    f"""SELECT product_id,
               {big("sum(CASE WHEN quantity_tier = 'Large Order' THEN quantity ELSE 0 END)")}
                   AS large_units,
               {dbl("sum(CASE WHEN discount > 0 THEN extended_price ELSE 0 END)")}
                   AS discounted_revenue
        FROM s_lines GROUP BY product_id""",
)
def conditional_sums(t):
    large = F.col("quantity_tier") == "Large Order"
    return (
        staging.stg_order_details(t.order_details)
        .groupBy("product_id")
        .agg(
            scalars.sum_where(large, "quantity").alias("large_units"),
            scalars.sum_where(F.col("has_discount"), "extended_price").alias("discounted_revenue"),
        )
    )


@query(
    "a08_conditional_means",
    f"""SELECT ship_country,
               {mean("CASE WHEN shipped_date IS NOT NULL THEN shipped_date - order_date END")}
                   AS avg_days,
               CAST(max(CASE WHEN freight_tier = 'High Freight'
                             THEN shipped_date - order_date END) AS INTEGER) AS max_days,
               CAST(min(CASE WHEN freight_tier = 'High Freight'
                             THEN shipped_date - order_date END) AS INTEGER) AS min_days
        FROM s_orders GROUP BY ship_country""",
)
def conditional_means(t):
    days, high = F.col("days_to_ship"), F.col("freight_tier") == "High Freight"
    return (
        staging.stg_orders(t.orders)
        .groupBy("ship_country")
        .agg(
            scalars.exact_mean(F.when(F.col("is_shipped"), days)).alias("avg_days"),
            F.max(F.when(high, days)).alias("max_days"),
            F.min(F.when(high, days)).alias("min_days"),
        )
    )


@query(
    "a09_one_row",
    f"""SELECT count(*) AS line_count, {big("sum(quantity)")} AS units,
               {dbl("sum(extended_price)")} AS revenue FROM lines""",
)
def one_row(t):
    return staging.stg_order_details(t.order_details).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("units"),
        F.sum("extended_price").alias("revenue"),
    )


@query(
    "a10_mean_of_sums",
    f"""WITH per_order AS (SELECT order_id, sum(extended_price) AS total FROM lines GROUP BY 1)
        SELECT count(*) AS orders, {mean("total")} AS avg_order_value FROM per_order""",
)
def mean_of_sums(t):
    per_order = (
        staging.stg_order_details(t.order_details)
        .groupBy("order_id")
        .agg(F.sum("extended_price").alias("total"))
    )
    return per_order.agg(
        F.count(F.lit(1)).alias("orders"), scalars.exact_mean("total").alias("avg_order_value")
    )


@query(
    "a11_dict_form",
    f"""SELECT product_id, {big("sum(quantity)")} AS units, count(order_id) AS line_count
        FROM lines GROUP BY product_id""",
)
def dict_form(t):
    return aggregates.by_dict(
        t.order_details,
        ["product_id"],
        {"quantity": "sum", "order_id": "count"},
        {"sum(quantity)": "units", "count(order_id)": "line_count"},
    )


@query(
    "a12_null_profile",
    """SELECT count(*) AS total_records,
              count(*) FILTER (order_id IS NULL) AS null_order,
              count(*) FILTER (shipped_date IS NULL) AS null_shipped,
              count(*) FILTER (ship_region IS NULL) AS null_region,
              (1 - CAST(count(*) FILTER (order_id IS NULL) + count(*) FILTER (shipped_date IS NULL)
                        + count(*) FILTER (ship_region IS NULL) AS DOUBLE)
                   / CAST(count(*) * 3 AS DOUBLE)) * 100 AS completeness_pct
       FROM sale_orders""",
)
def null_profile(t):
    return aggregates.null_profile(
        t.orders,
        {
            "order_id": "null_order",
            "shipped_date": "null_shipped",
            "ship_region": "null_region",
        },
    )


@query(
    "a13_rows_in_period",
    f"""SELECT count(*) AS rows_in_period FROM activity
        WHERE created_at >= TIMESTAMP '{EVENTS_NOW}' - INTERVAL 24 HOUR""",
)
def rows_in_period(t):
    return filters.lookback(t.user_events, "created_at", EVENTS_NOW, days=1).agg(
        F.count(F.lit(1)).alias("rows_in_period")
    )


@query(
    "a14_latest_and_age",
    f"""SELECT max(order_date) AS latest,
               CAST(DATE '{AS_OF}' - max(order_date) AS INTEGER) AS days_old
        FROM sale_orders""",
)
def latest_and_age(t):
    return aggregates.latest_date_and_age(t.orders, "order_date", AS_OF)


@query("a15_distinct_rows", "SELECT DISTINCT customer_id, employee_id FROM sale_orders")
def distinct_rows(t):
    return t.orders.select("customer_id", "employee_id").distinct()


@query(
    "a16_value_set",
    "SELECT DISTINCT event_type AS kind FROM activity WHERE event_type IS NOT NULL",
)
def value_set(t):
    return aggregates.value_set(t.user_events, "event_type", "kind")
