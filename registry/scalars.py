"""Scalar functions, each over a whole table."""

from pyspark.sql import functions as F

from registry import feeds
from registry.core import AS_OF, dbl, query, quotient, share
from tillworks.functions import scalars
from tillworks.operators import aggregates
from tillworks.plans import staging
from tillworks.streaming import metrics


@query(
    "f01_full_name",
    """SELECT o.order_id, e.first_name || ' ' || e.last_name AS employee_name
       FROM sale_orders o JOIN employees e ON o.employee_id = e.employee_id""",
)
def full_name(t):
    name = scalars.full_name("first_name", "last_name").alias("employee_name")
    return t.orders.join(t.employees, "employee_id").select("order_id", name)


@query(
    "f02_display_name",
    "SELECT user_id, username || ' (' || country || ')' AS user_full_name FROM users",
)
def display_name(t):
    return t.users.select(
        "user_id", scalars.display_name("username", "country").alias("user_full_name")
    )


@query("f03_upper_trim", "SELECT customer_id, upper(trim(country)) AS country_code FROM customers")
def upper_trim(t):
    return t.customers.select("customer_id", scalars.code("country").alias("country_code"))


@query("f04_lower_trim", "SELECT customer_id, lower(trim(city)) AS city_normalized FROM customers")
def lower_trim(t):
    return t.customers.select("customer_id", scalars.normalized("city").alias("city_normalized"))


@query(
    "f05_ilike_ladder",
    "SELECT customer_id, contact_title, contact_type FROM s_customers",
)
def ilike_ladder(t):
    return staging.stg_customers(t.customers).select(
        "customer_id", "contact_title", "contact_type"
    )


@query(
    "f06_pair_name",
    "SELECT customer_id, company_name AS customer_name FROM customers",
)
def pair_name(t):
    pair = F.concat(F.col("customer_id").cast("string"), F.lit(":"), F.col("company_name"))
    return t.customers.select("customer_id", scalars.pair_name(pair).alias("customer_name"))


@query("f07_text_date", "SELECT user_id, registration_date FROM users")
def text_date(t):
    return t.users.select(
        "user_id", scalars.text_date("registration_date").alias("registration_date")
    )


@query("f08_epoch_millis", "SELECT order_id, order_date FROM sale_orders")
def epoch_millis(t):
    days = F.date_diff(F.col("order_date"), F.lit("1970-01-01").cast("date"))
    millis = days.cast("bigint") * 86400000
    return t.orders.select("order_id", scalars.epoch_millis_date(millis).alias("order_date"))


@query(
    "f09_date_parts",
    """SELECT transaction_id, CAST(year(transaction_date) AS INTEGER) AS year,
              CAST(month(transaction_date) AS INTEGER) AS month,
              CAST(day(transaction_date) AS INTEGER) AS day,
              CAST(hour(transaction_date) AS INTEGER) AS hour
       FROM transactions""",
)
def date_parts(t):
    when = F.col("transaction_date")
    return t.sales_transactions.select(
        "transaction_id",
        F.year(when).alias("year"),
        F.month(when).alias("month"),
        F.dayofmonth(when).alias("day"),
        F.hour(when).alias("hour"),
    )


@query(
    "f10_date_trunc",
    """SELECT event_id, CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS event_hour,
              CAST(event_timestamp AS DATE) AS event_day,
              CAST(date_trunc('week', event_timestamp) AS DATE) AS event_week,
              CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month,
              CAST(date_trunc('quarter', event_timestamp) AS DATE) AS event_quarter,
              CAST(date_trunc('year', event_timestamp) AS DATE) AS event_year
       FROM activity""",
)
def date_trunc(t):
    return t.user_events.select(
        "event_id",
        *[
            scalars.truncated(unit, "event_timestamp").alias(f"event_{unit}")
            for unit in ("hour", "day", "week", "month", "quarter", "year")
        ],
    )


@query(
    "f11_extract",
    """SELECT order_id, CAST(extract(year FROM order_date) AS INTEGER) AS order_year_num,
              CAST(extract(month FROM order_date) AS INTEGER) AS order_month_num
       FROM sale_orders""",
)
def extract(t):
    return staging.stg_orders(t.orders).select("order_id", "order_year_num", "order_month_num")


@query(
    "f12_weekday",
    """SELECT order_id, CAST(extract(dow FROM order_date) AS INTEGER) AS order_day_of_week
       FROM sale_orders""",
)
def weekday(t):
    return t.orders.select("order_id", scalars.weekday("order_date").alias("order_day_of_week"))


@query(
    "f13_year_month",
    """SELECT transaction_id, strftime(transaction_date, '%Y-%m') AS transaction_year_month
       FROM transactions""",
)
def year_month(t):
    return t.sales_transactions.select(
        "transaction_id", scalars.year_month("transaction_date").alias("transaction_year_month")
    )


@query(
    "f14_day_difference",
    """SELECT order_id, CAST(shipped_date - order_date AS INTEGER) AS days_to_ship,
              CAST(shipped_date - required_date AS INTEGER) AS shipping_delay_days
       FROM sale_orders""",
)
def day_difference(t):
    return t.orders.select(
        "order_id",
        scalars.days_between("order_date", "shipped_date").alias("days_to_ship"),
        scalars.days_between("required_date", "shipped_date").alias("shipping_delay_days"),
    )


@query(
    "f15_grace_period",
    """SELECT order_id, required_date + 3 AS latest_date,
              shipped_date <= required_date + 3 AS within_grace
       FROM sale_orders""",
)
def grace_period(t):
    latest = F.date_add("required_date", 3)
    return t.orders.select(
        "order_id",
        latest.alias("latest_date"),
        (F.col("shipped_date") <= latest).alias("within_grace"),
    )


@query(
    "f16_age",
    f"""SELECT order_id, CAST(DATE '{AS_OF}' - order_date AS INTEGER) AS age_days
        FROM sale_orders""",
)
def age(t):
    return t.orders.select("order_id", scalars.age_days("order_date", AS_OF).alias("age_days"))


@query("f17_day_of_timestamp", "SELECT event_id, CAST(event_timestamp AS DATE) AS day FROM activity")
def day_of_timestamp(t):
    return t.user_events.select("event_id", F.col("event_timestamp").cast("date").alias("day"))


@query(
    "f18_line_arithmetic",
    """SELECT order_id, product_id, CAST(line_subtotal AS DOUBLE) AS line_subtotal,
              CAST(extended_price AS DOUBLE) AS extended_price,
              CAST(discount_amount AS DOUBLE) AS discount_amount FROM lines""",
)
def line_arithmetic(t):
    return staging.stg_order_details(t.order_details).select(
        "order_id", "product_id", "line_subtotal", "extended_price", "discount_amount"
    )


@query(
    "f19_round",
    """SELECT order_id, CAST(round(freight, 2) AS DOUBLE) AS freight_2,
              CAST(round(freight, 1) AS DOUBLE) AS freight_1 FROM sale_orders""",
)
def rounding(t):
    return t.orders.select(
        "order_id",
        F.round("freight", 2).alias("freight_2"),
        F.round("freight", 1).alias("freight_1"),
    )


@query(
    "f20_guarded_ratio",
    f"""SELECT product_id, {quotient("units_in_stock", "reorder_level")} AS cover,
               {quotient("units_in_stock", "reorder_level", 1, "NULL")} AS cover_or_null,
               {share("units_on_order", "(units_in_stock + units_on_order)")} AS on_order_pct
        FROM products""",
)
def guarded_ratio(t):
    stock, coming = F.col("units_in_stock"), F.col("units_on_order")
    reorder = F.col("reorder_level")
    return t.products.select(
        "product_id",
        scalars.ratio(stock, reorder, 2).alias("cover"),
        scalars.ratio(stock, reorder, 1, otherwise=None).alias("cover_or_null"),
        scalars.percent(coming, stock + coming).alias("on_order_pct"),
    )


@query(
    "f21_coalesce",
    """SELECT order_id, coalesce(shipped_date, required_date) AS due_or_shipped,
              coalesce(shipped_date - order_date, 0)::INTEGER AS days FROM sale_orders""",
)
def coalesced(t):
    return t.orders.select(
        "order_id",
        F.coalesce("shipped_date", "required_date").alias("due_or_shipped"),
        F.coalesce(scalars.days_between("order_date", "shipped_date"), F.lit(0)).alias("days"),
    )


@query(
    "f22_null_share",
    """SELECT (1 - CAST(count(*) FILTER (shipped_date IS NULL) AS DOUBLE)
                   / CAST(count(*) AS DOUBLE)) * 100 AS completeness_pct FROM sale_orders""",
)
def null_share(t):
    profile = aggregates.null_profile(t.orders, {"shipped_date": "null_shipped"})
    return profile.select("completeness_pct")


@query(
    "f23_cents_to_dollars",
    """SELECT p_partkey AS product_id,
              CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * 0.01, 2) AS DOUBLE) AS dollars
       FROM part""",
)
def cents_to_dollars(t):
    parts = t.file("part")
    return parts.select(
        F.col("p_partkey").alias("product_id"),
        scalars.cents_to_dollars("p_retailprice").alias("dollars"),
    )


@query("f24_json_field", "SELECT event_id, page_url, session_id FROM activity")
def json_field(t):
    return t.user_events.select(
        "event_id",
        scalars.json_text("event_data", "page").alias("page_url"),
        scalars.json_text("event_data", "session_id").alias("session_id"),
    )


@query("f25_nested_json_field", "SELECT event_id, browser, device FROM activity")
def nested_json_field(t):
    return t.user_events.select(
        "event_id",
        scalars.json_text("event_data", "metadata", "browser").alias("browser"),
        scalars.json_text("event_data", "metadata", "device").alias("device"),
    )


@query(
    "f26_json_record",
    "SELECT event_id, page_url AS page, session_id, browser, device FROM activity",
)
def json_record(t):
    schema = "page string, session_id string, metadata struct<browser: string, device: string>"
    record = F.from_json("event_data", schema).alias("r")
    return t.user_events.select("event_id", record).select(
        "event_id", "r.page", "r.session_id", "r.metadata.browser", "r.metadata.device"
    )


@query(
    "f27_json_text",
    """SELECT order_id, '{"order_id":' || order_id || ',"customer_id":' || customer_id
              || ',"order_date":"' || order_date || '"}' AS value
       FROM sale_orders""",
)
def json_text(t):
    return t.orders.select(
        "order_id", F.to_json(F.struct("order_id", "customer_id", "order_date")).alias("value")
    )


@query(
    "f28_explode_items",
    f"""SELECT order_id, product_id, quantity, {dbl("line_total")} AS line_total FROM feed_items""",
)
def explode_items(t):
    return metrics.order_items(feeds.order_events(t)).select(
        "order_id", "product_id", "quantity", "line_total"
    )


@query(
    "f29_boolean_flag",
    """SELECT order_id, coalesce(shipped_date > required_date, false) AS is_late,
              shipped_date IS NOT NULL AS is_shipped FROM sale_orders""",
)
def boolean_flag(t):
    shipped = F.col("shipped_date")
    return t.orders.select(
        "order_id",
        scalars.flag(shipped > F.col("required_date")).alias("is_late"),
        shipped.isNotNull().alias("is_shipped"),
    )
