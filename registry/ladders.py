"""Classification ladders, each over a whole table."""

from pyspark.sql import functions as F

from registry.core import AS_OF, EVENTS_AS_OF, query
from tillworks.functions import ladders, scalars
from tillworks.plans import jobs, marts, staging

PROMO = "PROMO"

_USERS = f"""
    SELECT user_id, count(*) AS n, sum(amount) AS spent,
           sum(CASE WHEN category = '{PROMO}' THEN 1 ELSE 0 END) AS promo
    FROM enriched WHERE status = 'completed' GROUP BY 1"""


def _segments(t):
    return jobs.user_segments(t.sales_transactions, t.users, t.catalog_products, PROMO)


@query(
    "c01_spending_segment",
    f"""WITH u AS ({_USERS})
        SELECT user_id, CASE WHEN spent >= 1000 THEN 'High Value'
                             WHEN spent >= 500 THEN 'Medium Value'
                             ELSE 'Low Value' END AS spending_segment FROM u""",
)
def spending_segment(t):
    return _segments(t).select("user_id", "spending_segment")


@query(
    "c02_purchase_frequency",
    f"""WITH u AS ({_USERS})
        SELECT user_id, CASE WHEN n >= 5 THEN 'Frequent' WHEN n >= 3 THEN 'Regular'
                             ELSE 'Occasional' END AS purchase_frequency FROM u""",
)
def purchase_frequency(t):
    return _segments(t).select("user_id", "purchase_frequency")


@query(
    "c03_product_preference",
    f"""WITH u AS ({_USERS})
        SELECT user_id, CASE WHEN promo / n >= 0.7::DOUBLE THEN 'Electronics Enthusiast'
                             WHEN promo / n >= 0.3::DOUBLE THEN 'Mixed Buyer'
                             ELSE 'Furniture Focused' END AS product_preference FROM u""",
)
def product_preference(t):
    return _segments(t).select("user_id", "product_preference")


@query(
    "c04_transaction_tier",
    """SELECT transaction_id,
              CASE WHEN amount >= 200 THEN 'high' WHEN amount >= 50 THEN 'medium'
                   ELSE 'low' END AS transaction_tier,
              CASE WHEN amount >= 1000 THEN 'High Value' WHEN amount >= 100 THEN 'Medium Value'
                   ELSE 'Low Value' END AS value_label
       FROM transactions""",
)
def transaction_tier(t):
    amount = F.col("amount")
    return t.sales_transactions.select(
        "transaction_id",
        ladders.transaction_tier(amount, high=200, medium=50).alias("transaction_tier"),
        ladders.transaction_value_label(amount).alias("value_label"),
    )


@query("c05_shipping_performance", "SELECT order_id, shipping_performance FROM s_orders")
def shipping_performance(t):
    return staging.stg_orders(t.orders).select("order_id", "shipping_performance")


@query("c06_freight_tier", "SELECT order_id, freight_tier FROM s_orders")
def freight_tier(t):
    return t.orders.select("order_id", ladders.freight_tier(F.col("freight")).alias("freight_tier"))


@query("c07_quantity_tier", "SELECT order_id, product_id, quantity, quantity_tier FROM s_lines")
def quantity_tier(t):
    return t.order_details.select(
        "order_id",
        "product_id",
        "quantity",
        ladders.quantity_tier(F.col("quantity")).alias("quantity_tier"),
    )


@query(
    "c08_discount_tier",
    """SELECT order_id, product_id, CAST(discount AS DOUBLE) AS discount, discount_tier
       FROM s_lines""",
)
def discount_tier(t):
    return t.order_details.select(
        "order_id",
        "product_id",
        "discount",
        ladders.discount_tier(F.col("discount")).alias("discount_tier"),
    )


@query(
    "c09_high_value_line",
    "SELECT order_id, product_id, extended_price >= 500 AS is_high_value_line FROM lines",
)
def high_value_line(t):
    return staging.stg_order_details(t.order_details).select(
        "order_id",
        "product_id",
        ladders.is_high_value_line(F.col("extended_price"), 500).alias("is_high_value_line"),
    )


@query("c10_region_group", "SELECT customer_id, country, region_group FROM s_customers")
def region_group(t):
    return t.customers.select(
        "customer_id", "country", ladders.region_group(F.col("country")).alias("region_group")
    )


@query("c11_contact_type", "SELECT customer_id, contact_type FROM s_customers")
def contact_type(t):
    return t.customers.select(
        "customer_id", ladders.contact_type(F.col("contact_title")).alias("contact_type")
    )


_STOCK = ("units_in_stock", "reorder_level", "discontinued")


@query(
    "c12_needs_reorder",
    """SELECT product_id, units_in_stock <= reorder_level AND NOT discontinued AS needs_reorder
       FROM products""",
)
def needs_reorder(t):
    return t.products.select(
        "product_id", ladders.needs_reorder(*map(F.col, _STOCK)).alias("needs_reorder")
    )


@query("c13_stock_status", "SELECT product_id, stock_status FROM s_products")
def stock_status(t):
    return t.products.select(
        "product_id", ladders.stock_status(*map(F.col, _STOCK)).alias("stock_status")
    )


@query("c14_price_tier", "SELECT product_id, price_tier FROM s_products")
def price_tier(t):
    return t.products.select(
        "product_id", ladders.price_tier(F.col("unit_price")).alias("price_tier")
    )


@query("c15_product_status", "SELECT product_id, product_status FROM s_products")
def product_status(t):
    return t.products.select(
        "product_id", ladders.product_status(*map(F.col, _STOCK)).alias("product_status")
    )


@query(
    "c16_inventory_status",
    """SELECT product_id, CASE WHEN units_in_stock <= reorder_level THEN 'LOW STOCK'
                               WHEN units_in_stock > 3 * reorder_level THEN 'OVERSTOCKED'
                               ELSE 'NORMAL' END AS inventory_status FROM products""",
)
def inventory_status(t):
    return t.products.select(
        "product_id",
        ladders.inventory_status(F.col("units_in_stock"), F.col("reorder_level")).alias(
            "inventory_status"
        ),
    )


_CUSTOMERS = f"""
    SELECT c.customer_id, count(DISTINCT o.order_id) AS n, sum(l.extended_price) AS value,
           DATE '{AS_OF}' - max(o.order_date) AS days
    FROM customers c LEFT JOIN sale_orders o ON c.customer_id = o.customer_id
    LEFT JOIN lines l ON o.order_id = l.order_id GROUP BY 1"""


def _customers(t):
    base = marts.customer_aggregates(
        staging.stg_customers(t.customers), staging.stg_orders(t.orders), t.order_details
    )
    return base.withColumn("days", scalars.age_days("last_order_day", AS_OF))


@query(
    "c17_customer_value",
    f"""WITH m AS ({_CUSTOMERS})
        SELECT customer_id, CASE WHEN value >= 20000 THEN 'VIP' WHEN value >= 15000
                   THEN 'High Value' WHEN value >= 10000 THEN 'Medium Value'
                   WHEN value > 0 THEN 'Low Value' ELSE 'No Orders' END AS value_segment
        FROM m""",
)
def customer_value(t):
    segment = ladders.customer_value(F.col("lifetime_value"), 20000, 15000, 10000)
    return _customers(t).select("customer_id", segment.alias("value_segment"))


@query(
    "c18_customer_frequency",
    f"""WITH m AS ({_CUSTOMERS})
        SELECT customer_id, CASE WHEN n >= 20 THEN 'Frequent' WHEN n >= 10 THEN 'Regular'
                   WHEN n >= 5 THEN 'Occasional' WHEN n > 0 THEN 'One-Time'
                   ELSE 'Never Ordered' END AS frequency_segment FROM m""",
)
def customer_frequency(t):
    segment = ladders.customer_frequency(F.col("total_orders"))
    return _customers(t).select("customer_id", segment.alias("frequency_segment"))


@query(
    "c19_customer_activity",
    f"""WITH m AS ({_CUSTOMERS})
        SELECT customer_id, CASE WHEN days IS NULL THEN 'Never Ordered'
                   WHEN days <= 30 THEN 'Active' WHEN days <= 90 THEN 'At Risk'
                   WHEN days <= 180 THEN 'Dormant' ELSE 'Churned' END AS activity_status
        FROM m""",
)
def customer_activity(t):
    return _customers(t).select(
        "customer_id", ladders.customer_activity(F.col("days")).alias("activity_status")
    )


@query(
    "c20_customer_tier",
    f"""WITH m AS ({_CUSTOMERS}),
        s AS (SELECT *, CASE WHEN value >= 30000 THEN 'VIP' WHEN value >= 20000 THEN 'High Value'
                             WHEN value >= 1000 THEN 'Medium Value' ELSE 'Low Value' END AS v,
                     CASE WHEN n >= 15 THEN 'Frequent' WHEN n >= 12 THEN 'Regular'
                          ELSE 'Other' END AS f FROM m)
        SELECT customer_id,
               CASE WHEN v = 'VIP' AND f = 'Frequent' AND coalesce(days, 0) <= 30 THEN 'Champion'
                    WHEN v IN ('VIP', 'High Value') AND f <> 'Other' THEN 'Loyal'
                    WHEN days > 90 AND v IN ('VIP', 'High Value') THEN 'At Risk VIP'
                    WHEN n <= 8 AND coalesce(days, 0) <= 90 THEN 'New Customer'
                    WHEN days > 180 THEN 'Lost' ELSE 'Standard' END AS customer_tier
        FROM s""",
)
def customer_tier(t):
    value = ladders.customer_value(F.col("lifetime_value"), 30000, 20000, 1000)
    frequency = ladders.customer_frequency(F.col("total_orders"), frequent=15, regular=12)
    tier = ladders.customer_tier(
        value, frequency, F.col("total_orders"), F.col("days"), new_orders=8
    )
    return _customers(t).select("customer_id", tier.alias("customer_tier"))


_ACTIVE = """
    SELECT coalesce(x.user_id, y.user_id) AS user_id, coalesce(x.value, 0) AS value,
           coalesce(x.day, y.day) AS day
    FROM (SELECT user_id, sum(CASE WHEN is_completed THEN amount ELSE 0 END) AS value,
                 max(transaction_day) AS day FROM s_transactions GROUP BY 1) x
    FULL OUTER JOIN (SELECT user_id, max(CAST(event_timestamp AS DATE)) AS day
                     FROM activity GROUP BY 1) y ON x.user_id = y.user_id"""


def _users(t):
    return marts.dim_user_metrics(
        staging.stg_sales_transactions(t.sales_transactions),
        staging.stg_user_events(t.user_events),
        EVENTS_AS_OF,
    )


@query(
    "c21_user_segment",
    f"""WITH u AS ({_ACTIVE})
        SELECT user_id, CASE WHEN value >= 2000 THEN 'VIP' WHEN value >= 1500 THEN 'High Value'
                   WHEN value >= 1000 THEN 'Medium Value' WHEN value > 0 THEN 'Low Value'
                   ELSE 'No Purchase' END AS user_segment FROM u""",
)
def user_segment(t):
    segment = ladders.user_segment(F.col("lifetime_value"), 2000, 1500, 1000)
    return _users(t).select("user_id", segment.alias("user_segment"))


@query(
    "c22_user_activity",
    f"""WITH u AS ({_ACTIVE})
        SELECT user_id, CASE WHEN DATE '{EVENTS_AS_OF}' - day <= 2 THEN 'Active'
                             WHEN DATE '{EVENTS_AS_OF}' - day <= 4 THEN 'At Risk'
                             WHEN DATE '{EVENTS_AS_OF}' - day <= 6 THEN 'Dormant'
                             ELSE 'Churned' END AS activity_status FROM u""",
)
def user_activity(t):
    status = ladders.user_activity(F.col("days_since_last_activity"), 2, 4, 6)
    return _users(t).select("user_id", status.alias("activity_status"))


_REVENUE = """
    SELECT p.product_id, p.stock_status, p.discontinued, sum(l.extended_price) AS revenue,
           max(o.order_date) AS last_day
    FROM s_products p LEFT JOIN lines l ON p.product_id = l.product_id
    LEFT JOIN sale_orders o ON l.order_id = o.order_id GROUP BY 1, 2, 3"""


def _products(t):
    return marts.product_metrics(
        staging.stg_products(t.products, t.categories, t.suppliers),
        staging.stg_order_details(t.order_details),
        staging.stg_orders(t.orders),
        staging.stg_customers(t.customers),
    )


@query(
    "c23_performance_tier",
    f"""WITH m AS ({_REVENUE})
        SELECT product_id, CASE WHEN revenue >= 17000 THEN 'Star Product'
                   WHEN revenue >= 14000 THEN 'High Performer'
                   WHEN revenue >= 11000 THEN 'Solid Performer' WHEN revenue > 0
                   THEN 'Low Performer' ELSE 'Never Sold' END AS performance_tier FROM m""",
)
def performance_tier(t):
    tier = ladders.performance_tier(F.col("total_revenue"), 17000, 14000, 11000)
    return _products(t).select("product_id", tier.alias("performance_tier"))


@query(
    "c24_inventory_action",
    f"""WITH m AS ({_REVENUE})
        SELECT product_id,
               CASE WHEN discontinued THEN 'Discontinued'
                    WHEN stock_status = 'Out of Stock' AND revenue > 12000
                        THEN 'URGENT: Restock High Seller'
                    WHEN stock_status = 'Low Stock' AND revenue > 13000
                        THEN 'High Priority Restock'
                    WHEN stock_status = 'Low Stock' THEN 'Monitor Stock'
                    WHEN stock_status = 'Overstocked' AND DATE '{AS_OF}' - last_day > 60
                        THEN 'Liquidate Excess'
                    WHEN stock_status = 'Overstocked' THEN 'Reduce Inventory'
                    ELSE 'Normal' END AS inventory_action
        FROM m""",
)
def inventory_action(t):
    action = ladders.inventory_action(
        F.col("discontinued"),
        F.col("stock_status"),
        F.col("total_revenue"),
        scalars.age_days("last_sale_day", AS_OF),
        urgent=12000,
        priority=13000,
        stale_days=60,
    )
    return _products(t).select("product_id", action.alias("inventory_action"))
