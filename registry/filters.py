"""Projections, filters, order and set operations."""

from pyspark.sql import functions as F

from registry.core import AS_OF, EVENTS_NOW, START_DATE, query
from tillworks.functions import ladders
from tillworks.operators import aggregates, filters, joins, ordering, unions
from tillworks.plans import jobs, staging


@query(
    "p01_select_rename",
    "SELECT order_id, customer_id, order_date, ship_via AS shipper_id FROM sale_orders",
)
def select_rename(t):
    names = {c: c for c in ("order_id", "customer_id", "order_date")}
    return filters.renamed(t.orders, {**names, "ship_via": "shipper_id"})


@query(
    "p02_disambiguate_names",
    """SELECT t.transaction_id, u.username AS customer_name, u.country,
              g.product_name, g.category, CAST(t.amount AS DOUBLE) AS amount, t.status
       FROM transactions t LEFT JOIN users u ON t.user_id = u.user_id
       LEFT JOIN goods g ON t.product_id = g.product_id""",
)
def disambiguate_names(t):
    return joins.named_transactions(
        t.sales_transactions,
        t.users.withColumnRenamed("username", "name"),
        t.catalog_products.withColumnRenamed("product_name", "name"),
    )


@query(
    "p03_rename_aggregates",
    """SELECT status, CAST(sum(amount) AS DOUBLE) AS total_revenue,
              count(transaction_id) AS transaction_count
       FROM transactions GROUP BY status""",
)
def rename_aggregates(t):
    return aggregates.by_dict(
        t.sales_transactions,
        ["status"],
        {"amount": "sum", "transaction_id": "count"},
        {"sum(amount)": "total_revenue", "count(transaction_id)": "transaction_count"},
    )


@query(
    "p04_computed_columns",
    """SELECT product_id, units_in_stock, units_on_order, reorder_level,
              units_in_stock + units_on_order AS total_available_units,
              units_in_stock - reorder_level AS headroom
       FROM products""",
)
def computed_columns(t):
    stock = F.col("units_in_stock")
    return t.products.select(
        "product_id", "units_in_stock", "units_on_order", "reorder_level"
    ).withColumns(
        {
            "total_available_units": stock + F.col("units_on_order"),
            "headroom": stock - F.col("reorder_level"),
        }
    )


@query(
    "p05_completed_only",
    """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount FROM transactions
       WHERE status = 'completed'""",
)
def completed_only(t):
    return filters.completed(t.sales_transactions).select("transaction_id", "amount")


@query(
    "p06_start_date",
    f"""SELECT transaction_id, transaction_date FROM transactions
        WHERE transaction_date >= TIMESTAMP '{START_DATE}'""",
)
def start_date(t):
    return filters.since(t.sales_transactions, "transaction_date", START_DATE).select(
        "transaction_id", "transaction_date"
    )


@query(
    "p07_previous_day",
    """SELECT order_id, shipped_date FROM sale_orders
       WHERE shipped_date >= DATE '2001-08-01' AND shipped_date < DATE '2001-08-02'""",
)
def previous_day(t):
    return filters.previous_day(t.orders, "shipped_date", AS_OF).select("order_id", "shipped_date")


def _fallback_sql(as_of):
    return f"""
        WITH day AS (
            SELECT order_id, shipped_date FROM sale_orders
            WHERE shipped_date >= DATE '{as_of}' - 1 AND shipped_date < DATE '{as_of}'),
        week AS (
            SELECT order_id, shipped_date FROM sale_orders
            WHERE shipped_date >= DATE '{as_of}' - 7 AND shipped_date < DATE '{as_of}' + 1)
        SELECT * FROM day
        UNION ALL SELECT * FROM week WHERE NOT EXISTS (SELECT 1 FROM day)"""


@query("p08_previous_day_or_week", _fallback_sql("2001-08-18"))
def previous_day_or_week(t):
    # Nothing ships so late, so the week stands in for the day.
    return filters.previous_day_or_week(t.orders, "shipped_date", "2001-08-18").select(
        "order_id", "shipped_date"
    )


@query("p08b_previous_day_found", _fallback_sql(AS_OF))
def previous_day_found(t):
    return filters.previous_day_or_week(t.orders, "shipped_date", AS_OF).select(
        "order_id", "shipped_date"
    )


@query(
    "p09_lookback",
    f"""SELECT 'orders' AS source, order_id AS id FROM sale_orders
        WHERE order_date >= DATE '{AS_OF}' - 7
        UNION ALL
        SELECT 'events', event_id FROM activity
        WHERE created_at >= TIMESTAMP '{EVENTS_NOW}' - INTERVAL 1 HOUR""",
)
def lookback(t):
    orders = filters.recent_days(t.orders, "order_date", AS_OF, 7)
    events = filters.lookback(t.user_events, "created_at", EVENTS_NOW, hours=1)
    return orders.select(F.lit("orders").alias("source"), F.col("order_id").alias("id")).union(
        events.select(F.lit("events"), "event_id")
    )


@query(
    "p10_between_dates",
    """SELECT order_id, order_date FROM sale_orders
       WHERE order_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""",
)
def between_dates(t):
    return filters.between_dates(t.orders, "order_date", "1997-01-01", "1997-12-31").select(
        "order_id", "order_date"
    )


@query(
    "p11_null_tests",
    """SELECT order_id, 'open' AS state FROM sale_orders WHERE shipped_date IS NULL
       UNION ALL SELECT order_id, 'shipped' FROM sale_orders WHERE shipped_date IS NOT NULL""",
)
def null_tests(t):
    waiting = filters.missing(t.orders, "shipped_date").select(
        "order_id", F.lit("open").alias("state")
    )
    return waiting.union(
        filters.present(t.orders, "shipped_date").select("order_id", F.lit("shipped"))
    )


@query("p12_not_discontinued", "SELECT product_id, product_name FROM products WHERE NOT discontinued")
def not_discontinued(t):
    return filters.sellable(t.products).select("product_id", "product_name")


@query(
    "p13_out_of_range",
    """SELECT order_id, product_id, quantity FROM lines
       WHERE quantity < 5 OR quantity > 45""",
)
def out_of_range(t):
    return filters.outside(t.order_details, "quantity", 5, 45).select(
        "order_id", "product_id", "quantity"
    )


@query(
    "p14_label_and_measure",
    """SELECT product_id, product_status, CAST(unit_price AS DOUBLE) AS unit_price
       FROM s_products WHERE product_status = 'Low Stock' AND unit_price > 30""",
)
def label_and_measure(t):
    staged = staging.stg_products(t.products, t.categories, t.suppliers)
    return filters.labelled_above(
        staged, "product_status", "Low Stock", "unit_price", 30
    ).select("product_id", "product_status", "unit_price")


@query(
    "p15_value_list",
    """SELECT customer_id, country FROM customers
       WHERE country IN ('USA', 'Canada', 'Mexico')""",
)
def value_list(t):
    return filters.in_list(t.customers, "country", ladders.NORTH_AMERICA).select(
        "customer_id", "country"
    )


# Order and limits

_SPENT = """SELECT user_id, CAST(sum(amount) AS DOUBLE) AS total_spent FROM transactions
            WHERE status = 'completed' GROUP BY user_id"""


def _spent(t):
    done = filters.completed(t.sales_transactions)
    return done.groupBy("user_id").agg(F.sum("amount").alias("total_spent"))


@query("o01_order_by_measure", f"{_SPENT} ORDER BY total_spent DESC, user_id")
def order_by_measure(t):
    return ordering.by_measure(_spent(t), "total_spent", "user_id")


@query(
    "o02_mixed_order",
    """SELECT country, category, count(*) AS transactions FROM enriched
       GROUP BY country, category ORDER BY country, transactions DESC, category""",
)
def mixed_order(t):
    sums = jobs._country_category_sums(t.sales_transactions, t.users, t.catalog_products)
    counts = sums.select("country", "category", "transactions")
    return ordering.by_keys_then_measure(counts, ["country"], "transactions", "category")


@query(
    "o03_nulls_last",
    """SELECT customer_id, last_order_date FROM (
           SELECT c.customer_id, max(o.order_date) AS last_order_date
           FROM customers c LEFT JOIN sale_orders o ON c.customer_id = o.customer_id
           GROUP BY c.customer_id)
       ORDER BY last_order_date DESC NULLS LAST, customer_id""",
)
def nulls_last(t):
    last = t.orders.groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"))
    every = t.customers.select("customer_id").join(last, "customer_id", "left")
    return ordering.by_measure_nulls_last(every, "last_order_date", "customer_id")


@query(
    "o04_latest_orders",
    """SELECT order_id, customer_id, order_date FROM sale_orders
       ORDER BY order_date DESC, order_id DESC LIMIT 500""",
)
def latest_orders(t):
    return ordering.latest(t.orders, "order_date", "order_id", 500).select(
        "order_id", "customer_id", "order_date"
    )


@query("o05_top_users", f"{_SPENT} ORDER BY sum(amount) DESC, user_id LIMIT 10")
def top_users(t):
    return ordering.top(_spent(t), "total_spent", 10, "user_id")


@query(
    "o06_first_of_sorted",
    """WITH sums AS (SELECT category, sum(amount) AS revenue FROM enriched GROUP BY category)
       SELECT category AS top_category, CAST(revenue AS DOUBLE) AS top_revenue
       FROM sums ORDER BY revenue DESC, category DESC LIMIT 1""",
)
def first_of_sorted(t):
    per_product = t.sales_transactions.groupBy("product_id").agg(F.sum("amount").alias("amount"))
    sums = (
        per_product.join(t.catalog_products.select("product_id", "category"), "product_id", "left")
        .groupBy("category")
        .agg(F.sum("amount").alias("revenue"))
    )
    return sums.agg(
        ordering.first_by("category", "revenue", "top_category"),
        F.max("revenue").alias("top_revenue"),
    )


#: The counted tables: label, place in the catalog, name in the SQL model.
COUNTED = (
    ("Categories", "categories", "categories"),
    ("Suppliers", "suppliers", "suppliers"),
    ("Products", "products", "products"),
    ("Customers", "customers", "customers"),
    ("Employees", "employees", "employees"),
    ("Shippers", "shippers", "shippers"),
    ("Orders", "orders", "sale_orders"),
    ("Order Details", "order_details", "lines"),
)


@query(
    "u01_table_counts",
    " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS record_count FROM {model}" for label, _, model in COUNTED
    ),
)
def table_counts(t):
    return unions.table_counts({label: t.table("trading", name) for label, name, _ in COUNTED})
