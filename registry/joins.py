"""Joins."""

from pyspark.sql import functions as F

from registry.core import AS_OF, big, dbl, query, share
from tillworks.operators import joins, ordering
from tillworks.plans import jobs, marts, staging

PROMO = "PROMO"


@query(
    "j01_order_context",
    f"""SELECT o.order_id, o.customer_id, c.company_name AS customer_name, c.country AS customer_country,
               o.employee_id, e.first_name || ' ' || e.last_name AS employee_name,
               s.company_name AS shipper_name, o.order_date, o.shipped_date,
               o.ship_country, {dbl("o.freight")} AS freight
        FROM sale_orders o
        JOIN customers c ON o.customer_id = c.customer_id
        JOIN employees e ON o.employee_id = e.employee_id
        JOIN shippers s ON o.ship_via = s.shipper_id""",
)
def order_context(t):
    return joins.order_context(t.orders, t.customers, t.employees, t.shippers)


@query(
    "j02_line_context",
    """SELECT order_id, product_id, product_name, category_name,
              CAST(unit_price AS DOUBLE) AS unit_price, quantity,
              CAST(discount AS DOUBLE) AS discount,
              CAST(extended_price AS DOUBLE) AS extended_price
       FROM line_names""",
)
def line_context(t):
    return joins.line_context(t.order_details, t.products, t.categories)


@query(
    "j03_product_catalog",
    """SELECT p.product_id, p.product_name, c.category_name,
              CAST(p.unit_price AS DOUBLE) AS unit_price, p.units_in_stock, p.units_on_order,
              p.reorder_level, p.discontinued
       FROM products p JOIN categories c ON p.category_id = c.category_id""",
)
def product_catalog(t):
    return joins.product_catalog(t.products, t.categories)


@query(
    "j04_enrich_transactions",
    f"""SELECT transaction_id, user_id, product_id, CAST(amount AS DOUBLE) AS amount, status,
               transaction_date, username, email, registration_date, country, product_name,
               category, CAST(price AS DOUBLE) AS price,
               username || ' (' || country || ')' AS user_full_name,
               CAST(date_diff('day', registration_date, transaction_date) AS INTEGER)
                   AS days_since_registration,
               coalesce(category = '{PROMO}', false) AS is_electronics, transaction_year_month
        FROM enriched""",
)
def enrich_transactions(t):
    return joins.enrich_transactions(
        t.sales_transactions.drop("currency", "created_at"), t.users, t.catalog_products, PROMO
    )


@query(
    "j05_product_names",
    """SELECT product_id, product_name, category_name, supplier_name, supplier_country
       FROM s_products""",
)
def product_names(t):
    return staging.stg_products(t.products, t.categories, t.suppliers).select(
        "product_id", "product_name", "category_name", "supplier_name", "supplier_country"
    )


@query(
    "j06_customer_orders",
    f"""SELECT c.customer_id, o.order_id, o.order_date,
               CASE WHEN count(l.order_id) > 0 THEN count(l.order_id) END AS line_count,
               {dbl("sum(l.extended_price)")} AS extended_price,
               {big("sum(l.quantity)")} AS quantity,
               {dbl("sum(l.discount_amount)")} AS discount_amount
        FROM customers c LEFT JOIN sale_orders o ON c.customer_id = o.customer_id
        LEFT JOIN lines l ON o.order_id = l.order_id
        GROUP BY c.customer_id, o.order_id, o.order_date""",
)
def customer_orders(t):
    return joins.customer_orders(
        t.customers.select("customer_id"),
        t.orders.select("order_id", "customer_id", "order_date"),
        t.order_details,
    )


@query(
    "j07_product_order_lines",
    """SELECT p.product_id, p.product_name, l.order_id, l.quantity,
              CAST(l.extended_price AS DOUBLE) AS extended_price, o.order_date, o.customer_id
       FROM products p LEFT JOIN lines l ON p.product_id = l.product_id
       LEFT JOIN sale_orders o ON l.order_id = o.order_id""",
)
def product_order_lines(t):
    return joins.product_order_lines(t.products, t.order_details, t.orders)


@query(
    "j08_full_outer_users",
    """WITH a AS (SELECT user_id, count(*) AS transactions FROM transactions
                  WHERE status = 'failed' GROUP BY user_id),
            b AS (SELECT user_id, count(*) AS signups FROM activity
                  WHERE event_type = 'signup' GROUP BY user_id)
       SELECT coalesce(a.user_id, b.user_id) AS user_id,
              coalesce(transactions, 0) AS transactions, coalesce(signups, 0) AS signups
       FROM a FULL OUTER JOIN b ON a.user_id = b.user_id""",
)
def full_outer_users(t):
    failed = t.sales_transactions.filter(F.col("status") == "failed")
    signups = t.user_events.filter(F.col("event_type") == "signup")
    both = (
        failed.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("transactions"))
        .join(signups.groupBy("user_id").agg(F.count(F.lit(1)).alias("signups")), "user_id", "full")
    )
    return both.select(
        "user_id",
        F.coalesce("transactions", F.lit(0)).alias("transactions"),
        F.coalesce("signups", F.lit(0)).alias("signups"),
    )


@query(
    "j09_daily_orders_and_revenue",
    f"""WITH o AS (SELECT order_date AS date, count(*) AS total_orders FROM sale_orders GROUP BY 1),
             r AS (SELECT order_date AS date, {big("sum(quantity)")} AS total_units_sold,
                          {dbl("sum(extended_price)")} AS total_revenue
                   FROM sale_orders JOIN lines USING (order_id) GROUP BY 1)
        SELECT o.date, o.total_orders, r.total_units_sold, r.total_revenue
        FROM o LEFT JOIN r ON o.date = r.date""",
)
def daily_orders_and_revenue(t):
    orders = staging.stg_orders(t.orders)
    lines = staging.stg_order_details(t.order_details)
    return (
        marts.daily_orders(orders)
        .select("date", "total_orders")
        .join(
            marts.daily_revenue(orders, lines).select("date", "total_units_sold", "total_revenue"),
            "date",
            "left",
        )
    )


@query(
    "j10_share_of_category",
    f"""WITH p AS (SELECT category_name, product_id, sum(extended_price) AS revenue
                   FROM line_names GROUP BY 1, 2),
             c AS (SELECT category_name, sum(revenue) AS total FROM p GROUP BY 1)
        SELECT p.product_id, p.category_name, {dbl("p.revenue")} AS total_revenue,
               {dbl("c.total")} AS category_total_revenue,
               {share("p.revenue", "c.total")} AS pct_of_category_revenue
        FROM p JOIN c ON p.category_name = c.category_name""",
)
def share_of_category(t):
    sales = jobs.product_sales(t.order_details, t.products, t.categories).select(
        "product_id", "category_name", "total_revenue"
    )
    return joins.with_group_share(
        sales,
        "category_name",
        "total_revenue",
        "category_total_revenue",
        "pct_of_category_revenue",
    )


@query(
    "j11_orphans",
    f"""SELECT 'lines of shipped orders' AS relation, count(*) AS orphans FROM lines l
        WHERE NOT EXISTS (SELECT 1 FROM sale_orders o
                          WHERE o.order_id = l.order_id AND o.shipped_date IS NOT NULL)
        UNION ALL
        SELECT 'customers of orders', count(*) FROM sale_orders o
        WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = o.customer_id)""",
)
def orphans(t):
    shipped = t.orders.filter(F.col("shipped_date").isNotNull())
    lines = joins.orphan_count(t.order_details, "order_id", shipped)
    customers = joins.orphan_count(t.orders, "customer_id", t.customers)
    return lines.select(F.lit("lines of shipped orders").alias("relation"), "orphans").unionByName(
        customers.select(F.lit("customers of orders").alias("relation"), "orphans")
    )


@query(
    "j12_lines_of_orders",
    f"""SELECT order_id, product_id, quantity FROM lines
        WHERE order_id IN (SELECT order_id FROM sale_orders
                           WHERE shipped_date >= DATE '{AS_OF}' - 7
                             AND shipped_date < DATE '{AS_OF}' + 1)""",
)
def lines_of_orders(t):
    week = t.orders.filter(
        F.col("shipped_date").between(F.lit("2001-07-26").cast("date"), F.lit(AS_OF).cast("date"))
    )
    return joins.details_of(t.order_details, week).select("order_id", "product_id", "quantity")


@query(
    "j13_lines_of_latest_orders",
    """SELECT order_id, product_id, quantity FROM lines
       WHERE order_id IN (SELECT order_id FROM sale_orders
                          ORDER BY order_date DESC, order_id DESC LIMIT 500)""",
)
def lines_of_latest_orders(t):
    newest = ordering.latest(t.orders, "order_date", "order_id", 500)
    return joins.details_of(t.order_details, newest).select(
        "order_id", "product_id", "quantity"
    )


@query(
    "j14_orders_of_top_quartile",
    """WITH m AS (SELECT o.customer_id, sum(l.extended_price) AS revenue
                  FROM sale_orders o JOIN lines l ON o.order_id = l.order_id GROUP BY 1),
            q AS (SELECT customer_id, ntile(4) OVER (ORDER BY revenue DESC, customer_id) AS tile
                  FROM m)
       SELECT o.order_id, o.customer_id FROM sale_orders o
       WHERE o.customer_id IN (SELECT customer_id FROM q WHERE tile = 1)""",
)
def orders_of_top_quartile(t):
    metrics = jobs.customer_metrics(t.orders, t.order_details, t.customers, AS_OF)
    ranked = jobs.ranked_customers(metrics.select("customer_id", "total_revenue"))
    best = ranked.filter(F.col("revenue_quartile") == 1)
    return joins.rows_of_customers(t.orders.select("order_id", "customer_id"), best)


@query(
    "j15_orders_with_totals",
    f"""SELECT o.order_id, o.customer_id, {dbl("sum(l.extended_price)")} AS order_total
        FROM sale_orders o JOIN lines l ON o.order_id = l.order_id GROUP BY 1, 2""",
)
def orders_with_totals(t):
    return joins.orders_with_totals(t.orders.select("order_id", "customer_id"), t.order_details)


@query(
    "j16_sales_and_stock",
    f"""SELECT s.product_id, s.units AS total_units_sold, p.units_in_stock, p.units_on_order,
               p.reorder_level
        FROM (SELECT product_id, {big("sum(quantity)")} AS units FROM line_names GROUP BY 1) s
        LEFT JOIN products p ON s.product_id = p.product_id""",
)
def sales_and_stock(t):
    sales = jobs.product_sales(t.order_details, t.products, t.categories)
    return jobs.product_stock_analysis(sales, t.products).select(
        "product_id", "total_units_sold", "units_in_stock", "units_on_order", "reorder_level"
    )


@query(
    "j17_sales_lines",
    """SELECT l.order_id, l.product_name, l.category_name, o.order_date,
              CAST(l.extended_price AS DOUBLE) AS extended_price
       FROM line_names l JOIN sale_orders o ON l.order_id = o.order_id""",
)
def sales_lines(t):
    return joins.sales_lines(t.products, t.categories, t.order_details, t.orders).select(
        "order_id", "product_name", "category_name", "order_date", "extended_price"
    )


@query(
    "j18_right_join_distinct",
    """SELECT DISTINCT c.customer_id, c.company_name, c.city, c.country
       FROM customers c RIGHT JOIN sale_orders o ON c.customer_id = o.customer_id
       WHERE o.order_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'""",
)
def right_join_distinct(t):
    return joins.customers_who_ordered(t.customers, t.orders, "1998-01-01", "1998-03-31")


@query(
    "j19_zero_filled_totals",
    f"""SELECT o.order_id, {dbl("coalesce(sum(l.extended_price), 0)")} AS order_total
        FROM sale_orders o LEFT JOIN lines l ON o.order_id = l.order_id GROUP BY 1""",
)
def zero_filled_totals(t):
    return joins.orders_with_zero_totals(t.orders.select("order_id"), t.order_details)
