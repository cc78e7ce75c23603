"""The named analytics jobs and the staging models."""

from registry.core import AS_OF, big, dbl, mean, query, quotient, stored
from tillworks.plans import jobs, staging

PROMO = "PROMO"


@query(
    "a20_aggregate_by_user",
    f"""SELECT user_id, count(transaction_id) AS total_transactions,
               {dbl("sum(amount)")} AS total_spent, {mean("amount")} AS avg_transaction_value,
               {dbl("max(amount)")} AS max_transaction, {dbl("min(amount)")} AS min_transaction
        FROM transactions WHERE status = 'completed' GROUP BY user_id
        ORDER BY sum(amount) DESC, user_id""",
)
def by_user(t):
    return jobs.aggregate_by_user(t.sales_transactions)


@query(
    "a21_aggregate_by_product",
    f"""SELECT product_id, count(transaction_id) AS total_sales,
               {dbl("sum(amount)")} AS total_revenue, {mean("amount")} AS avg_price
        FROM transactions WHERE status = 'completed' GROUP BY product_id
        ORDER BY sum(amount) DESC, product_id""",
)
def by_product(t):
    return jobs.aggregate_by_product(t.sales_transactions)


@query(
    "a22_aggregate_by_time",
    f"""SELECT CAST(year(transaction_date) AS INTEGER) AS year,
               CAST(month(transaction_date) AS INTEGER) AS month,
               CAST(day(transaction_date) AS INTEGER) AS day,
               count(transaction_id) AS daily_transactions,
               {dbl("sum(amount)")} AS daily_revenue, {mean("amount")} AS avg_transaction_value
        FROM transactions WHERE status = 'completed' GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
)
def by_time(t):
    return jobs.aggregate_by_time(t.sales_transactions)


@query(
    "a23_country_category_summary",
    f"""SELECT country, category, count(*) AS transactions, {dbl("sum(amount)")} AS total_revenue
        FROM enriched GROUP BY 1, 2 ORDER BY country, sum(amount) DESC, category""",
)
def country_category(t):
    return jobs.country_category_summary(t.sales_transactions, t.users, t.catalog_products)


@query(
    "a24_category_country_performance",
    f"""SELECT category, country, {dbl("sum(amount)")} AS total_revenue,
               count(transaction_id) AS transaction_count,
               {quotient("sum(amount)", "count(transaction_id)")} AS avg_transaction_value
        FROM enriched GROUP BY 1, 2 ORDER BY sum(amount) DESC, category, country""",
)
def category_country(t):
    return jobs.category_country_performance(t.sales_transactions, t.users, t.catalog_products)


@query(
    "a25_daily_sales_summary",
    f"""WITH per_order AS (SELECT order_id, sum(extended_price) AS total FROM lines GROUP BY 1)
        SELECT DATE '{AS_OF}' AS date, (SELECT count(*) FROM sale_orders) AS total_orders,
               {dbl("sum(extended_price)")} AS total_revenue,
               {big("sum(quantity)")} AS total_items_sold,
               (SELECT count(DISTINCT customer_id) FROM sale_orders) AS unique_customers,
               count(DISTINCT product_id) AS unique_products,
               (SELECT {mean("total")} FROM per_order) AS avg_order_value,
               {mean("discount")} AS avg_discount,
               (SELECT {dbl("sum(freight)")} FROM sale_orders) AS total_freight
        FROM lines""",
)
def daily_summary(t):
    return jobs.daily_sales_summary(t.orders, t.order_details, AS_OF)


@query(
    "a26_sales_by_category_summary",
    f"""SELECT category_name, {dbl("sum(extended_price)")} AS revenue,
               {big("sum(quantity)")} AS units_sold, count(DISTINCT order_id) AS order_count,
               CAST(sum(extended_price) AS DOUBLE) / sum(quantity) AS avg_item_price
        FROM line_names GROUP BY 1 ORDER BY sum(extended_price) DESC""",
)
def category_summary(t):
    return jobs.sales_by_category_summary(t.order_details, t.products, t.categories)


@query(
    "a27_sales_by_country",
    f"""WITH totals AS (SELECT order_id, sum(extended_price) AS total FROM lines GROUP BY 1)
        SELECT c.country, {dbl("sum(total)")} AS revenue, count(o.order_id) AS order_count,
               count(DISTINCT o.customer_id) AS customer_count
        FROM sale_orders o JOIN totals USING (order_id)
        JOIN customers c ON o.customer_id = c.customer_id
        GROUP BY 1 ORDER BY sum(total) DESC, c.country""",
)
def by_country(t):
    return jobs.sales_by_country(t.orders, t.order_details, t.customers)


@query(
    "a28_sales_by_employee",
    f"""WITH totals AS (SELECT order_id, sum(extended_price) AS total FROM lines GROUP BY 1)
        SELECT e.first_name || ' ' || e.last_name AS employee_name,
               {dbl("sum(total)")} AS revenue, count(o.order_id) AS order_count
        FROM sale_orders o JOIN totals USING (order_id)
        JOIN employees e ON o.employee_id = e.employee_id
        GROUP BY 1 ORDER BY sum(total) DESC""",
)
def by_employee(t):
    return jobs.sales_by_employee(t.orders, t.order_details, t.employees)


CUSTOMER_METRICS = f"""
    SELECT o.customer_id, c.company_name AS customer_name, c.country AS customer_country,
           count(o.order_id) AS total_orders, sum(l.extended_price) AS total_revenue,
           max(o.order_date) AS last_order_date, min(o.order_date) AS first_order_date,
           sum(l.quantity) AS total_units_purchased
    FROM sale_orders o JOIN lines l ON o.order_id = l.order_id
    JOIN customers c ON o.customer_id = c.customer_id GROUP BY 1, 2, 3"""


@query(
    "a29_customer_metrics",
    f"""WITH m AS ({CUSTOMER_METRICS})
        SELECT customer_id, customer_name, customer_country, total_orders,
               {dbl("total_revenue")} AS total_revenue,
               CAST(total_revenue AS DOUBLE) / total_orders AS avg_order_line_value,
               last_order_date, first_order_date,
               {big("total_units_purchased")} AS total_units_purchased,
               {quotient("total_revenue", "total_orders")} AS avg_order_value,
               CAST(DATE '{AS_OF}' - last_order_date AS INTEGER) AS days_since_last_order
        FROM m""",
)
def customer_metrics(t):
    return jobs.customer_metrics(t.orders, t.order_details, t.customers, AS_OF)


@query(
    "a30_country_performance",
    f"""WITH m AS ({CUSTOMER_METRICS})
        SELECT customer_country, count(customer_id) AS customer_count,
               {dbl("sum(total_revenue)")} AS country_revenue,
               {mean("total_revenue")} AS avg_customer_value,
               {big("sum(total_orders)")} AS total_orders,
               {quotient("sum(total_revenue)", "sum(total_orders)")} AS revenue_per_order
        FROM m GROUP BY 1 ORDER BY sum(total_revenue) DESC""",
)
def country_performance(t):
    return jobs.country_performance(
        jobs.customer_metrics(t.orders, t.order_details, t.customers, AS_OF)
    )


@query(
    "a31_top_customer_categories",
    f"""WITH m AS ({CUSTOMER_METRICS}),
        q AS (SELECT customer_id, ntile(4) OVER (ORDER BY total_revenue DESC, customer_id) AS tile
              FROM m)
        SELECT n.category_name, {dbl("sum(n.extended_price)")} AS category_revenue,
               count(n.order_id) AS order_count, {big("sum(n.quantity)")} AS units_sold
        FROM line_names n JOIN sale_orders o ON n.order_id = o.order_id
        JOIN q ON o.customer_id = q.customer_id AND q.tile = 1
        GROUP BY 1 ORDER BY sum(n.extended_price) DESC""",
)
def top_customer_categories(t):
    sales = jobs.customer_category_sales(
        t.orders, t.order_details, t.customers, t.products, t.categories
    )
    return jobs.top_customer_categories(stored(sales, "a31"))


PRODUCT_SALES = f"""
    SELECT product_id, product_name, category_name, count(order_id) AS times_ordered,
           sum(quantity) AS total_units_sold, sum(extended_price) AS total_revenue,
           {mean("unit_price")} AS avg_selling_price, {mean("discount")} AS avg_discount_rate
    FROM line_names GROUP BY 1, 2, 3"""


@query(
    "a32_product_sales",
    f"""WITH s AS ({PRODUCT_SALES})
        SELECT product_id, product_name, category_name, times_ordered,
               {big("total_units_sold")} AS total_units_sold,
               {dbl("total_revenue")} AS total_revenue, avg_selling_price, avg_discount_rate,
               {quotient("total_revenue", "total_units_sold")} AS revenue_per_unit
        FROM s""",
)
def product_sales(t):
    return jobs.product_sales(t.order_details, t.products, t.categories)


PRODUCT_STOCK = f"""
    SELECT s.*, p.units_in_stock, p.units_on_order, p.reorder_level,
           CASE WHEN p.units_in_stock <= p.reorder_level THEN 'LOW STOCK'
                WHEN p.units_in_stock > p.reorder_level * 3 THEN 'OVERSTOCKED'
                ELSE 'NORMAL' END AS inventory_status
    FROM ({PRODUCT_SALES}) s LEFT JOIN products p ON s.product_id = p.product_id"""


@query(
    "a33_product_stock_analysis",
    f"""WITH a AS ({PRODUCT_STOCK})
        SELECT product_id, product_name, {dbl("total_revenue")} AS total_revenue,
               {big("total_units_sold")} AS total_units_sold, units_in_stock, inventory_status,
               {quotient("units_in_stock * 30", "total_units_sold", 1, "NULL")}
                   AS stock_coverage_orders
        FROM a""",
)
def product_stock(t):
    sales = jobs.product_sales(t.order_details, t.products, t.categories)
    return jobs.product_stock_analysis(sales, t.products).select(
        "product_id",
        "product_name",
        "total_revenue",
        "total_units_sold",
        "units_in_stock",
        "inventory_status",
        "stock_coverage_orders",
    )


@query(
    "a34_category_performance",
    f"""WITH s AS ({PRODUCT_SALES})
        SELECT category_name, count(product_id) AS products_in_category,
               {dbl("sum(total_revenue)")} AS category_revenue,
               {big("sum(total_units_sold)")} AS category_units_sold,
               round(avg(avg_discount_rate), 9) AS avg_category_discount,
               {quotient("sum(total_revenue)", "count(product_id)")} AS revenue_per_product
        FROM s GROUP BY 1 ORDER BY sum(total_revenue) DESC""",
)
def category_performance(t):
    return jobs.category_performance(
        jobs.product_sales(t.order_details, t.products, t.categories)
    )


@query(
    "a35_stock_alerts",
    f"""WITH a AS ({PRODUCT_STOCK})
        SELECT product_name, category_name, {dbl("total_revenue")} AS total_revenue,
               {big("total_units_sold")} AS total_units_sold, units_in_stock, units_on_order
        FROM a WHERE inventory_status = 'LOW STOCK' AND total_revenue > 1000
        ORDER BY a.total_revenue DESC, product_id""",
)
def stock_alerts(t):
    sales = jobs.product_sales(t.order_details, t.products, t.categories)
    return jobs.stock_alerts(jobs.product_stock_analysis(sales, t.products))


@query(
    "a36_user_segments",
    f"""WITH m AS (
            SELECT user_id, username, country, count(transaction_id) AS total_transactions,
                   sum(amount) AS total_spent, {mean("amount")} AS avg_transaction,
                   {big(f"sum(CASE WHEN category = '{PROMO}' THEN 1 ELSE 0 END)")}
                       AS electronics_purchases
            FROM enriched WHERE status = 'completed' GROUP BY 1, 2, 3)
        SELECT user_id, username, country, total_transactions,
               {dbl("total_spent")} AS total_spent, avg_transaction, electronics_purchases,
               CASE WHEN total_spent >= 1000 THEN 'High Value'
                    WHEN total_spent >= 500 THEN 'Medium Value' ELSE 'Low Value'
               END AS spending_segment,
               CASE WHEN total_transactions >= 5 THEN 'Frequent'
                    WHEN total_transactions >= 3 THEN 'Regular' ELSE 'Occasional'
               END AS purchase_frequency,
               CASE WHEN electronics_purchases / total_transactions >= CAST(0.7 AS DOUBLE)
                    THEN 'Electronics Enthusiast'
                    WHEN electronics_purchases / total_transactions >= CAST(0.3 AS DOUBLE)
                    THEN 'Mixed Buyer' ELSE 'Furniture Focused' END AS product_preference
        FROM m""",
)
def user_segments(t):
    return jobs.user_segments(t.sales_transactions, t.users, t.catalog_products, PROMO)


@query(
    "a37_executive_summary",
    f"""WITH m AS ({CUSTOMER_METRICS}), a AS ({PRODUCT_STOCK}),
        byc AS (SELECT customer_country, sum(total_revenue) AS r FROM m GROUP BY 1),
        cat AS (SELECT category_name, sum(total_revenue) AS r FROM a GROUP BY 1)
        SELECT DATE '{AS_OF}' AS as_of, (SELECT count(*) FROM m) AS total_customers,
               (SELECT {dbl("sum(total_revenue)")} FROM m) AS total_revenue,
               (SELECT {mean("total_revenue")} FROM m) AS avg_customer_value,
               (SELECT customer_country FROM byc ORDER BY r DESC, 1 DESC LIMIT 1) AS top_country,
               (SELECT {dbl("max(r)")} FROM byc) AS top_country_revenue,
               (SELECT count(*) FROM a) AS total_products,
               (SELECT {dbl("sum(total_revenue)")} FROM a) AS total_product_revenue,
               (SELECT product_name FROM a ORDER BY total_revenue DESC, product_name DESC LIMIT 1)
                   AS top_product,
               (SELECT {dbl("max(total_revenue)")} FROM a) AS top_product_revenue,
               (SELECT category_name FROM cat ORDER BY r DESC, 1 DESC LIMIT 1) AS top_category,
               (SELECT {dbl("max(r)")} FROM cat) AS top_category_revenue,
               (SELECT count(*) FROM a WHERE inventory_status = 'LOW STOCK'
                    AND total_revenue > 1000) AS stock_alerts""",
)
def executive_summary(t):
    metrics = jobs.customer_metrics(t.orders, t.order_details, t.customers, AS_OF)
    sales = jobs.product_sales(t.order_details, t.products, t.categories)
    analysis = jobs.product_stock_analysis(sales, t.products)
    return jobs.executive_summary(metrics, analysis, AS_OF)


@query(
    "a38_order_subtotals",
    f"SELECT order_id, {dbl('sum(extended_price)')} AS subtotal FROM lines GROUP BY order_id",
)
def order_subtotals(t):
    return jobs.order_subtotals(t.order_details)


@query(
    "a39_product_sales_for_period",
    f"""SELECT n.category_name, n.product_name, {dbl("sum(n.extended_price)")} AS product_sales
        FROM line_names n JOIN sale_orders o ON n.order_id = o.order_id
        WHERE o.order_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY 1, 2""",
)
def product_sales_for_period(t):
    return jobs.product_sales_between(
        t.order_details, t.orders, t.products, t.categories, "1997-01-01", "1997-12-31"
    )


@query(
    "a40_sales_by_category",
    f"""SELECT n.category_id, n.category_name, n.product_name,
               {dbl("sum(n.extended_price)")} AS product_sales
        FROM line_names n JOIN sale_orders o ON n.order_id = o.order_id GROUP BY 1, 2, 3""",
)
def sales_by_category(t):
    return jobs.sales_by_category(t.order_details, t.orders, t.products, t.categories)


@query(
    "a41_quarterly_orders",
    """SELECT DISTINCT c.customer_id, c.company_name, c.city, c.country
       FROM customers c RIGHT JOIN sale_orders o ON c.customer_id = o.customer_id
       WHERE o.order_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""",
)
def quarterly_orders(t):
    return jobs.quarterly_orders(t.customers, t.orders, "1997-01-01", "1997-12-31")


@query(
    "a47_stg_sales_transactions",
    """SELECT transaction_id, user_id, product_id, CAST(amount AS DOUBLE) AS amount, currency,
              transaction_date, status, created_at, transaction_day,
              CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month,
              CAST(date_trunc('year', transaction_date) AS DATE) AS transaction_year,
              is_completed, transaction_tier
       FROM s_transactions""",
)
def stg_sales_transactions(t):
    return staging.stg_sales_transactions(t.sales_transactions)


@query(
    "a48_stg_user_events",
    """SELECT event_id, user_id, event_type, event_timestamp,
              '{"page":"' || page_url || '","session_id":"' || session_id
                  || '","metadata":{"browser":"' || browser || '","device":"' || device
                  || '"}}' AS event_data,
              created_at, page_url, session_id, browser, device,
              CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS event_hour,
              CAST(event_timestamp AS DATE) AS event_day,
              CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day,
              CAST(dayofweek(event_timestamp) AS INTEGER) AS day_of_week
       FROM activity""",
)
def stg_user_events(t):
    return staging.stg_user_events(t.user_events)


@query(
    "a49_stg_orders",
    """SELECT order_id, customer_id, employee_id, order_date, required_date, shipped_date,
              ship_via AS shipper_id, CAST(freight AS DOUBLE) AS freight, ship_name, ship_address,
              ship_city, ship_region, ship_postal_code, ship_country,
              order_date AS order_day,
              CAST(date_trunc('week', order_date) AS DATE) AS order_week,
              CAST(date_trunc('month', order_date) AS DATE) AS order_month,
              CAST(date_trunc('quarter', order_date) AS DATE) AS order_quarter,
              CAST(date_trunc('year', order_date) AS DATE) AS order_year,
              CAST(year(order_date) AS INTEGER) AS order_year_num,
              CAST(month(order_date) AS INTEGER) AS order_month_num,
              CAST(dayofweek(order_date) AS INTEGER) AS order_day_of_week,
              shipped_date IS NOT NULL AS is_shipped,
              CAST(shipped_date - order_date AS INTEGER) AS days_to_ship,
              CAST(shipped_date - required_date AS INTEGER) AS shipping_delay_days,
              shipping_performance, freight_tier
       FROM s_orders""",
)
def stg_orders(t):
    return staging.stg_orders(t.orders)


@query(
    "a50_stg_order_details",
    """SELECT order_id, product_id, CAST(unit_price AS DOUBLE) AS unit_price, quantity,
              CAST(discount AS DOUBLE) AS discount, CAST(line_subtotal AS DOUBLE) AS line_subtotal,
              CAST(extended_price AS DOUBLE) AS extended_price,
              CAST(discount_amount AS DOUBLE) AS discount_amount, quantity_tier,
              discount > 0 AS has_discount, discount_tier,
              extended_price >= 1000 AS is_high_value_line
       FROM s_lines""",
)
def stg_order_details(t):
    return staging.stg_order_details(t.order_details)


@query(
    "a51_stg_customers",
    """SELECT customer_id, company_name, contact_name, contact_title, address, city, region,
              postal_code, country, phone, fax, upper(trim(country)) AS country_code,
              lower(trim(city)) AS city_normalized, region_group, contact_type
       FROM s_customers""",
)
def stg_customers(t):
    return staging.stg_customers(t.customers)


@query(
    "a52_stg_products",
    """SELECT product_id, product_name, supplier_id, supplier_name, supplier_country, category_id,
              category_name, quantity_per_unit, CAST(unit_price AS DOUBLE) AS unit_price,
              units_in_stock, units_on_order, reorder_level, discontinued,
              units_in_stock + units_on_order AS total_available_units,
              units_in_stock <= reorder_level AND NOT discontinued AS needs_reorder,
              stock_status, price_tier, product_status
       FROM s_products""",
)
def stg_products(t):
    return staging.stg_products(t.products, t.categories, t.suppliers)


@query(
    "a53_reference_data_readiness",
    """WITH n AS (SELECT (SELECT count(*) FROM products WHERE NOT discontinued) AS product_count,
                         (SELECT count(*) FROM customers) AS customer_count,
                         (SELECT count(*) FROM employees) AS employee_count)
       SELECT *, product_count >= 5 AND customer_count >= 5 AS ready FROM n""",
)
def readiness(t):
    return jobs.reference_data_readiness(t.products, t.customers, t.employees)
