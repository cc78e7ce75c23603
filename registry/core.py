"""Registration, and the retail model as SQL for the comparison statements."""

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillworks.session import shared_folder
from tillworks.sources.fixed_values import (
    BROWSERS,
    CATEGORIES,
    CONTACT_TITLES,
    COUNTRIES,
    DEVICES,
    EMPLOYEES,
    SHIPPERS,
)
from tillworks.sources.tables import RetailTables

# Reference dates: the day after the last order, and the end of the event period.
AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"
EVENTS_NOW = "2024-01-31 00:00:00"
START_DATE = "2024-01-05"

QUERIES = {}
ORACLES = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals become doubles at the very end, after all exact arithmetic."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: for results that are read twice."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def query(key: str, sql: str | None = None):
    """Register a plan over the retail tables under a key."""

    def register(plan):
        QUERIES[key] = lambda spark, folder: plain(plan(RetailTables(spark, folder)))
        if sql is not None:
            ORACLES[key] = with_model(sql)
        return plan

    return register


# SQL fragments


def mean(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / count({x})"


def _whole(x: str) -> str:
    """An amount of up to seven decimal places in its smallest unit."""
    return f"CAST(({x}) * CAST(10000000 AS BIGINT) AS HUGEINT)"


def quotient(a: str, b: str, places: int = 2, otherwise: str = "0", times: int = 1) -> str:
    """Long division: the whole part, and one more if the rest is at least half the divisor."""
    x, y = f"({_whole(a)} * {times * 10**places})", _whole(b)
    digits = f"{x} // {y} + CASE WHEN {x} % {y} * 2 >= {y} THEN 1 ELSE 0 END"
    return f"CASE WHEN {b} > 0 THEN CAST({digits} AS DOUBLE) / {10**places} ELSE {otherwise} END"


def share(a: str, b: str, places: int = 2) -> str:
    return quotient(a, b, places, times=100)


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def text_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _values(rows) -> str:
    def item(v):
        return str(v) if isinstance(v, int) else f"'{v}'"

    return ", ".join("(" + ", ".join(item(v) for v in row) + ")" for row in rows)


def _cases(pairs) -> str:
    return " ".join(f"WHEN '{k}' THEN {v}" for k, v in pairs)


MODEL = {
    "sale_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_orderkey % 9 + 1 AS INTEGER) AS employee_id,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_orderdate AS DATE) + 7 AS required_date,
               CASE WHEN o_orderstatus = 'O' THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 13 AS INTEGER)
               END AS shipped_date,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS ship_via,
               CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.0004 AS DECIMAL(5,4)) AS freight,
               'Dock ' || (o_orderkey % 100) AS ship_name,
               (o_orderkey % 500) || ' Harbour Road' AS ship_address,
               'City ' || (o_custkey % 25) AS ship_city,
               CAST(NULL AS VARCHAR) AS ship_region,
               lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS ship_postal_code,
               {text_list(COUNTRIES)}[o_custkey % 25 + 1] AS ship_country
        FROM orders""",
    "lines0": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2))
                   AS line_subtotal,
               CAST(l_discount AS DECIMAL(4,2)) * CAST(2.5 AS DECIMAL(2,1)) AS discount
        FROM lineitem""",
    "lines": """
        SELECT order_id, product_id, quantity, discount, line_subtotal,
               CAST((2 * CAST(line_subtotal * 10000 AS BIGINT) + quantity) // (2 * quantity)
                    AS DECIMAL(14,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS unit_price,
               CAST(line_subtotal * (1 - discount) AS DECIMAL(18,7)) AS extended_price,
               CAST(line_subtotal * discount AS DECIMAL(18,7)) AS discount_amount
        FROM lines0""",
    "products": f"""
        SELECT p_partkey AS product_id, p_name AS product_name, p_partkey % 10 AS supplier_id,
               CASE p_type {_cases((c[1], c[0]) for c in CATEGORIES)} END AS category_id,
               p_brand AS quantity_per_unit,
               CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.01 AS DECIMAL(3,2))
                   * CAST(1 + p_size % 7 AS DECIMAL(2,0)) AS unit_price,
               CAST((p_partkey * 7 + 3) % 60 AS INTEGER) AS units_in_stock,
               CAST(p_partkey % 3 * 10 AS INTEGER) AS units_on_order,
               p_size % 30 AS reorder_level, p_partkey % 10 = 0 AS discontinued
        FROM part""",
    "categories": f"""
        SELECT * FROM (VALUES {_values(CATEGORIES)})
            AS v(category_id, category_name, description)""",
    "employees": f"""
        SELECT * FROM (VALUES {_values(EMPLOYEES)})
            AS v(employee_id, last_name, first_name, title)""",
    "shippers": f"""
        SELECT * FROM (VALUES {_values(SHIPPERS)}) AS v(shipper_id, company_name, phone)""",
    "customers": f"""
        SELECT c_custkey AS customer_id, c_name AS company_name,
               'Contact ' || c_custkey AS contact_name,
               CASE c_mktsegment {_cases((k, f"'{v}'") for k, v in CONTACT_TITLES.items())}
               END AS contact_title,
               (c_custkey % 100) || ' Market Street' AS address, n_name AS city,
               CAST(NULL AS VARCHAR) AS region,
               lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
               {text_list(COUNTRIES)}[c_nationkey + 1] AS country,
               '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
               CAST(NULL AS VARCHAR) AS fax
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "suppliers": f"""
        SELECT s_suppkey AS supplier_id, s_name AS company_name,
               {text_list(COUNTRIES)}[s_nationkey + 1] AS country
        FROM supplier""",
    "transactions": """
        SELECT event_id AS transaction_id, user_id, event_id % 50 AS product_id,
               CAST(value AS DECIMAL(10,2)) * CAST(5 AS DECIMAL(1,0)) AS amount,
               'USD' AS currency, ts AS transaction_date,
               CASE WHEN event_id % 10 = 3 THEN 'failed' ELSE 'completed' END AS status,
               ts AS created_at
        FROM events WHERE event_type = 'purchase'""",
    "activity": f"""
        SELECT event_id, user_id, event_type, ts AS event_timestamp, ts AS created_at,
               '/p' || json_extract_string(props, '$.k') AS page_url,
               's' || (user_id % 50) AS session_id,
               {text_list(BROWSERS)}[event_id % 4 + 1] AS browser,
               {text_list(DEVICES)}[event_id % 3 + 1] AS device
        FROM events""",
    "users": f"""
        SELECT c_custkey AS user_id, lower(c_name) AS username,
               'user' || c_custkey || '@example.com' AS email,
               DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS registration_date,
               {text_list(COUNTRIES)}[c_nationkey + 1] AS country
        FROM customer""",
    "goods": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.01 AS DECIMAL(3,2)) AS price
        FROM part""",
    "s_orders": """
        SELECT *, CASE WHEN shipped_date IS NULL THEN 'Not Shipped'
                       WHEN shipped_date <= required_date THEN 'On Time'
                       WHEN shipped_date <= required_date + 3 THEN 'Slightly Late'
                       ELSE 'Late' END AS shipping_performance,
               CASE WHEN freight >= 100 THEN 'High Freight'
                    WHEN freight >= 20 THEN 'Medium Freight'
                    ELSE 'Low Freight' END AS freight_tier
        FROM sale_orders""",
    "s_lines": """
        SELECT *, CASE WHEN quantity >= 50 THEN 'Bulk Order'
                       WHEN quantity >= 20 THEN 'Large Order'
                       WHEN quantity >= 5 THEN 'Standard Order'
                       ELSE 'Small Order' END AS quantity_tier,
               CASE WHEN discount >= 0.2 THEN 'High Discount'
                    WHEN discount >= 0.1 THEN 'Medium Discount'
                    WHEN discount > 0 THEN 'Low Discount'
                    ELSE 'No Discount' END AS discount_tier
        FROM lines""",
    "s_customers": """
        SELECT *, CASE WHEN country IN ('USA', 'Canada', 'Mexico') THEN 'North America'
                       WHEN country IN ('Brazil', 'Argentina', 'Venezuela') THEN 'South America'
                       WHEN country IN ('Japan', 'Australia', 'India', 'Egypt') THEN 'Other'
                       ELSE 'Europe' END AS region_group,
               CASE contact_title WHEN 'Owner' THEN 'Owner'
                                  WHEN 'Marketing Manager' THEN 'Manager'
                                  WHEN 'Sales Representative' THEN 'Sales Rep'
                                  WHEN 'Sales Agent' THEN 'Agent'
                                  ELSE 'Other' END AS contact_type
        FROM customers""",
    "s_products": """
        SELECT p.*, c.category_name, s.company_name AS supplier_name,
               s.country AS supplier_country,
               CASE WHEN units_in_stock = 0 AND NOT discontinued THEN 'Out of Stock'
                    WHEN units_in_stock <= reorder_level AND NOT discontinued THEN 'Low Stock'
                    WHEN units_in_stock > reorder_level * 3 THEN 'Overstocked'
                    ELSE 'Normal' END AS stock_status,
               CASE WHEN unit_price >= 50 THEN 'Premium'
                    WHEN unit_price >= 20 THEN 'Mid-Range'
                    ELSE 'Economy' END AS price_tier,
               CASE WHEN discontinued THEN 'Discontinued'
                    WHEN units_in_stock = 0 THEN 'Out of Stock'
                    WHEN units_in_stock <= reorder_level THEN 'Low Stock'
                    ELSE 'Available' END AS product_status
        FROM products p
        LEFT JOIN categories c ON p.category_id = c.category_id
        LEFT JOIN suppliers s ON p.supplier_id = s.supplier_id""",
    "s_transactions": """
        SELECT *, CAST(transaction_date AS DATE) AS transaction_day,
               status = 'completed' AS is_completed,
               CASE WHEN amount >= 1000 THEN 'high' WHEN amount >= 100 THEN 'medium'
                    ELSE 'low' END AS transaction_tier
        FROM transactions""",
    "enriched": """
        SELECT t.transaction_id, t.user_id, t.product_id, t.amount, t.status,
               CAST(t.transaction_date AS DATE) AS transaction_date,
               u.username, u.email, u.registration_date, u.country,
               g.product_name, g.category, g.price,
               strftime(t.transaction_date, '%Y-%m') AS transaction_year_month
        FROM transactions t
        LEFT JOIN users u ON t.user_id = u.user_id
        LEFT JOIN goods g ON t.product_id = g.product_id""",
    "feed_items": """
        SELECT order_id, product_id, product_name, quantity, round(extended_price, 2) AS line_total
        FROM lines LEFT JOIN products USING (product_id)""",
    "new_orders": """
        SELECT o.order_id, o.customer_id, company_name AS customer_name, c.country,
               coalesce(value, 0) AS order_total, coalesce(items, 0) AS item_count,
               coalesce(units, 0) AS units_ordered
        FROM sale_orders o LEFT JOIN customers c USING (customer_id)
        LEFT JOIN (SELECT order_id, sum(line_total) AS value, count(*) AS items,
                          CAST(sum(quantity) AS BIGINT) AS units
                   FROM feed_items GROUP BY order_id) USING (order_id)""",
    "order_feed": """
        SELECT order_id, 'new_order' AS event_type, order_date AS day FROM sale_orders
        UNION ALL BY NAME
        SELECT order_id, 'order_shipped' AS event_type, shipped_date AS day FROM sale_orders
        WHERE shipped_date IS NOT NULL
        UNION ALL BY NAME
        SELECT o_orderkey AS order_id, 'order_delivered' AS event_type FROM orders
        WHERE o_orderstatus = 'F'
        UNION ALL BY NAME
        SELECT DISTINCT l_orderkey AS order_id, 'order_returned' AS event_type FROM lineitem
        WHERE l_returnflag = 'R'""",
    "user_feed": """
        SELECT event_id, user_id, ts, json_extract_string(props, '$.k') AS place,
               CAST(value AS DECIMAL(10,2)) AS amount,
               CASE event_type WHEN 'view' THEN 'page_view' WHEN 'error' THEN 'search'
                               ELSE event_type END AS kind
        FROM events""",
    "line_names": """
        SELECT l.*, p.product_name, c.category_id, c.category_name
        FROM lines l JOIN products p ON l.product_id = p.product_id
        JOIN categories c ON p.category_id = c.category_id""",
}


def with_model(sql: str) -> str:
    """Prefix a statement with the parts of the model it uses."""
    used, pending = set(), [sql]
    while pending:
        text = pending.pop()
        for name in MODEL:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                pending.append(MODEL[name])
    parts = [f"{name} AS ({MODEL[name]})" for name in MODEL if name in used]
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
