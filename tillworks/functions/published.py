"""SQL functions that are stored in a layer and called by name; Spark puts their bodies into the plan."""

from pyspark.sql import SparkSession

_SCALARS = {
    "cents_to_dollars(cents DECIMAL(18,2))": (
        "DECIMAL(18,2)",
        "CAST(round(cents / CAST(100 AS DECIMAL(3,0)), 2) AS DECIMAL(18,2))",
    ),
    "layer_name(base STRING, layer STRING, production BOOLEAN)": (
        "STRING",
        "CASE WHEN layer IS NULL THEN base WHEN production THEN trim(layer)"
        " ELSE concat(base, '_', trim(layer)) END",
    ),
    "net_price(unit_price DECIMAL(18,2), quantity INT, discount DECIMAL(4,2))": (
        "DECIMAL(18,4)",
        "CAST(unit_price * quantity * (1 - discount) AS DECIMAL(18,4))",
    ),
}


def publish_functions(spark: SparkSession, database: str) -> None:
    """The scalar functions ``cents_to_dollars``, ``layer_name`` and ``net_price``.

    A null amount gives null; a null layer gives the base name, an unset ``production`` counts as
    false. Publishing again replaces them.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for signature, (kind, body) in _SCALARS.items():
        spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{signature} RETURNS {kind} RETURN {body}")


def publish_period_functions(spark: SparkSession, database: str) -> None:
    """Views with a period as argument, over the layer's tables ``customers`` and ``orders``.

    A call of a table function cannot name a database, so these belong to the session and bear the
    layer's name: ``<database>_quarterly_orders`` gives the customers who ordered from the first to
    the last day, each once, ``<database>_daily_orders`` the orders and customers per day. A null or
    reversed period gives no rows. The period is a filter on the stored orders and reaches their scan.
    """
    period = "(from_day DATE, to_day DATE)"
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {database}_quarterly_orders{period}
            RETURNS TABLE (customer_id BIGINT, company_name STRING, city STRING, country STRING)
            RETURN SELECT DISTINCT c.customer_id, c.company_name, c.city, c.country
                   FROM (SELECT DISTINCT customer_id FROM {database}.orders
                         WHERE order_date BETWEEN from_day AND to_day) o
                   LEFT JOIN {database}.customers c ON c.customer_id = o.customer_id"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {database}_daily_orders{period}
            RETURNS TABLE (order_date DATE, orders BIGINT, unique_customers BIGINT)
            RETURN SELECT order_date, sum(n), count(*)
                   FROM (SELECT order_date, customer_id, count(*) AS n FROM {database}.orders
                         WHERE order_date BETWEEN from_day AND to_day GROUP BY ALL)
                   GROUP BY order_date"""
    )
