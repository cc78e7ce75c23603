"""The live figures over a whole topic as one batch. The streams use the same functions.

The decoding of JSON records is checked on its own (t01, t09, t16, t21) and in the stream (s06).
"""

from pyspark.sql import functions as F

from registry import feeds
from registry.core import big, dbl, query, share
from tillworks.sinks import tables as sinks
from tillworks.streaming import events as ev
from tillworks.streaming import metrics


def _decoded(events, key, schema):
    return ev.readable(ev.decode(sinks.keyed_records(events, key), schema))


def _orders(t):
    return feeds.order_events(t)


def _users(t):
    return feeds.user_events(t)


@query(
    "t01_decode_events",
    f"""SELECT CAST(f.order_id AS VARCHAR) AS key, f.event_type || '-' || f.order_id AS event_id,
               f.event_type, CAST(f.day AS VARCHAR) AS timestamp, f.order_id,
               {dbl("n.order_total")} AS order_total,
               CAST(n.units_ordered AS INTEGER) AS units_ordered
        FROM order_feed f LEFT JOIN new_orders n
            ON f.order_id = n.order_id AND f.event_type = 'new_order'""",
)
def decode_events(t):
    return _decoded(feeds.order_events(t), "order_id", ev.ORDER_EVENT).select(
        "key", "event_id", "event_type", "timestamp", "order_id", "order_total", "units_ordered"
    )


@query(
    "t02_events_by_type",
    f"""WITH c AS (SELECT coalesce(event_type, 'unknown') AS event_type, count(*) AS events
                   FROM order_feed GROUP BY 1)
        SELECT event_type, events, {share("events", "(SELECT sum(events) FROM c)")} AS share_pct
        FROM c""",
)
def events_by_type(t):
    return metrics.type_shares(metrics.tally_types(_orders(t)))


@query(
    "t03_top_users",
    """SELECT user_id, count(*) AS events FROM user_feed
       GROUP BY 1 ORDER BY events DESC, 1 LIMIT 5""",
)
def top_users(t):
    return metrics.top_users(metrics.tally_users(_users(t)))


@query(
    "t04_order_counters",
    f"""SELECT (SELECT count(*) FROM order_feed) AS total_events, count(*) AS total_orders,
               {dbl("sum(order_total)")} AS total_revenue,
               {big("sum(item_count)")} AS total_items_sold,
               {big("sum(units_ordered)")} AS units_ordered,
               count(*) FILTER (order_total > 1000) AS high_value_orders,
               (SELECT count(*) FROM order_feed WHERE event_type = 'order_delivered')
                   AS delivered_orders,
               (SELECT count(*) FROM order_feed WHERE event_type = 'order_cancelled')
                   AS cancelled_orders,
               CAST(sum(order_total) AS DOUBLE) / count(*) AS average_order_value
        FROM new_orders""",
)
def order_counters(t):
    return metrics.order_report(metrics.tally_orders(_orders(t)))


@query(
    "t05_top_countries",
    f"""SELECT country, count(*) AS orders, {dbl("sum(order_total)")} AS revenue,
               CAST(sum(order_total) AS DOUBLE) / count(*) AS average_order
        FROM new_orders GROUP BY 1 ORDER BY sum(order_total) DESC, country LIMIT 5""",
)
def top_countries(t):
    return metrics.top_countries(metrics.tally_countries(_orders(t)))


@query(
    "t06_product_demand",
    f"""SELECT product_id, product_name, {big("sum(quantity)")} AS units
        FROM feed_items GROUP BY ALL ORDER BY units DESC, product_id LIMIT 5""",
)
def product_demand(t):
    return metrics.top_products(metrics.tally_products(_orders(t)))


@query(
    "t07_top_customers",
    """SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_name, count(*) AS orders
       FROM new_orders GROUP BY 1, 2 ORDER BY orders DESC, 1 LIMIT 5""",
)
def top_customers(t):
    return metrics.top_customers(metrics.tally_customers(_orders(t)))


@query(
    "t08_high_value_orders",
    f"""SELECT order_id, CAST(customer_id AS VARCHAR) AS customer_id, customer_name,
               country AS customer_country, {dbl("order_total")} AS order_total,
               CAST(item_count AS INTEGER) AS item_count,
               CAST(units_ordered AS INTEGER) AS units_ordered
        FROM new_orders WHERE order_total > 1000""",
)
def high_value_orders(t):
    return metrics.high_value_orders(_orders(t))


@query(
    "t09_high_value_purchases",
    f"""SELECT CAST(event_id AS VARCHAR) AS event_id, user_id,
               {dbl("amount")} AS amount
        FROM user_feed WHERE kind = 'purchase' AND amount > 100""",
)
def high_value_purchases(t):
    events = _decoded(feeds.user_events(t), "user_id", ev.USER_EVENT)
    return metrics.high_value_purchases(events, above=100)


@query(
    "t10_signups",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, user_id,
              CAST(ts AS VARCHAR) AS timestamp
       FROM user_feed WHERE kind = 'signup'""",
)
def signups(t):
    return metrics.signups(_users(t))


@query(
    "t11_outcome_counters",
    """SELECT count(*) FILTER (event_type = 'order_delivered') AS delivered_orders,
              count(*) FILTER (event_type = 'order_cancelled') AS cancelled_orders
       FROM order_feed""",
)
def outcome_counters(t):
    return metrics.tally_orders(_orders(t)).select("delivered_orders", "cancelled_orders")


@query(
    "t14_shipment_feed",
    """SELECT f.event_type, f.order_id, company_name AS shipper, CAST(day AS VARCHAR) AS shipped_date
       FROM order_feed f
       LEFT JOIN sale_orders o ON f.order_id = o.order_id AND f.event_type = 'order_shipped'
       LEFT JOIN shippers ON ship_via = shipper_id
       WHERE f.event_type IN ('order_shipped', 'order_delivered')""",
)
def shipment_feed(t):
    return metrics.shipment_feed(_orders(t)).select(
        "event_type", "order_id", "shipper", "shipped_date"
    )


@query(
    "t15_routes",
    """SELECT order_id, replace(event_type, 'order_returned', 'unknown') AS route
       FROM order_feed""",
)
def routes(t):
    return metrics.routed(_orders(t)).select("order_id", "route")


@query("t16_dead_letters", "SELECT CAST(doc_id AS VARCHAR) AS key, text AS value FROM documents")
def dead_letters(t):
    # Prose among the records of the topic: none of it is an event, and all of it is kept.
    prose = t.spark.read.parquet(f"{t.folder}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("key"), F.col("text").alias("value")
    )
    records = sinks.keyed_records(feeds.order_events(t), "order_id").unionByName(prose)
    return ev.dead_letters(ev.decode(records, ev.ORDER_EVENT))


@query(
    "t17_searches",
    """SELECT place AS search_query, count(*) AS searches
       FROM user_feed WHERE kind = 'search' GROUP BY 1""",
)
def searches(t):
    return metrics.tally_searches(_users(t))


@query(
    "t21_flow_report",
    f"""SELECT (SELECT count(*) FROM order_feed) AS messages,
               (SELECT count(DISTINCT event_type) FROM order_feed) AS event_types,
               {dbl("sum(order_total)")} AS order_value, true AS flowing
        FROM new_orders""",
)
def flow_report(t):
    return metrics.flow_report(_decoded(feeds.order_events(t), "order_id", ev.ORDER_EVENT))


@query("t21b_flow_types", "SELECT event_type, count(*) AS messages FROM order_feed GROUP BY 1")
def flow_types(t):
    events = _decoded(feeds.order_events(t), "order_id", ev.ORDER_EVENT)
    return metrics.flow_types(events).select("event_type", "messages")
