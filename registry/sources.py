"""Scans, the declared catalog, keyed records and the partition report."""

from pyspark.sql import functions as F

from registry.core import query
from tillworks.sinks import tables as sinks
from tillworks.sources import readers, schemas


@query(
    "s03_table_scan",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
              o_totalprice AS total_price
       FROM orders""",
)
def table_scan(t):
    orders = readers.raw_zone(t.spark, f"{t.folder}/orders.parquet")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total_price"),
    )


@query(
    "s04_raw_zone_scan",
    "SELECT event_id, user_id, event_type, ts FROM events WHERE event_type = 'purchase'",
)
def raw_zone_scan(t):
    events = readers.raw_zone(t.spark, f"{t.folder}/events.parquet", schemas.FILES["events"])
    return events.filter(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "event_type", "ts"
    )


@query(
    "s05_declared_catalog",
    """SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price FROM goods""",
)
def declared_catalog(t):
    return t.table("raw", "product_catalog")


@query(
    "k09_keyed_records",
    """SELECT CAST(user_id AS VARCHAR) AS key,
              '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
                  || event_type || '"}' AS value
       FROM activity""",
)
def keyed_records(t):
    return sinks.keyed_records(
        t.user_events.select("event_id", "user_id", "event_type"), "user_id"
    )


@query(
    "k11_partition_sizes",
    "SELECT count(*) AS records, CAST(0 AS BIGINT) AS over_half FROM lines",
)
def partition_sizes(t):
    # In eight partitions by order none may hold half of the lines.
    sizes = sinks.partition_sizes(sinks.keyed_partitions(t.order_details, "order_id", 8))
    half = t.order_details.agg(F.count(F.lit(1)) / 2).scalar()
    return sizes.agg(
        F.sum("records").alias("records"), F.count_if(F.col("records") > half).alias("over_half")
    )


@query("k11b_partition_report")
def partition_report(t):
    # The report itself: which partition holds how many records depends on Spark's hash.
    return sinks.partition_sizes(sinks.keyed_partitions(t.order_details, "order_id", 8))
