"""Sinks: each query writes to the shared folder and returns what is read back."""

import uuid

from pyspark.sql import functions as F

from registry import feeds
from registry.core import AS_OF, dbl, query
from tillworks.plans import jobs, staging
from tillworks.session import shared_folder
from tillworks.sinks import tables as sinks
from tillworks.sources import readers
from tillworks.streaming import events as ev
from tillworks.streaming import metrics, offsets, topics


#: Names what one run of the registry stores; each run uses the same databases again.
RUN = uuid.uuid4().hex[:12]


def _folder(t, name):
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _database(t, name):
    """A database of this run, empty: what an earlier call left there is dropped."""
    database = f"{name}_{RUN}"
    t.spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{_folder(t, name)}'")
    return database


def drop_databases(spark):
    """Drop what this run's queries created; for the owner of the run, once results are read."""
    for name in ("analytics", sinks.layer_name("retail", "staging")):
        spark.sql(f"DROP DATABASE IF EXISTS {name}_{RUN} CASCADE")


_SUBTOTALS = f"SELECT order_id, {dbl('sum(extended_price)')} AS subtotal FROM lines GROUP BY 1"


@query("k01_parquet_overwrite", _SUBTOTALS)
def parquet_overwrite(t):
    path = _folder(t, "k01")
    sinks.write_files(jobs.order_subtotals(t.order_details), path)
    return t.spark.read.parquet(path)


@query(
    "k02_partitioned_parquet",
    """SELECT order_id, CAST(year(order_date) AS INTEGER) AS year,
              CAST(month(order_date) AS INTEGER) AS month
       FROM sale_orders""",
)
def partitioned_parquet(t):
    path = _folder(t, "k02")
    dated = t.orders.select(
        "order_id", F.year("order_date").alias("year"), F.month("order_date").alias("month")
    )
    sinks.write_files(dated, path, partition_by=["year", "month"])
    return t.spark.read.parquet(path)


@query("k03_json_append", f"{_SUBTOTALS} UNION ALL {_SUBTOTALS}")
def json_append(t):
    path = _folder(t, "k03")
    subtotals = jobs.order_subtotals(t.order_details).select(
        "order_id", F.col("subtotal").cast("double").alias("subtotal")
    )
    for mode in ("overwrite", "append"):
        sinks.write_files(subtotals, path, format="json", mode=mode)
    return readers.raw_zone(t.spark, path, "order_id bigint, subtotal double", "json")


@query(
    "k04_dated_rerun",
    """SELECT category_name, units_sold, d AS date FROM (
           SELECT category_name, CAST(sum(quantity) AS BIGINT) AS units_sold FROM line_names
           GROUP BY 1)
       CROSS JOIN (VALUES (DATE '2001-08-01'), (DATE '2001-08-02')) AS v(d)""",
)
def dated_rerun(t):
    path, base = _folder(t, "k04"), _folder(t, "k04-sales")
    sales = jobs.sales_by_category_summary(t.order_details, t.products, t.categories).select(
        "category_name", "units_sold"
    )
    sinks.write_files(sales, base)
    for day in ("2001-08-01", "2001-08-02", "2001-08-02"):
        sinks.write_day(t.spark.read.parquet(base), path, day)
    return t.spark.read.parquet(path)


@query(
    "k05_typed_result_table",
    f"""SELECT DATE '{AS_OF}' AS date, country,
               {dbl("CAST(round(sum(total), 2) AS DECIMAL(18,2))")} AS revenue,
               CAST(count(*) AS INTEGER) AS order_count,
               CAST(count(DISTINCT customer_id) AS INTEGER) AS customer_count
        FROM (SELECT o.order_id, c.country, c.customer_id, sum(l.extended_price) AS total
              FROM sale_orders o JOIN lines l ON o.order_id = l.order_id
              JOIN customers c ON o.customer_id = c.customer_id GROUP BY 1, 2, 3)
        GROUP BY country""",
)
def typed_result_table(t):
    database = _database(t, "analytics")
    sinks.create_result_tables(t.spark, database)
    sales = jobs.sales_by_country(t.orders, t.order_details, t.customers)
    sinks.load_result_table(sales, database, "daily_country_sales", AS_OF)
    return t.spark.table(f"{database}.daily_country_sales").drop("created_at")


@query("k06_published_view", "SELECT order_id, shipping_performance FROM s_orders")
def published_view(t):
    name = f"stg_orders_{uuid.uuid4().hex}"
    sinks.publish_view(staging.stg_orders(t.orders), name)
    return t.spark.sql(f"SELECT order_id, shipping_performance FROM {name}")


@query(
    "k07_published_tables",
    """SELECT o.order_id, o.customer_id, l.product_id, l.quantity
       FROM sale_orders o JOIN lines l ON o.order_id = l.order_id""",
)
def published_tables(t):
    # Both tables are bucketed by the order, so this join needs no shuffle.
    database = _database(t, sinks.layer_name("retail", "staging"))
    orders = t.orders.select("order_id", "customer_id")
    lines = t.order_details.select("order_id", "product_id", "quantity")
    for name, df in (("orders", orders), ("order_details", lines)):
        sinks.publish_table(df, name, database, bucket_by="order_id", buckets=8)
    return t.spark.table(f"{database}.orders").join(
        t.spark.table(f"{database}.order_details"), "order_id"
    )


@query(
    "k10_keyed_partitions",
    """SELECT count(*) AS records, count(DISTINCT order_id) AS keys,
              CAST(0 AS BIGINT) AS keys_in_several_partitions FROM lines""",
)
def keyed_partitions(t):
    # Observed where the rows lie: each key in one partition only.
    placed = sinks.keyed_partitions(t.order_details, "order_id").select(
        "order_id", F.spark_partition_id().alias("partition_id")
    )
    per_key = placed.groupBy("order_id", "partition_id").agg(F.count(F.lit(1)).alias("n"))
    keys = per_key.groupBy("order_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("places"))
    return keys.agg(
        F.sum("n").alias("records"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("places") > 1).alias("keys_in_several_partitions"),
    )


@query(
    "k08_layer_names",
    """SELECT n_nationkey, n_name,
              CASE n_regionkey % 3 WHEN 0 THEN 'retail_staging' WHEN 1 THEN 'retail_marts'
                   ELSE 'retail' END AS apart,
              CASE n_regionkey % 3 WHEN 0 THEN 'staging' WHEN 1 THEN 'marts'
                   ELSE 'retail' END AS live
       FROM nation""",
)
def layer_names(t):
    # Nations as tables; the region says to which layer they belong, if to any.
    layers = (" staging ", "marts", None)

    def named(production):
        pairs = ((F.lit(k), F.lit(sinks.layer_name("retail", v, production))) for k, v in enumerate(layers))
        return F.create_map(*[x for pair in pairs for x in pair])[F.col("n_regionkey") % 3]

    return t.file("nation").select(
        "n_nationkey", "n_name", named(False).alias("apart"), named(True).alias("live")
    )


def _topic(t, events, key="order_id"):
    """All events as a topic of files."""
    folder = _folder(t, "topic")
    sinks.write_records(sinks.keyed_records(events, key), folder)
    return folder


@query(
    "s07_bounded_read",
    """SELECT CAST(least(500, count(*)) AS BIGINT) AS records, true AS decoded FROM order_feed""",
)
def bounded_read(t):
    # Which records come first is open; that 500 come, and that all are events, is not.
    records = topics.file_batch(t.spark, _topic(t, feeds.order_events(t)), "order_id")
    some = ev.decode(topics.sample(records, 500), ev.ORDER_EVENT)
    return some.agg(
        F.count(F.lit(1)).alias("records"), F.bool_and(F.col(ev.CORRUPT).isNull()).alias("decoded")
    )


@query(
    "s08_read_from_latest",
    "SELECT order_id, event_type FROM order_feed WHERE event_type = 'order_returned'",
)
def read_from_latest(t):
    # What was there before the offset is not read, what comes after it is.
    events = feeds.order_events(t)
    returned = F.col("event_type") == "order_returned"
    folder = _folder(t, "topic")
    offsets.append(sinks.keyed_records(events.where(~returned), "order_id"), folder)
    latest = offsets.latest(folder)
    offsets.append(sinks.keyed_records(events.where(returned), "order_id"), folder)
    records = offsets.read(t.spark, folder, latest)
    return ev.readable(ev.decode(records, ev.ORDER_EVENT)).select("order_id", "event_type")


#: Records of one poll. Batches of 100 are tested; over whole tables they would be very many.
POLL = 8000


def _polled(t, folder, handle):
    """Read a topic to its end in polls, and return the checkpoint."""
    marks = _folder(t, "marks")
    offsets.read_in_polls(t.spark, folder, marks, handle, POLL)
    return marks


@query(
    "s09_polls_of_bounded_size",
    f"""SELECT CAST(poll AS BIGINT) AS batch_id, CAST(least({POLL}, n - poll * {POLL}) AS BIGINT) AS records,
               CAST(poll * {POLL} AS BIGINT) AS first_offset
        FROM (SELECT n, unnest(range(0, (n + {POLL} - 1) // {POLL})) AS poll
              FROM (SELECT count(*) AS n FROM order_feed))""",
)
def polls_of_bounded_size(t):
    folder, output = _folder(t, "topic"), _folder(t, "polls")
    offsets.append(sinks.keyed_records(feeds.order_events(t), "order_id"), folder)
    _polled(t, folder, lambda batch, number: batch.write.mode("overwrite").parquet(f"{output}/batch_id={number}"))
    polls = t.spark.read.parquet(output).groupBy(F.col("batch_id").cast("bigint").alias("batch_id"))
    return polls.agg(F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"))


@query(
    "t22_offsets_of_a_query",
    f"""SELECT CAST(poll AS BIGINT) AS batch_id, true AS committed, CAST(least((poll + 1) * {POLL}, n) AS BIGINT) AS "offset"
        FROM (SELECT n, unnest(range(0, (n + {POLL} - 1) // {POLL})) AS poll
              FROM (SELECT count(*) AS n FROM user_feed))""",
)
def offsets_of_a_query(t):
    folder = _folder(t, "topic")
    offsets.append(sinks.keyed_records(feeds.user_events(t), "user_id"), folder)
    marks = _polled(t, folder, lambda batch, number: batch.write.format("noop").mode("overwrite").save())
    return offsets.progress(t.spark, marks)


@query(
    "t23_lag_of_a_query",
    """SELECT count(*) FILTER (event_type <> 'order_returned') AS committed_offset, count(*) AS latest_offset,
              count(*) FILTER (event_type = 'order_returned') AS lag
       FROM order_feed""",
)
def lag_of_a_query(t):
    # The query has stopped before the returned orders come.
    events = feeds.order_events(t)
    returned = F.col("event_type") == "order_returned"
    folder = _folder(t, "topic")
    offsets.append(sinks.keyed_records(events.where(~returned), "order_id"), folder)
    marks = _polled(t, folder, lambda batch, number: batch.write.format("noop").mode("overwrite").save())
    offsets.append(sinks.keyed_records(events.where(returned), "order_id"), folder)
    return offsets.group_lag(t.spark, folder, marks)


@query(
    "s06_topic_stream",
    """SELECT coalesce(event_type, 'unknown') AS event_type, count(*) AS events
       FROM order_feed GROUP BY 1""",
)
def topic_stream(t):
    # The whole topic as files, read as a stream from the earliest record to the end.
    output, marks = _folder(t, "tally"), _folder(t, "marks")
    topic = _topic(t, feeds.order_events(t))
    records = topics.file_topic(t.spark, topic, "order_id", per_trigger=100)
    query = topics.start_tallies(
        records, ev.ORDER_EVENT, {"types": metrics.tally_types}, output, marks
    )
    query.awaitTermination()
    return topics.merged_tally(t.spark, output, "types", ["event_type"])


@query(
    "t18_timed_run",
    """SELECT kind AS event_type, count(*) AS events FROM user_feed GROUP BY 1""",
)
def timed_run(t):
    # A stream that would go on is stopped after its time; the report is taken after the stop.
    output, marks = _folder(t, "tally"), _folder(t, "marks")
    records = topics.file_topic(t.spark, _topic(t, feeds.user_events(t), "user_id"), "user_id")
    query = topics.start_tallies(
        records, ev.USER_EVENT, {"types": metrics.tally_types}, output, marks,
        trigger={"processingTime": "1 second"},
    )
    query.processAllAvailable()
    return topics.run_for(
        query, 1, lambda: topics.merged_tally(t.spark, output, "types", ["event_type"])
    )
