"""Results that are kept over time: histories, increments, and counts that merge."""

import uuid

from pyspark.sql import functions as F

from registry.core import AS_OF, ORACLES, START_DATE, query
from registry.marts import HIGH, SOLID, STAR
from tillworks.operators import distinct, snapshots
from tillworks.plans import incremental, marts, staging
from tillworks.session import shared_folder
from tillworks.sinks import tables as sinks
from tillworks.sinks.versions import VersionedTable

STATE_DAYS = ("1998-01-01", "1999-01-01", "2000-01-01", "2001-01-01", "2002-06-01")


def _table(t, name):
    return VersionedTable(t.spark, f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}")


@query(
    "k12_customer_history",
    f"""WITH days AS (SELECT unnest([{", ".join(f"DATE '{d}'" for d in STATE_DAYS)}]) AS d),
        states AS (
            SELECT d, customer_id,
                   CASE WHEN count(*) >= 12 THEN 'many' WHEN count(*) >= 6 THEN 'some' ELSE 'few' END AS tier,
                   CAST(count(*) FILTER (shipped_date IS NULL) > 0 AS BOOLEAN) AS waiting
            FROM sale_orders JOIN days ON order_date < d
            GROUP BY ALL HAVING max(order_date) >= d - 200),
        grid AS (
            SELECT customer_id, d, tier, waiting
            FROM (SELECT DISTINCT customer_id FROM states) CROSS JOIN days
            LEFT JOIN states USING (customer_id, d)),
        turns AS (
            SELECT *, lag(tier) OVER w AS old_tier, lag(waiting) OVER w AS old_waiting
            FROM grid WINDOW w AS (PARTITION BY customer_id ORDER BY d)),
        kept AS (
            SELECT *, lead(d) OVER (PARTITION BY customer_id ORDER BY d) AS until
            FROM turns
            WHERE tier IS DISTINCT FROM old_tier OR waiting IS DISTINCT FROM old_waiting)
        SELECT customer_id, tier, waiting, d AS valid_from, until AS valid_to
        FROM kept WHERE tier IS NOT NULL""",
)
def customer_history(t):
    # The customers of the last 200 days, recorded five times; each state is recorded twice.
    table = _table(t, "customer-history")
    for day in STATE_DAYS:
        state = _active(t, day)
        version = snapshots.record_state(table, state, "customer_id", day)
        if snapshots.record_state(table, state, "customer_id", day) != version:
            raise RuntimeError(f"recording {day} again has changed the history")
    return table.read().drop(snapshots.HASH)


@query(
    "k12b_late_changes",
    """WITH changes AS (
            SELECT customer_id, order_date AS d, CAST(count(*) > 1 AS BOOLEAN) AS several, max(ship_via) AS ship_via
            FROM sale_orders GROUP BY ALL),
        early AS (
            SELECT *, lag((several, ship_via)) OVER (PARTITION BY customer_id ORDER BY d) AS old
            FROM changes WHERE month(d) % 2 = 1),
        known AS (
            SELECT customer_id, d, several, ship_via FROM early WHERE old IS NULL OR old <> (several, ship_via)
            UNION ALL SELECT customer_id, d, several, ship_via FROM changes WHERE month(d) % 2 = 0),
        turns AS (
            SELECT *, lag((several, ship_via)) OVER (PARTITION BY customer_id ORDER BY d) AS old FROM known)
        SELECT customer_id, several, ship_via, d AS valid_from,
               lead(d) OVER (PARTITION BY customer_id ORDER BY d) AS valid_to
        FROM turns WHERE old IS NULL OR old <> (several, ship_via)""",
)
def late_changes(t):
    # How each customer last ordered, from changes that come out of order: odd months first. What
    # comes late holds until the next change on record.
    table = _table(t, "late-changes")
    changes = t.orders.groupBy("customer_id", "order_date").agg(
        (F.count(F.lit(1)) > 1).alias("several"), F.max("ship_via").alias("ship_via")
    )
    for odd in (1, 0):
        some = changes.where(F.month("order_date") % 2 == odd)
        snapshots.record_state(table, some, "customer_id", "2002-06-01", changed_at="order_date", full=False)
    return table.read().drop(snapshots.HASH)


def _active(t, day):
    before = t.orders.where(F.col("order_date") < F.lit(day).cast("date"))
    n = F.count(F.lit(1))
    return (
        before.groupBy("customer_id")
        .agg(
            F.when(n >= 12, "many").when(n >= 6, "some").otherwise("few").alias("tier"),
            (F.count_if(F.col("shipped_date").isNull()) > 0).alias("waiting"),
            F.max("order_date").alias("last"),
        )
        .where(F.col("last") >= F.date_sub(F.lit(day).cast("date"), 200))
        .drop("last")
    )


@query(
    "a05b_distinct_customers_by_period",
    """SELECT grain, period, count(DISTINCT customer_id) AS unique_customers
       FROM (SELECT customer_id, unnest(['day', 'month', 'quarter', 'year']) AS grain,
                    unnest([order_date, CAST(date_trunc('month', order_date) AS DATE),
                            CAST(date_trunc('quarter', order_date) AS DATE),
                            CAST(date_trunc('year', order_date) AS DATE)]) AS period
             FROM sale_orders)
       GROUP BY ALL""",
)
def distinct_customers(t):
    path = f"{shared_folder(t.spark)}/bitmaps-{uuid.uuid4().hex}"
    distinct.id_bitmaps(t.orders, ["order_date"], "customer_id").write.parquet(path)
    days = t.spark.read.parquet(path)
    return distinct.distinct_by_period(days, "order_date", ["day", "month", "quarter", "year"], "unique_customers")


#: The days up to which the increments take the sources into account; the last is after all.
MARKS = ("1997-06-30", "1999-12-31", "2000-01-15", "2002-12-31")


def full_run(key, of):
    """Register a plan under ``key`` with the statement of another query."""

    def register(plan):
        query(key)(plan)
        ORACLES[key] = ORACLES[of]
        return plan

    return register


@full_run("a42b_incremental_daily_sales", of="a42_fct_daily_sales")
def incremental_daily_sales(t):
    table = _table(t, "daily-sales")
    for day in ("2024-01-07", "2024-01-20", "2024-12-31"):
        incremental.refresh_daily_sales(table, t.sales_transactions, START_DATE, day)
    return table.read()


@full_run("a43b_incremental_order_performance", of="a43_fct_order_performance")
def incremental_order_performance(t):
    # The orders are stored by month, so that a refresh reads the months it touches.
    table, path = _table(t, "order-performance"), f"{shared_folder(t.spark)}/orders-{uuid.uuid4().hex}"
    month = incremental.month_part(F.col("order_date")).alias("order_month")
    sinks.write_files(t.orders.select("*", month), path, partition_by=["order_month"])
    orders = t.spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path)
    orders = orders.withColumn("order_month", F.col("order_month").cast("string"))
    for day in MARKS:
        incremental.refresh_order_performance(table, orders, t.order_details, day)
    return table.read()


@full_run("a44b_incremental_product_sales", of="a44_fct_product_sales")
def incremental_product_sales(t):
    table = _table(t, "product-sales")
    products = staging.stg_products(t.products, t.categories, t.suppliers)
    for day in MARKS:
        incremental.refresh_product_metrics(table, products, t.order_details, t.orders, t.customers, day)
    return marts.product_standing(table.read(), AS_OF, star=STAR, high=HIGH, solid=SOLID)


@full_run("a45b_incremental_customer_metrics", of="a45_dim_customer_metrics")
def incremental_customer_metrics(t):
    table = _table(t, "customer-metrics")
    for day in MARKS:
        incremental.refresh_customer_metrics(table, t.customers, t.orders, t.order_details, AS_OF, day)
    return table.read()
