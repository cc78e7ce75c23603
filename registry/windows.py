"""Window functions, spread over the cluster, against plain windows in SQL."""

from registry.core import AS_OF, dbl, query, stored
from tillworks.operators import joins, windows
from tillworks.plans import jobs

PROMO = "PROMO"


def _dated(t):
    enriched = joins.enrich_transactions(t.sales_transactions, t.users, t.catalog_products, PROMO)
    return enriched.select(
        "transaction_id", "user_id", "transaction_date", "amount", "category",
        "transaction_year_month",
    )


def _own(t):
    return _dated(t).select("transaction_id", "user_id", "transaction_date", "amount")


def _user_window(t, outputs):
    return windows.spread_window(
        _own(t),
        ["user_id"],
        windows.ascending("transaction_date"),
        ["transaction_id"],
        outputs,
        value="amount",
    )


BASE = "transaction_id, user_id, transaction_date, CAST(amount AS DOUBLE) AS amount"
BY_USER = "PARTITION BY user_id ORDER BY transaction_date"


@query(
    "w01_user_row_number",
    f"""SELECT {BASE}, row_number() OVER ({BY_USER}, transaction_id) AS user_transaction_number
        FROM enriched""",
)
def user_row_number(t):
    return _user_window(t, {"user_transaction_number": windows.ROW_NUMBER})


@query(
    "w02_user_running_total",
    f"""SELECT {BASE}, {dbl(f"sum(amount) OVER ({BY_USER})")} AS user_running_total
        FROM enriched""",
)
def user_running_total(t):
    return _user_window(t, {"user_running_total": windows.RUNNING_TOTAL})


@query(
    "w03_previous_amount",
    f"""SELECT {BASE}, {dbl(f"lag(amount) OVER ({BY_USER}, transaction_id)")}
            AS previous_transaction_amount
        FROM enriched""",
)
def previous_amount(t):
    return _user_window(t, {"previous_transaction_amount": windows.LAG})


@query(
    "w04_next_amount",
    f"""SELECT {BASE}, {dbl(f"lead(amount) OVER ({BY_USER}, transaction_id)")}
            AS next_transaction_amount
        FROM enriched""",
)
def next_amount(t):
    return _user_window(t, {"next_transaction_amount": windows.LEAD})


@query(
    "w05_rank_in_category",
    f"""SELECT {BASE}, category,
               rank() OVER (PARTITION BY category ORDER BY amount DESC) AS category_sales_rank
        FROM enriched""",
)
def rank_in_category(t):
    return windows.rank_in_category(_dated(t).drop("transaction_year_month"))


@query(
    "w06_dense_rank_in_month",
    f"""SELECT {BASE}, transaction_year_month,
               dense_rank() OVER (PARTITION BY transaction_year_month ORDER BY amount DESC)
                   AS monthly_transaction_rank
        FROM enriched""",
)
def dense_rank_in_month(t):
    return windows.rank_in_month(_dated(t).drop("category"))


REVENUE = """
    SELECT o.customer_id, sum(l.extended_price) AS total_revenue
    FROM sale_orders o JOIN lines l ON o.order_id = l.order_id GROUP BY 1"""


@query(
    "w07_global_row_number",
    f"""WITH m AS ({REVENUE})
        SELECT customer_id, {dbl("total_revenue")} AS total_revenue,
               row_number() OVER (ORDER BY m.total_revenue DESC, customer_id) AS revenue_rank
        FROM m""",
)
def global_row_number(t):
    metrics = jobs.customer_metrics(t.orders, t.order_details, t.customers, AS_OF)
    return windows.global_rank(
        stored(metrics.select("customer_id", "total_revenue"), "w07"),
        windows.descending("total_revenue"),
        ["customer_id"],
        rank="revenue_rank",
    )


@query(
    "w08_global_quartile",
    f"""WITH m AS ({REVENUE})
        SELECT customer_id, {dbl("total_revenue")} AS total_revenue,
               row_number() OVER (ORDER BY m.total_revenue DESC, customer_id) AS revenue_rank,
               CAST(ntile(4) OVER (ORDER BY m.total_revenue DESC, customer_id) AS INTEGER)
                   AS revenue_quartile
        FROM m""",
)
def global_quartile(t):
    metrics = jobs.customer_metrics(t.orders, t.order_details, t.customers, AS_OF)
    return jobs.ranked_customers(stored(metrics.select("customer_id", "total_revenue"), "w08"))


@query(
    "w09_all_transaction_windows",
    f"""SELECT {BASE}, category, transaction_year_month,
               row_number() OVER ({BY_USER}, transaction_id) AS user_transaction_number,
               {dbl(f"sum(amount) OVER ({BY_USER})")} AS user_running_total,
               {dbl(f"lag(amount) OVER ({BY_USER}, transaction_id)")}
                   AS previous_transaction_amount,
               {dbl(f"lead(amount) OVER ({BY_USER}, transaction_id)")}
                   AS next_transaction_amount,
               rank() OVER (PARTITION BY category ORDER BY amount DESC) AS category_sales_rank,
               dense_rank() OVER (PARTITION BY transaction_year_month ORDER BY amount DESC)
                   AS monthly_transaction_rank
        FROM enriched""",
)
def all_transaction_windows(t):
    return windows.apply_window_functions(stored(_dated(t), "w09"), keep=lambda rows: stored(rows, "w09"))
