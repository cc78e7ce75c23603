"""The named analytics jobs. Each is one plan: nothing is collected between its steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import ladders, scalars
from tillworks.operators import aggregates, filters, joins, ordering, windows
from tillworks.plans import staging

# Sales transactions


def aggregate_by_user(transactions: DataFrame) -> DataFrame:
    names = (
        "total_transactions",
        "total_spent",
        "avg_transaction_value",
        "max_transaction",
        "min_transaction",
    )
    forms = aggregates.five_numbers("amount", names)
    forms[0] = F.count("transaction_id").alias("total_transactions")
    return ordering.by_measure(
        filters.completed(transactions).groupBy("user_id").agg(*forms), "total_spent", "user_id"
    )


def aggregate_by_product(transactions: DataFrame) -> DataFrame:
    sales = filters.completed(transactions).groupBy("product_id").agg(
        F.count("transaction_id").alias("total_sales"),
        F.sum("amount").alias("total_revenue"),
        scalars.exact_mean("amount").alias("avg_price"),
    )
    return ordering.by_measure(sales, "total_revenue", "product_id")


def aggregate_by_time(transactions: DataFrame) -> DataFrame:
    day = F.col("transaction_date")
    return (
        filters.completed(transactions)
        .groupBy(
            F.year(day).alias("year"), F.month(day).alias("month"), F.day(day).alias("day")
        )
        .agg(
            F.count("transaction_id").alias("daily_transactions"),
            F.sum("amount").alias("daily_revenue"),
            scalars.exact_mean("amount").alias("avg_transaction_value"),
        )
        .orderBy("year", "month", "day")
    )


def _user_product_sums(transactions: DataFrame) -> DataFrame:
    """Transactions reduced to one row per user and product, before any join."""
    return transactions.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count("transaction_id").alias("transaction_ids"),
        F.sum("amount").alias("amount"),
        F.count("amount").alias("amounts"),
    )


def _country_category_sums(
    transactions: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    return (
        _user_product_sums(transactions)
        .join(users.select("user_id", "country"), "user_id", "left")
        .join(products.select("product_id", "category"), "product_id", "left")
        .groupBy("country", "category")
        .agg(
            F.sum("transactions").alias("transactions"),
            F.sum("amount").alias("total_revenue"),
        )
    )


def country_category_summary(
    transactions: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    sums = _country_category_sums(transactions, users, products)
    return ordering.by_keys_then_measure(sums, ["country"], "total_revenue", "category")


def category_country_performance(
    transactions: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    sums = _country_category_sums(transactions, users, products).select(
        "category",
        "country",
        "total_revenue",
        F.col("transactions").alias("transaction_count"),
        scalars.ratio(F.col("total_revenue"), F.col("transactions"), 2).alias(
            "avg_transaction_value"
        ),
    )
    return ordering.by_measure(sums, "total_revenue", "category", "country")


def user_segments(
    transactions: DataFrame,
    users: DataFrame,
    products: DataFrame,
    electronics: str = "Electronics",
) -> DataFrame:
    per_product = _user_product_sums(filters.completed(transactions)).join(
        products.select("product_id", "category"), "product_id", "left"
    )
    per_user = per_product.groupBy("user_id").agg(
        F.sum("transaction_ids").alias("total_transactions"),
        F.sum("amount").alias("total_spent"),
        F.try_divide(F.sum("amount").cast("double"), F.sum("amounts")).alias("avg_transaction"),
        scalars.sum_where(F.col("category") == electronics, "transactions").alias(
            "electronics_purchases"
        ),
    )
    share = F.try_divide(F.col("electronics_purchases"), F.col("total_transactions"))
    return (
        per_user.join(users.select("user_id", "username", "country"), "user_id", "left")
        .withColumns(
            {
                "spending_segment": ladders.spending_segment(F.col("total_spent")),
                "purchase_frequency": ladders.purchase_frequency(F.col("total_transactions")),
                "product_preference": ladders.product_preference(share),
            }
        )
        .select(
            "user_id",
            "username",
            "country",
            "total_transactions",
            "total_spent",
            "avg_transaction",
            "electronics_purchases",
            "spending_segment",
            "purchase_frequency",
            "product_preference",
        )
    )


# Orders: the daily ETL


def daily_sales_summary(orders: DataFrame, details: DataFrame, as_of: str) -> DataFrame:
    """One row. Products and orders are counted by grouping, so no task holds the distinct set."""
    day = F.lit(as_of).cast("date")
    lines = staging.stg_order_details(details)
    per_order = lines.groupBy("order_id").agg(
        F.sum("extended_price").alias("order_total"),
        F.sum("quantity").alias("units"),
        F.sum("discount").alias("discounts"),
        F.count("discount").alias("discount_rows"),
    )
    money = per_order.agg(
        F.sum("order_total").alias("total_revenue"),
        F.sum("units").alias("total_items_sold"),
        scalars.exact_mean("order_total").alias("avg_order_value"),
        F.try_divide(F.sum("discounts").cast("double"), F.sum("discount_rows")).alias(
            "avg_discount"
        ),
    )
    variety = lines.agg(F.count_distinct("product_id").alias("unique_products"))
    placed = orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("freight").alias("total_freight"),
    )
    return aggregates.side_by_side([placed, money, variety]).select(
        day.alias("date"),
        "total_orders",
        "total_revenue",
        "total_items_sold",
        "unique_customers",
        "unique_products",
        "avg_order_value",
        "avg_discount",
        "total_freight",
    )


def sales_by_category_summary(
    details: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """One pass over the lines: they shrink to one row per category and order, which counts the
    orders by rows and carries the sums."""
    category = joins.product_catalog(products, categories).select("product_id", "category_name")
    per_order = (
        staging.stg_order_details(details)
        .join(category, "product_id")
        .groupBy("category_name", "order_id")
        .agg(F.sum("extended_price").alias("revenue"), F.sum("quantity").alias("units_sold"))
    )
    mean_price = F.try_divide(F.col("revenue").cast("double"), F.col("units_sold"))
    sums = per_order.groupBy("category_name").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("units_sold").alias("units_sold"),
        F.count("order_id").alias("order_count"),
    ).select(
        "category_name",
        "revenue",
        "units_sold",
        "order_count",
        mean_price.alias("avg_item_price"),
    )
    return ordering.by_measure(sums, "revenue", "category_name")


def sales_by_country(orders: DataFrame, details: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders are reduced to one row per customer before the country is looked up, which also
    turns the distinct count of customers into a plain count."""
    per_customer = (
        joins.orders_with_totals(orders.select("order_id", "customer_id"), details)
        .groupBy("customer_id")
        .agg(F.sum("order_total").alias("revenue"), F.count("order_id").alias("orders"))
    )
    sums = (
        per_customer.join(customers.select("customer_id", "country"), "customer_id")
        .groupBy("country")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("orders").alias("order_count"),
            F.count("customer_id").alias("customer_count"),
        )
    )
    return ordering.by_measure(sums, "revenue", "country")


def sales_by_employee(orders: DataFrame, details: DataFrame, employees: DataFrame) -> DataFrame:
    per_employee = (
        joins.orders_with_totals(orders.select("order_id", "employee_id"), details)
        .groupBy("employee_id")
        .agg(F.sum("order_total").alias("revenue"), F.count("order_id").alias("orders"))
    )
    names = employees.select(
        "employee_id", scalars.full_name("first_name", "last_name").alias("employee_name")
    )
    sums = (
        per_employee.join(names, "employee_id")
        .groupBy("employee_name")
        .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("order_count"))
    )
    return ordering.by_measure(sums, "revenue", "employee_name")


def orders_to_process(orders: DataFrame, as_of: str) -> DataFrame:
    """Orders shipped the day before or, failing that, in the last week."""
    return filters.previous_day_or_week(orders, "shipped_date", as_of)


# Customer analytics


def customer_metrics(
    orders: DataFrame, details: DataFrame, customers: DataFrame, as_of: str
) -> DataFrame:
    """Recency, frequency and money per customer with at least one line.

    ``total_orders`` counts order lines, and ``avg_order_value`` is revenue per line: that is
    the meaning these columns have always had.
    """
    per_customer = (
        orders.select("order_id", "customer_id", "order_date")
        .join(joins.order_line_sums(details), "order_id")
        .groupBy("customer_id")
        .agg(
            F.sum("line_count").alias("total_orders"),
            F.sum("extended_price").alias("total_revenue"),
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
            F.sum("quantity").alias("total_units_purchased"),
        )
    )
    names = customers.select(
        "customer_id",
        F.col("company_name").alias("customer_name"),
        F.col("country").alias("customer_country"),
    )
    revenue, lines = F.col("total_revenue"), F.col("total_orders")
    return per_customer.join(names, "customer_id").select(
        "customer_id",
        "customer_name",
        "customer_country",
        "total_orders",
        "total_revenue",
        F.try_divide(revenue.cast("double"), lines).alias("avg_order_line_value"),
        "last_order_date",
        "first_order_date",
        "total_units_purchased",
        scalars.ratio(revenue, lines, 2).alias("avg_order_value"),
        scalars.age_days("last_order_date", as_of).alias("days_since_last_order"),
    )


def ranked_customers(metrics: DataFrame, partitions: int | None = None) -> DataFrame:
    """Customer metrics with revenue rank and quartile over all customers."""
    return windows.global_rank(
        metrics,
        windows.descending("total_revenue"),
        ["customer_id"],
        rank="revenue_rank",
        tile="revenue_quartile",
        partitions=partitions,
    )


def country_performance(metrics: DataFrame) -> DataFrame:
    revenue = F.col("total_revenue")
    sums = metrics.groupBy("customer_country").agg(
        F.count("customer_id").alias("customer_count"),
        F.sum(revenue).alias("country_revenue"),
        scalars.exact_mean(revenue).alias("avg_customer_value"),
        F.sum("total_orders").alias("total_orders"),
    )
    return ordering.by_measure(
        sums.withColumn(
            "revenue_per_order",
            scalars.ratio(F.col("country_revenue"), F.col("total_orders"), 2),
        ),
        "country_revenue",
        "customer_country",
    )


def customer_category_sales(
    orders: DataFrame,
    details: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    """What each known customer bought, by category; null for lines whose product has none.

    One pass over the lines: they shrink to one row per order and category, and those to one row
    per customer and category. Store the result where more than one figure is taken from it.
    """
    category = joins.product_catalog(products, categories).select("product_id", "category_name")
    per_order = (
        staging.stg_order_details(details)
        .join(category, "product_id", "left")
        .groupBy("order_id", "category_name")
        .agg(
            F.sum("extended_price").alias("revenue"),
            F.count("order_id").alias("lines"),
            F.sum("quantity").alias("units"),
        )
    )
    per_customer = (
        per_order.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "category_name")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("lines").alias("lines"),
            F.sum("units").alias("units"),
        )
    )
    return joins.rows_of_customers(per_customer, customers)


def top_customer_categories(sales: DataFrame, quartile: int = 1) -> DataFrame:
    """What the customers of a revenue quartile buy, from sales by customer and category."""
    totals = sales.groupBy("customer_id").agg(F.sum("revenue").alias("total_revenue"))
    best = ranked_customers(totals).filter(F.col("revenue_quartile") == quartile)
    sums = (
        joins.rows_of_customers(sales.filter("category_name is not null"), best)
        .groupBy("category_name")
        .agg(
            F.sum("revenue").alias("category_revenue"),
            F.sum("lines").alias("order_count"),
            F.sum("units").alias("units_sold"),
        )
    )
    return ordering.by_measure(sums, "category_revenue", "category_name")


# Product analytics


def product_sales(details: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Sales per product. ``times_ordered`` counts lines."""
    per_product = (
        staging.stg_order_details(details)
        .groupBy("product_id")
        .agg(
            F.count("order_id").alias("times_ordered"),
            F.sum("quantity").alias("total_units_sold"),
            F.sum("extended_price").alias("total_revenue"),
            scalars.exact_mean("unit_price").alias("avg_selling_price"),
            scalars.exact_mean("discount").alias("avg_discount_rate"),
        )
    )
    names = joins.product_catalog(products, categories).select(
        "product_id", "product_name", "category_name"
    )
    return per_product.join(names, "product_id").select(
        "product_id",
        "product_name",
        "category_name",
        "times_ordered",
        "total_units_sold",
        "total_revenue",
        "avg_selling_price",
        "avg_discount_rate",
        scalars.ratio(F.col("total_revenue"), F.col("total_units_sold"), 2).alias(
            "revenue_per_unit"
        ),
    )


def product_stock_analysis(sales: DataFrame, products: DataFrame) -> DataFrame:
    stock = products.select("product_id", "units_in_stock", "units_on_order", "reorder_level")
    on_hand, sold = F.col("units_in_stock"), F.col("total_units_sold")
    return sales.join(stock, "product_id", "left").withColumns(
        {
            "inventory_status": ladders.inventory_status(on_hand, F.col("reorder_level")),
            "stock_coverage_orders": scalars.ratio(on_hand * 30, sold, 1, otherwise=None),
        }
    )


def category_performance(sales: DataFrame) -> DataFrame:
    """Category totals over product sales; the mean discount weighs every product the same. It is
    rounded once, for output, beyond what the order of adding up can change."""
    sums = sales.groupBy("category_name").agg(
        F.count("product_id").alias("products_in_category"),
        F.sum("total_revenue").alias("category_revenue"),
        F.sum("total_units_sold").alias("category_units_sold"),
        F.round(F.avg("avg_discount_rate"), 9).alias("avg_category_discount"),
    )
    return ordering.by_measure(
        sums.withColumn(
            "revenue_per_product",
            scalars.ratio(F.col("category_revenue"), F.col("products_in_category"), 2),
        ),
        "category_revenue",
        "category_name",
    )


def stock_alerts(analysis: DataFrame, bound: float = 1000) -> DataFrame:
    """Products that sell well and run low."""
    alerts = filters.labelled_above(
        analysis, "inventory_status", "LOW STOCK", "total_revenue", bound
    ).select(
        "product_name",
        "category_name",
        "total_revenue",
        "total_units_sold",
        "units_in_stock",
        "units_on_order",
        "product_id",
    )
    return ordering.by_measure(alerts, "total_revenue", "product_id").drop("product_id")


def executive_summary(
    metrics: DataFrame, analysis: DataFrame, as_of: str, alert_bound: float = 1000
) -> DataFrame:
    """One row of headline figures, from customer metrics and product stock analysis.

    Both sides go through their small middle grain (country, category) on the way to one row.
    """
    countries = metrics.groupBy("customer_country").agg(
        F.count("customer_id").alias("customers"), F.sum("total_revenue").alias("country_revenue")
    )
    customer_side = countries.agg(
        F.sum("customers").alias("total_customers"),
        F.sum("country_revenue").alias("total_revenue"),
        ordering.first_by("customer_country", "country_revenue", "top_country"),
        F.max("country_revenue").alias("top_country_revenue"),
    ).withColumn(
        "avg_customer_value",
        F.try_divide(F.col("total_revenue").cast("double"), F.col("total_customers")),
    )
    low = (F.col("inventory_status") == "LOW STOCK") & (F.col("total_revenue") > alert_bound)
    best = F.max(F.struct("total_revenue", "product_name", "product_id")).alias("best")
    categories = analysis.groupBy("category_name").agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("total_revenue").alias("category_revenue"),
        scalars.count_where(low).alias("alerts"),
        best,
    )
    product_side = categories.agg(
        F.sum("products").alias("total_products"),
        F.sum("category_revenue").alias("total_product_revenue"),
        F.max("best").alias("best"),
        ordering.first_by("category_name", "category_revenue", "top_category"),
        F.max("category_revenue").alias("top_category_revenue"),
        F.sum("alerts").alias("stock_alerts"),
    )
    return aggregates.side_by_side([customer_side, product_side]).select(
        F.lit(as_of).cast("date").alias("as_of"),
        "total_customers",
        "total_revenue",
        "avg_customer_value",
        "top_country",
        "top_country_revenue",
        "total_products",
        "total_product_revenue",
        F.col("best.product_name").alias("top_product"),
        F.col("best.total_revenue").alias("top_product_revenue"),
        "top_category",
        "top_category_revenue",
        "stock_alerts",
    )


# Views of the trading database


def order_subtotals(details: DataFrame) -> DataFrame:
    return joins.order_totals(details).withColumnRenamed("order_total", "subtotal")


def _product_revenue(details: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue per product over the lines of the given orders, one row per product."""
    return (
        staging.stg_order_details(joins.details_of(details, orders))
        .groupBy("product_id")
        .agg(F.sum("extended_price").alias("revenue"))
    )


def product_sales_between(
    details: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    first: str,
    last: str,
) -> DataFrame:
    """Sales per category and product name of the orders in a period."""
    in_period = filters.between_dates(orders, "order_date", first, last)
    return (
        _product_revenue(details, in_period)
        .join(joins.product_catalog(products, categories), "product_id")
        .groupBy("category_name", "product_name")
        .agg(F.sum("revenue").alias("product_sales"))
    )


def sales_by_category(
    details: DataFrame, orders: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    named = products.select("product_id", "product_name", "category_id").join(
        categories.select("category_id", "category_name"), "category_id"
    )
    return (
        _product_revenue(details, orders)
        .join(named, "product_id")
        .groupBy("category_id", "category_name", "product_name")
        .agg(F.sum("revenue").alias("product_sales"))
    )


def quarterly_orders(customers: DataFrame, orders: DataFrame, first: str, last: str) -> DataFrame:
    return joins.customers_who_ordered(customers, orders, first, last)


def reference_data_readiness(
    products: DataFrame, customers: DataFrame, employees: DataFrame, at_least: int = 5
) -> DataFrame:
    """One row: counts of usable reference rows, and whether they suffice for events."""
    counts = [
        (filters.sellable(products), "product_count"),
        (customers, "customer_count"),
        (employees, "employee_count"),
    ]
    columns = [df.agg(F.count(F.lit(1))).scalar().alias(name) for df, name in counts]
    one_row = products.sparkSession.range(1).select(*columns)
    return one_row.withColumn(
        "ready", (F.col("product_count") >= at_least) & (F.col("customer_count") >= at_least)
    )
