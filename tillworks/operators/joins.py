"""Joins of the retail model.

Joins that feed an aggregate first reduce the many side to one row per key, so a key that
holds a third of the rows costs no more than any other. Joins whose result is row by row have
the many side on the inner or preserved side, where adaptive execution splits hot keys by their
real sizes. Only tables of a fixed size carry a broadcast hint; for all others Spark checks it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import scalars
from tillworks.plans import staging


def order_context(
    orders: DataFrame, customers: DataFrame, employees: DataFrame, shippers: DataFrame
) -> DataFrame:
    """Orders with the names of customer, employee and shipper."""
    who = customers.select(
        "customer_id",
        F.col("company_name").alias("customer_name"),
        F.col("country").alias("customer_country"),
    )
    staff = employees.select(
        "employee_id", scalars.full_name("first_name", "last_name").alias("employee_name")
    )
    carriers = shippers.select(
        F.col("shipper_id").alias("ship_via"), F.col("company_name").alias("shipper_name")
    )
    return (
        orders.join(staff, "employee_id")
        .join(carriers, "ship_via")
        .join(who, "customer_id")
        .select(
            "order_id",
            "customer_id",
            "customer_name",
            "customer_country",
            "employee_id",
            "employee_name",
            "order_date",
            "shipped_date",
            "freight",
            "ship_country",
            "shipper_name",
        )
    )


def product_catalog(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products that have a category, with its name."""
    return products.join(categories.select("category_id", "category_name"), "category_id").select(
        "product_id",
        "product_name",
        "category_name",
        "unit_price",
        "units_in_stock",
        "units_on_order",
        "reorder_level",
        "discontinued",
    )


def line_context(details: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Order lines with product and category names and the price after discount."""
    names = product_catalog(products, categories).select(
        "product_id", "product_name", "category_name"
    )
    lines = staging.stg_order_details(details).select(
        "order_id", "product_id", "unit_price", "quantity", "discount", "extended_price"
    )
    return lines.join(names, "product_id").select(
        "order_id",
        "product_id",
        "product_name",
        "category_name",
        "unit_price",
        "quantity",
        "discount",
        "extended_price",
    )


def enrich_transactions(
    transactions: DataFrame,
    users: DataFrame,
    products: DataFrame,
    electronics: str = "Electronics",
) -> DataFrame:
    """Transactions with user and product; both joins keep unmatched transactions."""
    day = scalars.text_date("transaction_date")
    return (
        transactions.withColumn("transaction_date", day)
        .join(
            users.withColumn("registration_date", scalars.text_date("registration_date")),
            "user_id",
            "left",
        )
        .join(products, "product_id", "left")
        .withColumns(
            {
                "user_full_name": scalars.display_name("username", "country"),
                "days_since_registration": scalars.days_between(
                    "registration_date", "transaction_date"
                ),
                "is_electronics": scalars.flag(F.col("category") == electronics),
                "transaction_year_month": scalars.year_month("transaction_date"),
            }
        )
    )


def named_transactions(transactions: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Transactions with two columns called ``name`` told apart by their table."""
    t, u, p = transactions.alias("t"), users.alias("u"), products.alias("p")
    return (
        t.join(u, F.col("t.user_id") == F.col("u.user_id"), "left")
        .join(p, F.col("t.product_id") == F.col("p.product_id"), "left")
        .select(
            "t.transaction_id",
            F.col("u.name").alias("customer_name"),
            "u.country",
            F.col("p.name").alias("product_name"),
            "p.category",
            "t.amount",
            "t.status",
        )
    )


def order_line_sums(details: DataFrame) -> DataFrame:
    """Lines reduced to one row per order."""
    return (
        staging.stg_order_details(details)
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum("extended_price").alias("extended_price"),
            F.sum("quantity").alias("quantity"),
            F.sum("discount_amount").alias("discount_amount"),
        )
    )


def order_totals(details: DataFrame) -> DataFrame:
    """Net total per order."""
    return (
        staging.stg_order_details(details)
        .groupBy("order_id")
        .agg(F.sum("extended_price").alias("order_total"))
    )


def with_children(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Every parent with its children, parents without any included: a left join in two parts.

    Adaptive execution splits a hot key on the many side of an inner join, but not on the outer
    side of a left join. So the matches come from an inner join, and the parents without
    children from an anti join with the distinct keys.
    """
    matched = child.join(parent, key)
    childless = parent.join(child.select(key).distinct(), key, "left_anti")
    rows = matched.unionByName(childless, allowMissingColumns=True)
    return rows.select(*parent.columns, *[c for c in child.columns if c != key])


def customer_orders(customers: DataFrame, orders: DataFrame, details: DataFrame) -> DataFrame:
    """Every customer with its orders, and every order with the sums of its lines."""
    with_lines = orders.join(order_line_sums(details), "order_id", "left")
    return with_children(customers, with_lines, "customer_id")


def product_order_lines(products: DataFrame, details: DataFrame, orders: DataFrame) -> DataFrame:
    """Every product with its lines, and every line with date and customer of its order."""
    lines = (
        staging.stg_order_details(details)
        .select("product_id", "order_id", "quantity", "extended_price")
        .join(orders.select("order_id", "order_date", "customer_id"), "order_id", "left")
    )
    return with_children(products.select("product_id", "product_name"), lines, "product_id")


def orders_with_totals(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders that have lines, with their net total."""
    return orders.join(order_totals(details), "order_id")


def orders_with_zero_totals(orders: DataFrame, details: DataFrame) -> DataFrame:
    """All orders, with total 0 when they have no lines."""
    zero = F.lit(0).cast("decimal(1,0)")
    return orders.join(order_totals(details), "order_id", "left").withColumn(
        "order_total", F.coalesce("order_total", zero)
    )


def orphan_count(
    child: DataFrame, key: str, parent: DataFrame, null_is_orphan: bool = True
) -> DataFrame:
    """One row: how many child rows have no parent. Keys are counted before the join."""
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    if not null_is_orphan:
        counts = counts.filter(F.col(key).isNotNull())
    return counts.join(parent.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans")
    )


def details_of(details: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of the given orders; adaptive execution broadcasts the ids if they are few."""
    return details.join(orders.select("order_id"), "order_id", "left_semi")


def rows_of_customers(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows whose customer is in the list."""
    return rows.join(customers.select("customer_id"), "customer_id", "left_semi")


def sales_lines(
    products: DataFrame, categories: DataFrame, details: DataFrame, orders: DataFrame
) -> DataFrame:
    """Lines with product, category and order date."""
    return line_context(details, products, categories).join(
        orders.select("order_id", "order_date"), "order_id"
    )


def customers_who_ordered(customers: DataFrame, orders: DataFrame, first: str, last: str) -> DataFrame:
    """Customers with an order in the period, once each; an order whose customer is unknown
    yields a row of nulls. Orders are reduced to distinct customers before the join."""
    period = F.col("order_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    buyers = orders.filter(period).select(F.col("customer_id").alias("buyer")).distinct()
    known = customers.select("customer_id", "company_name", "city", "country")
    return (
        known.join(buyers, F.col("customer_id") == F.col("buyer"), "right").drop("buyer").distinct()
    )


def with_group_share(df: DataFrame, group: str, measure: str, total: str, share: str) -> DataFrame:
    """Add the total of a measure per group and each row's percent of it.

    The totals are summed before the shuffle and joined by their real size.
    """
    totals = df.groupBy(group).agg(F.sum(measure).alias(total))
    return df.join(totals, group, "left").withColumn(
        share, scalars.percent(F.col(measure), F.col(total))
    )
