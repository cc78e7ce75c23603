"""Data-quality checks. A check is one row (check_name, value, passed); thresholds and the
reference time are arguments. Rules over one table share one scan of it."""

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import scalars
from tillworks.operators import aggregates, filters, joins


def _check(one_row: DataFrame, name: str, value: Column, passed: Column) -> DataFrame:
    return one_row.select(
        F.lit(name).alias("check_name"),
        value.cast("double").alias("value"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


# Order checks


def order_integrity(
    orders: DataFrame, details: DataFrame, as_of: str, days: int = 7
) -> DataFrame:
    """One row: recent orders, how many have a positive total, and the share in percent."""
    recent = filters.recent_days(orders, "order_date", as_of, days).select("order_id")
    lines = joins.details_of(details, recent)
    totals = joins.orders_with_zero_totals(recent, lines)
    counted = totals.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("order_total") > 0).alias("orders_with_items"),
        F.count_if(F.col("order_total") == 0).alias("orders_without_items"),
    )
    share = F.col("orders_with_items") / F.col("total_orders") * 100
    return counted.withColumn(
        "integrity_score", F.when(F.col("total_orders") > 0, share).otherwise(F.lit(0.0))
    )


def check_order_integrity(
    orders: DataFrame, details: DataFrame, as_of: str, days: int = 7, at_least: float = 95
) -> DataFrame:
    score = F.col("integrity_score")
    return _check(
        order_integrity(orders, details, as_of, days), "order_integrity", score, score >= at_least
    )


def referential_issues(
    orders: DataFrame,
    details: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    employees: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    """Orphans per foreign key. Customer and product are mandatory, so null counts there."""
    keys = [
        ("Orphaned customers", orders, "customer_id", customers, True),
        ("Orphaned employees", orders, "employee_id", employees, False),
        ("Orphaned products", details, "product_id", products, True),
        ("Orphaned categories", products, "category_id", categories, False),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            joins.orphan_count(child, key, parent, mandatory).select(
                F.lit(name).alias("relation"), F.col("orphans").alias("issues")
            )
            for name, child, key, parent, mandatory in keys
        ],
    )


def check_referential_integrity(*tables: DataFrame) -> DataFrame:
    total = referential_issues(*tables).agg(F.sum("issues").alias("issues"))
    return _check(total, "referential_integrity", F.col("issues"), F.col("issues") == 0)


def _violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations per rule as rows, from one scan."""
    counts = df.agg(*[F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())])
    pairs = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, name in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def business_rule_violations(
    orders: DataFrame, details: DataFrame, products: DataFrame
) -> DataFrame:
    discount, ordered = F.col("discount"), F.col("order_date")
    on_lines = {
        "Negative/zero unit prices": F.col("unit_price") <= 0,
        "Negative/zero quantities": F.col("quantity") <= 0,
        "Invalid discounts": (discount < 0) | (discount > 1),
    }
    on_orders = {
        "Shipped before ordered": F.col("shipped_date") < ordered,
        "Required before ordered": F.col("required_date") < ordered,
    }
    on_products = {
        "Discontinued with stock": F.col("discontinued") & (F.col("units_in_stock") > 0)
    }
    return (
        _violations(details, on_lines)
        .unionByName(_violations(orders, on_orders))
        .unionByName(_violations(products, on_products))
    )


def check_business_rules(
    orders: DataFrame, details: DataFrame, products: DataFrame, at_most: int = 5
) -> DataFrame:
    total = business_rule_violations(orders, details, products).agg(
        F.sum("violations").alias("total")
    )
    return _check(total, "business_rules", F.col("total"), F.col("total") <= at_most)


def check_order_freshness(orders: DataFrame, as_of: str, at_most_days: int = 90) -> DataFrame:
    age = F.col("days_old")
    return _check(
        aggregates.latest_date_and_age(orders, "order_date", as_of),
        "data_freshness",
        age,
        age <= at_most_days,
    )


# Event checks


def check_event_freshness(events: DataFrame, as_of: str, below_minutes: float = 60) -> DataFrame:
    now = F.lit(as_of).cast("timestamp_ntz")
    age = F.col("minutes_old")
    return _check(
        events.agg(F.max("created_at").alias("latest")).withColumn(
            "minutes_old", scalars.minutes_between("latest", now)
        ),
        "event_freshness",
        age,
        age < below_minutes,
    )


def _last_hours(events: DataFrame, as_of: str, hours: int) -> DataFrame:
    return filters.lookback(events, "created_at", as_of, hours=hours)


def check_event_completeness(
    events: DataFrame, as_of: str, hours: int = 1, at_least: float = 95
) -> DataFrame:
    columns = {
        "user_id": "null_user_id",
        "event_type": "null_event_type",
        "event_timestamp": "null_timestamp",
    }
    score = F.col("completeness_pct")
    return _check(
        aggregates.null_profile(_last_hours(events, as_of, hours), columns),
        "event_completeness",
        score,
        score >= at_least,
    )


def check_event_volume(
    events: DataFrame, as_of: str, hours: int = 1, at_least: int = 100
) -> DataFrame:
    rows = F.col("rows")
    counted = _last_hours(events, as_of, hours).agg(F.count(F.lit(1)).alias("rows"))
    return _check(counted, "event_volume", rows, rows >= at_least)


# Outcome


def all_checks(checks: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def verdict(checks: DataFrame) -> DataFrame:
    """One row: the number of checks, how many failed, and the outcome label."""
    return checks.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.when(F.coalesce(F.bool_and("passed"), F.lit(False)), "quality_passed")
        .otherwise("quality_failed")
        .alias("outcome"),
    )


def alert(checks: DataFrame) -> DataFrame:
    """The failing checks with their values; empty when all pass."""
    return checks.filter(~F.col("passed")).select("check_name", "value")


def metrics_record(checks: DataFrame, run_time: str, database: str) -> DataFrame:
    """One row per run: every check's value as a column."""
    names = ("order_integrity", "referential_integrity", "business_rules", "data_freshness")
    titles = ("integrity_score_pct", "referential_issues", "business_violations", "data_age_days")
    return checks.agg(
        F.lit(run_time).cast("timestamp_ntz").alias("timestamp"),
        F.lit(database).alias("database"),
        *[
            F.max(F.when(F.col("check_name") == name, F.col("value"))).alias(title)
            for name, title in zip(names, titles, strict=True)
        ],
    )


# Declared column tests


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; null is no value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


@dataclass(frozen=True)
class ColumnTest:
    """A declared test of a column, or of an expression over the columns."""

    table: str
    column: str
    name: str
    args: tuple = ()


def unique(table: str, column: str) -> ColumnTest:
    return ColumnTest(table, column, "unique")


def not_null(table: str, column: str) -> ColumnTest:
    return ColumnTest(table, column, "not_null")


def accepted_values(table: str, column: str, values: Sequence[str]) -> ColumnTest:
    """Null passes."""
    return ColumnTest(table, column, "accepted_values", tuple(values))


def expression_is_true(table: str, expression: str) -> ColumnTest:
    """Unknown counts as a violation."""
    return ColumnTest(table, expression, "expression_is_true")


def accepted_range(table: str, column: str, low: float, high: float) -> ColumnTest:
    return ColumnTest(table, column, "accepted_range", (low, high))


def _broken(test: ColumnTest) -> Column:
    """True for a row that violates a row test."""
    if test.name == "expression_is_true":
        return ~F.coalesce(F.expr(test.column), F.lit(False))
    value = F.col(test.column)
    if test.name == "not_null":
        return value.isNull()
    if test.name == "accepted_values":
        return ~value.isin(*test.args)
    low, high = test.args
    return (value < low) | (value > high)


def failures(df: DataFrame, test: ColumnTest) -> DataFrame:
    """One row: how many rows (or, for uniqueness, values) violate the test."""
    if test.name == "unique":
        violations = not_unique(df, test.column)
    else:
        violations = df.filter(_broken(test))
    return violations.agg(F.count(F.lit(1)).alias("failures"))


def _table_results(df: DataFrame, keys: Sequence[str], tests: Sequence[ColumnTest]) -> DataFrame:
    """One row with the failures of all tests of a table.

    Without a uniqueness test that is one aggregate. With one, the row tests are counted along
    with the rows of each key value, so the table is still read only once.
    """
    counts = [F.count_if(_broken(t)).alias(f"t{i}") for i, t in enumerate(tests)]
    if not keys:
        return df.agg(*counts)
    key = keys[0]
    per_value = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *counts)
    repeated = F.col("_key").isNotNull() & (F.col("_n") > 1)
    first = per_value.agg(
        F.count_if(repeated).alias("u0"),
        *[F.coalesce(F.sum(f"t{i}"), F.lit(0)).alias(f"t{i}") for i in range(len(tests))],
    )
    others = [
        not_unique(df, k).agg(F.count(F.lit(1)).alias(f"u{i}"))
        for i, k in enumerate(keys[1:], start=1)
    ]
    return aggregates.side_by_side([first, *others])


def run_suite(tables: Mapping[str, DataFrame], tests: Sequence[ColumnTest]) -> DataFrame:
    """All declared tests as one result table: one pass over each table, and one more for every
    uniqueness test after the first."""

    def result(test: ColumnTest, failures: str) -> Column:
        return F.struct(
            F.lit(test.table).alias("table_name"),
            F.lit(test.column).alias("column_name"),
            F.lit(test.name).alias("test_name"),
            F.col(failures).cast("bigint").alias("failures"),
        )

    results = []
    for table, df in tables.items():
        unique_tests = [t for t in tests if t.table == table and t.name == "unique"]
        row_tests = [t for t in tests if t.table == table and t.name != "unique"]
        if not unique_tests and not row_tests:
            continue
        counted = _table_results(df, [t.column for t in unique_tests], row_tests)
        outcome = [result(t, f"u{i}") for i, t in enumerate(unique_tests)]
        outcome += [result(t, f"t{i}") for i, t in enumerate(row_tests)]
        results.append(counted.select(F.inline(F.array(*outcome))))
    return reduce(DataFrame.unionByName, results).withColumn("passed", F.col("failures") == 0)


# The accepted labels of the declared tests.
SEGMENTS = ("VIP", "High Value", "Medium Value", "Low Value", "No Purchase")
ACTIVITY = ("Active", "At Risk", "Dormant", "Churned")
STATUSES = ("completed", "failed", "pending", "cancelled")


def declared_tests() -> list[ColumnTest]:
    """The tests declared for sources, staging models and marts."""
    keys = {
        "sales_transactions": "transaction_id",
        "user_events": "event_id",
        "product_catalog": "product_id",
        "stg_sales_transactions": "transaction_id",
        "stg_user_events": "event_id",
        "stg_orders": "order_id",
        "stg_customers": "customer_id",
        "stg_products": "product_id",
        "fct_daily_sales": "date",
        "fct_order_performance": "date",
        "fct_product_sales": "product_id",
        "dim_customer_metrics": "customer_id",
        "dim_user_metrics": "user_id",
    }
    filled = {
        "sales_transactions": ("user_id", "amount"),
        "user_events": ("user_id", "event_type"),
        "stg_sales_transactions": ("user_id", "amount"),
        "stg_user_events": ("user_id", "event_type", "event_timestamp"),
        "stg_orders": ("customer_id",),
        "stg_order_details": ("order_id", "product_id", "extended_price"),
        "stg_customers": ("company_name",),
        "stg_products": ("product_name",),
        "fct_daily_sales": ("total_transactions", "total_revenue", "completion_rate"),
        "dim_user_metrics": (
            "lifetime_value",
            "user_segment",
            "activity_status",
            "engagement_score",
        ),
    }
    tests = [test(table, key) for table, key in keys.items() for test in (unique, not_null)]
    tests += [not_null(table, column) for table, columns in filled.items() for column in columns]
    tests += [
        accepted_values("sales_transactions", "status", STATUSES),
        accepted_values("dim_user_metrics", "user_segment", SEGMENTS),
        accepted_values("dim_user_metrics", "activity_status", ACTIVITY),
        accepted_range("fct_daily_sales", "completion_rate", 0, 100),
        expression_is_true(
            "fct_daily_sales",
            "total_transactions >= completed_transactions + failed_transactions",
        ),
    ]
    return tests
