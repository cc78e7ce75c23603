"""Row filters and projections. Reference dates are arguments, so results are repeatable."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


def renamed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select the given columns under new names, in order."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])


def completed(transactions: DataFrame, status: str = "completed") -> DataFrame:
    return transactions.filter(F.col("status") == status)


def since(df: DataFrame, column: str, start_date: str) -> DataFrame:
    """Rows from a start date on."""
    return df.filter(F.col(column) >= _day(start_date))


def previous_day(df: DataFrame, column: str, as_of: str) -> DataFrame:
    """Rows of the day before the reference date."""
    today = _day(as_of)
    return df.filter((F.col(column) >= F.date_sub(today, 1)) & (F.col(column) < today))


def previous_day_or_week(df: DataFrame, column: str, as_of: str) -> DataFrame:
    """Rows of the day before or, if that day has none, of the last 7 days up to today.

    One query: whether the day has rows is a scalar subquery, and the filter on the week
    reaches the scan in both cases.
    """
    today, value = _day(as_of), F.col(column)
    week = df.filter((value >= F.date_sub(today, 7)) & (value < F.date_add(today, 1)))
    yesterday = (value >= F.date_sub(today, 1)) & (value < today)
    found = df.filter(yesterday).agg(F.count(F.lit(1)) > 0).scalar()
    return week.filter(yesterday | ~found)


def lookback(df: DataFrame, column: str, as_of: str, days: int = 0, hours: int = 0) -> DataFrame:
    """Rows no older than the given span before the reference time."""
    span = F.make_dt_interval(F.lit(days), F.lit(hours))
    return df.filter(F.col(column) >= F.lit(as_of).cast("timestamp_ntz") - span)


def recent_days(df: DataFrame, column: str, as_of: str, days: int) -> DataFrame:
    """Rows whose date is no older than the given days before the reference date."""
    return df.filter(F.col(column) >= F.date_sub(_day(as_of), days))


def between_dates(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    return df.filter(F.col(column).between(_day(first), _day(last)))


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def sellable(products: DataFrame) -> DataFrame:
    return products.filter(~F.col("discontinued"))


def outside(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def labelled_above(df: DataFrame, label: str, value: str, measure: str, bound: float) -> DataFrame:
    """Rows with a label and with a measure above a bound."""
    return df.filter(F.col(label) == value).filter(F.col(measure) > bound)


def in_list(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(column).isin(*values))
