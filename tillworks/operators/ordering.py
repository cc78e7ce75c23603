"""Report order, limits and firsts. Every order ends in a unique key, so that ties are settled."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_measure(df: DataFrame, measure: str, *tie: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), *tie)


def by_keys_then_measure(df: DataFrame, keys: Sequence[str], measure: str, *tie: str) -> DataFrame:
    return df.orderBy(*keys, F.col(measure).desc(), *tie)


def by_measure_nulls_last(df: DataFrame, measure: str, *tie: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc_nulls_last(), *tie)


def latest(df: DataFrame, date: str, key: str, rows: int) -> DataFrame:
    """The latest rows: a top-k, so no task sorts the whole table."""
    return df.orderBy(F.col(date).desc(), F.col(key).desc()).limit(rows)


def top(df: DataFrame, measure: str, rows: int, *tie: str) -> DataFrame:
    return by_measure(df, measure, *tie).limit(rows)


def first_by(label: str, measure: str, name: str) -> Column:
    """Aggregate: the label with the highest measure; equal measures go to the higher label."""
    return F.max_by(F.col(label), F.struct(measure, label)).alias(name)
