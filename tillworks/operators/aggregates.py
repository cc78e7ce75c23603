"""Aggregate forms shared by the jobs. All combine on the map side before any shuffle."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import scalars


def five_numbers(value: str, names: Sequence[str]) -> list[Column]:
    """Count, sum, mean, maximum and minimum of a column under the given names."""
    column = F.col(value)
    mean = scalars.exact_mean(column)
    forms = [F.count(column), F.sum(column), mean, F.max(column), F.min(column)]
    return [form.alias(name) for form, name in zip(forms, names, strict=True)]


def distinct_counts(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, str | Column]
) -> DataFrame:
    """Exact distinct counts per key."""
    return df.groupBy(*keys).agg(
        *[F.count_distinct(column).alias(name) for name, column in columns.items()]
    )


def by_dict(
    df: DataFrame, keys: Sequence[str], forms: Mapping[str, str], names: Mapping[str, str]
) -> DataFrame:
    """Aggregate in dict form, then rename Spark's output columns."""
    out = df.groupBy(*keys).agg(dict(forms))
    for old, new in names.items():
        out = out.withColumnRenamed(old, new)
    return out


def null_profile(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row: total rows, nulls per column and percent of filled cells, from one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(name) for c, name in columns.items()],
    )
    nulls = sum((F.col(name) for name in columns.values()), F.lit(0))
    return counted.withColumn(
        "completeness_pct",
        scalars.completeness(nulls, F.col("total_records"), len(columns)),
    )


def latest_date_and_age(df: DataFrame, column: str, as_of: str) -> DataFrame:
    """One row: the latest date and its age in days."""
    return df.agg(F.max(column).alias("latest")).withColumn(
        "days_old", scalars.age_days("latest", as_of)
    )


def side_by_side(rows: Sequence[DataFrame]) -> DataFrame:
    """One-row results with different columns as one row, without a join: stacked, and then
    the only value of each column is taken."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def merged_by(keys: Sequence[str], results: Sequence[DataFrame]) -> DataFrame:
    """Results with the same keys and different columns as one table, null keys included."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def value_set(df: DataFrame, column: str, name: str) -> DataFrame:
    """The distinct values of a column in order, one row each; null is no value."""
    return df.select(F.col(column).alias(name)).dropna().distinct().orderBy(name)
