"""Exact distinct counts that can be merged: bitmaps of ids instead of counts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "id_bucket", "ids"


def id_bitmaps(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key and range of 32,768 ids, a bitmap of the ids that occur.

    ``value`` is a whole number from 0 on, dense enough that a bitmap of 4 KB is worth its range;
    nulls are not counted. Each task sets bits before the shuffle, so that a bitmap per key, range
    and task travels, however many rows there are.
    """
    ids = F.col(f"`{value}`")
    return (
        df.where(ids.isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(ids).alias(BUCKET))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias(BITMAP))
    )


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Bitmaps of coarser keys from stored ones: months from days, without the rows."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many different ids the bitmaps of each key hold."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count(BITMAP)).alias(name))


def distinct_by_period(bitmaps: DataFrame, day: str, units: Sequence[str], name: str) -> DataFrame:
    """``grain, period, name``: distinct ids per day and per longer unit, from daily bitmaps.

    Each unit merges the daily bitmaps anew; what is counted are bitmaps, never the rows again.
    """
    out = None
    for unit in units:
        period = F.date_trunc(unit, F.col(f"`{day}`")).cast("date").alias("period")
        merged = merged_bitmaps(bitmaps, [period])
        counts = distinct_counts(merged, ["period"], name).select(F.lit(unit).alias("grain"), "period", name)
        out = counts if out is None else out.unionByName(counts)
    return out
