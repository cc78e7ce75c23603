"""Places in a sorted order, counted by many tasks."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.storage import shuffle_partitions, stored


def numbered(rows: DataFrame, order: Sequence[Column], groups: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``place`` (from 0, in its group), ``first`` (the place of its group's first
    row among all rows) and ``n`` (rows of its group).

    Rows are sorted by ``groups`` and ``order`` over ranges of both, so that a large group covers
    several tasks; each task counts its own, and one row per task and group carries what stands
    before. Nulls come first and form a group of their own; the places of rows that tie in
    ``order`` are arbitrary. The numbered rows are kept in the shared folder before they are
    counted, so a task that runs again numbers nothing anew. ``rows`` is read twice (its ranges
    are drawn first), and should be stored where it is dear. It must not have columns named
    ``place``, ``first``, ``n``, ``_part`` or ``_at``.
    """
    keys = [F.col(f"`{g}`") for g in groups]
    parts = max(1, shuffle_partitions(rows.sparkSession))
    ranged = rows.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    placed = stored(
        ranged.withColumn("_part", F.spark_partition_id()).withColumn(
            "_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        )
    )
    counts = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_low"))
    # One row per task of the sort.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        counts.groupBy("_part")
        .agg(F.sum("_rows").alias("_total"))
        .select(F.col("_part").alias("_of"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    )
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    carried = counts.join(bases, F.col("_part") == F.col("_of")).select(
        *[F.col(f"`{g}`").alias(f"_group_{i}") for i, g in enumerate(groups)],
        "_of",
        "_base",
        F.min(F.col("_base") + F.col("_low")).over(group).alias("first"),
        F.sum("_rows").over(group).alias("n"),
    )
    same = F.col("_part") == F.col("_of")
    for i, key in enumerate(keys):
        same &= key.eqNullSafe(F.col(f"_group_{i}"))
    place = (F.col("_base") + F.col("_at") - F.col("first")).alias("place")
    return placed.join(carried, same).select(
        *[F.col(f"`{c}`") for c in rows.columns], place, "first", "n"
    )
