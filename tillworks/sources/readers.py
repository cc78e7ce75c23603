"""Batch sources: literal rows, raw-zone paths and database tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A few rows under a declared schema (dimension literals, test rows)."""
    return spark.createDataFrame(list(rows), schema)


def inferred_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A few rows with names only; Spark infers the types."""
    return spark.createDataFrame(list(rows), list(names))


def raw_zone(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    format: str = "parquet",
    **options: str,
) -> DataFrame:
    """Files under a path. A declared schema spares the inference pass over the files."""
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def database_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str | int,
    upper: str | int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table, read by ``partitions`` tasks that each take one range of a column.

    ``lower`` and ``upper`` only set the stride; rows outside them are read as well.
    SQL text goes in as ``table="(select ...) t"``. The driver jar must be on the class path.
    """
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )
