"""Where intermediate results are kept: one folder that all executors share."""

from pyspark.sql import DataFrame, SparkSession

from tillworks.session import shared_folder


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one in the warehouse, which on
    a cluster must not be a folder of one machine."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(spark))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared folder, without their lineage.

    Use it where a result is read more than once, or where computing it again could deal rows out
    differently (numbers given per task, for example).
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_bits(spark: SparkSession) -> int:
    """Buckets for data that travels packed, as a power of two: one for each shuffle partition,
    32 at least, so that a bucket is about a partition's share of the data."""
    return max(5, (shuffle_partitions(spark) - 1).bit_length())
