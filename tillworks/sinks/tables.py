"""Batch sinks. No sink funnels its rows through one task; file counts follow the data."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Typed result tables of the daily ETL. Money has 18 digits, so that totals do not overflow.
RESULT_TABLES = {
    "daily_sales_summary": (
        "date date, total_orders int, total_revenue decimal(18,2), total_items_sold bigint,"
        " unique_customers int, unique_products int, avg_order_value decimal(18,2),"
        " avg_discount decimal(5,4), total_freight decimal(18,2), created_at timestamp"
    ),
    "daily_category_sales": (
        "date date, category_name string, revenue decimal(18,2), units_sold bigint,"
        " order_count int, avg_item_price decimal(18,2), created_at timestamp"
    ),
    "daily_country_sales": (
        "date date, country string, revenue decimal(18,2), order_count int,"
        " customer_count int, created_at timestamp"
    ),
}


def write_files(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    format: str = "parquet",
    mode: str = "overwrite",
    rows_per_file: int = 0,
    **options: str,
) -> None:
    """Write files. Rows of one output partition are brought together by a rebalance, which
    adaptive execution splits again where one partition is large."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(format).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.save(path)


def write_day(df: DataFrame, path: str, date: str, date_column: str = "date") -> None:
    """Store the result of one day. A rerun replaces that day and leaves the others alone."""
    (
        df.withColumn(date_column, F.lit(date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )


def typed(df: DataFrame, table: str) -> DataFrame:
    """Cast a result to the columns of its table; the load time is added here."""
    schema = df.sparkSession.createDataFrame([], RESULT_TABLES[table]).schema
    stamped = df.withColumn("created_at", F.current_timestamp())
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def create_result_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the typed result tables, partitioned by day."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, columns in RESULT_TABLES.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns})"
            " USING parquet PARTITIONED BY (date)"
        )


def load_result_table(df: DataFrame, database: str, table: str, date: str) -> None:
    """Insert the result of one day. A rerun replaces that day and leaves the others alone."""
    dated = df.withColumn("date", F.lit(date).cast("date"))
    rows = typed(dated, table).drop("date")
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {database}.{table} PARTITION (date = DATE '{date}')"
        f" SELECT {', '.join(rows.columns)} FROM {{rows}}",
        rows=rows,
    )


def layer_name(base: str, layer: str | None, production: bool = False) -> str:
    """Name of a layer: the layer alone in production, ``base_layer`` elsewhere."""
    if layer is None:
        return base
    layer = layer.strip()
    return layer if production else f"{base}_{layer}"


def publish_view(df: DataFrame, name: str) -> None:
    """A model that is computed when it is read."""
    df.createOrReplaceTempView(name)


def publish_table(
    df: DataFrame,
    name: str,
    database: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
) -> None:
    """A model that is stored. Tables bucketed alike on a key join on it without a shuffle."""
    if database:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(f"{database}.{name}" if database else name)


def keyed_records(df: DataFrame, key: str) -> DataFrame:
    """Rows as (key, value) with the whole row as JSON text."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def publish_records(records: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send keyed records to a topic; the broker keeps the order per key."""
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )


#: Records of one file of a topic: compressed lines are read from their start, one task a file.
RECORDS_PER_FILE = 500_000


def write_records(records: DataFrame, path: str, mode: str = "append") -> None:
    """Write the values as JSON lines, the file form of a topic. They repeat every field name, so
    they are compressed; readers tell that from the names of the files."""
    writer = records.select("value").write.mode(mode).option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.text(path, compression="lz4")


def keyed_partitions(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Rows hash-partitioned by a key. Joins and aggregates do this themselves; it is for
    writers and for code that works per partition."""
    return df.repartition(partitions, key) if partitions else df.repartition(key)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Records per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("records")
    )
