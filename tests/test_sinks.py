"""Write, read back, and write again."""

import pytest
from pyspark.sql import functions as F

from tillworks import session
from tillworks.plans import jobs
from tillworks.sinks import tables as sinks
from tillworks.sources.tables import RetailTables


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    return RetailTables(spark, sf_dir)


def test_partitioned_write_prunes(spark, tmp_path):
    df = spark.range(100).withColumn("year", (F.col("id") % 3 + 2020).cast("int"))
    path = str(tmp_path / "p")
    sinks.write_files(df, path, partition_by=["year"], rows_per_file=10)
    one = spark.read.parquet(path).filter("year = 2021")
    assert one.count() == 33 and len(one.inputFiles()) >= 4
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().toString()


def test_dated_write_replaces_only_its_day(spark, tmp_path):
    path = str(tmp_path / "daily")
    for day, rows in (("2024-01-01", 3), ("2024-01-02", 5), ("2024-01-01", 7)):
        sinks.write_day(spark.range(rows), path, day)
    got = spark.read.parquet(path).groupBy("date").count().collect()
    assert {str(r["date"]): r["count"] for r in got} == {"2024-01-01": 7, "2024-01-02": 5}


def test_result_tables_are_typed_and_rerunnable(spark, t, tmp_path):
    sinks.create_result_tables(spark, "ana", str(tmp_path / "ana"))
    sinks.create_result_tables(spark, "ana", str(tmp_path / "ana"))
    for as_of in ("2001-08-01", "2001-08-02", "2001-08-02"):
        orders = jobs.orders_to_process(t.orders, as_of)
        details = t.order_details.join(orders.select("order_id"), "order_id", "left_semi")
        results = {
            "daily_sales_summary": jobs.daily_sales_summary(orders, details, as_of),
            "daily_category_sales": jobs.sales_by_category_summary(
                details, t.products, t.categories
            ),
            "daily_country_sales": jobs.sales_by_country(orders, details, t.customers),
        }
        for name, result in results.items():
            sinks.load_result_table(result, "ana", name, as_of)
    summary = spark.table("ana.daily_sales_summary")
    assert summary.count() == 2
    types = dict(summary.dtypes)
    assert types["total_revenue"] == "decimal(18,2)" and types["avg_discount"] == "decimal(5,4)"
    assert summary.filter("created_at is null").count() == 0
    category = spark.table("ana.daily_category_sales")
    assert category.groupBy("date", "category_name").count().filter("count > 1").count() == 0
    assert spark.table("ana.daily_country_sales").count() > 0


def test_layers_views_and_tables(spark, tmp_path):
    assert sinks.layer_name("analytics", None) == "analytics"
    assert sinks.layer_name("analytics", " marts ") == "analytics_marts"
    assert sinks.layer_name("analytics", "marts", production=True) == "marts"
    sinks.publish_view(spark.range(3), "three")
    assert spark.table("three").count() == 3
    spark.sql(f"CREATE DATABASE analytics_marts LOCATION '{tmp_path}/marts'")
    for rows in (3, 4):
        sinks.publish_table(spark.range(rows), "numbers", "analytics_marts")
    assert spark.table("analytics_marts.numbers").count() == 4


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE b LOCATION '{tmp_path}/b'")
    for name in ("one", "two"):
        sinks.publish_table(spark.range(1000).withColumn(name, F.col("id")), name, "b",
                            bucket_by="id", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b.one").join(spark.table("b.two"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_records_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    records = sinks.keyed_records(df, "id")
    assert sorted(map(tuple, records.collect())) == [("1", '{"id":1,"name":"a"}'), ("2", '{"id":2}')]
    sinks.write_records(records, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 2
    sizes = sinks.partition_sizes(sinks.keyed_partitions(spark.range(100), "id", 4))
    assert sizes.agg(F.sum("records")).first()[0] == 100 and sizes.count() <= 4


def test_records_of_a_topic_are_compressed(spark, tmp_path):
    from tillworks.streaming import topics

    rows = spark.range(0, 20000, 1, 2).select(
        F.col("id").alias("order_id"), F.lit("new_order").alias("event_type"), F.sha2(F.col("id").cast("string"), 256).alias("customer_name")
    )
    records, folder = sinks.keyed_records(rows, "order_id"), tmp_path / "topic"
    sinks.write_records(records, str(folder))
    text = records.agg(F.sum(F.length("value"))).first()[0]
    assert sum(f.stat().st_size for f in folder.glob("part-*")) < 0.75 * text
    again = topics.file_batch(spark, str(folder), "order_id")
    assert again.exceptAll(records).count() == 0 and again.count() == 20000


def test_catalog_views(spark, t):
    names = t.register_views("v_")
    assert "v_user_events" in names and "v_orders" in names
    assert spark.sql("SELECT count(*) AS n FROM v_orders").first().n == t.orders.count()


def test_shared_folder_is_the_configured_one_or_in_the_warehouse(spark):
    assert "checkpoints" in session.shared_folder(spark)
    plain = spark.newSession()
    plain.conf.set("spark.checkpoint.dir", "") if plain.conf.isModifiable("spark.checkpoint.dir") else None
    assert not session.shared_folder(plain).startswith("/tmp/tillworks")


def test_the_partition_report(spark):
    from tillworks.sinks import tables as sinks

    lines = spark.range(10_000).selectExpr("id % 700 AS order_id")
    placed = sinks.keyed_partitions(lines, "order_id", 8)
    report = {r.partition_id: r.records for r in sinks.partition_sizes(placed).collect()}
    by_hand = [len(part) for part in placed.rdd.glom().collect()]
    assert report == {k: n for k, n in enumerate(by_hand) if n}
    assert sum(report.values()) == 10_000 and max(report.values()) < 5_000
    assert sinks.partition_sizes(placed.limit(0)).count() == 0
