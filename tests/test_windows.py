"""The spread windows must equal Spark's own windows, whatever the partition edges cut."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillworks.operators import windows as w

SCHEMA = "id long, g string, d int, x decimal(12,2)"


def _rows(shape, n, seed):
    rng = random.Random(seed)
    for i in range(n):
        if shape == "hot_group":
            g = "hot" if i % 3 else f"g{rng.randrange(20)}"
            d = rng.randrange(12)
        elif shape == "hot_peers":
            g, d = ("hot", 5) if i % 3 else (f"g{rng.randrange(4)}", rng.randrange(6))
        elif shape == "one_value":
            g, d = "only", 1
        elif shape == "nulls":
            g = rng.choice([None, "a", "b"])
            d = rng.choice([None, 1, 2, 3])
        else:
            g, d = f"g{rng.randrange(60)}", rng.randrange(1000)
        x = None if shape == "nulls" and rng.random() < 0.4 else round(rng.random() * 100, 2)
        yield (i, g, d, None if x is None else Decimal(str(x)))


@pytest.mark.parametrize(
    "shape,partitions",
    [("plain", 1), ("plain", 6), ("hot_group", 6), ("hot_peers", 13), ("one_value", 6), ("nulls", 5)],
)
def test_equals_plain_windows(spark, shape, partitions):
    df = spark.createDataFrame(list(_rows(shape, 300, 7)), SCHEMA).repartition(4)
    got = w.spread_window(
        df,
        ["g"],
        w.ascending("d"),
        ["id"],
        {
            "row_number": w.ROW_NUMBER,
            "rnk": w.RANK,
            "dense": w.DENSE_RANK,
            "total": w.RUNNING_TOTAL,
            "before": w.LAG,
            "after": w.LEAD,
        },
        value="x",
        partitions=partitions,
    )
    peers = Window.partitionBy("g").orderBy("d")
    rows = Window.partitionBy("g").orderBy("d", "id")
    want = df.select(
        "*",
        F.row_number().over(rows).cast("long").alias("row_number"),
        F.rank().over(peers).cast("long").alias("rnk"),
        F.dense_rank().over(peers).cast("long").alias("dense"),
        F.sum("x").over(peers).alias("total"),
        F.lag("x").over(rows).alias("before"),
        F.lead("x").over(rows).alias("after"),
    )
    assert {r.id: tuple(r) for r in got.collect()} == {r.id: tuple(r) for r in want.collect()}


@pytest.mark.parametrize("n,partitions", [(1, 1), (3, 6), (4, 6), (10, 1), (103, 6)])
def test_global_rank_and_ntile(spark, n, partitions):
    df = spark.createDataFrame(list(_rows("plain", n, 3)), SCHEMA)
    got = w.global_rank(
        df, w.descending("x"), ["id"], rank="pos", tile="tile", partitions=partitions
    )
    order = Window.orderBy(F.col("x").desc(), "id")
    want = df.select(
        "*",
        F.row_number().over(order).cast("long").alias("pos"),
        F.ntile(4).over(order).alias("tile"),
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_descending_puts_nulls_last(spark):
    rows = [(1, "a", 1, None), (2, "a", 1, 5), (3, "a", 1, 9)]
    df = spark.createDataFrame(rows, "id long, g string, d int, x int")
    got = w.global_rank(df, w.descending("x"), ["id"], rank="pos", partitions=3)
    assert {r["id"]: r["pos"] for r in got.collect()} == {3: 1, 2: 2, 1: 3}


def test_no_task_holds_a_hot_group(spark):
    """With one group for all rows, every partition still gets its share."""
    df = spark.range(20000).select("id", F.lit("hot").alias("g"), (F.col("id") % 5).alias("d"))
    keys = [F.col("g"), *w.ascending("d"), F.col("id")]
    bounds = w._bounds(df, keys, ["id"], 8)
    place = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    parts = df.withColumn("part", w._part(place, bounds))
    sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20000 / 8 * 1.5
    # The same rows give the same bounds, however they are dealt.
    again = w._bounds(df.repartition(5), keys, ["id"], 8)
    same = df.withColumn("one", w._part(place, bounds)).withColumn("two", w._part(place, again))
    assert same.where("one <> two").count() == 0
    got = w.spread_window(
        df, ["g"], w.ascending("d"), ["id"], {"rnk": w.RANK, "n": w.ROW_NUMBER}, partitions=8
    )
    assert got.agg(F.max("n"), F.max("rnk"), F.count_distinct("n")).first() == (20000, 16001, 20000)
