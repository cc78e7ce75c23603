"""Histories, increments and mergeable counts."""

import random

import pytest
from pyspark.sql import functions as F

from tillworks.operators import distinct, snapshots
from tillworks.plans import incremental, marts, staging
from tillworks.sinks.versions import PART, VersionedTable
from tillworks.sources.tables import RetailTables

STATE = "id int, name string, n int, since string"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def state(spark, rows):
    return spark.createDataFrame([(i, name, n, None) for i, name, n in rows], STATE).drop("since")


def periods(df):
    rows = ((r.id, r.name, r.n, str(r.valid_from), str(r.valid_to) if r.valid_to else None) for r in df.collect())
    return sorted(rows, key=str)


def history_by_hand(states):
    """Periods from full states in order."""
    out, open_rows = [], {}
    for day, rows in states:
        rows = {i: (name, n) for i, name, n in rows}
        for i in list(open_rows):
            if rows.get(i) != open_rows[i][0]:
                values, since = open_rows.pop(i)
                if since != day:
                    out.append((i, *values, since, day))
        for i, values in rows.items():
            open_rows.setdefault(i, (values, day))
    out += [(i, *values, since, None) for i, (values, since) in open_rows.items()]
    return sorted(out, key=str)


def test_states_with_deletions_and_returns(spark, table):
    rng = random.Random(4)
    states = []
    for k in range(1, 5):
        rows = [(i, rng.choice(["a", "b", "", "c d"]), rng.randint(0, 1)) for i in range(60) if rng.random() < 0.7]
        states.append((f"2024-01-0{k}", rows))
    for k, (day, rows) in enumerate(states, 1):
        assert snapshots.record_state(table, state(spark, rows), "id", day, buckets=4) == k
        assert snapshots.record_state(table, state(spark, rows), "id", day, buckets=4) == k  # a rerun
        assert periods(table.read()) == history_by_hand(states[:k])
    day, rows = states[2]
    assert sorted((r.id, r.name, r.n) for r in snapshots.valid_at(table.read(), day).collect()) == sorted(rows)
    with pytest.raises(ValueError):
        snapshots.record_state(table, state(spark, rows), "id", day)


def test_a_corrected_state_replaces_that_of_its_day(spark, table):
    snapshots.record_state(table, state(spark, [(1, "a", 0), (2, "x", 0)]), "id", "2024-01-01")
    snapshots.record_state(table, state(spark, [(1, "wrong", 0), (3, "wrong", 0)]), "id", "2024-01-02")
    snapshots.record_state(table, state(spark, [(1, "right", 0), (2, "x", 0)]), "id", "2024-01-02")
    assert periods(table.read()) == [
        (1, "a", 0, "2024-01-01", "2024-01-02"),
        (1, "right", 0, "2024-01-02", None),
        (2, "x", 0, "2024-01-01", None),
    ]


def test_late_rows_go_where_they_belong(spark, table):
    def record(*rows):
        df = spark.createDataFrame(rows, STATE).withColumn("since", F.col("since").cast("date"))
        return snapshots.record_state(table, df, "id", "2024-02-01", changed_at="since", full=False, buckets=4)

    record((1, "a", 0, "2024-01-01"), (1, "c", 0, "2024-01-09"), (2, "z", 0, "2024-01-05"))
    record((1, "b", 0, "2024-01-04"), (2, "y", 0, "2024-01-02"), (2, "y", 0, "2024-01-02"))
    want = [
        (1, "a", 0, "2024-01-01", "2024-01-04"),
        (1, "b", 0, "2024-01-04", "2024-01-09"),
        (1, "c", 0, "2024-01-09", None),
        (2, "y", 0, "2024-01-02", "2024-01-05"),
        (2, "z", 0, "2024-01-05", None),
    ]
    assert periods(table.read()) == want
    version = table.versions()[-1]
    assert record((1, "b", 0, "2024-01-04")) == version  # known already
    assert record((1, "a", 0, "2024-01-02")) == version  # says what holds then
    assert periods(table.read()) == want


def test_only_touched_buckets_are_written(spark, table):
    rows = [(i, "same", 0) for i in range(200)]
    snapshots.record_state(table, state(spark, rows), "id", "2024-01-01", buckets=8)
    before = table.manifest()["parts"]
    rows[17] = (17, "changed", 0)
    snapshots.record_state(table, state(spark, rows), "id", "2024-01-02", buckets=8)
    after = table.manifest()["parts"]
    assert len([p for p in before if before[p] != after[p]]) == 1
    assert sum(p.startswith("closed-") for p in after) == 1


def test_odd_states(spark, table):
    nothing = state(spark, [])
    assert snapshots.record_state(table, nothing, "id", "2024-01-01") == 0 and table.read() is None
    rows = [(None, "no key", 0), (1, None, None), (1, None, None), (2, "", 0), (3, "x" * 100_000, 0)]
    snapshots.record_state(table, state(spark, rows), "id", "2024-01-02")
    snapshots.record_state(table, state(spark, [(1, "", None), (2, None, 0), (3, "x" * 100_000, 0)]), "id", "2024-01-03")
    assert [(r[0], r[1] and r[1][:1], r[4]) for r in periods(table.read())] == [
        (1, "", None), (1, None, "2024-01-03"), (2, "", "2024-01-03"), (2, None, None), (3, "x", None)
    ]
    snapshots.record_state(table, nothing, "id", "2024-01-04")
    assert all(p[4] for p in periods(table.read()))


def test_readers_never_see_half_a_version(spark, table, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, part string")
    assert table.publish(rows, ["a", "b"], "m1") == 1
    old = table.read()
    other = spark.createDataFrame([(3, "a")], "k int, part string")
    monkeypatch.setattr(table, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.publish(other, ["a"], "m2")
    monkeypatch.undo()
    assert sorted(r.k for r in table.read().collect()) == [1, 2] and table.manifest()["mark"] == "m1"
    stale = VersionedTable(spark, table.folder)
    assert table.publish(other, ["a"], "m2") == 2
    monkeypatch.setattr(stale, "manifest", lambda version=None: {"version": 1, "mark": "m1", "schema": None, "parts": {}})
    with pytest.raises(RuntimeError):
        stale.publish(other, ["a"], "m3")
    assert sorted(r.k for r in old.collect()) == [1, 2]  # planned before, still readable
    assert sorted(r.k for r in table.read().collect()) == [2, 3]
    assert sorted(r.k for r in table.read(version=1).collect()) == [1, 2]
    assert table.publish(other.limit(0), ["a"]) == 3 and [r.k for r in table.read().collect()] == [2]
    table.remove_unused(1)
    assert table.versions() == [3] and [r.k for r in table.read().collect()] == [2]


@pytest.fixture(scope="module")
def retail(spark, sf_dir):
    return RetailTables(spark, sf_dir)


def same(one, two):
    key = lambda r: tuple(str(v) for v in r)
    names = sorted(one.columns)
    assert names == sorted(two.columns)
    assert sorted(map(key, one.select(names).collect())) == sorted(map(key, two.select(names).collect()))


def test_increments_equal_the_full_run_at_every_mark(retail, tmp_path):
    spark, t = retail.spark, retail
    tables = [VersionedTable(spark, str(tmp_path / n)) for n in ("days", "products", "customers")]
    products = staging.stg_products(t.products, t.categories, t.suppliers)
    for mark in ("1998-05-31", "1998-06-20", "2002-12-31"):
        incremental.refresh_order_performance(tables[0], t.orders, t.order_details, mark)
        incremental.refresh_product_metrics(tables[1], products, t.order_details, t.orders, t.customers, mark)
        incremental.refresh_customer_metrics(tables[2], t.customers, t.orders, t.order_details, "2003-01-01", mark)
        known = incremental.orders_known(t.orders, mark)
        lines = t.order_details.join(known.select("order_id"), "order_id", "left_semi")
        orders, details = staging.stg_orders(known), staging.stg_order_details(lines)
        full = marts.fct_order_performance(orders, details)
        same(tables[0].read(), full.withColumn("date", F.col("date").cast("date")))
        same(tables[1].read(), marts.product_metrics(products, details, orders, staging.stg_customers(t.customers)))
        same(tables[2].read(), marts.dim_customer_metrics(staging.stg_customers(t.customers), orders, lines, "2003-01-01"))
    versions = [table.versions() for table in tables]
    incremental.refresh_order_performance(tables[0], t.orders, t.order_details, "2002-12-31")
    assert [table.versions() for table in tables] == versions  # the mark was reached before


def test_a_refresh_leaves_other_parts_alone(retail, tmp_path):
    table, t = VersionedTable(retail.spark, str(tmp_path / "days")), retail
    incremental.refresh_order_performance(table, t.orders, t.order_details, "1999-06-30")
    before = table.manifest()["parts"]
    incremental.refresh_order_performance(table, t.orders, t.order_details, "1999-07-02")
    after = table.manifest()["parts"]
    changed = {p for p in after if before.get(p) != after[p]}
    assert changed <= {"1999-06", "1999-07"} and "1999-07" in changed and len(before) > 20
    assert len(table.read(["1999-07"]).inputFiles()) < len(table.read().inputFiles())


def test_stored_months_are_pruned(retail, tmp_path):
    path = str(tmp_path / "orders")
    month = incremental.month_part(F.col("order_date")).alias("order_month")
    retail.orders.select("*", month).write.partitionBy("order_month").parquet(path)
    stored = retail.spark.read.parquet(path)
    plan = stored.where(F.col("order_month").isin(["1999-06"]))
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "order_month" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_bitmaps_count_and_merge(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["2024-01-01", "2024-01-31", "2024-02-01", None]), rng.choice([None, 0, 7, 32767, 32768, 100_000, rng.randint(0, 10**6)]))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "day string, id bigint").withColumn("day", F.col("day").cast("date"))
    days = distinct.id_bitmaps(df, ["day"], "id")
    got = {(r.grain, str(r.period)): r.n for r in distinct.distinct_by_period(days, "day", ["day", "month"], "n").collect()}
    want = {}
    for day, i in rows:
        if i is not None:
            want.setdefault(("day", str(day)), set()).add(i)
            want.setdefault(("month", day[:7] + "-01" if day else "None"), set()).add(i)
    assert got == {k: len(v) for k, v in want.items()}
    assert distinct.distinct_counts(distinct.id_bitmaps(df.limit(0), ["day"], "id"), ["day"], "n").count() == 0


def test_merging_reads_bitmaps_and_shuffles_bitmaps(retail, tmp_path):
    path = str(tmp_path / "bitmaps")
    days = distinct.id_bitmaps(retail.orders, ["order_date"], "customer_id")
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bitmap_construct_agg" in plan
    days.write.parquet(path)
    merged = distinct.distinct_by_period(retail.spark.read.parquet(path), "order_date", ["year"], "n")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "bitmap_or_agg" in plan
