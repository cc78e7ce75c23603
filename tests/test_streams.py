"""Streams over files: same figures as a batch, nothing twice after a restart, bad lines apart."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from registry import feeds
from tillworks.sinks import tables as sinks
from tillworks.sources.tables import RetailTables
from tillworks.streaming import events as ev
from tillworks.streaming import metrics, topics

TALLIES = {
    "types": (metrics.tally_types, ["event_type"]),
    "orders": (metrics.tally_orders, []),
    "countries": (metrics.tally_countries, ["country"]),
    "products": (metrics.tally_products, ["product_id", "product_name"]),
    "customers": (metrics.tally_customers, ["customer_id", "customer_name"]),
}
FEEDS = {
    "high_value": metrics.high_value_orders,
    "stock": metrics.stock_cancellations,
    "payments": metrics.unconfirmed_payments,
    "shipments": metrics.shipment_feed,
    "routed": lambda e: metrics.routed(e).select("order_id", "route"),
}


def rows(df):
    names = sorted(df.columns)
    return sorted(map(str, (tuple(r) for r in df.select(*names).collect())))


@pytest.fixture(scope="module")
def topic(spark, sf_dir, tmp_path_factory):
    """Three files of order events, the last with broken lines."""
    folder = str(tmp_path_factory.mktemp("topic"))
    events = feeds.order_events(RetailTables(spark, sf_dir))
    records = sinks.keyed_records(events, "order_id")
    parts = records.withColumn("part", F.crc32("key") % 3)
    for i in range(2):
        sinks.write_records(parts.filter(F.col("part") == i).coalesce(1), folder)
    return folder, parts.filter(F.col("part") == 2), records


def test_tallies_feeds_and_restart(spark, topic, tmp_path):
    folder, third, records = topic
    tallied, marks = str(tmp_path / "tally"), str(tmp_path / "marks")
    fed, feed_marks = str(tmp_path / "feeds"), str(tmp_path / "feed-marks")

    def run():
        source = topics.file_topic(spark, folder, "order_id", per_trigger=1)
        queries = [
            topics.start_tallies(
                source, ev.ORDER_EVENT, {n: t for n, (t, _) in TALLIES.items()}, tallied, marks
            ),
            topics.start_feeds(source, ev.ORDER_EVENT, FEEDS, fed, feed_marks),
        ]
        for query in queries:
            query.awaitTermination()
            assert query.exception() is None
        return queries

    run()
    broken = spark.createDataFrame([("x", "{not json"), ("y", ""), ("z", '{"order_id": "a"}')],
                                   "key string, value string")
    sinks.write_records(third.drop("part").union(broken).coalesce(1), folder)
    last = run()  # a restart goes on from the checkpoint
    run()  # nothing new: nothing may change
    assert topics.processing_rate(last[0]) > 0

    events = ev.readable(ev.decode(records, ev.ORDER_EVENT))
    for name, (tally, keys) in TALLIES.items():
        merged = topics.merged_tally(spark, tallied, name, keys)
        assert rows(merged) == rows(tally(events)), name
    for name, feed in FEEDS.items():
        assert rows(topics.feed(spark, fed, name)) == rows(feed(events)), name
    dead = topics.feed(spark, fed, "dead_letters")
    assert sorted(r.value for r in dead.collect()) == ["", '{"order_id": "a"}', "{not json"]
    assert topics.merged_tally(spark, tallied, "errors", []).first().errors == 3

    for _ in range(2):  # merging what is merged changes nothing
        assert topics.compact_tally(spark, tallied, "countries", ["country"]) == 2
        assert topics.compact_feed(spark, fed, "routed") == 2
        merged = topics.merged_tally(spark, tallied, "countries", ["country"])
        assert rows(merged) == rows(metrics.tally_countries(events))
        assert rows(topics.feed(spark, fed, "routed")) == rows(FEEDS["routed"](events))
    # Merged batches are gone, and nothing is read from them.
    assert topics._numbered(spark, f"{tallied}/countries", "batch_id") == {}
    assert list(topics._numbered(spark, f"{tallied}/countries.merged", "up_to")) == [2]
    more = feeds.order_events(RetailTables(spark, "/root/testdata/sf0.001")).limit(100)
    sinks.write_records(sinks.keyed_records(more, "order_id"), folder)
    run()
    again = topics.merged_tally(spark, tallied, "countries", ["country"])
    both = metrics.tally_countries(events.drop("key").unionByName(more))
    assert rows(again) == rows(both)
    # A merge that breaks off leaves a folder without its mark: it does not count.
    broken = f"{tallied}/countries.merged/up_to=99"
    spark.range(3).write.parquet(broken)
    (Path(broken) / "_SUCCESS").unlink()
    assert rows(topics.merged_tally(spark, tallied, "countries", ["country"])) == rows(both)
    last = topics.compact_tally(spark, tallied, "countries", ["country"])
    assert last > 2
    assert rows(topics.merged_tally(spark, tallied, "countries", ["country"])) == rows(both)


def test_replayed_batch_replaces_its_counts(spark, topic, tmp_path):
    folder, _, _ = topic
    out = str(tmp_path / "out")
    for attempt in ("a", "b"):  # the second run has lost its checkpoint and starts over
        source = topics.file_topic(spark, folder, "order_id")
        topics.start_tallies(
            source, ev.ORDER_EVENT, {"types": metrics.tally_types}, out, str(tmp_path / attempt)
        ).awaitTermination()
    batch = ev.readable(ev.decode(topics.file_batch(spark, folder, "order_id"), ev.ORDER_EVENT))
    assert rows(topics.merged_tally(spark, out, "types", ["event_type"])) == rows(
        metrics.tally_types(batch)
    )


def test_state_tally(spark, topic, tmp_path):
    folder, _, _ = topic
    decoded = ev.readable(
        ev.decode(topics.file_topic(spark, folder, "order_id", per_trigger=1), ev.ORDER_EVENT)
    )
    out = str(tmp_path / "state")
    query = topics.start_state_tally(decoded, metrics.tally_types, out, str(tmp_path / "marks"))
    query.awaitTermination()
    batch = ev.readable(ev.decode(topics.file_batch(spark, folder, "order_id"), ev.ORDER_EVENT))
    assert rows(topics.latest_state(spark, out)) == rows(metrics.tally_types(batch))


def test_run_for_and_listener(spark, topic, tmp_path):
    folder, _, _ = topic
    out = str(tmp_path / "tally")
    monitor = topics.LagMonitor()
    spark.streams.addListener(monitor)
    try:
        query = topics.start_tallies(
            topics.file_topic(spark, folder, "order_id"),
            ev.ORDER_EVENT,
            {"types": metrics.tally_types},
            out,
            str(tmp_path / "marks"),
            trigger={"processingTime": "1 second"},
        )
        query.processAllAvailable()
        report = topics.run_for(
            query, 1, lambda: topics.merged_tally(spark, out, "types", ["event_type"])
        )
        assert not query.isActive and report.count() == 4
        assert monitor.progress[str(query.id)]["offsets"]
        assert monitor.progress[str(query.id)]["lag"] == 0
    finally:
        spark.streams.removeListener(monitor)


def test_bounded_reads(spark, topic):
    folder, _, _ = topic
    records = topics.file_batch(spark, folder, "order_id")
    assert topics.sample(records, 20).count() == 20
    events = ev.readable(ev.decode(topics.sample(records, 20), ev.ORDER_EVENT))
    report = metrics.flow_report(events).first()
    assert report.messages == 20 and report.flowing
    assert metrics.flow_report(events.limit(0)).first().flowing is False


def test_lag():
    assert topics.lag('{"t":{"0":5,"1":7}}', '{"t":{"0":9,"1":7,"2":4}}') == 8
    assert topics.lag('{"logOffset":2}', '{"logOffset":2}') == 0
    assert topics.lag(None, '{"t":{"0":3}}') == 3 and topics.lag('{"t":{"0":3}}', "null") == 0


def test_alerts_on_literal_events(spark):
    """Reasons and payment states, which no given table holds."""
    lines = [
        '{"event_id":"a","order_id":1,"event_type":"order_cancelled","cancellation_reason":"Out of stock"}',
        '{"event_id":"b","order_id":2,"event_type":"order_cancelled","cancellation_reason":"Other"}',
        '{"event_id":"c","order_id":3,"event_type":"payment_confirmed","payment_status":"pending"}',
        '{"event_id":"d","order_id":4,"event_type":"payment_confirmed","payment_status":"confirmed"}',
        '{"event_id":"e","order_id":5,"event_type":"order_cancelled"}',
    ]
    records = spark.createDataFrame([("k", x) for x in lines], "key string, value string")
    events = ev.readable(ev.decode(records, ev.ORDER_EVENT))
    assert [r.event_id for r in metrics.stock_cancellations(events).collect()] == ["a"]
    assert [r.event_id for r in metrics.unconfirmed_payments(events).collect()] == ["c"]
    assert metrics.tally_orders(events).first().cancelled_orders == 3


def test_deduplication_is_optional(spark, tmp_path):
    folder = str(tmp_path / "in")
    lines = ['{"event_id":"e1","user_id":1,"event_type":"signup","timestamp":"2024-01-01 00:00:00"}'] * 3
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(folder)
    decoded = ev.readable(ev.decode(topics.file_topic(spark, folder, "user_id"), ev.USER_EVENT))
    timed = decoded.withColumn("event_time", F.col("timestamp").cast("timestamp"))
    for stream, want in ((timed, 3), (topics.deduplicated(timed, "10 minutes"), 1)):
        out = str(tmp_path / f"out{want}")
        stream.writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / f"marks{want}")
        ).trigger(availableNow=True).start(out).awaitTermination()
        assert spark.read.parquet(out).count() == want


def test_defaults_of_sparse_events(spark):
    lines = [
        '{"order_id":1,"event_type":"new_order"}',
        '{"order_id":2,"event_type":"payment_confirmed"}',
        '{"order_id":3}',
        '{"order_id":4,"event_type":"new_order","order_total":1000.00,"customer_country":"UK",'
        '"order_items":[{"product_id":1,"product_name":"a"}]}',
        '{"order_id":5,"event_type":"new_order","order_total":1000.01}',
    ]
    records = spark.createDataFrame([("k", x) for x in lines], "key string, value string")
    events = ev.readable(ev.decode(records, ev.ORDER_EVENT))
    report = metrics.order_report(metrics.tally_orders(events)).first()
    assert (report.total_events, report.total_orders, report.high_value_orders) == (5, 3, 1)
    assert float(report.total_revenue) == 2000.01 and report.units_ordered == 0
    assert {r.country: r.orders for r in metrics.tally_countries(events).collect()} == {
        "Unknown": 2, "UK": 1}
    assert [r.units for r in metrics.tally_products(events).collect()] == [0]
    assert [r.order_id for r in metrics.unconfirmed_payments(events).collect()] == [2]
    assert {r.order_id: r.route for r in metrics.routed(events).collect()}[3] == "unknown"
    none = metrics.order_report(metrics.tally_orders(events.limit(0))).first()
    assert (none.total_orders, none.average_order_value) == (0, 0.0)
