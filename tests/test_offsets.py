"""Topics with record offsets: reads, polls of exact size, restarts, committed offsets and lag."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from tillworks.streaming import offsets


def records(spark, low, high, files=3):
    value = F.concat(F.lit('{"n": '), F.col("id").cast("string"), F.lit("}"))
    return spark.range(low, high, 1, files).select(F.col("id").cast("string").alias("key"), value.alias("value"))


def keys(df):
    return sorted(int(r.key) for r in df.collect())


@pytest.fixture
def topic(spark, tmp_path):
    folder = str(tmp_path / "topic")
    assert offsets.append(records(spark, 0, 250), folder) == 0
    return folder


def poll(spark, folder, marks, limit=100, starting=offsets.EARLIEST):
    """Read to the end in polls; what each one held."""
    got = []
    source = offsets.stream(spark, folder, starting, limit)
    running = (
        source.writeStream.foreachBatch(lambda batch, number: got.append((number, [r.offset for r in batch.collect()])))
        .option("checkpointLocation", marks)
        .trigger(processingTime="0 seconds")
        .start()
    )
    running.processAllAvailable()
    running.stop()
    return [(number, sorted(found)) for number, found in got]


def test_bounded_reads_from_any_offset(spark, topic):
    everything = offsets.read(spark, topic)
    assert keys(everything) == list(range(250))
    assert [r.offset for r in everything.orderBy("offset").collect()] == list(range(250))
    assert [int(r.key) for r in everything.orderBy("offset").collect()] == list(range(250))
    assert keys(offsets.read(spark, topic, limit=100)) == list(range(100))
    assert keys(offsets.read(spark, topic, offsets.LATEST)) == []
    mark = offsets.latest(topic)
    assert json.loads(mark)["offset"] == 250
    assert offsets.append(records(spark, 1000, 1050), topic) == 1
    assert keys(offsets.read(spark, topic, mark)) == list(range(1000, 1050))
    assert keys(offsets.read(spark, topic, mark, limit=7)) == list(range(1000, 1007))
    assert len(keys(offsets.read(spark, topic, limit=275))) == 275


def test_polls_hold_exactly_their_limit_across_restarts(spark, topic, tmp_path):
    marks = str(tmp_path / "marks")
    first = poll(spark, topic, marks)
    assert first == [(0, list(range(100))), (1, list(range(100, 200))), (2, list(range(200, 250)))]
    offsets.append(records(spark, 0, 130), topic)
    offsets.append(records(spark, 0, 20, 1), topic)
    again = poll(spark, topic, marks)
    assert again == [(3, list(range(250, 350))), (4, list(range(350, 400)))]
    assert poll(spark, topic, marks) == []


def test_a_new_query_can_start_at_the_end(spark, topic, tmp_path):
    marks = str(tmp_path / "marks")
    assert poll(spark, topic, marks, starting=offsets.latest(topic)) == [(0, [])]  # a first, empty batch
    offsets.append(records(spark, 7, 9), topic)
    assert poll(spark, topic, marks) == [(1, [250, 251])]
    assert poll(spark, topic, str(tmp_path / "other"), starting=offsets.LATEST) == [(0, [])]


def test_committed_offsets_and_lag(spark, topic, tmp_path):
    marks = str(tmp_path / "marks")
    poll(spark, topic, marks)
    found = sorted((r.batch_id, r.committed, r["offset"]) for r in offsets.progress(spark, marks).collect())
    assert found == [(0, True, 100), (1, True, 200), (2, True, 250)]
    assert offsets.group_lag(spark, topic, marks).collect() == [(250, 250, 0)]
    offsets.append(records(spark, 0, 30), topic)
    assert offsets.group_lag(spark, topic, marks).collect() == [(250, 280, 30)]


def test_a_group_of_readers_takes_the_polls_of_one_query(spark, topic, tmp_path, monkeypatch):
    monkeypatch.setattr(offsets, "FEWEST", 2)
    marks, got, broken, together = str(tmp_path / "marks"), {}, [5], threading.Barrier(3)
    offsets.append(records(spark, 250, 333), topic)

    def handle(batch, number):
        if number in (0, 3, 6) and broken:
            together.wait(60)  # the first polls of three stretches are at work at once
        if number in broken:
            raise ValueError("lost")
        got.setdefault(number, []).append(sorted(r.offset for r in batch.collect()))

    with pytest.raises(Exception, match="lost"):
        offsets.read_in_polls(spark, topic, marks, handle, 50, readers=3)
    # Seven polls of 50: three stretches of three, three and one; the second stops at its last poll.
    assert sorted(got) == [0, 1, 2, 3, 4, 6]
    assert offsets.group_lag(spark, topic, marks).collect() == [(250, 333, 83)]
    broken.clear()
    offsets.append(records(spark, 0, 20), topic)
    offsets.read_in_polls(spark, topic, marks, handle, 50, readers=3)
    assert got == {
        **{k: [list(range(50 * k, 50 * k + 50))] for k in range(6)}, 6: [list(range(300, 333))], 7: [list(range(333, 353))]
    }
    assert offsets.group_lag(spark, topic, marks).collect() == [(353, 353, 0)]
    found = sorted(map(tuple, offsets.progress(spark, marks).collect()))
    assert found == [(k, True, min(50 * k + 50, 333)) for k in range(7)] + [(7, True, 353)]
    offsets.read_in_polls(spark, topic, marks, handle, 50, readers=3)
    assert sorted(got) == list(range(8)) and all(len(g) == 1 for g in got.values())


def test_a_group_on_an_empty_topic(spark, tmp_path):
    folder, marks, got = str(tmp_path / "topic"), str(tmp_path / "marks"), []
    offsets.append(records(spark, 0, 0), folder)
    offsets.read_in_polls(spark, folder, marks, lambda batch, number: got.append((number, batch.count())), 50)
    assert got == [(0, 0)]
    assert offsets.group_lag(spark, folder, marks).collect() == [(0, 0, 0)]
    offsets.append(records(spark, 0, 20), folder)
    assert offsets.group_lag(spark, folder, marks).collect() == [(0, 20, 20)]
    offsets.read_in_polls(spark, folder, marks, lambda batch, number: got.append((number, batch.count())), 50)
    assert got[-1] == (1, 20)
    assert offsets.group_lag(spark, folder, marks).collect() == [(20, 20, 0)]


def test_the_lag_of_a_group_is_what_came_after_all_its_readers(spark, topic, tmp_path, monkeypatch):
    monkeypatch.setattr(offsets, "FEWEST", 1)
    marks = tmp_path / "marks"
    offsets.read_in_polls(spark, topic, str(marks), lambda batch, number: batch.write.format("noop").mode("overwrite").save(), 100)
    assert sorted(p.name for p in marks.iterdir()) == ["stretch=0-0-100-100", "stretch=1-100-200-100", "stretch=2-200-250-100"]
    offsets.append(records(spark, 0, 30), topic)
    assert offsets.group_lag(spark, topic, str(marks)).collect() == [(250, 280, 30)]


def test_a_batch_that_fails_is_not_committed(spark, topic, tmp_path):
    marks, got = str(tmp_path / "marks"), []

    def broken(batch, number):
        if number == 1 and not got:
            got.append(number)
            raise ValueError("lost")

    source = offsets.stream(spark, topic, limit=100).writeStream.foreachBatch(broken)
    running = source.option("checkpointLocation", marks).trigger(processingTime="0 seconds").start()
    with pytest.raises(Exception, match="lost"):
        running.processAllAvailable()
    assert sorted((r.batch_id, r.committed) for r in offsets.progress(spark, marks).collect()) == [(0, True), (1, False)]
    assert offsets.group_lag(spark, topic, marks).collect() == [(100, 250, 150)]
    assert poll(spark, topic, marks) == [(1, list(range(100, 200))), (2, list(range(200, 250)))]


def test_odd_topics(spark, tmp_path):
    folder = str(tmp_path / "topic")
    assert keys(offsets.read(spark, folder)) == [] and json.loads(offsets.latest(folder))["offset"] == 0
    offsets.append(records(spark, 0, 0), folder)
    rows = [(None, None), ("", ""), ("k", "x" * 300_000), ("k", "x" * 300_000)]
    offsets.append(spark.createDataFrame([(k, v, 1) for k, v in rows], "key string, value string, offset int"), folder)
    got = [(r.key, r.value) for r in offsets.read(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)
    # A batch whose write has not ended does not count, and is written over.
    records(spark, 0, 5).write.parquet(f"{folder}/batch=0000000002")
    (tmp_path / "topic" / "batch=0000000002" / "_SUCCESS").unlink()
    assert len(offsets.read(spark, folder).collect()) == 4
    assert offsets.append(records(spark, 10, 12), folder) == 2 and len(offsets.read(spark, folder).collect()) == 6


def test_row_groups_before_an_offset_are_skipped(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import parquet

    folder = tmp_path / "topic" / "batch=0000000000"
    folder.mkdir(parents=True)
    names = [str(k) for k in range(1000)]
    parquet.write_table(pa.table({"key": names, "value": names}), str(folder / "part-0.parquet"), row_group_size=90)
    (folder / "_SUCCESS").touch()
    held = offsets._Topic(str(tmp_path / "topic"))
    for low, count in ((0, 1), (89, 2), (90, 90), (500, 500), (999, 1)):
        found = [k for b in held.read("batch=0000000000/part-0.parquet", low, count, 5) for k in b.column(0).to_pylist()]
        assert found == names[low : low + count]
    assert keys(offsets.read(spark, f"file:{tmp_path}/topic", limit=123)) == list(range(123))


def test_a_read_decodes_only_the_row_groups_it_needs(spark, tmp_path, monkeypatch):
    # Texts of random digits: 4 MB that do not shrink.
    rows = spark.range(0, 4000, 1, 1).select(
        F.col("id").cast("string").alias("key"),
        F.concat(*[F.sha2(F.concat("id", F.lit(f"-{k}")), 512) for k in range(16)]).alias("value"),
    )
    folder = str(tmp_path / "topic")
    offsets.append(rows, folder)
    topic, asked = offsets._Topic(folder), []
    name = topic.files()[-1]
    opened = topic._parquet

    class Watched:
        def __init__(self, file):
            self._file = file

        def __enter__(self):
            return self

        def __exit__(self, *error):
            self._file.close()

        def __getattr__(self, what):
            return getattr(self._file, what)

        def iter_batches(self, columns, row_groups):
            asked.append(sum(self._file.metadata.row_group(k).num_rows for k in row_groups))
            return self._file.iter_batches(columns=columns, row_groups=row_groups)

    monkeypatch.setattr(topic, "_parquet", lambda n: Watched(opened(n)))
    assert opened(name).num_row_groups > 2
    for low in (0, 1500, 3990):
        found = [int(k) for b in topic.read(name, low, 10, 0) for k in b.column(0).to_pylist()]
        assert found == list(range(low, low + 10))
    assert len(asked) == 3 and max(asked) < 2500


def test_a_stream_reads_each_footer_once(spark, topic, monkeypatch):
    held, opened = offsets._Topic(topic), []
    real = held._parquet
    monkeypatch.setattr(held, "_parquet", lambda n: opened.append(n) or real(n))
    at = held.forward(dict(offsets._START), 100)
    held.ranges(offsets._START, at)
    end = held.forward(at, 200)
    assert sum(r.value[2] for r in held.ranges(at, end)) == 150
    assert len(opened) == len(set(opened)) == 3
