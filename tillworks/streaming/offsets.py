"""Topics as files of records with offsets.

A topic is a folder of batches ``batch=<number>`` of Parquet files with the columns ``key`` and
``value``. The records of complete batches stand in one order: by batch, file name and place in the
file. An offset is the number of records before it, with the file and place that it falls on, so it
stays small however long the topic gets. How many records a file holds is in its footer.
"""

import json
import re
import sys
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from typing import NamedTuple

from pyspark import cloudpickle, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# The source runs in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "record_topic"
EARLIEST, LATEST = "earliest", "latest"
_START = {"offset": 0, "file": "", "within": 0}
#: Bytes of a row group. One is decoded from its start, so a read from within a file costs this
#: much more than its records, however long the file is.
GROUP = 1 << 20
#: Queries that read a topic side by side at most, and the polls that make one worth its start.
READERS = 8
FEWEST = 16


def append(records: DataFrame, folder: str) -> int:
    """Add records (``key, value``) to a topic as its next batch; returns the batch's number.

    One writer at a time. A batch counts once its write has ended; what a failed write left is
    written over.
    """
    spark = records.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    complete = [-1]
    if system.exists(path):
        for entry in system.listStatus(path):
            done = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
            if entry.getPath().getName().startswith("batch=") and system.exists(done):
                complete.append(int(entry.getPath().getName()[6:]))
    number = max(complete) + 1
    writer = records.select("key", "value").write.mode("overwrite").option("parquet.block.size", GROUP)
    writer.parquet(f"{folder}/batch={number:010d}")
    return number


class _Topic:
    """The files of a topic and their numbers of records, read as far as they are needed."""

    def __init__(self, folder: str):
        self._folder, self._counts = folder, {}

    def _open(self):
        from pyarrow import fs

        place = re.sub("^file:/(?!/)", "file:///", self._folder)
        return fs.FileSystem.from_uri(place) if "://" in place else (fs.LocalFileSystem(), place)

    def files(self, after: str = "") -> list[str]:
        """Files of complete batches from ``after`` on, in order, relative to the folder."""
        from pyarrow import fs

        system, base = self._open()
        listed = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
        batches = sorted(f.base_name for f in listed if f.base_name.startswith("batch="))
        found = []
        for batch in batches:
            if batch < after.split("/")[0]:
                continue
            names = [f.base_name for f in system.get_file_info(fs.FileSelector(f"{base}/{batch}"))]
            if "_SUCCESS" in names:
                found += sorted(f"{batch}/{n}" for n in names if n.endswith(".parquet"))
        return [f for f in found if f >= after]

    def _parquet(self, name: str):
        from pyarrow import parquet

        system, base = self._open()
        return parquet.ParquetFile(system.open_input_file(f"{base}/{name}"))

    def records(self, name: str) -> int:
        # Files of complete batches do not change: a stream asks for the same ones in every poll.
        if name not in self._counts:
            with self._parquet(name) as file:
                self._counts[name] = file.metadata.num_rows
        return self._counts[name]

    def forward(self, start: dict, limit: int | None = None) -> dict:
        """The offset that many records further on, or at the end of the topic."""
        at = dict(start)
        left = limit
        for name in self.files(start["file"]):
            inside = start["within"] if name == start["file"] else 0
            some = self.records(name) - inside
            if left is not None:
                some = min(some, left)
                left -= some
            if some:
                at = {"offset": at["offset"] + some, "file": name, "within": inside + some}
            if left == 0:
                break
        return at

    def ranges(self, start: dict, end: dict) -> list[InputPartition]:
        """The stretches of files between two offsets, as (file, first record, number of records,
        offset of the first)."""
        if start["offset"] >= end["offset"]:
            return []
        out, offset = [], start["offset"]
        for name in self.files(start["file"]):
            if name > end["file"]:
                break
            low = start["within"] if name == start["file"] else 0
            high = end["within"] if name == end["file"] else self.records(name)
            if high > low:
                out.append(InputPartition((name, low, high - low, offset)))
                offset += high - low
        return out

    def read(self, name: str, low: int, count: int, offset: int) -> Iterator:
        """Batches of records; only the row groups that hold some of them are read."""
        import numpy as np
        import pyarrow as pa

        with self._parquet(name) as file:
            groups, before, skip = [], 0, 0
            for k in range(file.num_row_groups):
                rows = file.metadata.row_group(k).num_rows
                if before < low + count and before + rows > low:
                    skip = skip if groups else low - before
                    groups.append(k)
                before += rows
            left = count
            for batch in file.iter_batches(columns=["key", "value"], row_groups=groups):
                part = batch.slice(min(skip, batch.num_rows), left)
                skip = max(0, skip - batch.num_rows)
                if part.num_rows:
                    numbers = pa.array(np.arange(offset, offset + part.num_rows))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), numbers], ["key", "value", "offset"])
                    offset, left = offset + part.num_rows, left - part.num_rows
                if not left:
                    break


def _starting(topic: _Topic, given: str) -> dict:
    if given == EARLIEST:
        return dict(_START)
    return topic.forward(_START) if given == LATEST else json.loads(given)


class _BatchReader(DataSourceReader):
    def __init__(self, folder, starting, limit):
        self._topic, self._starting, self._limit = _Topic(folder), starting, limit

    def partitions(self):
        start = _starting(self._topic, self._starting)
        return self._topic.ranges(start, self._topic.forward(start, self._limit)) or [InputPartition(None)]

    def read(self, partition):
        return iter(()) if partition.value is None else self._topic.read(*partition.value)


class _StreamReader(DataSourceStreamReader):
    """Gives at most ``limit`` records per batch, and none behind the offset ``until``.

    The position is where the last planned batch ended. After a restart Spark plans the last batch
    of the checkpoint again before it asks for a new offset, which brings the position back.
    """

    def __init__(self, folder, starting, limit, until):
        self._topic, self._starting, self._limit = _Topic(folder), starting, limit
        self._until, self._at = until, None

    def initialOffset(self):
        return _starting(self._topic, self._starting)

    def latestOffset(self):
        if self._at is None:
            self._at = self.initialOffset()
        limit = self._limit
        if self._until is not None:
            left = max(0, self._until - self._at["offset"])
            limit = left if limit is None else min(limit, left)
        if limit != 0:
            self._at = self._topic.forward(self._at, limit)
        return self._at

    def partitions(self, start, end):
        if self._at is None or self._at["offset"] < end["offset"]:
            self._at = end
        return self._topic.ranges(start, end)

    def read(self, partition):
        return self._topic.read(*partition.value)


class RecordTopic(DataSource):
    """``spark.read`` and ``spark.readStream`` format ``record_topic``.

    Options: ``path``; ``startingOffsets`` (``earliest``, ``latest`` or an offset as JSON);
    ``maxRecords``, the records of one read or, for a stream, of one batch; ``untilOffset``, the
    number of the record before which a stream ends (none: it goes on with what is added). A stream
    keeps its offsets in its checkpoint, and ``startingOffsets`` counts for a new one only.
    """

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "key string, value string, offset bigint"

    def _settings(self):
        limit = self.options.get("maxrecords") or self.options.get("maxRecords")
        starting = self.options.get("startingoffsets") or self.options.get("startingOffsets") or EARLIEST
        return self.options["path"], starting, int(limit) if limit else None

    def reader(self, schema):
        return _BatchReader(*self._settings())

    def streamReader(self, schema):
        until = self.options.get("untiloffset") or self.options.get("untilOffset")
        return _StreamReader(*self._settings(), int(until) if until else None)


def _configured(reader, folder, starting, limit):
    reader = reader.format(FORMAT).option("path", folder).option("startingOffsets", starting)
    return reader.option("maxRecords", limit) if limit else reader


def read(spark: SparkSession, folder: str, starting: str = EARLIEST, limit: int | None = None) -> DataFrame:
    """``key, value, offset`` of the records from an offset on, at most ``limit`` of them."""
    spark.dataSource.register(RecordTopic)
    return _configured(spark.read, folder, starting, limit).load()


def stream(
    spark: SparkSession, folder: str, starting: str = EARLIEST, limit: int | None = None, until: int | None = None
) -> DataFrame:
    """The records of a topic as a stream, at most ``limit`` of them in one batch, and none from
    the record number ``until`` on."""
    spark.dataSource.register(RecordTopic)
    reader = _configured(spark.readStream, folder, starting, limit)
    return (reader if until is None else reader.option("untilOffset", until)).load()


def latest(folder: str) -> str:
    """The offset behind the last record, for reading what comes later."""
    return json.dumps(_Topic(folder).forward(_START))


class _Stretch(NamedTuple):
    """Polls ``first`` and on, of ``limit`` records each, from record ``start`` to ``end``."""

    first: int
    start: int
    end: int
    limit: int

    @property
    def name(self) -> str:
        return "stretch=" + "-".join(map(str, self))

    @property
    def polls(self) -> int:
        return max(1, -(-(self.end - self.start) // self.limit))


def _path(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _stretches(spark: SparkSession, checkpoint: str) -> list[_Stretch]:
    """What the readers of a group were given, in order; nothing for the checkpoint of one query."""
    system, path = _path(spark, checkpoint)
    names = [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []
    return sorted(_Stretch(*map(int, n[8:].split("-"))) for n in names if n.startswith("stretch="))


def _reached(spark: SparkSession, checkpoint: str, stretches: list[_Stretch]) -> dict[_Stretch, int]:
    """The offset that each reader of a group has committed; without a commit that of its start."""
    reached = {s.name: s.start for s in stretches}
    system, logs = _path(spark, f"{checkpoint}/stretch=*/commits/[0-9]*")
    if system.globStatus(logs):
        done = _batches(spark, checkpoint, "stretch=*/").where("committed")
        # One row per reader.
        reached |= dict(map(tuple, done.groupBy("stretch").agg(F.max("offset")).collect()))
    return {s: reached[s.name] for s in stretches}


def read_in_polls(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    limit: int,
    readers: int = READERS,
) -> None:
    """Read a topic to its present end in polls of ``limit`` records, and ``handle(batch, number)``
    each of them.

    One query takes one poll after the other, which costs its time however little they hold. So a
    group of up to ``readers`` queries reads stretches of the topic side by side. The polls are
    those of one query and have its numbers, but those of different stretches come in no order, and
    ``handle`` may be at work on several at once. Each stretch has a checkpoint of its own under
    ``checkpoint``. Called again, readers that did not reach their end go on from there, and
    records that came since are read in new stretches.
    """
    topic = _Topic(folder)
    given, end = _stretches(spark, checkpoint), topic.forward(_START)["offset"]
    number, at = (given[-1].first + given[-1].polls, given[-1].end) if given else (0, 0)
    if end > at or not given:
        polls = max(1, -(-(end - at) // limit))
        each = max(FEWEST, -(-polls // readers))
        for k in range(0, polls, each):
            some = _Stretch(number + k, at + k * limit, min(end, at + (k + each) * limit), limit)
            # In order, before any is read: whatever is there has no gap.
            system, path = _path(spark, f"{checkpoint}/{some.name}")
            system.mkdirs(path)
            given.append(some)

    # Spark changes the environment kept with a registered source when a query of it starts, while
    # tasks of others are sent with it. So each reader gets a registration of its own.
    registering = Lock()

    def run(some: _Stretch) -> None:
        starting = json.dumps(topic.forward(_START, some.start))
        with registering:
            records = stream(spark, folder, starting, some.limit, some.end)
        writer = records.writeStream.foreachBatch(lambda batch, k: handle(batch, some.first + k))
        marks = f"{checkpoint}/{some.name}"
        running = writer.option("checkpointLocation", marks).trigger(processingTime="0 seconds").start()
        try:
            running.processAllAvailable()
        finally:
            running.stop()

    open_ = [s for s, done in _reached(spark, checkpoint, given).items() if done < s.end or not s.end]
    with ThreadPoolExecutor(readers) as pool:
        list(pool.map(inheritable_thread_target(spark)(run), open_))


def _batches(spark: SparkSession, checkpoint: str, group: str = "") -> DataFrame:
    """``stretch, batch_id, committed, offset`` from the logs of a query, or of a group's queries."""
    place = F.input_file_name()
    stretch = F.regexp_extract(place, r"/(stretch=[^/]*)/\w+/\d+$", 1)
    first = F.coalesce(F.regexp_extract(stretch, r"=(\d+)", 1).try_cast("bigint"), F.lit(0))
    number = F.regexp_extract(place, r"/(\d+)$", 1).cast("bigint") + first
    logs = {
        name: spark.read.text(f"{checkpoint}/{group}{name}", pathGlobFilter="[0-9]*", wholetext=True).select(
            stretch.alias("stretch"), number.alias("batch_id"), "value"
        )
        for name in ("offsets", "commits")
    }
    last_line = F.element_at(F.split(F.rtrim("value"), "\n"), -1)
    offset = F.get_json_object(last_line, "$.offset").cast("bigint").alias("offset")
    planned = logs["offsets"].select("stretch", "batch_id", offset)
    commits = logs["commits"].select("batch_id", F.lit(True).alias("committed"))
    return planned.join(commits, "batch_id", "left").select(
        "stretch", "batch_id", F.coalesce("committed", F.lit(False)).alias("committed"), "offset"
    )


def progress(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch_id, committed, offset`` of every batch in a query's checkpoint: which batches were
    planned, which are committed, and up to which record. It reads the query's own logs, so it can
    be asked while the query runs and after it has ended. The batches of a group are its polls."""
    group = "stretch=*/" if _stretches(spark, checkpoint) else ""
    return _batches(spark, checkpoint, group).drop("stretch")


def group_lag(spark: SparkSession, folder: str, checkpoint: str) -> DataFrame:
    """One row: the offset that a query has committed, the topic's latest one, and the lag between
    them in records. A query without a commit has committed 0. A group has committed what is
    committed without a gap."""
    newest = F.lit(json.loads(latest(folder))["offset"]).cast("bigint")
    stretches = _stretches(spark, checkpoint)
    if stretches:
        reached = _reached(spark, checkpoint, stretches)
        upto = next((done for s, done in reached.items() if done < s.end), stretches[-1].end)
        done = spark.range(1).select(F.lit(upto).cast("bigint").alias("committed_offset"))
    else:
        done = progress(spark, checkpoint).agg(
            F.coalesce(F.max(F.when(F.col("committed"), F.col("offset"))), F.lit(0)).alias("committed_offset")
        )
    return done.select("committed_offset", newest.alias("latest_offset"), (newest - F.col("committed_offset")).alias("lag"))
