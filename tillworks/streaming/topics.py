"""Topic sources and the queries that keep live figures.

The file form of a topic is a folder of JSON lines. Kafka needs its connector on the class
path; both forms give the same (key, value) records.
"""

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tillworks.streaming import events as ev


def kafka_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """A Kafka topic as a stream. ``starting`` applies to a query without a checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def kafka_batch(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The records that a Kafka topic holds now."""
    loaded = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return loaded.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def _records(lines: DataFrame, key: str) -> DataFrame:
    return lines.select(F.get_json_object("value", f"$.{key}").alias("key"), "value")


def file_topic(
    spark: SparkSession, folder: str, key: str, per_trigger: int | None = None
) -> DataFrame:
    """A folder of JSON lines as a stream; ``per_trigger`` limits the files of one batch."""
    reader = spark.readStream.format("text")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return _records(reader.load(folder), key)


def file_batch(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """The records that a folder of JSON lines holds now."""
    return _records(spark.read.text(folder), key)


def sample(records: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` records, for a bounded look at a topic."""
    return records.limit(rows)


def deduplicated(events: DataFrame, watermark: str, time: str = "event_time") -> DataFrame:
    """Drop repeated deliveries within the watermark. Off unless asked for: it changes counts."""
    return events.withWatermark(time, watermark).dropDuplicatesWithinWatermark(["event_id"])


def start_feeds(
    records: DataFrame,
    schema: str,
    feeds: Mapping[str, Callable[[DataFrame], DataFrame]],
    output: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Write several row-by-row feeds and the dead letters of one source.

    Each micro-batch is decoded once and written to ``output/<feed>/batch_id=N``. A batch that
    is run again after a failure overwrites its own folder, so nothing is written twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = ev.decode(batch, schema).persist()
        try:
            good = ev.readable(decoded)
            parts = {name: feed(good) for name, feed in feeds.items()}
            parts["dead_letters"] = ev.dead_letters(decoded)
            for name, part in parts.items():
                part.write.mode("overwrite").parquet(f"{output}/{name}/batch_id={batch_id}")
        finally:
            decoded.unpersist()

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def start_tallies(
    records: DataFrame,
    schema: str,
    tallies: Mapping[str, Callable[[DataFrame], DataFrame]],
    output: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Keep running counts without a state store.

    Each micro-batch adds its own counts per key under ``output/<tally>/batch_id=N``; a report
    merges them. Memory stays bounded however many keys there are, and a repeated batch
    replaces its counts instead of adding them again.
    """

    def count(batch: DataFrame, batch_id: int) -> None:
        decoded = ev.decode(batch, schema).persist()
        try:
            good = ev.readable(decoded)
            parts = {name: tally(good) for name, tally in tallies.items()}
            parts["errors"] = ev.dead_letters(decoded).agg(F.count(F.lit(1)).alias("errors"))
            for name, part in parts.items():
                part.write.mode("overwrite").parquet(f"{output}/{name}/batch_id={batch_id}")
        finally:
            decoded.unpersist()

    writer = records.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _listed(spark: SparkSession, folder: str) -> list:
    """What a folder holds, as the file system lists it; nothing if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(system.listStatus(path)) if system.exists(path) else []


def _numbered(spark: SparkSession, folder: str, prefix: str) -> dict[int, str]:
    """Complete parts ``prefix=N`` of a folder by their number; a part whose write did not end is
    left out."""
    found = {}
    for part in _listed(spark, folder):
        name, place = part.getPath().getName(), part.getPath().toString()
        if name.startswith(f"{prefix}="):
            if any(f.getPath().getName() == "_SUCCESS" for f in _listed(spark, place)):
                found[int(name[len(prefix) + 1 :])] = place
    return found


def _remove(spark: SparkSession, places) -> None:
    for place in places:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _parts(spark: SparkSession, output: str, name: str, segments: bool):
    """Merged states in use, the batches after them, and all that is superseded.

    With ``segments`` every state counts, else the newest has taken over the earlier ones."""
    states = _numbered(spark, f"{output}/{name}.merged", "up_to")
    batches = _numbered(spark, f"{output}/{name}", "batch_id")
    newest = max(states, default=-1)
    used = dict(states) if segments else {n: p for n, p in states.items() if n == newest}
    later = {n: p for n, p in batches.items() if n > newest}
    old = [p for n, p in batches.items() if n <= newest]
    old += [p for n, p in states.items() if n not in used]
    return used, later, old


def _read(spark: SparkSession, places) -> DataFrame:
    return spark.read.parquet(*places)


def _added(parts: DataFrame, keys: list[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*sums)


def merged_tally(spark: SparkSession, output: str, name: str, keys: list[str]) -> DataFrame:
    """The counts of all batches, added up per key."""
    used, later, _ = _parts(spark, output, name, segments=False)
    return _added(_read(spark, [*used.values(), *later.values()]), keys)


def compact_tally(spark: SparkSession, output: str, name: str, keys: list[str]) -> int:
    """Merge the batches so far, so that reports read one state and the batches after it.

    The new state goes to a folder of its own and counts once its write has ended; until then
    reports go on with what they had. Only then are merged batches and earlier states removed, so
    listings stay short. With nothing new, nothing is written. Returns the last batch merged.
    A report that was planned before may find its files gone: plan it again.
    """
    used, later, old = _parts(spark, output, name, segments=False)
    last = max([*used, *later])
    if later:
        parts = _read(spark, [*used.values(), *later.values()])
        # Sums of decimals widen: a state keeps the column types of the batches.
        types = dict(parts.dtypes)
        state = _added(parts, keys)
        state = state.select(*[F.col(c).cast(types[c]).alias(c) for c in state.columns])
        state.write.mode("overwrite").parquet(f"{output}/{name}.merged/up_to={last}")
        old = _parts(spark, output, name, segments=False)[2]
    _remove(spark, old)
    return last


def feed(spark: SparkSession, output: str, name: str) -> DataFrame:
    """All rows that a feed has written."""
    used, later, _ = _parts(spark, output, name, segments=True)
    return _read(spark, [*used.values(), *later.values()])


def compact_feed(spark: SparkSession, output: str, name: str) -> int:
    """Gather the batches since the last time into one segment; earlier segments stay as they
    are. Merged batches are removed once the segment is complete."""
    used, later, old = _parts(spark, output, name, segments=True)
    last = max([*used, *later])
    if later:
        _read(spark, list(later.values())).write.mode("overwrite").parquet(
            f"{output}/{name}.merged/up_to={last}"
        )
        old = _parts(spark, output, name, segments=True)[2]
    _remove(spark, old)
    return last


def start_state_tally(
    events: DataFrame,
    tally: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Running counts in the state store, for small key sets (event types, countries).

    Every batch writes the full result under ``output/batch_id=N``; the latest one counts.
    """

    def write(result: DataFrame, batch_id: int) -> None:
        result.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    writer = (
        tally(events)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def latest_state(spark: SparkSession, output: str) -> DataFrame:
    """The counts that the last batch of a state tally wrote."""
    states = spark.read.parquet(output)
    newest = states.agg(F.max("batch_id")).scalar()
    return states.filter(F.col("batch_id") == newest).drop("batch_id")


def run_for(query: StreamingQuery, seconds: int, report: Callable[[], DataFrame]) -> DataFrame:
    """Let a query run for a fixed time, stop it, and return the final report."""
    query.awaitTermination(seconds)
    query.stop()
    return report()


def processing_rate(query: StreamingQuery) -> float:
    """Rows per second of the last batch, 0 before the first."""
    progress = query.lastProgress
    return float(progress["processedRowsPerSecond"] or 0) if progress else 0.0


def _positions(offset, path: tuple = ()) -> dict:
    """The numbers of an offset by their place: per topic and partition, or of a file log. An
    offset that is not JSON has none."""
    if isinstance(offset, str):
        try:
            offset = json.loads(offset)
        except ValueError:
            return {}
    if isinstance(offset, dict):
        inner = [_positions(v, (*path, k)) for k, v in offset.items()]
        return {k: v for part in inner for k, v in part.items()}
    return {path: int(offset)} if offset is not None else {}


def lag(end, latest) -> int:
    """How far the processed offsets are behind the latest ones, added over all partitions.

    A partition without a processed offset counts from its start; a source that names no latest
    offset has no lag."""
    done = _positions(end)
    return sum(max(0, at - done.get(place, 0)) for place, at in _positions(latest).items())


class LagMonitor(StreamingQueryListener):
    """Keeps the latest progress of every query: rows, rate, source offsets and lag."""

    def __init__(self):
        self.progress = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        self.progress[str(progress.id)] = {
            "batch": progress.batchId,
            "rows": progress.numInputRows,
            "rows_per_second": progress.processedRowsPerSecond,
            "offsets": [
                {"source": s.description, "end": s.endOffset, "latest": s.latestOffset}
                for s in progress.sources
            ],
            "lag": sum(lag(s.endOffset, s.latestOffset) for s in progress.sources),
        }

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
