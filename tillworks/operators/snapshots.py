"""History of a table whose rows change: one row per key and period in which its values held."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.sinks.versions import PART, VersionedTable, staged

FROM, TO, HASH = "valid_from", "valid_to", "row_hash"
#: Who wins at one moment: an end that is on record, a row on record, a deletion, a new row.
_END, _RECORDED, _DELETED, _GIVEN = range(4)


def row_hash(columns) -> Column:
    """A hash of a row's values that tells null from empty and one column from the next."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}), 256)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("string")


def _periods(points: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Rows with the periods that follow from what is known at single moments."""
    at_once = points.groupBy(key, FROM).agg(F.max(F.struct("weight", HASH, *values)).alias("it"))
    known = at_once.select(key, FROM, F.col("it.weight").isin(_END, _DELETED).alias("gone"), f"it.{HASH}", *[f"it.{v}" for v in values])
    line = Window.partitionBy(key).orderBy(FROM)
    state = F.when(F.col("gone"), F.lit("")).otherwise(F.col(HASH))
    changes = (
        known.withColumn("state", state)
        .withColumn("previous", F.coalesce(F.lag("state").over(line), F.lit("")))
        .where("state <> previous")
    )
    return changes.withColumn(TO, F.lead(FROM).over(line)).where("not gone").select(key, *values, HASH, FROM, TO)


def record_state(
    table: VersionedTable,
    state: DataFrame,
    key: str,
    as_of: str,
    changed_at: str | None = None,
    full: bool = True,
    buckets: int = 16,
) -> int:
    """Record what a source holds ``as_of`` a day, and return the table's version.

    The history has the source's columns, ``row_hash``, ``valid_from`` and ``valid_to`` (both
    dates; null while the row holds). A row whose hash differs from the one that holds closes its
    period and opens a new one; a new key opens one; with ``full`` a key that is missing from the
    state is closed. ``changed_at`` names a date column with the day since when a row's values
    hold, and a key may have several rows; without it that is ``as_of``. A row with an earlier day
    than what is recorded (a late one) is put into the history where it belongs. Recording a state
    again changes nothing, and no version is made; a different state for the same day replaces what
    was recorded for it. Full states must come in the order of their days: what is missing from a
    late one could have come back since, which a history of changes does not say.

    Open rows are compared by key and hash alone. Keys are dealt to ``buckets`` by hash: only
    buckets with a change are written, closed rows are added to theirs, and closed rows are read
    and rewritten only in buckets with late or returning keys. Rows without a key are left out; of
    several rows for one key and day the one with the greatest hash counts. The columns must be
    comparable (no maps).
    """
    manifest = table.manifest()
    if full and manifest["mark"] and as_of < manifest["mark"]:
        raise ValueError(f"a full state of {as_of}, but the history goes up to {manifest['mark']}")
    values = [c for c in state.columns if c not in (key, changed_at)]
    since = F.col(changed_at).cast("date") if changed_at else F.lit(as_of).cast("date")
    given = state.where(F.col(key).isNotNull()).select(key, *values, since.alias(FROM)).withColumn(HASH, row_hash(values))
    given = staged(
        given.groupBy(key, FROM).agg(F.max(F.struct(HASH, *values)).alias("it")).select(key, FROM, "it.*"), table.folder
    )
    parts = manifest["parts"]
    columns = [key, *values, HASH, FROM, TO]
    nothing = given.withColumn(TO, F.lit(None).cast("date")).select(*columns).limit(0)

    def of(kind: str, wanted=None) -> DataFrame:
        names = [p for p in parts if p.startswith(f"{kind}-") and (wanted is None or p.split("-")[1] in wanted)]
        return table.read(names).select(*columns) if names else nothing

    held = of("open").select(F.col(key).alias("_key"), F.col(HASH).alias("_hash"), F.col(FROM).alias("_since"))
    met = given.select(key, FROM, HASH).join(held, F.col(key) == F.col("_key"), "full_outer")
    late = F.col("_key").isNull() | (F.col(FROM) < F.col("_since"))
    differs = late | (F.col(HASH) != F.col("_hash"))
    missing = F.col(key).isNull() & F.lit(full)
    touched = staged(
        met.where(F.coalesce(differs, missing))
        .groupBy(F.coalesce(key, "_key").alias(key))
        .agg(F.max(F.coalesce(late, F.lit(False))).alias("late"), F.max(F.col(key).isNull()).alias("missing")),
        table.folder,
    )
    deep = [r[0] for r in touched.where("late").select(_bucket(key, buckets)).distinct().collect()]
    recorded = of("open").unionByName(of("closed", set(deep)).join(touched.where("late"), key, "left_semi"))
    recorded = staged(recorded.join(touched, key, "left_semi"), table.folder)
    ends = recorded.where(F.col(TO).isNotNull()).select(key, *values, HASH, F.col(TO).alias(FROM), F.lit(_END).alias("weight"))
    deleted = recorded.where(F.col(TO).isNull()).join(touched.where("missing"), key, "left_semi")
    points = (
        recorded.select(key, *values, HASH, FROM, F.lit(_RECORDED).alias("weight"))
        .unionByName(ends)
        .unionByName(deleted.withColumn(FROM, F.lit(as_of).cast("date")).select(key, *values, HASH, FROM, F.lit(_DELETED).alias("weight")))
        .unionByName(given.join(touched, key, "left_semi").select(key, *values, HASH, FROM, F.lit(_GIVEN).alias("weight")))
    )
    now = staged(_periods(points, key, values).select(*columns), table.folder)
    period = [key, HASH, FROM, TO]
    changed = now.select(*period).exceptAll(recorded.select(*period)).unionByName(
        recorded.select(*period).exceptAll(now.select(*period))
    )
    changed = staged(changed.select(key).distinct().join(touched, key).select(key, "late"), table.folder)
    dealt = {r[0]: r[1] for r in changed.groupBy(_bucket(key, buckets).alias("b")).agg(F.max("late")).collect()}
    if not dealt:
        return manifest["version"]
    rewritten = {b for b, is_late in dealt.items() if is_late}
    name = F.when(F.col(TO).isNull(), F.lit("open-")).otherwise(F.lit("closed-"))
    rows = now.join(changed, key, "left_semi")
    rows = rows.unionByName(of("open", set(dealt)).join(changed, key, "left_anti"))
    if rewritten:
        rows = rows.unionByName(of("closed", rewritten).join(changed.where("late"), key, "left_anti"))
    replaced = [f"open-{b}" for b in dealt] + [f"closed-{b}" for b in rewritten]
    return table.publish(rows.withColumn(PART, F.concat(name, _bucket(key, buckets))), replaced, max(as_of, manifest["mark"] or as_of))


def valid_at(history: DataFrame, day: str) -> DataFrame:
    """The rows that held on a day."""
    on = F.lit(day).cast("date")
    return history.where((F.col(FROM) <= on) & (F.col(TO).isNull() | (F.col(TO) > on)))
