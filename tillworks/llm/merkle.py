"""A Merkle tree over the rows of a dataset: digests per group, one root, and proofs per row."""

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm.numbering import numbered
from tillworks.llm.storage import checkpoint_folder, stored

FAN_OUT = 16
#: The tree over the groups' own roots. Trees of groups are named by the place of their first leaf.
TOP = -1
#: Bytes of a digest.
_SIZE = 32


class Manifest(NamedTuple):
    """``leaves`` (``tree, place, n, digest`` and what was given), the folder of the node rows,
    and the root in hexadecimal (None for no rows)."""

    leaves: DataFrame
    folder: str
    root: str | None
    fan_out: int


def digest_of(columns: Sequence[str], instead: Mapping[str, Column] | None = None) -> Column:
    """The SHA-256 of a row's values: ``-`` for null, else the number of bytes, a colon and the
    value, one after the other. ``instead`` gives other values for some columns."""
    parts = []
    for name in columns:
        value = (instead or {}).get(name, F.col(f"`{name}`")).cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _inner(level: DataFrame, number: int, fan_out: int) -> DataFrame:
    """The nodes over a level: each has up to ``fan_out`` neighbours' digests as ``children``.

    The only node of the level below stays what it is (``lone``).
    """
    child = F.struct((F.col("place") % fan_out).alias("place"), F.col("digest"))
    runs = level.groupBy("tree", F.floor(F.col("place") / fan_out).cast("bigint").alias("run")).agg(
        F.array_sort(F.collect_list(child)).alias("run_of"), F.max("n").alias("below")
    )
    hexed = F.array_join(F.transform("run_of", lambda c: _text(c["digest"])), "")
    lone = F.col("below") == 1
    return runs.select(
        "tree",
        F.lit(number).alias("level"),
        F.col("run").alias("place"),
        F.ceil(F.col("below") / fan_out).cast("bigint").alias("n"),
        F.unhex(hexed).alias("children"),
        F.when(lone, F.element_at("run_of", 1)["digest"]).otherwise(F.unhex(F.sha2(hexed, 256))).alias("digest"),
        lone.alias("lone"),
    )


def _levels(leaves: DataFrame, most: int, folder: str, fan_out: int) -> DataFrame:
    """Write the nodes of all levels, and read them."""
    spark, level, number = leaves.sparkSession, leaves, 0
    while number == 0 or most > 1:
        number, most = number + 1, -(-most // fan_out)
        path = f"{folder}/{number}"
        _inner(level, number, fan_out).write.parquet(path)
        level = spark.read.parquet(path).where("n > 1")
    return spark.read.parquet(*[f"{folder}/{k}" for k in range(1, number + 1)])


def build(leaves: DataFrame, group: str, order: Sequence[Column], fan_out: int = FAN_OUT) -> Manifest:
    """Build the trees over ``leaves``, which have a binary ``digest``, and keep them.

    In each group the leaves stand in ``order`` (ties by digest); while several nodes remain, each
    run of ``fan_out`` neighbours (the last run may be shorter) becomes the SHA-256 of their
    digests in hexadecimal. The groups' roots, in the order of the group (null first, then by
    bytes), are the leaves of one more tree, which gives the root. Places are counted by many
    tasks, so a group may hold most of the rows. Every inner node is one row in the folder's
    ``nodes``: ``tree, level, place``, its children's digests, and the node above it
    (``up_tree, up_level, up_place``, and ``spot``, its number among that node's children).

    Null groups form one group; rows that repeat are leaves each; an empty table has no root.
    Other columns stay with the leaves; none may be named ``tree``, ``place``, ``first``, ``n``,
    ``_part`` or ``_at``.
    """
    spark = leaves.sparkSession
    folder = f"{checkpoint_folder(spark)}/merkle-{uuid.uuid4()}"
    placed = numbered(stored(leaves), [*order, F.col("digest")], [group]).withColumnRenamed("first", "tree")
    placed.write.parquet(f"{folder}/leaves")
    placed = spark.read.parquet(f"{folder}/leaves")
    most = placed.agg(F.max("n")).first()[0]
    if most is None:
        return Manifest(placed, folder, None, fan_out)
    inner = _levels(placed.select("tree", "place", "n", "digest"), most, f"{folder}/levels", fan_out)
    subroots = numbered(inner.where("n = 1").select("tree", "digest"), [F.col("tree")])
    subroots.write.parquet(f"{folder}/subroots")
    subroots = spark.read.parquet(f"{folder}/subroots")
    groups = subroots.count()
    above = F.floor(F.col("place") / fan_out).cast("bigint").alias("up_place")
    spot = (F.col("place") % fan_out).cast("int").alias("spot")
    within = [F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"), above, spot]
    kept = ["tree", "level", "place", "children", "lone"]
    nodes = inner.where("n > 1").select(*kept, *within)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in zip(("up_tree", "up_level", "up_place", "spot"), ("bigint", "int", "bigint", "int"))]
    tops = inner.where("n = 1").select(*kept)
    if groups == 1:
        root = subroots.first()["digest"]
        nodes = nodes.unionByName(tops.select(*kept, *nothing))
    else:
        roots = subroots.select(F.lit(TOP).cast("bigint").alias("tree"), "place", "n", "digest")
        upper = _levels(roots, groups, f"{folder}/upper", fan_out)
        root = upper.where("n = 1").first()["digest"]
        link = subroots.select(
            F.col("tree").alias("of"), F.lit(TOP).cast("bigint").alias("up_tree"), F.lit(1).alias("up_level"), above, spot
        )
        nodes = (
            nodes.unionByName(tops.join(link, F.col("tree") == F.col("of")).drop("of"))
            .unionByName(upper.where("n > 1").select(*kept, *within))
            .unionByName(upper.where("n = 1").select(*kept, *nothing))
        )
    nodes.write.parquet(f"{folder}/nodes")
    return Manifest(placed, folder, root.hex(), fan_out)


#: ``climb`` has a row per run of leaves and level: one folded digest per leaf, and the siblings
#: met so far, which the leaves of a run share.
_CLIMB = f"""
WITH RECURSIVE climb AS (
    SELECT tree, place, up_tree, up_level, up_place, spot,
           transform(leaves, x -> if(lone, x.presented, {{fold_leaf}})) AS folded,
           X'' AS siblings, CAST(NULL AS BINARY) AS subroot
    FROM runs
    UNION ALL
    SELECT c.tree, c.place, n.up_tree, n.up_level, n.up_place, n.spot,
           transform(c.folded, f -> {{fold}}),
           concat(c.siblings, {{others}}),
           coalesce(c.subroot, if(n.tree = {TOP}, substring(n.children, c.spot * {_SIZE} + 1, {_SIZE}), NULL))
    FROM climb c JOIN nodes n
      ON n.tree = c.up_tree AND n.level = c.up_level AND n.place = c.up_place
)
SELECT tree AS at_tree, place AS at_place, folded, siblings, subroot FROM climb WHERE up_tree IS NULL
"""


def _replaced(children: str, spot: str, value: str) -> str:
    """SQL for the digest of a run in which the one at ``spot`` is ``value``."""
    before = f"substring({children}, 1, {spot} * {_SIZE})"
    after = f"substring({children}, ({spot} + 1) * {_SIZE} + 1)"
    return f"unhex(sha2(lower(hex(concat({before}, {value}, {after}))), 256))"


def _others(children: str, spot: str) -> str:
    return (
        f"concat(substring({children}, 1, {spot} * {_SIZE}),"
        f" substring({children}, ({spot} + 1) * {_SIZE} + 1))"
    )


def verify(spark: SparkSession, manifest: Manifest, presented: str = "digest") -> DataFrame:
    """Climb from every leaf to the root with the digest that is presented for it.

    ``presented`` names a binary column of the leaves. Returns the leaves' columns (without
    ``tree, place, n``) and ``subroot``, ``root``, ``siblings`` (the proof: the other digests of
    each run on the way up, from left to right, in hexadecimal), ``folded_root`` (the root that
    follows from the presented digest and the siblings) and ``verified``.

    The climb is a recursive query over the stored node rows: each step joins the node above,
    appends the siblings and folds. The leaves of one run meet the same siblings above it, so they
    climb in one row, which holds a folded digest for each of them; a row has up to ``fan_out``
    of these and one run of siblings per level. A single leaf of all is its own root, without
    siblings; no rows give no rows; a null in ``presented`` gives a null root that is not verified.
    """
    leaves, fan_out = manifest.leaves, manifest.fan_out
    kept = [c for c in leaves.columns if c not in ("tree", "place", "n")]
    result = ("subroot", "root", "siblings", "folded_root", "verified")
    if manifest.root is None:
        none = [F.lit(None).cast("boolean" if c == "verified" else "string").alias(c) for c in result]
        return leaves.select(*[F.col(f"`{c}`") for c in kept], *none)
    leaf = F.struct(
        (F.col("place") % fan_out).cast("int").alias("spot"),
        F.col(f"`{presented}`").alias("presented"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
    )
    runs = leaves.groupBy("tree", F.floor(F.col("place") / fan_out).cast("bigint").alias("run")).agg(
        F.collect_list(leaf).alias("leaves")
    )
    first = spark.read.parquet(f"{manifest.folder}/nodes").where("level = 1").withColumnRenamed("tree", "of")
    path = f"{manifest.folder}/runs-{uuid.uuid4()}"
    runs.join(first, (F.col("tree") == F.col("of")) & (F.col("run") == F.col("place"))).drop("of", "run").write.parquet(path)
    # A session of its own: the climb makes more rows than a recursive query may by default.
    own = spark.newSession()
    own.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    own.read.parquet(path).createOrReplaceTempView("runs")
    own.read.parquet(f"{manifest.folder}/nodes").createOrReplaceTempView("nodes")
    climbed = own.sql(
        _CLIMB.format(
            fold_leaf=_replaced("children", "x.spot", "x.presented"),
            fold=_replaced("n.children", "c.spot", "f"),
            others=_others("n.children", "c.spot"),
        )
    )
    arrived = f"{path}-arrived"
    climbed.write.parquet(arrived)
    root = F.lit(manifest.root)
    met = spark.read.parquet(path).join(
        spark.read.parquet(arrived), (F.col("tree") == F.col("at_tree")) & (F.col("place") == F.col("at_place"))
    )
    each = met.select(
        F.explode(F.arrays_zip("leaves", "folded")).alias("it"), "children", "lone", "siblings", "subroot"
    )
    own_siblings = F.when(F.col("lone"), F.lit(b"")).otherwise(F.expr(_others("children", "it.leaves.spot")))
    folded_root = _text(F.col("it.folded"))
    return each.select(
        *[F.col(f"it.leaves.row.`{c}`").alias(c) for c in kept],
        F.coalesce(_text(F.col("subroot")), root).alias("subroot"),
        root.alias("root"),
        _text(F.concat(own_siblings, F.col("siblings"))).alias("siblings"),
        folded_root.alias("folded_root"),
        F.coalesce(folded_root == root, F.lit(False)).alias("verified"),
    )
