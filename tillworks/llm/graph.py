"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.storage import stored


def _smallest_neighbours(both: DataFrame) -> DataFrame:
    """Per vertex the smallest of itself and its neighbours; reduced before the shuffle."""
    return both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def _stars(edges: DataFrame) -> bool:
    """Whether each vertex with an edge to a smaller one has no other, and that one none at all."""
    ends = F.array(
        F.struct(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up")),
        F.struct(F.col("b").alias("v"), F.lit(0).alias("down"), F.lit(1).alias("up")),
    )
    met = edges.select(F.explode(ends).alias("e")).groupBy("e.v")
    met = met.agg(F.sum("e.down").alias("down"), F.max("e.up").alias("up"))
    return met.where("down > 1 or down = 1 and up = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """The component of every vertex with an edge, as ``(vertex, component_id)``.

    ``edges`` has two columns ``a`` and ``b`` of bigint; direction, repeats and loops do not
    matter, and rows with a null are ignored. The component's id is its smallest vertex. An empty
    table gives an empty table.

    Large-star and small-star steps take turns until only stars are left: each links a vertex's
    neighbours to the smallest among them, so the graph shrinks to stars in a few rounds, also
    for long chains. Edges lead to smaller vertices, so a star's centre is its smallest. A vertex
    with very many neighbours is a minimum (taken before the shuffle) and a join that adaptive
    execution can split. Each round is kept in the shared folder.
    """
    edges = (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )
    edges = stored(edges)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        star = _smallest_neighbours(both)
        # Large star: larger neighbours of a vertex are linked to the smallest one.
        large = (
            both.where("b > a")
            .join(star, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        # Small star: a vertex and its smaller neighbours are linked to the smallest one.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        edges = stored(small.select("e.a", "e.b").where("a <> b").distinct())
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component_id")).unionByName(
        roots.select(F.col("b").alias("vertex"), F.col("b").alias("component_id"))
    )
