"""Embedding near-dedup: an exact range join by cosine over cells around pivots."""

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.graph import connected_components
from tillworks.llm.storage import shuffle_partitions, stored

_PACKED = "cell int, visiting boolean, reps binary, weights binary, vectors binary"
_FOUND = "a bigint, b bigint, n bigint"
_ROWS = 2048
_BLOCK_BYTES = 1 << 20


def _matrix(column) -> np.ndarray:
    """A column of equally long vectors as unit rows in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _angles(units, pivots):
    return np.arccos(np.clip(units @ pivots.T, -1, 1))


def _homes(batches, pivots):
    """The nearest pivot of each vector, by its size."""
    for batch in batches:
        if batch.num_rows:
            column = batch.column(0)
            near = np.zeros(len(column), dtype=np.int64)
            sizes = np.diff(column.offsets.to_numpy())
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                units = _matrix(column.take(pa.array(rows)))
                mine, table = pivots[size]
                near[rows] = mine[_angles(units, table).argmin(axis=1)]
            pivot, n = np.unique(near, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pivot), pa.array(n)], names=["pivot", "n"])


def _deal(batches, pivots, cells, angle):
    """Send each vector to its home cell, and as a visitor to each cell where it may have a
    partner.

    A pivot's vectors are split over ``cells[pivot]``, a range of cells. Near vectors u and v,
    with pivots p and q, have angle(v, p) <= angle(u, p) + angle <= angle(u, q) + angle <=
    angle(v, q) + 2 angle. Of two cells, one alone receives the other's visitors; which one
    alternates, so that cells have like shares.
    """
    slack = 1e-9
    for batch in batches:
        out, held = [], 0
        column, reps, weights = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        sizes = np.diff(column.offsets.to_numpy()) if batch.num_rows else np.zeros(0, int)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            units = _matrix(column.take(pa.array(rows)))
            mine, table = pivots[size]
            angles = _angles(units, table)
            nearest = angles.argmin(axis=1)
            first, count = cells[mine[nearest], 0], cells[mine[nearest], 1]
            home = first + reps[rows] % count
            reach = angles <= angles.min(axis=1, keepdims=True) + 2 * angle + slack
            for place, pivot in enumerate(mine):
                able = np.flatnonzero(reach[:, place])
                for cell in range(cells[pivot, 0], cells[pivot, 0] + cells[pivot, 1]):
                    own = home[able]
                    lower, higher = np.minimum(own, cell), np.maximum(own, cell)
                    goes_to = np.where((lower + higher) % 2 == 0, higher, lower)
                    visitors = able[(own != cell) & (goes_to == cell)]
                    step = max(1, _BLOCK_BYTES // (8 * size))
                    for visiting, some in ((False, np.flatnonzero(home == cell)), (True, visitors)):
                        for at in range(0, len(some), step):
                            take = some[at : at + step]
                            held += 8 * size * len(take)
                            out.append(
                                (cell, visiting, reps[rows][take].astype(np.int64).tobytes(),
                                 weights[rows][take].astype(np.int64).tobytes(),
                                 units[take].tobytes())
                            )
                    if held > 16 * _BLOCK_BYTES:
                        yield _packed(out)
                        out, held = [], 0
        if out:
            yield _packed(out)


def _packed(lines):
    types = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    arrays = [pa.array(c, type=t) for c, t in zip(zip(*lines), types)]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _PACKED.split(", ")])


class _Cell:
    """One cell: its own vectors, what they have been linked with, and a label per linked set."""

    def __init__(self):
        self.reps, self.weights, self.units, self.links, self.label = [], [], [], None, None

    def add(self, reps, weights, units):
        self.reps.append(reps)
        self.weights.append(weights)
        self.units.append(units)

    def close(self, least):
        """All own vectors are there: link them with each other."""
        if self.links is not None or not self.reps:
            return []
        self.reps, self.weights = np.concatenate(self.reps), np.concatenate(self.weights)
        self.units = np.concatenate(self.units)
        self.links = np.zeros(len(self.reps), dtype=np.int64)
        self.label = np.arange(len(self.reps))
        edges = []
        for at in range(0, len(self.reps), _ROWS):
            near = self.units[at : at + _ROWS] @ self.units.T >= least
            rows = np.arange(len(near))
            near[rows, at + rows] = False
            self.links[at : at + _ROWS] += near @ self.weights
            for row in np.flatnonzero(near.any(axis=1)):
                edges += self._join(np.append(np.flatnonzero(near[row]), at + row))
        return edges

    def visit(self, reps, weights, units, least):
        """Link a block of visitors; gives their counts and edges."""
        if not len(self.reps):
            return [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        near = units @ self.units.T >= least
        self.links += weights @ near
        edges = []
        hit = np.flatnonzero(near.any(axis=1))
        for row in hit:
            linked = np.flatnonzero(near[row])
            edges += self._join(linked)
            edges.append((reps[row], self.reps[self.label[linked[0]]]))
        return edges, reps[hit], near[hit] @ self.weights

    def _join(self, members):
        labels = np.unique(self.label[members])
        if len(labels) == 1:
            return []
        self.label[np.isin(self.label, labels[1:])] = labels[0]
        return [(self.reps[x], self.reps[labels[0]]) for x in labels[1:]]


def _found(edges, reps, counts):
    """Edges (a, b) and counts of links (a, n) as rows."""
    some = counts > 0
    reps, counts = reps[some], counts[some]
    if not len(edges) and not len(reps):
        return
    pairs = np.array(edges, dtype=np.int64).reshape(-1, 2)
    none = pa.nulls(len(reps), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((pairs[:, 0], reps))),
            pa.concat_arrays([pa.array(pairs[:, 1]), none]),
            pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(counts.astype(np.int64))]),
        ],
        names=["a", "b", "n"],
    )


def _compare(batches, least):
    """Rows sorted by cell, own vectors first: compare each block with the cell's own vectors.

    A cell's own vectors are held; visitors pass by in blocks. Per vector and cell there is at
    most one count, and at most one edge besides those that join sets.
    """
    name, cell = None, _Cell()
    nothing = np.zeros(0, dtype=np.int64)

    def end(cell):
        yield from _found(cell.close(least), nothing, nothing)
        if cell.links is not None:
            yield from _found([], cell.reps, cell.links)

    for batch in batches:
        for line in batch.to_pylist():
            if line["cell"] != name:
                yield from end(cell)
                name, cell = line["cell"], _Cell()
            reps = np.frombuffer(line["reps"], dtype=np.int64)
            weights = np.frombuffer(line["weights"], dtype=np.int64)
            units = np.frombuffer(line["vectors"], dtype=np.float64).reshape(len(reps), -1)
            if not line["visiting"]:
                cell.add(reps, weights, units)
                continue
            yield from _found(cell.close(least), nothing, nothing)
            yield from _found(*cell.visit(reps, weights, units, least))
    yield from end(cell)


def near_groups(
    vectors: DataFrame,
    least: float = 0.9,
    cell_rows: int = 4096,
    max_pivots: int = 512,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Link all pairs of vectors with cosine ``least`` or more, and group them.

    Returns, per row, ``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` (the
    smallest id reachable by links, its own included) and ``kept`` (the two are equal).

    The join is exact. Equal vectors are taken as one with a weight. Pivots (about one for each
    ``cell_rows`` vectors, ``max_pivots`` at most, drawn by a hash) divide the others by the
    smallest angle; a cell of more than ``cell_rows`` is split, so none grows with the data, and
    the triangle inequality says in which cells a vector may have partners. Cells are compared
    independently, blocks of visitors against the cell's own vectors in double precision, and give
    counts and a spanning set of edges, never all pairs.

    A null or empty vector, one with a null or non-finite component, and a zero vector link with
    nothing: ``n_links`` 0, its own component. Vectors of different lengths do not link. Rows that
    share an id are separate rows for the counts. A row with a null id is counted as a link of
    others; its own component is that of its vector, null if no row of the component has an id.
    An empty table gives an empty table; other columns are ignored.
    """
    spark = vectors.sparkSession
    angle = math.acos(least)
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    nonzero = F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(finite & nonzero, F.lit(False)))
    usable = rows.where("usable")
    distinct = stored(
        usable.groupBy("vector")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("least_id"))
        .withColumn("rep", F.coalesce("least_id", -1 - F.abs(F.xxhash64("vector") % (1 << 62))))
    )
    n = distinct.count()
    drawn = (
        distinct.orderBy(F.xxhash64("vector"), "rep")
        .limit(min(max_pivots, max(1, -(-n // cell_rows))))
        .select("vector")
        .collect()
    )
    lengths = [r["n"] for r in distinct.select(F.size("vector").alias("n")).distinct().collect()]
    by_length = {}
    for row in drawn:
        by_length.setdefault(len(row["vector"]), []).append(row["vector"])
    for size in lengths:  # every length that occurs has a pivot of its own
        by_length.setdefault(size, [[1.0] + [0.0] * (size - 1)])
    pivots, at = {}, 0
    for size, found in sorted(by_length.items()):
        table = _matrix(pa.array(found, pa.list_(pa.float64())))
        pivots[size] = (np.arange(at, at + len(found)), table)
        at += len(found)
    sizes = (
        distinct.select("vector")
        .mapInArrow(partial(_homes, pivots=pivots), "pivot bigint, n bigint")
        .groupBy("pivot")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.ones(at, dtype=np.int64)
    for row in sizes:
        counts[row["pivot"]] = max(1, -(-row["n"] // cell_rows))
    cells = np.stack((np.cumsum(counts) - counts, counts), axis=1)
    found = stored(
        distinct.select("vector", "rep", "weight")
        .mapInArrow(partial(_deal, pivots=pivots, cells=cells, angle=angle), _PACKED)
        .repartition(max(shuffle_partitions(spark), 1), "cell")
        .sortWithinPartitions("cell", "visiting")
        .mapInArrow(partial(_compare, least=least), _FOUND)
    )
    links = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("links"))
    components = connected_components(found.where("b is not null").select("a", "b"))
    # Stand-ins for vectors without an id are negative and may not name a component.
    members = distinct.select("vector", "rep", "weight", "least_id").join(
        components, F.col("rep") == F.col("vertex"), "left"
    )
    named = (
        members.withColumn("root", F.coalesce("component_id", "rep"))
        .join(
            members.groupBy(F.coalesce("component_id", "rep").alias("root")).agg(
                F.min("least_id").alias("name")
            ),
            "root",
        )
        .join(links, F.col("rep") == F.col("a"), "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.col("name").alias("component_id"),
        )
    )
    linked = usable.select("vec_id", "vector").join(named, "vector").select(
        "vec_id", "n_links", "component_id"
    )
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
