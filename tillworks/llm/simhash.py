"""SimHash near-dedup: documents whose 64-bit fingerprints differ in few bits."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import ranges, slices
from tillworks.llm.graph import connected_components
from tillworks.llm.storage import shuffle_partitions, stored

#: Fingerprints link at this many differing bits or fewer. With two segments of 32 bits, one of
#: the two then differs by one bit at most.
MAX_BITS = 3
_HALF = 32
#: Larger groups of one signature are split by segments of the other half before pairs are compared.
_PAIRWISE = 64
_TILE = 1024


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text: a bit is 1 if over half of the shingles' XXH64 have it.

    A-Z are lower-cased, words are split at ASCII white space, and each run of ``shingle`` words,
    repeats included, counts once; with fewer words the whole sequence is the only shingle. No
    words give zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        rows = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            prints = [fingerprint((t or "").encode()) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.array(prints, dtype=np.uint64).view(np.int64))],
                names=["doc_id", "print"],
            )


def _signatures(fingerprint: Column) -> Column:
    """For each half and each of its bits: the half without that bit."""
    keys = []
    for half in range(2):
        part = F.shiftrightunsigned(fingerprint, _HALF * half).bitwiseAND(F.lit((1 << _HALF) - 1))
        for bit in range(_HALF):
            tag = (half * _HALF + bit) << _HALF
            keys.append(part.bitwiseAND(F.lit(~(1 << bit))).bitwiseOR(F.lit(tag)))
    return F.explode(F.array(*keys))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n items the smallest item reachable over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        while True:
            further = after[after]
            if np.array_equal(further, after):
                break
            after = further
        if np.array_equal(after, label):
            return label
        label = after


def _runs(keys: np.ndarray):
    """Starts and lengths of the runs of equal keys."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return starts, np.diff(np.append(starts, len(keys)))


def _near(prints, a, b):
    close = np.bitwise_count(prints[a] ^ prints[b]) <= MAX_BITS
    return a[close], b[close]


def _pairs_in_small_runs(prints, starts, counts):
    """Pairs of near fingerprints in runs, item against the item ``lag`` places on."""
    item = np.repeat(starts, counts) + ranges(counts)
    end = np.repeat(starts + counts, counts)
    found = []
    for lag in range(1, int(counts.max(initial=1))):
        item, end = item[item + lag < end], end[item + lag < end]
        found.append(_near(prints, item, item + lag))
    return found


def _links_in_large_run(prints):
    """Links that connect what is near within one large group; at most one per member.

    Near members differ by at most one bit in one quarter of the other half too, so they meet in
    the groups of those variants; what is still large is compared tile by tile. The comparison
    never holds more than a tile of pairs, and only roots go on.
    """
    n = len(prints)
    label = np.arange(n)

    def join(a, b):
        nonlocal label
        label = _roots(n, np.concatenate((np.arange(n), a)), np.concatenate((label, b)))

    for quarter in range(4):
        piece = (prints >> np.uint64(16 * quarter)) & np.uint64(0xFFFF)
        for bit in range(16):
            key = piece & ~np.uint64(1 << bit)
            order = np.argsort(key, kind="stable")
            starts, counts = _runs(key[order])
            ordered = prints[order]
            small = (counts > 1) & (counts <= _PAIRWISE)
            for a, b in _pairs_in_small_runs(ordered, starts[small], counts[small]):
                join(order[a], order[b])
            for start, count in zip(starts[counts > _PAIRWISE], counts[counts > _PAIRWISE]):
                for i in range(start, start + count, _TILE):
                    for j in range(i, start + count, _TILE):
                        left = ordered[i : min(i + _TILE, start + count)]
                        right = ordered[j : min(j + _TILE, start + count)]
                        near = np.bitwise_count(left[:, None] ^ right[None, :]) <= MAX_BITS
                        x, y = np.nonzero(near)
                        join(order[i + x], order[j + y])
    return label


def _links(batches):
    """Rows sorted by signature: links between near fingerprints of one signature.

    Groups are gathered across batches. A group holds distinct fingerprints only, 24 bytes each.
    """
    keep = None

    def of(key, prints, reps):
        starts, counts = _runs(key)
        small = (counts > 1) & (counts <= _PAIRWISE)
        pairs = _pairs_in_small_runs(prints, starts[small], counts[small])
        if pairs:
            a, b = (np.concatenate(x) for x in zip(*pairs))
            used, at = np.unique(np.concatenate((a, b)), return_inverse=True)
            label = _roots(len(used), at[: len(a)], at[len(a) :])
            moved = label != np.arange(len(used))
            yield reps[used[moved]], reps[used[label[moved]]]
        for start, count in zip(starts[counts > _PAIRWISE], counts[counts > _PAIRWISE]):
            label = _links_in_large_run(prints[start : start + count])
            moved = label != np.arange(count)
            yield reps[start : start + count][moved], reps[start + label[moved]]

    def rows(key, prints, reps):
        for a, b in of(key, prints, reps):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        new[1] = new[1].view(np.uint64)
        if keep:
            new = [np.concatenate(x) for x in zip(keep, new)]
        last = int(np.searchsorted(new[0], new[0][-1])) if len(new[0]) else 0
        yield from rows(*(x[:last] for x in new))
        keep = [x[last:] for x in new]
    if keep:
        yield from rows(*keep)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, print)``: the fingerprint of each row as the bits of a bigint."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(_fingerprints, "doc_id bigint, print bigint")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents whose fingerprints are linked by chains of three bits or fewer.

    Returns, per row, ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id that can be reached. Copies share one fingerprint, so only distinct fingerprints
    are compared: each is cut into two segments of 32 bits, of which one differs by at most one
    bit, and is indexed under each segment with each single bit left out (64 signatures). Equal
    signatures meet and are verified, and a group of one signature gives at most one link per
    member.

    Null and empty texts have fingerprint zero and are linked like any other. Repeated rows get
    the same result. A row with a null id gets the component of its fingerprint; a fingerprint
    that only such rows have links nothing and has a null component. An empty table gives an
    empty table; other columns are ignored.
    """
    marked = stored(fingerprints(docs, id_col, text_col))
    prints = stored(marked.groupBy("print").agg(F.min("doc_id").alias("rep")))
    n = shuffle_partitions(docs.sparkSession)
    links = (
        prints.where("rep is not null")
        .select(_signatures(F.col("print")).alias("signature"), "print", "rep")
        .repartition(n, "signature")
        .sortWithinPartitions("signature")
        .mapInArrow(_links, "a bigint, b bigint")
    )
    components = connected_components(links)
    labelled = prints.join(components, prints.rep == components.vertex, "left").select(
        "print", F.coalesce("component_id", "rep").alias("component_id")
    )
    return marked.join(labelled, "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
