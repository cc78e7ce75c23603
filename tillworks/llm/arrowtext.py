"""Helpers for vectorised work on columns of text inside tasks."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20
#: Space, tab, line feed, vertical tab, form feed and carriage return.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def text_bytes(column):
    """A text column as one run of UTF-8 bytes and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cut a batch so that each slice holds about ``limit`` bytes of text, and a row at least."""
    if not batch.num_rows:
        return
    values = batch.column(batch.schema.get_field_index(column))
    lengths = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit mixer: every bit of the input moves every bit out."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(n: int, factor: np.uint64) -> np.ndarray:
    """1, b, b^2, ... modulo 2^64."""
    out = np.full(max(n, 1), factor, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _cuts(data: np.ndarray, limit: int):
    """Places to cut a long run of bytes, each just after white space."""
    start = 0
    while len(data) - start > limit:
        stop = start + limit
        while stop < len(data) and not IS_SPACE[data[stop]]:
            stop += 1
        yield start, stop
        start = stop
    yield start, len(data)


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """A 64-bit polynomial hash of every word, and how many words each row has."""
    hashes, places = [], []
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    for low, high in _cuts(data, SLICE_BYTES):
        part = data[low:high]
        if not len(part):
            continue
        solid = ~IS_SPACE[part]
        first = solid.copy()
        first[1:] &= ~solid[:-1] | edge[low + 1 : high]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        letters = part[solid].astype(np.uint64) + np.uint64(1)
        before = np.cumsum(solid) - 1
        begins = before[starts]
        lengths = np.diff(np.append(begins, len(letters)))
        within = np.arange(len(letters)) - np.repeat(begins, lengths)
        letters *= powers(int(lengths.max()), _BASE)[within]
        sums = np.add.reduceat(letters, begins)
        hashes.append(mix(sums ^ (lengths.astype(np.uint64) * _BASE)))
        places.append(starts + low)
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets) - 1, dtype=np.int64)
    places = np.concatenate(places)
    counts = np.diff(np.searchsorted(places, offsets))
    return np.concatenate(hashes), counts


def rolling_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The Rabin-Karp hash, modulo 2^64, of every run of ``width`` words.

    A window's polynomial is the difference of two prefix sums, brought to a common power by the
    inverse of the (odd) base.
    """
    n = len(words)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * powers(n, _BASE), out=prefix[1:])
    sums = prefix[width:] - prefix[:-width]
    return mix(sums * powers(len(sums), _INVERSE))


def ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, ..., c - 1 for each count c, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def carried_columns(names) -> Column:
    """Columns that go through a function on batches untouched, as one struct ``carried``."""
    packed = F.struct(*[F.col(f"`{n}`") for n in names]) if names else F.lit(None).cast("string")
    return packed.alias("carried")
