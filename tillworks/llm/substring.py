"""Substring dedup: passages that an earlier document holds are cut out."""

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import ranges, rolling_hashes, slices, text_bytes, word_hashes
from tillworks.llm.storage import bucket_bits

#: Hashes travel as their low 7 bytes, and as the bucket that their high bits name.
_TALLY = (
    "bucket int, docs binary, counts binary, gaps binary, hashes binary,"
    " gone_docs binary, gone_counts binary, gone_gaps binary"
)
_MARKS = "id bigint, bucket int, places binary"


def _windows(data, offsets, width):
    """Hashes of all windows of all rows, and how many each row has."""
    words, counts = word_hashes(data, offsets)
    hashes = rolling_hashes(words, width)
    per_row = np.maximum(counts - width + 1, 0)
    starts = np.repeat(np.cumsum(counts) - counts, per_row) + ranges(per_row)
    return hashes[starts], per_row


def _grouped(ids, ordinals):
    """Runs of equal ids: the ids, their lengths, and ordinals as gaps (mostly 0) in each run."""
    new = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1)) if len(ids) else np.zeros(0, int)
    counts = np.diff(np.append(new, len(ids))).astype(np.uint32)
    gaps = np.diff(ordinals, prepend=0) - 1
    gaps[new] = ordinals[new]
    return ids[new].astype(np.int64), counts, gaps.astype(np.uint32)


def _ungrouped(counts, gaps):
    """The ordinals of ``_grouped``."""
    counts = np.frombuffer(counts, dtype=np.uint32).astype(np.int64)
    steps = np.frombuffer(gaps, dtype=np.uint32).astype(np.int64) + 1
    sums = np.cumsum(steps)
    before = np.repeat((sums - steps)[np.cumsum(counts) - counts], counts) if len(steps) else steps
    return counts, sums - before - 1


def _tally(batches, width, bits):
    """Per slice of documents and bucket: the hashes that occur, each with its smallest document.

    What a slice can decide alone, it decides: a window that a smaller document of the slice has
    too is gone. So however often a passage occurs, a slice sends its hash once.
    """
    shift = np.uint64(64 - bits)
    for batch in batches:
        for part in slices(batch, "text"):
            part = part.take(pc.sort_indices(part.column(0)))
            ids = part.column(0).to_numpy(zero_copy_only=False)
            hashes, per_row = _windows(*text_bytes(part.column(1)), width)
            if not len(hashes):
                continue
            owner = np.repeat(ids, per_row)
            order = np.argsort(hashes, kind="stable")
            by_hash = hashes[order]
            new = np.concatenate(([True], by_hash[1:] != by_hash[:-1]))
            first = np.empty(len(order), dtype=bool)
            first[order] = new
            smallest = np.empty(len(order), dtype=ids.dtype)
            smallest[order] = owner[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
            gone = owner > smallest
            # Place of each window among its document's windows of the same bucket.
            bucket = (hashes >> shift).astype(np.int32)
            to_bucket = np.argsort(bucket, kind="stable")
            row = np.repeat(np.arange(len(ids)), per_row)[to_bucket]
            sizes = np.bincount(bucket, minlength=1 << bits)
            key = bucket[to_bucket].astype(np.int64) * len(ids) + row
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            place = ranges(np.diff(np.append(starts, len(key))))
            first, gone, hashes = first[to_bucket], gone[to_bucket], hashes[to_bucket]
            residue = np.frombuffer(hashes.tobytes(), dtype=np.uint8).reshape(-1, 8)[:, :7]
            ends = np.cumsum(sizes)
            out = []
            for b in np.flatnonzero(sizes):
                span = slice(ends[b] - sizes[b], ends[b])
                line = [int(b)]
                for which in (first[span], gone[span]):
                    # By row, not id: two rows with one id count their windows apart.
                    rows, counts, gaps = _grouped(row[span][which], place[span][which])
                    line += [ids[rows].astype(np.int64).tobytes(), counts.tobytes(), gaps.tobytes()]
                line.insert(4, residue[span][first[span]].tobytes())
                out.append(line)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*out), [pa.int32()] + [pa.binary()] * 7)],
                names=[c.split()[0] for c in _TALLY.split(", ")],
            )


def _decide(table: pa.Table) -> pa.Table:
    """One bucket: a window is gone where a smaller document has the same hash."""
    owner, place, hashes, gone_owner, gone_place = [], [], [], [], []
    for line in table.select(range(1, 8)).to_pylist():
        docs = np.frombuffer(line["docs"], dtype=np.int64)
        counts, places = _ungrouped(line["counts"], line["gaps"])
        owner.append(np.repeat(docs, counts))
        place.append(places)
        packed = np.zeros((len(places), 8), dtype=np.uint8)
        packed[:, :7] = np.frombuffer(line["hashes"], dtype=np.uint8).reshape(-1, 7)
        hashes.append(packed.view(np.uint64).ravel())
        docs = np.frombuffer(line["gone_docs"], dtype=np.int64)
        counts, places = _ungrouped(line["gone_counts"], line["gone_gaps"])
        gone_owner.append(np.repeat(docs, counts))
        gone_place.append(places)
    bucket = table.column("bucket")[0].as_py()
    owner, place, hashes = map(np.concatenate, (owner, place, hashes))
    order = np.argsort(hashes, kind="stable")
    by_hash, by_owner = hashes[order], owner[order]
    starts = np.flatnonzero(np.concatenate(([True], by_hash[1:] != by_hash[:-1]))[: len(order)])
    if len(starts):
        smallest = np.minimum.reduceat(by_owner, starts)
        late = by_owner > np.repeat(smallest, np.diff(np.append(starts, len(order))))
        gone_owner.append(by_owner[late])
        gone_place.append(place[order][late])
    owner, place = np.concatenate(gone_owner), np.concatenate(gone_place)
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order].astype(np.uint32)
    starts = np.flatnonzero(np.diff(owner, prepend=owner[:1] - 1)) if len(owner) else []
    ends = np.append(starts[1:], len(owner)).astype(int) if len(starts) else []
    return pa.table(
        {
            "id": pa.array(owner[starts] if len(starts) else [], pa.int64()),
            "bucket": pa.array([bucket] * len(starts), pa.int32()),
            "places": pa.array([place[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
        }
    )


def _covered(data: np.ndarray, marks, width, bits) -> np.ndarray:
    """Which words of one document are covered by a window that is gone."""
    hashes, _ = _windows(data, np.array([0, len(data)]), width)
    if not len(hashes):
        return np.zeros(0, dtype=bool)
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(1 << bits))
    ends = np.append(starts[1:], len(order))
    hit = []
    for m in marks:
        at = starts[m["bucket"]] + np.frombuffer(m["places"], dtype=np.uint32).astype(np.int64)
        hit.append(order[at[at < ends[m["bucket"]]]])
    gone = np.isin(hashes, hashes[np.concatenate(hit)])
    depth = np.zeros(len(hashes) + width, dtype=np.int64)
    depth[:-width] += gone
    depth[width:] -= gone
    return np.cumsum(depth)[:-1] > 0


def _cut(batches, width, bits):
    """Remove what is covered; give the spans of removed words and the rest of the text."""
    for batch in batches:
        for part in slices(batch, "text"):
            texts = part.column(1).to_pylist()
            marks = part.column(2).to_pylist()
            n_words, n_removed, spans, kept = [], [], [], []
            for text, mark in zip(texts, marks):
                raw = (text or "").encode()
                words = raw.split()
                n_words.append(len(words))
                covered = np.zeros(0, dtype=bool)
                if mark:
                    covered = _covered(np.frombuffer(raw, dtype=np.uint8), mark, width, bits)
                if covered.any():
                    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                    spans.append([(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])])
                    pieces, at = [], 0
                    for a, b in zip(edges[::2], edges[1::2]):
                        pieces += words[at:a]
                        at = b
                    words = pieces + words[at:]
                else:
                    spans.append([])
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                    pa.array(kept, pa.string()),
                ],
                names=["id", "n_words", "n_removed", "removed", "kept_text"],
            )


def remove_repeated_passages(
    docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Cut out the words of every window of ``width`` words that a document with a smaller id has.

    Words are runs of anything but space, tab, LF, VT, FF and CR. Every window of every document is
    hashed (Rabin-Karp over words); Spark gathers equal hashes, and windows of all but the smallest
    document that holds them are gone. Windows are judged on the input. Returns, per row,
    ``doc_id, n_words, n_removed, removed, kept_text``: ``removed`` has the maximal spans of
    removed words as (start, length), ``kept_text`` the other words joined by one space.

    Null and empty texts, and texts shorter than a window, lose nothing. An id stands for one text:
    repeated rows never remove each other's words and all get the same result. Rows with a null id
    are returned whole and remove nothing. An empty table gives an empty table; other columns are
    ignored.

    Equal means equal hashes: 61 to 64 bits, by the number of buckets. A window that many documents
    share is sent once per slice of documents (4 MB of text), so no bucket grows with the number of
    copies.
    """
    bits = bucket_bits(docs.sparkSession)

    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    marks = (
        docs.where("id is not null and text is not null")
        .mapInArrow(partial(_tally, width=width, bits=bits), _TALLY)
        .groupBy("bucket")
        .applyInArrow(_decide, _MARKS)
        .groupBy("id")
        .agg(F.collect_list(F.struct("bucket", "places")).alias("marks"))
    )
    out = docs.join(marks, "id", "left").select("id", "text", "marks")
    schema = (
        "id bigint, n_words bigint, n_removed bigint,"
        " removed array<struct<start: bigint, length: bigint>>, kept_text string"
    )
    return out.mapInArrow(partial(_cut, width=width, bits=bits), schema).withColumnRenamed(
        "id", "doc_id"
    )
