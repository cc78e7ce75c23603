"""Token counts: every distinct pre-token is cut into pieces once."""

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import slices, text_bytes
from tillworks.llm.storage import bucket_bits

_SPACE, _BREAK = 0x20, 0x0A
_MARK = "▁".encode()
#: A line names a slice of documents; with ``docs`` it lists them, else it has one bucket's
#: pre-tokens and their frequencies.
_FREQUENCIES = (
    "bucket int, slice bigint, docs array<bigint>, sizes binary,"
    " tokens binary, lengths binary, spread binary, rows binary, times binary"
)
_SUMS = "slice bigint, docs array<bigint>, sizes binary, rows binary, sums binary"
_SUM_TYPES = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]


def _columns(lines, types, schema):
    columns = zip(*lines) if lines else [[] for _ in types]
    arrays = [pa.array(list(c), type=t) for c, t in zip(columns, types)]
    return arrays, [c.split()[0] for c in schema.split(", ")]


def _narrow(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on as bytes, each as wide as the largest needs; the width comes first."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return bytes([kind.itemsize]) + numbers.astype(kind).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"u{data[0]}", offset=1).astype(np.int64)


def pre_tokens(data: np.ndarray) -> np.ndarray:
    """Starts of the stretches that no piece of the vocabulary crosses.

    A stretch is a run of spaces with the word behind it; a line feed stands alone. Spaces are
    only ever a piece's first characters, and no piece holds a line feed, so the counts of a
    text's stretches add up to the count of the text.
    """
    space, feed = data == _SPACE, data == _BREAK
    first = feed.copy()
    first[1:] |= (space[1:] & ~space[:-1]) | feed[:-1]
    first[:1] = True
    return np.flatnonzero(first)


def counter(path: str):
    """A function from stretches (bytes) to their numbers of pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def count(stretches):
        # The library puts a space before every text. It stands for a stretch's own first space;
        # elsewhere it is parted from the stretch by a line feed, and both are taken off again.
        spaced = np.array([s.startswith(b" ") for s in stretches], dtype=bool)
        texts = [s[1:].decode() if own else "\n" + s.decode() for s, own in zip(stretches, spaced)]
        counts = np.array([len(p) for p in model.encode(texts, num_threads=1)], dtype=np.int64)
        counts[[not t for t in texts]] = 1  # an empty text has no pieces, a lone space has one
        return counts - np.where(spaced, 0, 2)

    return count


def _frequencies(batches, bits):
    """Per slice of documents and bucket of pre-tokens: the distinct ones, and how often each
    document has them."""
    number = 0
    types = [pa.int32(), pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * 6
    for batch in batches:
        for part in slices(batch, "text"):
            raw, offsets = text_bytes(part.column(1))
            sizes = np.diff(offsets)
            raw = raw.tobytes()
            texts = [
                b" " + raw[a:b].replace(_MARK, b" ") if b > a else b""
                for a, b in zip(offsets.tolist(), offsets[1:].tolist())
            ]
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
            whole = b"".join(texts)
            starts = pre_tokens(np.frombuffer(whole, dtype=np.uint8))
            starts = np.union1d(starts, offsets[:-1][np.diff(offsets) > 0])
            ends = np.append(starts[1:], len(whole))
            digest = xxhash.xxh64_intdigest
            spans = zip(starts.tolist(), ends.tolist())
            hashes = np.array([digest(whole[a:b]) for a, b in spans], dtype=np.uint64)
            row = np.searchsorted(offsets, starts, side="right") - 1
            distinct, at, token = np.unique(hashes, return_index=True, return_inverse=True)
            key, times = np.unique(token * part.num_rows + row, return_counts=True)
            token, row = key // part.num_rows, key % part.num_rows
            spread = np.bincount(token, minlength=len(at))
            buckets = (distinct >> np.uint64(64 - bits)).astype(np.int64)
            edges = np.searchsorted(buckets, np.arange((1 << bits) + 1))
            pairs = np.concatenate(([0], np.cumsum(spread)))[edges]
            name = (TaskContext.get().partitionId() << 32) + number
            number += 1
            docs = part.column(0).to_pylist()
            lines = [[number % (1 << bits), name, docs, sizes.tobytes()] + [None] * 5]
            for b in np.flatnonzero(np.diff(edges)):
                some, of = slice(edges[b], edges[b + 1]), slice(pairs[b], pairs[b + 1])
                tokens = [whole[starts[i] : ends[i]] for i in at[some]]
                numbers = (np.array([len(t) for t in tokens]), spread[some], row[of], times[of])
                lines.append([int(b), name, None, None, b"".join(tokens), *map(_narrow, numbers)])
            yield pa.RecordBatch.from_arrays(*_columns(lines, types, _FREQUENCIES))


def _weigh(table, path):
    """One bucket: count the pieces of its distinct pre-tokens, and weigh the frequencies."""
    out, lines, number = [], [], {}
    for line in table.to_pylist():
        if line["docs"] is not None:
            out.append([line["slice"], line["docs"], line["sizes"], None, None])
            continue
        ends = np.cumsum(_numbers(line["lengths"])).tolist()
        tokens = [line["tokens"][a:b] for a, b in zip([0] + ends, ends)]
        line["numbers"] = [number.setdefault(t, len(number)) for t in tokens]
        lines.append(line)
    counts = counter(path)(list(number)) if number else None
    for line in lines:
        each = np.repeat(counts[line["numbers"]], _numbers(line["spread"]))
        rows, at = np.unique(_numbers(line["rows"]), return_inverse=True)
        sums = np.bincount(at, weights=each * _numbers(line["times"])).astype(np.int64)
        out.append([line["slice"], None, None, _narrow(rows), _narrow(sums)])
    arrays, names = _columns(out, _SUM_TYPES, _SUMS)
    return pa.table(arrays, names=names)


def _add(table: pa.Table) -> pa.Table:
    """One slice of documents: add up what its buckets give."""
    lines = table.to_pylist()
    listed = next(line for line in lines if line["docs"] is not None)
    total = np.zeros(len(listed["docs"]), dtype=np.int64)
    for line in lines:
        if line["docs"] is None:
            total[_numbers(line["rows"])] += _numbers(line["sums"])
    return pa.table(
        {
            "doc_id": pa.array(listed["docs"], pa.int64()),
            "n_bytes": pa.array(np.frombuffer(listed["sizes"], dtype=np.int64)),
            "n_tokens": pa.array(total),
        }
    )


def token_counts(
    docs: DataFrame,
    model_path: str,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, as the sentencepiece model counts.

    ``model_path`` names a BPE model without text normalisation, whose pieces hold spaces only as
    first characters, at the same place on every executor. Slices of documents (about 4 MB) list
    their distinct pre-tokens and how often each document has them; Spark brings equal pre-tokens
    together, each is cut once, and the weighted counts go back to the slices to be added. No ids
    are kept.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; a null id
    stays. An empty table gives an empty table; other columns are ignored. Slices are numbered per
    task, so the input must give the same partitions when read again (a table does).
    """
    bits = bucket_bits(docs.sparkSession)

    def weigh(table: pa.Table) -> pa.Table:
        return _weigh(table, model_path)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (
        rows.mapInArrow(partial(_frequencies, bits=bits), _FREQUENCIES)
        .groupBy("bucket")
        .applyInArrow(weigh, _SUMS)
        .groupBy("slice")
        .applyInArrow(_add, "doc_id bigint, n_bytes bigint, n_tokens bigint")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
