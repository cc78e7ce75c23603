"""Packing: documents laid end to end and cut into sequences of one length."""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import slices
from tillworks.llm.storage import stored

#: Words whose ids a task remembers; then it starts again.
_REMEMBERED = 600_000
#: Texts with one of these are cut as a whole: strings of special tokens, and characters that
#: not every rule takes for white space.
_ODD = (
    r"<\||[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f"
    r"\u205f-\u2064\u3000\ufeff]"
)
_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint,"
    " sequence_id bigint, offset bigint"
)


#: Splits letters, single digits and the rest apart, and drops white space (a fixed value of the
#: tokenizer's file).
_LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters whose normal form and lower case are one letter each, and marks behind them.
_STEM = r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!\"#$%&()*+,\-./:;=>?@\[\]^_{|}~]*)"


def _stems_apart(tokenizer) -> bool:
    """Whether a word's letters and the marks behind them are cut on their own, letters in lower
    case."""
    import json

    parts = json.loads(tokenizer.to_str())
    forms = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
    splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        forms == ["NFC", "Replace", "Lowercase"]
        and [p["type"] for p in splits] == ["Split", "ByteLevel"]
        and splits[0]["pattern"].get("Regex") == _LETTERS_APART
        and not splits[1]["add_prefix_space"]
        and not splits[1].get("use_regex", True)
    )


def encoder(path: str):
    """A function from texts to their ids as bytes, and the type of an id.

    The tokenizer cuts words apart at white space and drops it, so the ids of a text are those of
    its words; each word's are looked up once and remembered. Where the tokenizer also cuts
    letters and marks apart, the letters go to its model at once, so that a stem is cut once
    whatever marks and capitals it comes with.
    """
    import os
    import re

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(path)
    kind = np.dtype("<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
    odd = re.compile(_ODD)
    stem_of = re.compile(_STEM).fullmatch if _stems_apart(tokenizer) else None
    as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    letters = {c: as_bytes(chr(c))[0][0] for c in range(0xC0, 0x100)}
    cut_stem = tokenizer.model.tokenize
    known, stems = {}, {}

    def packed(ids):
        return np.array(ids, dtype=kind).tobytes()

    def cut(texts):
        return [packed(f.ids) for f in tokenizer.encode_batch(texts, add_special_tokens=False)]

    def learn(words):
        rest = []
        for word in words:
            parts = stem_of(word) if stem_of else None
            if not parts:
                rest.append(word)
                continue
            stem, marks = parts[1].lower(), parts[2]
            ids = stems.get(stem)
            if ids is None:
                text = stem if stem.isascii() else stem.translate(letters)
                ids = stems[stem] = packed([t.id for t in cut_stem(text)])
            if marks:
                if marks not in stems:
                    stems[marks] = cut([marks])[0]
                ids += stems[marks]
            known[word] = ids
        known.update(zip(rest, cut(rest)))

    def encode(texts):
        plain = [None if odd.search(t) else t.split() for t in texts]
        new = {w for words in plain if words for w in words} - known.keys()
        if len(known) + len(new) > _REMEMBERED:
            known.clear()
            stems.clear()
            new = {w for words in plain if words for w in words}
        learn(new)
        return [
            cut([t])[0] if words is None else b"".join(map(known.__getitem__, words))
            for t, words in zip(texts, plain)
        ]

    return encode, kind


def _encoded(batches, path, end):
    """Ids of every document, and where they start within the task's own run of ids."""
    encode, kind = encoder(path)
    task, at = TaskContext.get().partitionId(), 0
    last = np.array([end], dtype=kind).tobytes()
    for batch in batches:
        for part in slices(batch, "text"):
            texts = ["" if t is None else t for t in part.column(1).to_pylist()]
            ids = [x + last for x in encode(texts)]
            counts = np.array([len(x) // kind.itemsize for x in ids], dtype=np.int64)
            starts = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), task, dtype=np.int32)),
                    pa.array(starts),
                    pa.array(counts),
                    part.column(0),
                    pa.array(np.full(len(ids), kind.itemsize, dtype=np.int32)),
                    pa.array(ids, pa.binary()),
                ],
                names=["task", "at", "n", "doc_id", "width", "ids"],
            )


def _pieces(batches, length):
    """Cut each document where a sequence ends."""
    names = [c.split()[0] for c in _PIECES.split(", ")]
    types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
    for batch in batches:
        lines = []
        size = 0
        for doc, at, n, width, ids in zip(*(c.to_pylist() for c in batch.columns)):
            ids = np.frombuffer(ids, dtype=f"<u{width}").astype("<u4")
            start = 0
            while start < n:
                sequence, offset = divmod(at + start, length)
                stop = min(n, start + length - offset)
                lines.append([doc, start, stop - start, ids[start:stop].tobytes(), n, sequence, offset])
                size += stop - start
                start = stop
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*lines), types)], names=names
                    )
                    lines, size = [], 0
        if lines:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*lines), types)], names=names
            )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = 4096,
    end: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Lay the ids of all documents end to end, each followed by ``end``, and cut every ``length``.

    Returns one row per piece of a document that lies in one sequence: ``doc_id``, ``start`` (its
    document's ids before it), ``length``, ``ids`` (little-endian, 4 bytes each), ``doc_tokens``
    (with the end), ``sequence_id``, and ``offset`` in the sequence. All sequences but the last
    are full. The first pass writes each document's ids, with their place in the run of its task,
    to the shared folder; the totals per task, one row each, are summed to global offsets; the
    second pass cuts.

    Null and empty texts have the end alone; repeated rows are packed each; a null id stays. An
    empty table gives an empty table; other columns are ignored. The tokenizer must drop white
    space and cut words apart there; ``tokenizer_path`` is the same on every executor.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    encoded = stored(
        rows.mapInArrow(
            partial(_encoded, path=tokenizer_path, end=end),
            "task int, at bigint, n bigint, doc_id bigint, width int, ids binary",
        )
    )
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        encoded.groupBy("task")
        .agg(F.max(F.col("at") + F.col("n")).alias("total"))
        .select(F.col("task"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    )
    # One row per task of the first pass.
    placed = encoded.join(F.broadcast(offsets), "task").select(
        "doc_id", (F.col("base") + F.col("at")).alias("at"), "n", "width", "ids"
    )
    return placed.mapInArrow(partial(_pieces, length=length), _PIECES)
