"""Importance resampling towards a target: hashed n-gram buckets, gains, and a weighted draw."""

import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import carried_columns, slices, text_bytes
from tillworks.llm.numbering import numbered
from tillworks.llm.storage import stored

#: Words in a task's dictionary. Other words are looked at one by one, with the same result.
DICTIONARY = 50_000
#: Every ASCII character that is no letter or digit parts words; A-Z become a-z; the bytes of
#: other characters stay.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = ord(" ")
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B)):
    _PLAIN[_low:_high] = np.arange(_low, _high)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
_POLYNOMIAL = 0xEDB88320


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    return table


class Shifts:
    """What a CRC-32 becomes when more bytes follow: ``crc(a + b) = after(crc(a), len(b)) ^ crc(b)``.

    Appending zero bytes is linear in the bits of the CRC, so one table of 4 x 256 values does it
    for a power of two of bytes; a length is a sum of powers.
    """

    def __init__(self):
        low = _byte_table()
        bits = np.array([1 << k for k in range(32)], dtype=np.uint32)
        self._tables = []
        images = (bits >> np.uint32(8)) ^ low[bits & np.uint32(255)]  # one more byte
        for _ in range(32):
            table = np.zeros((4, 256), dtype=np.uint32)
            for byte in range(4):
                for bit in range(8):
                    having = (np.arange(256) >> bit & 1).astype(bool)
                    table[byte, having] ^= images[8 * byte + bit]
            self._tables.append(table)
            images = self._apply(table, images)  # twice as many bytes

    @staticmethod
    def _apply(table, crc):
        return (
            table[0][crc & np.uint32(255)]
            ^ table[1][crc >> np.uint32(8) & np.uint32(255)]
            ^ table[2][crc >> np.uint32(16) & np.uint32(255)]
            ^ table[3][crc >> np.uint32(24)]
        )

    def after(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = crc.copy()
        left = lengths.copy()
        for table in self._tables:
            if not left.any():
                break
            odd = np.flatnonzero(left & 1)
            out[odd] = self._apply(table, out[odd])
            left >>= 1
        return out


class Scanner:
    """Finds the words of texts and gives each its CRC-32 and its length in bytes.

    The dictionary is an Aho-Corasick automaton over words with the delimiter on both sides, so
    that a match is always a whole word; its payloads are places in the arrays of CRCs and
    lengths. It is made of the most frequent words of the first slice, and again when a slice has
    more than half of its words outside.
    """

    def __init__(self, limit: int = DICTIONARY):
        self._limit, self._automaton = limit, None

    def _learn(self, text: str) -> None:
        import ahocorasick

        counts = Counter(text.split(" "))
        del counts[""]
        chosen = [word for word, _ in counts.most_common(self._limit)]
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        coded = [w.encode() for w in chosen]
        self._crc = np.array([zlib.crc32(w) for w in coded], dtype=np.uint32)
        self._size = np.array([len(w) for w in coded], dtype=np.int64)
        for number, word in enumerate(chosen):
            self._automaton.add_word(f" {word} ", number)
        self._automaton.make_automaton()

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """CRC and length of every word, and the number of words of each row."""
        plain = np.full(len(data) + len(offsets), ord(" "), dtype=np.uint8)
        rows = len(offsets) - 1
        # One delimiter stands before each row, and one after the last.
        plain[np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))] = _PLAIN[data]
        solid = plain != ord(" ")
        edge = np.flatnonzero(solid[1:] != solid[:-1])  # the last byte before a change
        starts, ends = edge[0::2] + 1, edge[1::2] + 1
        counts = np.diff(np.searchsorted(starts, offsets + np.arange(rows + 1)))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), counts
        # Runs of delimiters become one, so that neighbours share it.
        keep = solid.copy()
        keep[1:] |= solid[:-1]
        keep[0] = True
        tight = plain[keep]
        text = tight.tobytes().decode()
        if self._automaton is None:
            self._learn(text)
        crc, known = self._scan(text, tight, len(starts))
        if 2 * known.sum() < len(starts):
            self._learn(text)
            crc, known = self._scan(text, tight, len(starts))
        raw = plain.tobytes()
        rest = np.flatnonzero(~known)
        spans = zip(starts[rest].tolist(), ends[rest].tolist())
        crc[rest] = np.fromiter((zlib.crc32(raw[a:b]) for a, b in spans), np.uint32, len(rest))
        return crc, ends - starts, counts

    def _scan(self, text: str, tight: np.ndarray, words: int):
        """CRCs of the words that the automaton emits, and which they are."""
        found = list(self._automaton.iter(text))
        crc, known = np.zeros(words, dtype=np.uint32), np.zeros(words, dtype=bool)
        if found:
            at, number = np.array(found, dtype=np.int64).T
            # A match ends at a delimiter: the k-th ends the k-th word (the first is before all).
            letters = tight[(tight & 0xC0) != 0x80]
            which = np.cumsum(letters == ord(" "))[at] - 2
            crc[which], known[which] = self._crc[number], True
        return crc, known


def feature_buckets(crc, sizes, counts, shifts: Shifts, n_gram: int, buckets: int):
    """Bucket of every run of 1 to ``n_gram`` words of each row, and the row it is in.

    The CRC of a run is composed from those of its words and of the space between them.
    """
    row = np.repeat(np.arange(len(counts)), counts)
    found, rows = [crc % buckets], [row]
    run, space = crc, np.full(len(crc), zlib.crc32(b" "), dtype=np.uint32)
    one = np.ones(len(crc), dtype=np.int64)
    spaced = shifts.after(crc, one) ^ space  # each word with the space behind it
    for k in range(1, n_gram):
        last = len(crc) - k
        if last <= 0:
            break
        head = spaced if k == 1 else shifts.after(run, one[: len(run)]) ^ space[: len(run)]
        run = shifts.after(head[:last], sizes[k:]) ^ crc[k:]
        inside = row[:last] == row[k:]
        found.append(run[inside] % buckets)
        rows.append(row[:last][inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(rows)


def _count(batches, n_gram, buckets):
    """One row per task and bucket that it has met."""
    scanner, shifts, total = Scanner(), Shifts(), np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            words = scanner.words(*text_bytes(part.column(0)))
            found, _ = feature_buckets(*words, shifts, n_gram, buckets)
            total += np.bincount(found, minlength=buckets)
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "features"])


def bucket_counts(texts: DataFrame, n_gram: int = 2, buckets: int = 10_000, text_col: str = "text") -> DataFrame:
    """``bucket, features``: how many features of all texts fall into each bucket that has any.

    Each task adds up its own, at most one row per bucket, before the shuffle.
    """
    rows = texts.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = rows.mapInArrow(partial(_count, n_gram=n_gram, buckets=buckets), "bucket bigint, features bigint")
    return counted.groupBy("bucket").agg(F.sum("features").alias("features"))


def gains(docs: DataFrame, target: DataFrame, n_gram: int = 2, buckets: int = 10_000, text_col: str = "text") -> np.ndarray:
    """Per bucket, 1000 times the log of how much likelier it is in ``target`` than in ``docs``.

    Both are smoothed by one feature per bucket, and the figure is floored. It is one number per
    bucket, and the only thing that the driver sees of the texts.
    """
    sides = [
        bucket_counts(side, n_gram, buckets, text_col).withColumn("side", F.lit(k))
        for k, side in enumerate((docs, target))
    ]
    table = np.zeros((2, buckets), dtype=np.int64)
    for r in sides[0].unionByName(sides[1]).collect():
        table[r["side"], r["bucket"]] = r["features"]
    (raw, aim), (all_raw, all_aim) = table, table.sum(axis=1).tolist()
    ratio = ((aim + 1) * float(all_raw + buckets)) / ((raw + 1) * float(all_aim + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(batches, gain, n_gram):
    scanner, shifts, buckets = Scanner(), Shifts(), len(gain)
    for batch in batches:
        for part in slices(batch, "text"):
            crc, sizes, counts = scanner.words(*text_bytes(part.column(0)))
            found, row = feature_buckets(crc, sizes, counts, shifts, n_gram, buckets)
            n = np.bincount(row, minlength=part.num_rows)
            # Sums of whole numbers under 2^53 are exact in doubles.
            total = np.bincount(row, weights=gain[found], minlength=part.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(1),
                    part.column(2),
                    pa.array(counts.astype(np.int64)),
                    pa.array(n.astype(np.int64)),
                    pa.array(total // np.maximum(n, 1)),
                ],
                names=["doc_id", "carried", "n_words", "n_features", "weight"],
            )


def weights(
    docs: DataFrame,
    gain: np.ndarray,
    n_gram: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry=(),
) -> DataFrame:
    """``doc_id, carried, n_words, n_features, weight``: the floored mean gain of each text's
    features (0 without any); ``carry`` names columns that go along in the struct ``carried``."""
    rows = docs.select(
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        carried_columns(carry),
    )
    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(
        partial(_weigh, gain=gain, n_gram=n_gram),
        f"doc_id bigint, carried {kind}, n_words bigint, n_features bigint, weight bigint",
    )


def gumbel(id_col: str = "doc_id", seed: int = 7) -> Column:
    """A draw from the standard Gumbel distribution that depends on the id alone, times 1000 and
    floored."""
    text = F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))
    head = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((head + 0.5) / F.lit(float(1 << 32))))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    min_words: int = 20,
    n_gram: int = 2,
    buckets: int = 10_000,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Draw documents without replacement, likelier the more they look like ``target``.

    Words are runs of ASCII letters, digits and any characters beyond ASCII, with A-Z in lower
    case; features are all runs of 1 to ``n_gram`` words, in buckets by the CRC-32 of their bytes.
    A document's weight is the floored mean of its features' ``gains``; its score adds Gumbel
    noise, and the ``percent`` highest scores of those with ``min_words`` words or more are drawn
    (ties to the smaller id). Returns ``doc_id, n_features, weight, score, rank`` of every row;
    ``rank`` (1, 2, 3 ...) is null for what is not drawn.

    Both passes read whole texts; a text costs its own size in memory several times over. The
    ranks are counted by ranges of the score, in many tasks.

    Null and empty texts have no features and weight 0. Rows without an id are not drawn and have
    no score. Rows that repeat are counted, and drawn, each; those with equal id and score get
    neighbouring ranks in any order. An empty table gives an empty table, an empty target gives
    gains that depend on ``docs`` alone. Other columns are ignored.
    """
    gain = gains(docs, target, n_gram, buckets, text_col)
    scored = weights(docs, gain, n_gram, id_col, text_col).select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + gumbel(seed=seed)).alias("score")
    )
    able = ((F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()).alias("able")
    placed = numbered(stored(scored.select("*", able)), [F.desc("score"), F.col("doc_id")], ["able"])
    drawn = F.col("able") & (F.col("place") < F.floor(F.col("n") * percent / 100))
    return placed.select(
        "doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place") + 1).alias("rank")
    )
