"""Language ID by n-gram filters that answer for all languages at once."""

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import carried_columns, mix, slices

UNKNOWN = "und"
_FACTORS = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PROBES = 3
#: Text that is worked on at once.
_SLICE = 1 << 20
#: Characters whose n-grams are in memory at once: they take about a hundred times their size.
_BLOCK = 1 << 17


@dataclass
class LanguageFilter:
    """Languages, and a Bloom filter whose cells hold one bit per language.

    The bitwise and of an n-gram's cells has the bits of all languages that contain it, and of
    some that do not: ``wrong`` is the share of n-grams for which a language's bit comes up by
    chance.
    """

    languages: list[str]
    cells: np.ndarray  # cells x words of 64 languages
    wrong: np.ndarray

    def masks(self, grams: np.ndarray) -> np.ndarray:
        size = np.uint64(len(self.cells) - 1)
        found = self.cells[grams & size]
        for probe in range(1, _PROBES):
            found = found & self.cells[(grams >> np.uint64(20 * probe)) & size]
        return found


def build_filter(languages, grams, owners, cells: int = 1 << 20) -> LanguageFilter:
    """A filter of the n-grams of each language; ``owners`` has the place of a gram's language."""
    table = np.zeros((cells, -(-max(len(languages), 1) // 64)), dtype=np.uint64)
    bits = np.uint64(1) << (owners.astype(np.uint64) % np.uint64(64))
    for probe in range(_PROBES):
        at = (grams >> np.uint64(20 * probe)) & np.uint64(cells - 1)
        np.bitwise_or.at(table, (at.astype(np.int64), owners // 64), bits)
    fill = np.array(
        [np.mean((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(languages))]
    )
    return LanguageFilter(list(languages), table, fill**_PROBES)


def gram_blocks(texts, block: int = _BLOCK):
    """Hashes of the 3- and 4-grams of letters of each text, and the text that each is from, in
    arrays of the n-grams that begin in ``block`` characters.

    Letters are lower-cased; whatever lies between letters is one boundary, which a gram may have
    at its ends only.
    """
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\0" + "\0".join(lowered) + "\0").encode("utf-32-le"), dtype=np.uint32)
    lengths = np.array([len(t) + 1 for t in lowered], dtype=np.int64)
    used = np.flatnonzero(np.bincount(codes))
    letters = np.zeros(int(used[-1]) + 1, dtype=bool)
    letters[used] = [chr(c).isalpha() for c in used]
    letter = letters[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    owners = np.zeros(int(np.count_nonzero(keep)), dtype=np.int32)
    owners[1:] = np.repeat(np.arange(len(lowered), dtype=np.int32), lengths)[keep[1:]]
    kept = np.where(letter, codes, np.uint32(0))[keep]
    del codes, letter, keep
    for low in range(0, len(kept) - 2, block):
        code = kept[low : low + block + 3].astype(np.uint64)
        owner, inner = owners[low + 1 : low + len(code)], code != 0
        n3, n4 = min(block, len(code) - 2), min(block, len(code) - 3)
        three = code[:n3] * _FACTORS[0] + code[1 : n3 + 1] * _FACTORS[1] + code[2 : n3 + 2] * _FACTORS[2]
        four = three[:n4] + code[3 : n4 + 3] * _FACTORS[3]
        take3, take4 = inner[1 : n3 + 1], inner[1 : n4 + 1] & inner[2 : n4 + 2]
        grams = np.concatenate((mix(three[take3]), mix(~four[take4])))
        yield grams, np.concatenate((owner[:n3][take3], owner[:n4][take4]))


def text_grams(texts):
    """All n-grams of ``gram_blocks`` at once."""
    blocks = [(np.zeros(0, np.uint64), np.zeros(0, np.int32)), *gram_blocks(texts)]
    return tuple(np.concatenate(x) for x in zip(*blocks))


def pieces(texts, limit: int = _SLICE):
    """Texts in groups of about ``limit`` characters, with the text that each piece is from.

    A longer text is cut after a space, where a gram ends anyway, so its pieces have the grams of
    the whole (a run of ``limit`` characters without a space is cut as it comes).
    """
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        text, start = text or "", 0
        while True:
            stop = len(text)
            if stop - start > limit:
                stop = text.rfind(" ", start, start + limit) + 1
                stop = stop if stop > start else start + limit
            rows.append(row)
            parts.append(text[start:stop])
            size += stop - start
            if size >= limit:
                yield np.array(rows), parts
                rows, parts, size = [], [], 0
            start = stop
            if start >= len(text):
                break
    if rows:
        yield np.array(rows), parts


def _counted(batches):
    """n-grams of labelled texts with their counts, summed per block of n-grams."""
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            names = part.column(0).to_pylist()
            place = {name: i for i, name in enumerate(dict.fromkeys(names))}
            languages = np.array([place[n] for n in names], dtype=np.int64)
            for rows, texts in pieces(part.column(1).to_pylist()):
                for grams, owner in gram_blocks(texts):
                    yield _grams_of(languages[rows[owner]], list(place), grams)


def _grams_of(language, names, grams):
    """One row per language and n-gram, with its count."""
    order = np.lexsort((grams, language))
    grams, language = grams[order], language[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (language[1:] != language[:-1])
    starts = np.flatnonzero(new)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.string()).take(pa.array(language[starts])),
            pa.array(grams[starts].view(np.int64)),
            pa.array(np.diff(np.append(starts, len(grams)))),
        ],
        names=["lang", "gram", "n"],
    )


def fit(
    labelled: DataFrame,
    texts_per_language: int = 2000,
    grams_per_language: int = 30_000,
    max_languages: int = 256,
    share: float = 0.2,
) -> LanguageFilter:
    """Learn from ``(doc_id, text, lang)``, rows with a null text or language left out.

    Per language about ``texts_per_language`` whole texts, taken by a hash of the id, are read;
    their n-grams are counted in Spark. A language's set has an n-gram if it is among the
    ``grams_per_language`` most frequent there, occurs twice, and is at least ``share`` times as
    frequent as in the language that has it most. What comes to the driver is bounded by
    ``max_languages`` (the most frequent) times ``grams_per_language``.
    """
    labelled = labelled.where("text is not null and lang is not null")
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    languages = [row["lang"] for row in sizes]
    if not languages:
        return build_filter([], np.zeros(0, np.uint64), np.zeros(0, np.int64), 2)
    rates = F.create_map(
        *[x for row in sizes for x in (F.lit(row["lang"]), F.lit(texts_per_language / row["count"]))]
    )
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(17)), 11) / F.lit(float(1 << 53))
    sample = labelled.where(drawn < F.coalesce(rates[F.col("lang")], F.lit(0.0)))
    counts = (
        sample.select("lang", F.col("text").cast("string").alias("text"))
        .mapInArrow(_counted, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    by_language = Window.partitionBy("lang")
    kept = (
        counts.where("n > 1")
        .withColumn("rate", F.col("n") / F.sum("n").over(by_language))
        .withColumn("rank", F.row_number().over(by_language.orderBy(F.desc("n"), "gram")))
        .where(F.col("rank") <= grams_per_language)
        .withColumn("most", F.max("rate").over(Window.partitionBy("gram")))
        .where(F.col("rate") >= share * F.col("most"))
        .select("lang", "gram")
        .toPandas()
    )
    place = {name: i for i, name in enumerate(languages)}
    owners = kept["lang"].map(place).to_numpy(dtype=np.int64)
    return build_filter(languages, kept["gram"].to_numpy(dtype=np.int64).view(np.uint64), owners)


def _predict(batches, model):
    languages = np.array([*model.languages, UNKNOWN], dtype=object)
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            n = part.num_rows
            total, hits = np.zeros(n), np.zeros((len(model.languages), n))
            for rows, texts in pieces(part.column(1).to_pylist()):
                for grams, owner in gram_blocks(texts):
                    owner = rows[owner]
                    total += np.bincount(owner, minlength=n)
                    masks = model.masks(grams)
                    for i in range(len(model.languages)):
                        bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                        hits[i] += np.bincount(owner, weights=bit, minlength=n)
            best, pick = np.full(n, -1.0), np.full(n, len(model.languages))
            for i, wrong in enumerate(model.wrong):
                corrected = (hits[i] / np.maximum(total, 1) - wrong) / (1 - wrong)
                corrected = np.clip(corrected, 0, 1)
                pick = np.where(corrected > best, i, pick)
                best = np.maximum(best, corrected)
            pick = np.where(total > 0, pick, len(model.languages))
            best = np.where((total > 0) & (best > 0), best, 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(languages[pick], pa.string()),
                    pa.array(best.astype(np.float64)),
                    part.column(2),
                ],
                names=["doc_id", "lang_pred", "score", "carried"],
            )


def predict(
    docs: DataFrame,
    model: LanguageFilter,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, and with ``carry`` a struct ``carried`` of those
    columns.

    Each n-gram of the whole text is looked up once for all languages; a language's count of hits
    is corrected for those expected by chance, and the most hits decide (the language with more
    training texts at a tie). ``score`` is the corrected share of the text's n-grams that the
    language has, 0 to 1.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if nothing was
    learned. Repeated rows are predicted each; a null id stays. An empty table gives an empty
    table; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        carried_columns(carry),
    )
    kind = rows.schema["carried"].dataType.simpleString()
    out = rows.mapInArrow(
        partial(_predict, model=model),
        f"doc_id bigint, lang_pred string, score double, carried {kind}",
    )
    return out if carry else out.drop("carried")
