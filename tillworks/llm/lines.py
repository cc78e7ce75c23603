"""Line dedup: lines that stand on many sites are boilerplate."""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import carried_columns, slices
from tillworks.llm.storage import stored

_TRIMMED = " \t\r\v\f"
#: Sketches of 2^12 registers: a standard error of 1.04 / 64 of the count.
_REGISTERS = 12
_ERROR = 1.04 / 2 ** (_REGISTERS / 2)


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: id, site, place, and a hash of the trimmed line."""
    split = docs.where("text is not null").select(
        "doc_id", "site", F.posexplode(F.split("text", "\n")).alias("place", "line")
    )
    trimmed = F.btrim("line", F.lit(_TRIMMED))
    return split.where(trimmed != "").select("doc_id", "site", "place", F.xxhash64(trimmed).alias("line"))


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """``(line, first)``: hashes of lines on ``min_sites`` sites or more, and the smallest id.

    A sketch of the sites is merged per line. Where its estimate is within five standard errors
    (and one site) of the limit, the line's distinct sites are counted exactly.
    """
    spread = stored(
        lines.groupBy("line")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(_REGISTERS))).alias("sites"),
            F.min("doc_id").alias("first"),
        )
        .where(F.col("sites") >= min_sites * (1 - 5 * _ERROR) - 1)
    )
    sure = F.col("sites") > min_sites * (1 + 5 * _ERROR) + 1
    near = spread.where(~sure)
    exact = (
        lines.select("line", "site")
        .join(near.select("line"), "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count("site").alias("exact"))
        .where(F.col("exact") >= min_sites)
    )
    return (
        spread.where(sure)
        .select("line", "first")
        .unionByName(near.join(exact, "line", "left_semi").select("line", "first"))
    )


def _cut(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            n_lines, n_removed, kept = [], [], []
            for text, gone in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                rows = text.split("\n") if text is not None else []
                n_lines.append(sum(1 for r in rows if r.strip(_TRIMMED)))
                n_removed.append(len(gone or ()))
                if gone:
                    gone = set(gone)
                    text = "\n".join(r for i, r in enumerate(rows) if i not in gone)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    part.column(3),
                ],
                names=["doc_id", "n_lines", "n_removed", "text", "carried"],
            )


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    carry: list[str] | None = None,
) -> DataFrame:
    """Cut lines that stand on ``min_sites`` sites or more from all but their first document.

    Lines end at line feeds and are compared trimmed of white space at the ends; blank lines are
    never cut. A line stays in the document with the smallest id that has it, wherever it stands
    there. Returns ``doc_id, n_lines`` (lines that are not blank)``, n_removed, text`` per row,
    and with ``carry`` a struct ``carried`` of those columns.

    A null text stays null with 0 lines; a null site counts as no site. An id stands for one text:
    repeated rows get the same result. Rows with a null id count for the sites and keep all lines.
    An empty table gives an empty table; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(site_col).cast("string").alias("site"),
        carried_columns(carry),
    )
    lines = _lines(rows.drop("carried"))
    # The common lines come first: the join is then between two reduced sides, and a line that is
    # everywhere is split by adaptive execution.
    gone = (
        lines.select("doc_id", "place", "line")
        .join(boilerplate(lines, min_sites), "line")
        .where("doc_id > first")
        .groupBy("doc_id")
        .agg(F.collect_set("place").alias("gone"))
    )
    out = rows.select("doc_id", "text", "carried").join(gone, "doc_id", "left")
    kind = rows.schema["carried"].dataType.simpleString()
    cut = out.select("doc_id", "text", "gone", "carried").mapInArrow(
        _cut, f"doc_id bigint, n_lines bigint, n_removed bigint, text string, carried {kind}"
    )
    return cut if carry else cut.drop("carried")
