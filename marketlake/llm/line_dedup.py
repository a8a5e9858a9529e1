"""Line deduplication across documents, in DataFrame operations only.

Lines are exploded and normalised, and their 128-bit hashes counted by document. A line found
in many documents stays only in the document with the largest id. Each document is put together
again from the positions that stay.

Scale: what is shuffled by hash are two longs, an id and a position for each line of sufficient
length; texts are shuffled once, by document. The counts have map-side partials, so a line that
a third of all documents share arrives as a few rows for each map task. The positions of the most
frequent lines are found by a broadcast of at most `HEAVIEST` hashes, those of the others by a
shuffle in which no hash has many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import (
    SPACES,
    ascii_lower,
    heavy_lookup,
    pack,
    row_key,
    stored,
    text_or_empty,
    unpack,
)


def line_key(line):
    """A line without ASCII white space at its ends and with A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def long_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key has `min_chars` code points or more: _id, _th, _pos, _h1, _h2."""
    lines = docs.select(
        *row_key(id_col, text_col),
        F.posexplode(F.split(text_or_empty(text_col), "\n")).alias("_pos", "_line"),
    ).withColumn("_key", line_key(F.col("_line")))
    return lines.filter(F.length("_key") >= min_chars).select(
        "_id",
        "_th",
        "_pos",
        F.xxhash64("_key").alias("_h1"),
        F.xxhash64(F.lit(1), F.col("_key")).alias("_h2"),
    )


def frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in `min_docs` documents or more, with the largest document id holding each and
    the number of lines."""
    per_doc = lines.groupBy("_h1", "_h2", "_id").agg(F.count("*").alias("_in_doc"))
    counted = per_doc.groupBy("_h1", "_h2").agg(
        F.count("_id").alias("_docs"),
        F.max("_id").alias("_keeper"),
        F.sum("_in_doc").alias("_lines"),
    )
    return counted.filter(F.col("_docs") >= min_docs).select("_h1", "_h2", "_keeper", "_lines")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """`docs` with repeated lines dropped, plus `n_lines` (before) and `n_dropped`, both long.

    A line counts by its key (`line_key`). A key of at least `min_chars` code points found in at
    least `min_docs` documents loses all its lines except those of the largest id holding it.

    Null text: one empty line, and the text stays null. Empty text: one empty line. Rows that
    share an id count as one document, and each is cleaned by itself; equal rows give equal
    results. A row without an id counts in no total and is never the one that keeps a line. Other
    columns pass through; a column named like a result is replaced. Empty table: no rows.
    """
    lines = stored(long_lines(docs, id_col, text_col, min_chars))
    repeated = stored(frequent_lines(lines, min_docs))
    held = heavy_lookup(lines, repeated, ["_h1", "_h2"], "_lines", ["_keeper"])
    dropped = (
        held.filter(F.col("_keeper").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy(F.col("_id").alias("_drop_id"), F.col("_th").alias("_drop_th"))
        .agg(F.collect_set("_pos").alias("_drop"))
    )
    rows = docs.select(
        pack(docs, text_col), *row_key(id_col, text_col), F.col(f"`{text_col}`").alias("_text")
    )
    joined = rows.join(
        dropped,
        F.col("_id").eqNullSafe(F.col("_drop_id")) & (F.col("_th") == F.col("_drop_th")),
        "left",
    )
    # The one-element array binds the lines, so that they are split once for a document.
    text = F.coalesce(F.col("_text").cast("string"), F.lit(""))

    def without_dropped(lines):
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop"))
        return F.array_join(F.transform(stay, lambda i: lines[i]), "\n")

    cleaned = F.transform(F.array(F.split(text, "\n")), without_dropped)[0]
    kept = F.col("_drop").isNull()
    return unpack(
        joined,
        docs.columns,
        **{
            text_col: F.when(kept, F.col("_text")).otherwise(cleaned),
            "n_lines": F.size(F.split(text, "\n")).cast("bigint"),
            "n_dropped": F.when(kept, F.lit(0)).otherwise(F.size("_drop")).cast("bigint"),
        },
    )
