"""Helpers the operators share: packed rows, word expressions, shared tables."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.session import shared_dir, stored

__all__ = ["HEAVIEST", "LISTED", "ascii_lower", "heavy_lookup", "listed", "pack", "row_key",
           "shared_dir", "stored", "stored_counting", "text_or_empty", "tune_arrow", "unpack", "words"]

# ASCII white space, as in the class [\x20\x09-\x0D].
SPACES = " \t\n\x0b\f\r"


def stored_counting(df: DataFrame, *conditions: Column) -> tuple[DataFrame, list[int]]:
    """`stored(df)` with its number of rows, and of those where each condition holds.

    Counted by the write itself.
    """
    told = Observation()
    counts = [F.count_if(c).alias(f"n{i}") for i, c in enumerate([F.lit(True), *conditions])]
    table = stored(df.observe(told, *counts))
    seen = told.get
    return table, [seen.get(f"n{i}") or 0 for i in range(len(counts))]


# Keys that `listed` broadcasts, at most.
LISTED = 1_000_000


def listed(keys: DataFrame) -> DataFrame:
    """`keys`, stored, to pick rows by a semi or anti join: broadcast if there are few of them.

    So the rows, which may be long, are not shuffled for it. More keys are left to Spark.
    """
    table, (n,) = stored_counting(keys)
    return F.broadcast(table) if n <= LISTED else table


def tune_arrow(spark: SparkSession, rows: int = 2000, mb: int = 16) -> None:
    """Arrow batches bounded by rows and bytes, so that very long texts do not pile up in one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z alone; other letters stay."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def words(col: Column) -> Column:
    """The runs of characters other than ASCII white space, in order."""
    return F.array_remove(F.split(col, r"[\x20\x09-\x0D]+"), "")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart: the id, and a hash of the text for rows that share an id."""
    return [F.col(id_col).alias("_id"), F.xxhash64(text_or_empty(text_col)).alias("_th")]


def pack(df: DataFrame, *without: str) -> Column:
    """All columns but `without` as one struct, so that working columns cannot clash with them."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in without]
    return F.struct(*kept).alias("_row")


def unpack(df: DataFrame, names: list[str], **results: Column) -> DataFrame:
    """The packed columns again, in their order, then `results`.

    A result of a packed or left out column's name stands in its place.
    """
    kept = [
        results[c].alias(c) if c in results else F.col("_row").getField(c).alias(c) for c in names
    ]
    return df.select(*kept, *[col.alias(c) for c, col in results.items() if c not in names])


# Keys that a `heavy_lookup` broadcasts, at most.
HEAVIEST = 1000


def heavy_lookup(
    rows: DataFrame, facts: DataFrame, on: list[str], weight: str, columns: list[str]
) -> DataFrame:
    """`rows` with `columns` of `facts`, by a left join on `on`, even where few keys hold most rows.

    `facts` has each key once and `weight`, the rows that it meets. Keys of at least 1 / HEAVIEST of
    all these rows, so HEAVIEST at most, are broadcast; the others are joined by a shuffle, in which
    no key is large. Both tables are read twice: store them first.
    """
    total = facts.agg(F.sum(weight).alias("n")).head()["n"] or 0
    is_heavy = F.col(weight) * HEAVIEST >= total
    heavy = facts.filter(is_heavy).select(*on, *columns).withColumn("_heavy", F.lit(True))
    met = rows.join(F.broadcast(heavy), on, "left")
    light = facts.filter(~is_heavy).select(*on, *columns)
    others = met.filter(F.col("_heavy").isNull()).drop("_heavy", *columns).join(light, on, "left")
    names = [*rows.columns, *columns]
    return met.filter("_heavy").select(names).unionByName(others.select(names))
