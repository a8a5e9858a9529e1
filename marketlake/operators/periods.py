"""Last value per period, differences of cumulative series, and neighbours by chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_of_period(
    df: DataFrame, keys: list[str], value: str, order: str, alias: str
) -> DataFrame:
    """`value` at the greatest `order` per key; partials are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(alias))


def diff_cumulative(
    df: DataFrame, key: str, day: str, value: str, delta: str, gap: str
) -> DataFrame:
    """Difference of a cumulative value to the previous observed day, and that day's distance.

    Takes one row per (key, day), so a key's window holds at most one row per calendar day.
    """
    w = Window.partitionBy(key).orderBy(day)
    return df.withColumns(
        {
            delta: F.col(value) - F.lag(value).over(w),
            gap: F.datediff(F.col(day), F.lag(day).over(w)).cast("bigint"),
        }
    )


def _carry_from_chunks(
    df: DataFrame, keys: list[str], chunk: str, summary: Column, carry: Column, alias: str
) -> DataFrame:
    """One row per (keys, chunk): what the neighbouring chunks contribute to it.

    `summary` condenses a chunk, `carry` looks from one chunk's summary (`_s`, windowed
    over `_w`) at the others.
    """
    condensed = df.groupBy(*keys, chunk).agg(summary.alias("_s"))
    return condensed.withColumn(alias, carry).select(*keys, chunk, alias)


def _join_chunks(rows: DataFrame, found: DataFrame, keys: list[str], chunk: str) -> DataFrame:
    """`rows` with the carried column of their chunk; a null chunk is a chunk like any other."""
    names = [*keys, chunk]
    carried = found.withColumnsRenamed({name: f"_c_{name}" for name in names})
    same = [F.col(name).eqNullSafe(F.col(f"_c_{name}")) for name in names]
    return rows.join(carried, same, "left").drop(*[f"_c_{name}" for name in names])


def lag_by_chunk(
    df: DataFrame, keys: list[str], chunk: str, order: str, alias: str
) -> DataFrame:
    """`lag(order)` per key without ever sorting a whole key in one task.

    Rows are windowed within (keys, chunk); the first row of a chunk takes the last
    value of the key's previous chunk from a second, much smaller window with one row
    per chunk. `chunk` must be non-decreasing in `order`, such as its calendar day.
    """
    by_chunk = Window.partitionBy(*keys).orderBy(chunk)
    before = _carry_from_chunks(
        df, keys, chunk, F.max(order), F.lag("_s").over(by_chunk), "_before"
    )
    inner = Window.partitionBy(*keys, chunk).orderBy(order)
    lagged = df.withColumn("_lag", F.lag(order).over(inner))
    return (
        _join_chunks(lagged, before, keys, chunk)
        .withColumn(alias, F.coalesce("_lag", "_before"))
        .drop("_lag", "_before")
    )


def running_max_by_chunk(
    df: DataFrame,
    keys: list[str],
    chunk: str,
    order: list[Column],
    value: str,
    alias: str,
    condense: DataFrame | None = None,
) -> DataFrame:
    """Greatest `value` among the strictly earlier rows of the key, in the same two levels.

    `condense` may name a cheaper input with the same maxima so far, such as `df` before
    its repeated values were removed; by default `df` is read for both levels.
    """
    earlier_chunks = (
        Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    )
    source = df if condense is None else condense
    before = _carry_from_chunks(
        source, keys, chunk, F.max(value), F.max("_s").over(earlier_chunks), "_before"
    )
    inner = (
        Window.partitionBy(*keys, chunk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = df.withColumn("_within", F.max(value).over(inner))
    return (
        _join_chunks(within, before, keys, chunk)
        .withColumn(alias, F.greatest("_within", "_before"))
        .drop("_within", "_before")
    )


def lead_by_chunk(
    df: DataFrame, keys: list[str], chunk: str, order: str, alias: str
) -> DataFrame:
    """`lead(order)` per key in two levels; the last row of a chunk looks at the next chunk."""
    by_chunk = Window.partitionBy(*keys).orderBy(chunk)
    after = _carry_from_chunks(
        df, keys, chunk, F.min(order), F.lead("_s").over(by_chunk), "_after"
    )
    inner = Window.partitionBy(*keys, chunk).orderBy(order)
    led = df.withColumn("_lead", F.lead(order).over(inner))
    return (
        _join_chunks(led, after, keys, chunk)
        .withColumn(alias, F.coalesce("_lead", "_after"))
        .drop("_lead", "_after")
    )
