"""How much of a window the intervals of a key cover, overlaps counted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def by_day(df: DataFrame, start: str, end: str, day: str) -> DataFrame:
    """Half-open intervals of seconds [start, end), cut at midnights: one row a day they touch.

    Empty and reversed intervals vanish, and so do those without a bound.
    """
    real = df.filter(F.col(start) < F.col(end))
    days = F.sequence(F.floor(F.col(start) / DAY), F.floor((F.col(end) - 1) / DAY))
    cut = real.withColumn(day, F.explode(days))
    return cut.withColumns(
        {
            start: F.greatest(F.col(start), F.col(day) * DAY),
            end: F.least(F.col(end), (F.col(day) + 1) * DAY),
        }
    )


def coverage_sum(
    windows: DataFrame, intervals: DataFrame, key: str, start: str = "start", end: str = "end"
) -> DataFrame:
    """`key`, window_seconds, covered_seconds, uncovered_seconds for each of `windows`.

    Both have `key` and seconds `start` and `end`, half open; a key has one window and any number of
    intervals, which may overlap. A window without intervals is uncovered, an empty one has 0
    seconds.

    Windows and intervals are cut at midnights and meet on (key, day), and overlaps are resolved
    within a day. A day's covered seconds just add up, so a key with very many intervals spreads
    over all tasks. Equal intervals are one before they are sorted.
    """
    wanted = windows.select(key, F.col(start).alias("_from"), F.col(end).alias("_to"))
    pieces = by_day(intervals.select(key, start, end), start, end, "_day").distinct()
    clipped = (
        by_day(wanted, "_from", "_to", "_day")
        .join(pieces, [key, "_day"])
        .select(
            key,
            "_day",
            F.greatest(start, "_from").alias("_s"),
            F.least(end, "_to").alias("_e"),
        )
        .filter("_s < _e")
    )
    earlier = (
        Window.partitionBy(key, "_day")
        .orderBy("_s", "_e")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # What an interval adds to the union of those that begin before it.
    reached = F.coalesce(F.max("_e").over(earlier), F.col("_s"))
    added = clipped.withColumn(
        "_added", F.greatest(F.col("_e") - F.greatest("_s", reached), F.lit(0))
    )
    covered = added.groupBy(key).agg(F.sum("_added").alias("_covered"))
    length = F.greatest(F.col("_to") - F.col("_from"), F.lit(0))
    seconds = F.coalesce("_covered", F.lit(0)).cast("bigint")
    return wanted.join(covered, key, "left").select(
        key,
        length.alias("window_seconds"),
        seconds.alias("covered_seconds"),
        (length - seconds).alias("uncovered_seconds"),
    )
