"""Executable assumptions. Every check yields rows (or a count) that should be empty."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, NULL keys aside."""
    present = df.dropna(subset=keys) if len(keys) == 1 else df
    counted = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def not_in(column: str, values: Iterable) -> Column:
    return ~F.col(column).isin(*values)


def out_of_bounds(column: str, low=None, high=None) -> Column:
    """Outside [low, high], bounds included in the range; NULL is not a failure."""
    tests = [F.col(column) < low] if low is not None else []
    tests += [F.col(column) > high] if high is not None else []
    return reduce(lambda a, b: a | b, tests)


def orphan_counts(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child keys without a parent row, and their row counts; NULL keys aside.

    The child is counted per key first, so the anti join sees keys, not rows: a key with
    a third of all rows is one row there. The parent is merged: by the estimate of one column of a
    wide file, millions of keys would be broadcast.
    """
    counted = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counted.join(parent.select(column).hint("merge"), column, "left_anti")


@dataclass(frozen=True)
class RowCheck:
    """A predicate that marks a failing row."""

    name: str
    failing: Column
    severity: str = "error"


def row_check_counts(df: DataFrame, checks: list[RowCheck]) -> DataFrame:
    """(name, severity, failures) of many row checks from a single pass over the table."""
    counts = df.agg(
        *[F.count_if(c.failing).alias(f"c{i}") for i, c in enumerate(checks)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.inline(rows))


def count_check(
    name: str, failing: DataFrame, severity: str = "error", n: Column | None = None
) -> DataFrame:
    """The same shape for a check that needs its own shuffle: failing rows, or the sum of `n`."""
    total = F.count(F.lit(1)) if n is None else F.coalesce(F.sum(n), F.lit(0).cast("bigint"))
    return failing.agg(total.alias("failures")).select(
        F.lit(name).alias("name"), F.lit(severity).alias("severity"), "failures"
    )


def severity_report(counts: list[DataFrame]) -> DataFrame:
    """One row per check with its status: pass, or its severity when it failed."""
    everything = reduce(DataFrame.unionByName, counts)
    status = F.when(F.col("failures") > 0, F.col("severity")).otherwise(F.lit("pass"))
    return everything.withColumn("status", status)


def raise_on_errors(report: DataFrame) -> None:
    """The build goes red on any error; warnings pass. The report has one row per check."""
    red = [r.name for r in report.filter("status = 'error'").collect()]
    if red:
        raise RuntimeError("failed checks: " + ", ".join(red))


def freshness(
    raw: DataFrame, source: str, now: Column, warn_hours: int, error_hours: int
) -> DataFrame:
    """Age of the newest row and its status. An empty source is an error."""
    age = (F.unix_timestamp(now) - F.unix_timestamp("last_ingested_at")) / 3600
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), F.lit("error"))
        .when(F.col("age_hours") > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return (
        raw.agg(F.max("_ingested_at").alias("last_ingested_at"))
        .withColumn("age_hours", age)
        .select(F.lit(source).alias("source"), "last_ingested_at", "age_hours",
                status.alias("status"))
    )
