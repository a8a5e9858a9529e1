"""As-of join: the last right-hand row at or before each left-hand moment."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys of the left side that are broadcast at most: some 5 MB of ids of 77 digits.
MOST_KEYS = 50_000


@dataclass(frozen=True)
class Reach:
    """What is known of the left side from when it was written: the days its moments lie on, and its
    keys, if they are few."""

    first: date | None
    last: date | None
    keys: DataFrame | None = None

    @classmethod
    def known(cls, left: DataFrame, key: str, n: int, first: date | None, last: date | None) -> Reach:
        """`n`: rows of `left`. Beyond `MOST_KEYS` keys the join alone has to sort them out."""
        keys = left.select(F.col(key).alias("_reached")).distinct() if n <= MOST_KEYS else None
        return cls(first, last, keys)

    def prune(self, right: DataFrame, key: str, day: str, before: timedelta, until: timedelta) -> DataFrame:
        """`right` on the days from `before` the first moment to `until` the last, of the keys.

        Plain bounds on the partition column, and a filter by key before anything is shuffled.
        """
        if self.first is None:
            return right.limit(0)
        bounds = (self.first - before, self.last - until)
        near = right.filter(F.col(day).between(*[F.lit(b) for b in bounds]))
        if self.keys is None:
            return near
        return near.join(F.broadcast(self.keys), F.col(key) == F.col("_reached"), "left_semi")


def day_bins(df: DataFrame, first: Column, last: Column, bin_col: str) -> DataFrame:
    """One row per calendar day the interval [first, last] touches.

    Joins merge it: Spark estimates an explode by the size of its input, and would broadcast many
    times what it takes for small.
    """
    days = F.explode(F.sequence(F.to_date(first), F.to_date(last)))
    return df.withColumn(bin_col, days).hint("merge")


def reachable_days(
    left: DataFrame, right: DataFrame, first: Column, last: Column, right_day: str
) -> DataFrame:
    """`right` between the earliest and the latest day that any left interval touches.

    Two scalar subqueries over the left side: Spark runs them first and hands the scan plain
    bounds on its partition column, so days out of reach are not listed, let alone read.
    """
    bounds = left.agg(F.min(F.to_date(first)).alias("lo"), F.max(F.to_date(last)).alias("hi"))
    day = F.col(right_day)
    return right.filter(
        (day >= bounds.select("lo").scalar()) & (day <= bounds.select("hi").scalar())
    )


def asof_candidates(
    left: DataFrame,
    right: DataFrame,
    *,
    on: dict[str, str],
    left_ts: str,
    right_ts: str,
    tolerance_hours: int,
    values: list[str],
    right_day: str,
    pruned: bool = False,
) -> DataFrame:
    """Left rows with every right row in the window (left_ts - tolerance, left_ts].

    on: left column -> right column, equal in both.
    right_day: the right side's UTC calendar date of `right_ts` (its partition column).
    pruned: the right side is cut to the days in reach already (`Reach`).

    Each left row is repeated for the few days its window touches and equi-joined on
    (key, day), so a row meets at most those days of its key's history and one key's
    history spreads over all tasks.
    """
    low = F.col(left_ts) - F.make_dt_interval(hours=F.lit(tolerance_hours))
    near = right if pruned else reachable_days(left, right, low, F.col(left_ts), right_day)
    keep = {name: f"_r_{name}" for name in {*on.values(), *values, right_ts, right_day}}
    probe = near.select(*[F.col(name).alias(alias) for name, alias in sorted(keep.items())])

    ts = F.col(keep[right_ts])
    match = (ts <= F.col(left_ts)) & (ts > low) & (F.col("_bin") == F.col(keep[right_day]))
    for mine, theirs in on.items():
        match = match & (F.col(mine) == F.col(keep[theirs]))
    # The long side streams through the join; only a key's few targets are buffered.
    met = probe.join(day_bins(left, low, F.col(left_ts), "_bin"), match)
    taken = [right_ts, *values]
    return met.select(*left.columns, *[F.col(keep[name]).alias(name) for name in taken])


def asof_join(left: DataFrame, right: DataFrame, **options) -> DataFrame:
    """Inner as-of join: of `asof_candidates` (same arguments) the latest right row.

    Left rows must be distinct; right rows unique per (key, right_ts). The best row is an
    aggregate with map-side partials, not a sort.
    """
    ts = F.col(options["right_ts"])
    return (
        asof_candidates(left, right, **options)
        .groupBy(*left.columns)
        .agg(
            F.max(ts).alias(options["right_ts"]),
            *[F.max_by(F.col(v), ts).alias(v) for v in options["values"]],
        )
    )
