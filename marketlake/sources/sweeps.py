"""Which catalog rows a sync takes."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLOSED_LOOKBACK_DAYS = 14


def closed_since(today: date, lookback_days: int = CLOSED_LOOKBACK_DAYS) -> date:
    return today - timedelta(days=lookback_days)


def sweep_arms(full: bool, since: date | None = None) -> dict[str, Column]:
    """Arm name -> predicate. Open and closed are both explicit: a market whose state is
    unknown belongs to neither. The recent arm goes by scheduled end date."""
    if full:
        return {"open": ~F.col("is_closed"), "closed": F.col("is_closed")}
    recent = F.col("is_closed") & (F.to_date("end_at") >= F.lit(since))
    return {"open": ~F.col("is_closed"), "recently-closed": recent}


def sweep(
    markets: DataFrame,
    *,
    full: bool = False,
    since: date | None = None,
    volume_floor: float | None = None,
) -> DataFrame:
    """Markets in scope, tagged with their arm: one scan with one filter. NaN volumes are below
    every floor."""
    arms = sweep_arms(full, since)
    if volume_floor:
        volume = F.col("volume_usd")
        markets = markets.filter((volume >= volume_floor) & ~F.isnan(volume))
    tag = reduce(
        lambda acc, arm: acc.when(arms[arm], F.lit(arm)),
        list(arms)[1:],
        F.when(arms["open"], F.lit("open")),
    )
    return markets.withColumn("sweep", tag).filter(F.col("sweep").isNotNull())


def first_of_arms(swept: DataFrame, n: int) -> DataFrame:
    """The first `n` markets of each arm, in market order. A report of a sweep; no sweep is cut."""
    w = Window.partitionBy("sweep").orderBy("market_id")
    # row_number <= n makes Spark keep n rows per arm and task before the shuffle.
    return swept.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def arm_counters(swept: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of each arm of each sweep, named `<sweep>_<arm>`: two numbers a sweep."""
    return {
        f"{name}_{row['sweep']}": row["count"]
        for name, rows in swept.items()
        for row in rows.groupBy("sweep").count().collect()
    }
