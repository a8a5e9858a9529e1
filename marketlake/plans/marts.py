"""The analytical marts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import prices
from marketlake.operators.asof import (
    Reach,
    asof_candidates,
    asof_join,
    day_bins,
    reachable_days,
)
from marketlake.operators.periods import diff_cumulative, last_of_period

# Fixed parameters of the marts.
HORIZON_HOURS = (24, 168, 720)  # a day, a week, thirty days before resolution
ASOF_TOLERANCE_HOURS = 50
DYNAMICS_DAYS = 30
MIN_EVENT_MARKETS = 3

# --- calibration -----------------------------------------------------------------


def horizon_targets(resolutions: DataFrame) -> DataFrame:
    """Three target moments per resolved market; a row-wise explode, no join."""
    hours = F.explode(F.array(*[F.lit(h).cast("bigint") for h in HORIZON_HOURS]))
    with_hours = resolutions.select(
        "market_id", "yes_token_id", "outcome", "volume_usd", "resolved_at",
        hours.alias("horizon_hours"),
    )
    target = prices.minus_hours(F.col("resolved_at"), F.col("horizon_hours"))
    return with_hours.withColumn("target_ts", target).drop("resolved_at")


ASOF = {
    "on": {"yes_token_id": "token_id"},
    "left_ts": "target_ts",
    "right_ts": "price_ts",
    "tolerance_hours": ASOF_TOLERANCE_HOURS,
    "right_day": "price_date",
}


def price_at_targets(
    targets: DataFrame, fct_prices: DataFrame, pruned: bool = False
) -> DataFrame:
    """Last known price at or before each target, if recent enough; unmatched ones drop."""
    return asof_join(
        targets, fct_prices, values=["price", "fidelity_minutes"], pruned=pruned, **ASOF
    )


def ranked_prices(targets: DataFrame, fct_prices: DataFrame) -> DataFrame:
    """All prices near enough to each target, ranked from the latest (`recency_rank` 1).

    A window holds the prices of one market within the tolerance: some 180,000 at one a second.
    """
    latest_first = Window.partitionBy("market_id", "horizon_hours").orderBy(F.desc("price_ts"))
    met = asof_candidates(targets, fct_prices, values=["price"], **ASOF)
    return met.withColumn("recency_rank", F.row_number().over(latest_first).cast("bigint"))


def scored(priced: DataFrame) -> DataFrame:
    return priced.select(
        "horizon_hours",
        prices.price_bucket(F.col("price")).alias("price_bucket"),
        "price",
        prices.outcome_int(F.col("outcome")).alias("outcome_int"),
    )


def calibration_agg(scored_rows: DataFrame) -> DataFrame:
    error = prices.squared_error(F.col("price"), F.col("outcome_int"))
    return scored_rows.groupBy("horizon_hours", "price_bucket").agg(
        F.count(F.lit(1)).alias("n_markets"),
        F.avg("price").alias("avg_price"),
        F.avg("outcome_int").alias("outcome_rate"),
        F.avg(error).alias("brier_score"),
    )


def with_wilson(buckets: DataFrame) -> DataFrame:
    rate, n = F.col("outcome_rate"), F.col("n_markets")
    return buckets.select(
        "horizon_hours",
        "price_bucket",
        "n_markets",
        "avg_price",
        "outcome_rate",
        prices.wilson_bound(rate, n, -1).alias("wilson_low"),
        prices.wilson_bound(rate, n, +1).alias("wilson_high"),
        "brier_score",
    )


def resolved_reach(
    resolutions: DataFrame, n: int, first: datetime | None, last: datetime | None
) -> Reach:
    """The reach of stored resolutions, from their number, first and last moment (UTC)."""
    days = [None if moment is None else moment.date() for moment in (first, last)]
    return Reach.known(resolutions, "yes_token_id", n, *days)


def calibration_prices(fct_prices: DataFrame, reach: Reach) -> DataFrame:
    """The prices that some target of the calibration can meet."""
    longest = timedelta(hours=max(HORIZON_HOURS) + ASOF_TOLERANCE_HOURS + 24)
    shortest = timedelta(days=min(HORIZON_HOURS) // 24)
    return reach.prune(fct_prices, "token_id", "price_date", longest, shortest)


def mart_calibration(
    resolutions: DataFrame, fct_prices: DataFrame, reach: Reach | None = None
) -> DataFrame:
    """Per (horizon, price decile): how often did it happen? At most 30 rows.

    With the `reach` of the resolutions, known since they were written, prices out of it go before
    the join; without it their days are found by a subquery.
    """
    targets = horizon_targets(resolutions).drop("volume_usd")
    if reach is not None:
        fct_prices = calibration_prices(fct_prices, reach)
    priced = price_at_targets(targets, fct_prices, pruned=reach is not None)
    return with_wilson(calibration_agg(scored(priced))).orderBy("horizon_hours", "price_bucket")


# --- price dynamics --------------------------------------------------------------


def dynamics_prices(fct_prices: DataFrame, reach: Reach) -> DataFrame:
    """The prices of the last days before some resolution."""
    return reach.prune(
        fct_prices, "token_id", "price_date", timedelta(days=DYNAMICS_DAYS), timedelta(0)
    )


def prices_before_resolution(
    resolutions: DataFrame, fct_prices: DataFrame, reach: Reach | None = None
) -> DataFrame:
    """Every price of a resolved market from 30 days out up to its resolution moment.

    Joined on (token, day), so a long history is spread by day. Days before the earliest or
    after the latest that any market needs are pruned from the scan, by `reach` or a subquery.
    """
    resolved = resolutions.select(
        "market_id",
        F.col("yes_token_id").alias("token_id"),
        prices.outcome_int(F.col("outcome")).alias("outcome_int"),
        "resolved_at",
    )
    first = F.date_sub(F.to_date("resolved_at"), DYNAMICS_DAYS)
    if reach is not None:
        near = dynamics_prices(fct_prices, reach)
    else:
        near = reachable_days(resolved, fct_prices, first, F.col("resolved_at"), "price_date")
    points = near.select("token_id", "price_date", "price_ts", "price")
    days = day_bins(resolved, first, F.col("resolved_at"), "price_date")
    return points.join(days, ["token_id", "price_date"]).filter(
        F.col("price_ts") <= F.col("resolved_at")
    )


def daily_before_resolution(joined: DataFrame) -> DataFrame:
    """End-of-day price per market and days left.

    The join keys are part of the grouping, so its partitioning is reused: no shuffle
    between join and aggregate.
    """
    left = prices.days_between(F.to_date("resolved_at"), F.col("price_date"))
    keys = ["token_id", "price_date", "market_id", "outcome_int", "days_before"]
    daily = last_of_period(
        joined.withColumn("days_before", left), keys, "price", "price_ts", "eod_price"
    )
    return daily.select("market_id", "outcome_int", "days_before", "eod_price")


def with_moves(daily: DataFrame) -> DataFrame:
    """Move against the previous observed day; at most 31 rows per market window."""
    w = Window.partitionBy("market_id").orderBy(F.desc("days_before"))
    move = F.abs(F.col("eod_price") - F.lag("eod_price").over(w))
    return daily.withColumn("abs_daily_move", move)


def dynamics_agg(moves: DataFrame) -> DataFrame:
    # One row per market and day, so counting rows counts distinct markets.
    return moves.groupBy("days_before").agg(
        F.count("market_id").alias("n_markets"),
        F.avg(F.abs(F.col("eod_price") - F.col("outcome_int"))).alias("avg_abs_error"),
        F.avg("abs_daily_move").alias("avg_abs_daily_move"),
    )


def mart_price_dynamics(
    resolutions: DataFrame, fct_prices: DataFrame, reach: Reach | None = None
) -> DataFrame:
    """Error and movement by days before resolution, 0 to 30. `reach`: as for the calibration."""
    daily = daily_before_resolution(prices_before_resolution(resolutions, fct_prices, reach))
    return dynamics_agg(with_moves(daily)).orderBy("days_before")


# --- event coherence -------------------------------------------------------------


def exclusive_roster(markets: DataFrame) -> DataFrame:
    """Markets of mutually exclusive events that can be priced."""
    return (
        markets.filter("is_neg_risk")
        .select("event_id", "market_id", "yes_token_id")
        .dropna(subset=["event_id", "yes_token_id"])
    )


def multi_outcome_events(roster: DataFrame) -> DataFrame:
    counts = roster.groupBy("event_id").agg(F.count(F.lit(1)).alias("n_markets"))
    return counts.filter(F.col("n_markets") >= MIN_EVENT_MARKETS)


def eod_prices(fct_prices: DataFrame) -> DataFrame:
    return last_of_period(fct_prices, ["token_id", "price_date"], "price", "price_ts", "eod_price")


def roster_members(roster: DataFrame) -> DataFrame:
    """Roster rows of multi-outcome events, with the number of markets of their event.

    Counted with partials and joined back, so that an event with very many markets is split by
    Spark's skew handling instead of being one window.
    """
    return roster.join(multi_outcome_events(roster), "event_id")


def priced_roster(members: DataFrame, fct_prices: DataFrame) -> DataFrame:
    """Members with each day's closing price.

    Prices of other tokens go before the closing prices are taken: they are the most of the fact.
    """
    tokens = members.select(F.col("yes_token_id").alias("token_id")).distinct()
    daily = eod_prices(fct_prices.join(tokens, "token_id", "left_semi"))
    return members.join(daily, members.yes_token_id == daily.token_id).select(
        "event_id", "n_markets", "market_id", "token_id", "price_date", "eod_price"
    )


def event_day_sums(priced: DataFrame) -> DataFrame:
    return priced.groupBy("event_id", "n_markets", "price_date").agg(
        F.count(F.lit(1)).alias("n_priced"), F.sum("eod_price").alias("sum_yes_prices")
    )


def mart_event_coherence(markets: DataFrame, fct_prices: DataFrame) -> DataFrame:
    """Sum of Yes prices per exclusive event and fully priced day."""
    members = roster_members(exclusive_roster(markets))
    sums = event_day_sums(priced_roster(members, fct_prices))
    return sums.filter(F.col("n_priced") == F.col("n_markets")).select(
        "event_id",
        "price_date",
        "n_markets",
        "sum_yes_prices",
        (F.col("sum_yes_prices") - 1).alias("deviation"),
    )


# --- daily volume ----------------------------------------------------------------


def eod_volume(history: DataFrame) -> DataFrame:
    """Last known cumulative volume per market and day with a version."""
    rows = history.filter(F.col("volume_usd").isNotNull()).withColumn(
        "snap_date", F.to_date("valid_from")
    )
    return last_of_period(
        rows, ["market_id", "snap_date"], "volume_usd", "valid_from", "cum_volume_usd"
    )


def volume_changes(eod: DataFrame) -> DataFrame:
    return diff_cumulative(
        eod, "market_id", "snap_date", "cum_volume_usd", "volume_delta_usd", "days_since_prev"
    )


def mart_daily_volume(history: DataFrame) -> DataFrame:
    """Traded volume per market and observed day; each market's first day drops out."""
    return volume_changes(eod_volume(history)).filter(F.col("volume_delta_usd").isNotNull())
