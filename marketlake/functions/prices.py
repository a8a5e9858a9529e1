"""Column expressions on prices, outcomes and time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_key(token_id: Column, t: Column) -> Column:
    """Surrogate key `token:unix seconds`; NULL when either part is."""
    return F.concat(token_id, F.lit(":"), t.cast("string"))


def epoch_ts(t: Column) -> Column:
    return F.timestamp_seconds(t)


def clamp_unit(p: Column) -> Column:
    """Into [0, 1]. `least`/`greatest` skip NULLs, so a NULL is kept NULL explicitly."""
    return F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


# Seconds between which a price point can lie: 2010 to 2100. Milliseconds and microseconds of the
# same years are far above; the fact therefore has at most some 33,000 dates.
EARLIEST, LATEST = 1_262_304_000, 4_102_444_800


def plausible_time(t: Column) -> Column:
    return t.between(EARLIEST, LATEST - 1)


# Why staging leaves a raw price row out; the first that holds.
UNUSABLE_REASONS = ("no token", "no time", "implausible time", "no price")


def unusable_reason(token: Column, t: Column, p: Column) -> Column:
    """One of `UNUSABLE_REASONS`, or NULL for a usable point."""
    no_token, no_time, implausible, no_price = UNUSABLE_REASONS
    return (
        F.when(token.isNull(), no_token)
        .when(t.isNull(), no_time)
        .when(~plausible_time(t), implausible)
        .when(p.isNull() | F.isnan(p), no_price)
    )


def usable_point(token_id: Column, t: Column, p: Column) -> Column:
    return token_id.isNotNull() & plausible_time(t) & p.isNotNull() & ~F.isnan(p)


def out_of_range(p: Column) -> Column:
    """Points the clamp changes."""
    return (p < 0) | (p > 1)


def terminal_outcome(yes_price: Column, no_price: Column) -> Column:
    """'yes' / 'no' when final prices are exactly 1 and 0; NULL for ties and refunds."""
    return F.when((yes_price == 1) & (no_price == 0), F.lit("yes")).when(
        (yes_price == 0) & (no_price == 1), F.lit("no")
    )


def outcome_int(outcome: Column) -> Column:
    return F.when(outcome == "yes", F.lit(1)).otherwise(F.lit(0))


def price_bucket(price: Column) -> Column:
    """Decile 0..9; a price of exactly 1 belongs to 9."""
    return F.least(F.floor(price * 10), F.lit(9).cast("bigint"))


def minus_hours(ts: Column, hours: Column) -> Column:
    return ts - F.make_dt_interval(hours=hours)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def squared_error(price: Column, outcome: Column) -> Column:
    return F.pow(price - outcome, F.lit(2))


def wilson_bound(rate: Column, n: Column, sign: int, z: float = 1.96) -> Column:
    """Wilson score bound of a rate over n trials: sign -1 for low, +1 for high."""
    z2 = z * z
    centre = rate + F.lit(z2) / (2 * n)
    spread = F.lit(z) * F.sqrt((rate * (1 - rate) + F.lit(z2) / (4 * n)) / n)
    return (centre + sign * spread) / (1 + F.lit(z2) / n)
