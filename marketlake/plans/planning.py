"""What to fetch next: one catalog and one watermark table in, planned fetches out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.coverage import coverage_sum
from marketlake.operators.periods import lag_by_chunk
from marketlake.operators.skew import salted_join

DAY = 86_400

# Fixed parameters of the planners, in seconds unless named otherwise.
VOLUME_FLOOR = 10_000.0
INITIAL_LOOKBACK = 30 * DAY
MAX_WINDOW = 30 * DAY
OVERLAP = 3_600
MIN_REFETCH = 1_800
MAX_SPAN = 14 * DAY
FIDELITY_LADDER = (60, 180, 360, 720, 1440)


def token_watermarks(raw_prices: DataFrame) -> DataFrame:
    """Newest landed second per token. A maximum over what landed: it never goes back,
    and an empty fetch leaves it where it was."""
    return (
        raw_prices.filter(F.col("token_id").isNotNull())
        .groupBy("token_id")
        .agg(F.max("t").alias("watermark"))
    )


def advance_watermarks(marks: DataFrame, landed: DataFrame) -> DataFrame:
    """Watermarks after another load, without rescanning what was landed before."""
    return (
        marks.unionByName(token_watermarks(landed))
        .groupBy("token_id")
        .agg(F.max("watermark").alias("watermark"))
    )


def at_least(volume: Column, floor: float) -> Column:
    """Volume at or above a floor. NaN, which Spark takes for the largest number, is not."""
    return (volume >= floor) & ~F.isnan(volume)


def harvest_scope(markets: DataFrame, floor: float = VOLUME_FLOOR) -> DataFrame:
    """Open markets at or above the volume floor."""
    return markets.filter(~F.col("is_closed") & at_least(F.col("volume_usd"), floor))


def top_by_volume(markets: DataFrame, n: int) -> DataFrame:
    """The `n` markets of the largest volume; unknown volumes and NaN come last."""
    known = F.nanvl(F.col("volume_usd"), F.lit(None).cast("double"))
    return markets.orderBy(known.desc_nulls_last(), "market_id").limit(n)


def backfill_scope(
    markets: DataFrame, floor: float = VOLUME_FLOOR, end_date_min: str | None = None
) -> DataFrame:
    """Closed markets at or above the floor, optionally ended on or after a date."""
    scope = markets.filter(F.col("is_closed") & at_least(F.col("volume_usd"), floor))
    if end_date_min is not None:
        scope = scope.filter(F.to_date("end_at") >= F.lit(end_date_min).cast("date"))
    return scope


def backfill_todo(scope: DataFrame, attempted: DataFrame) -> DataFrame:
    """Markets with a token that no earlier backfill attempted, empty attempts included."""
    done = attempted.select(F.col("token_id").alias("yes_token_id")).distinct()
    return scope.filter(F.col("yes_token_id").isNotNull()).join(done, "yes_token_id", "left_anti")


def with_watermark(scope: DataFrame, marks: DataFrame) -> DataFrame:
    """Left join: a market never fetched has no watermark."""
    marks = marks.select(F.col("token_id").alias("yes_token_id"), "watermark")
    return scope.join(marks, "yes_token_id", "left")


def fetch_status(now: Column) -> Column:
    """no_token, fresh (fetched less than half an hour ago) or fetch."""
    fresh = now - F.col("watermark") < MIN_REFETCH
    return (
        F.when(F.col("yes_token_id").isNull(), F.lit("no_token"))
        .when(fresh, F.lit("fresh"))
        .otherwise(F.lit("fetch"))
    )


def with_window(planned: DataFrame, now: Column) -> DataFrame:
    """Next fetch window: an overlap before the watermark, or the initial lookback, never
    longer than the longest window. What an older watermark leaves uncovered is counted."""
    start = F.coalesce(F.col("watermark") - OVERLAP, now - INITIAL_LOOKBACK)
    oldest = now - MAX_WINDOW
    return planned.withColumns(
        {
            "start_ts": F.greatest(start, oldest),
            "end_ts": now,
            "uncovered_seconds": F.greatest(oldest - start, F.lit(0).cast("bigint")),
        }
    )


def with_chunks(windows: DataFrame, span: int = MAX_SPAN) -> DataFrame:
    """Cut each window into consecutive spans of at most `span` seconds; empty ones vanish."""
    starts = F.explode(F.sequence("start_ts", F.col("end_ts") - 1, F.lit(span).cast("bigint")))
    return windows.filter(F.col("start_ts") < F.col("end_ts")).select(
        *[c for c in windows.columns if c not in ("start_ts", "end_ts")],
        starts.alias("chunk_start"),
        "end_ts",
    ).withColumn("chunk_end", F.least(F.col("chunk_start") + span, "end_ts")).drop("end_ts")


def plan_harvest(scope: DataFrame, marks: DataFrame, now: Column) -> DataFrame:
    """Status and window of every market in scope."""
    joined = with_watermark(scope, marks).withColumn("status", fetch_status(now))
    return with_window(joined, now)


def plan_fetches(scope: DataFrame, marks: DataFrame, now: Column) -> DataFrame:
    """One row per planned fetch."""
    due = plan_harvest(scope, marks, now).filter("status = 'fetch'")
    return with_chunks(due.select("market_id", "yes_token_id", "start_ts", "end_ts"))


def finest_fidelity(raw_prices: DataFrame) -> DataFrame:
    """Of each token's landed series, only the one at the finest rung of the ladder.

    Whole series compete, unlike the point-wise choice in staging. The join back is
    salted by time, so one token's points spread over many tasks.
    """
    on_ladder = raw_prices.filter(F.col("fidelity_minutes").isin(*FIDELITY_LADDER))
    finest = on_ladder.groupBy("token_id").agg(F.min("fidelity_minutes").alias("fidelity_minutes"))
    return salted_join(
        on_ladder, finest, ["token_id", "fidelity_minutes"], spread=["t"], how="left_semi"
    )


def gap_report(points: DataFrame, factor: int = 1) -> DataFrame:
    """Consecutive points of a token further apart than `factor` times their fidelity."""
    rows = points.select("token_id", "price_ts", "price_date", "fidelity_minutes")
    near = lag_by_chunk(rows, ["token_id"], "price_date", "price_ts", "prev_ts")
    gap = F.unix_timestamp("price_ts") - F.unix_timestamp("prev_ts")
    return (
        near.withColumn("gap_seconds", gap)
        .filter(F.col("gap_seconds") > factor * 60 * F.col("fidelity_minutes"))
        .select("token_id", "prev_ts", "price_ts", "fidelity_minutes", "gap_seconds")
    )


def window_coverage(windows: DataFrame, raw_prices: DataFrame) -> DataFrame:
    """Of each token's fetch window, the seconds that landed points cover and those they do not.

    A point stands for the time from its moment on, as long as its fidelity. windows: yes_token_id
    (markets that share one have one window), start_ts, end_ts.
    """
    points = raw_prices.filter(F.col("token_id").isNotNull()).select(
        F.col("token_id").alias("yes_token_id"),
        F.col("t").alias("start"),
        (F.col("t") + 60 * F.col("fidelity_minutes")).alias("end"),
    )
    asked = windows.filter(F.col("yes_token_id").isNotNull()).groupBy("yes_token_id").agg(
        F.min("start_ts").alias("start"), F.max("end_ts").alias("end")
    )
    return coverage_sum(asked, points, "yes_token_id")


# --- run summaries and the failure gate ---------------------------------------------


def harvest_summary(planned: DataFrame) -> DataFrame:
    """Markets targeted and how each was dealt with, as one row."""
    def count(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return planned.agg(
        F.count(F.lit(1)).alias("markets_targeted"),
        count("fetch").alias("tokens_fetched"),
        count("fresh").alias("skipped_fresh"),
        count("no_token").alias("skipped_no_token"),
    )


def run_points(raw_prices: DataFrame) -> DataFrame:
    """Points and tokens landed per run."""
    return raw_prices.groupBy("_run_id").agg(
        F.count(F.lit(1)).alias("points_landed"),
        F.count_distinct("token_id").alias("tokens_landed"),
    )


def fidelity_counts(raw_prices: DataFrame) -> DataFrame:
    """Tokens and points per fidelity. Distinct tokens are found per (fidelity, token)
    first, so one busy fidelity spreads over all tasks."""
    pairs = raw_prices.groupBy("fidelity_minutes", "token_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return pairs.groupBy("fidelity_minutes").agg(
        F.count("token_id").alias("n_tokens"), F.sum("n").alias("n_points")
    )


def failure_gate(outcomes: DataFrame, failed: Column, tolerance: float = 0.1) -> DataFrame:
    """One row: attempted, failed, whether the run passes. Fails only strictly above the
    tolerance; a run that attempted nothing passes."""
    counts = outcomes.agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(failed).alias("failed")
    )
    passed = ~(F.col("failed") > F.lit(tolerance) * F.col("attempted"))
    return counts.withColumn("passed", passed)


def enforce(gate: DataFrame) -> None:
    """Raise when a one-row gate did not pass."""
    row = gate.first()
    if not row.passed:
        raise RuntimeError(f"{row.failed}/{row.attempted} units failed")
