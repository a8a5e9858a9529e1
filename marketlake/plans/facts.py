"""Dimension, facts and market history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions import prices
from marketlake.operators import history
from marketlake.plans.staging import POINT_COLUMNS, best_points, newest_first, price_points
from marketlake.session import stored, table_or_empty
from marketlake.sources.layout import write_price_partitions
from marketlake.sources.schemas import FCT_PRICES

# The public columns of the dimension and those a new version is recorded with.
DIM_COLUMNS = [
    "market_id",
    "condition_id",
    "question",
    "slug",
    "event_id",
    "event_slug",
    "yes_token_id",
    "no_token_id",
    "is_active",
    "is_closed",
    "is_neg_risk",
    "uma_resolution_status",
    "volume_usd",
    "liquidity_usd",
    "start_at",
    "end_at",
    "closed_at",
    "created_at",
    "updated_at",
]

TRACKED_COLUMNS = [
    "market_id",
    "question",
    "slug",
    "is_active",
    "is_closed",
    "uma_resolution_status",
    "volume_usd",
    "liquidity_usd",
    "end_at",
    "updated_at",
]


HISTORY_COLUMNS = [*TRACKED_COLUMNS, "valid_from", "valid_to"]
HISTORY_TYPES = {
    "is_active": T.BooleanType(),
    "is_closed": T.BooleanType(),
    "volume_usd": T.DoubleType(),
    "liquidity_usd": T.DoubleType(),
    "end_at": T.TimestampType(),
    "updated_at": T.TimestampType(),
    "valid_from": T.TimestampType(),
    "valid_to": T.TimestampType(),
}


def dim_markets(stg_markets: DataFrame) -> DataFrame:
    """One row per market, current state."""
    return stg_markets.select(*DIM_COLUMNS)


def resolution_candidates(stg_markets: DataFrame) -> DataFrame:
    """Closed markets with their derived outcome and resolution moment, unusable ones too."""
    return stg_markets.filter("is_closed").select(
        "market_id",
        "condition_id",
        "question",
        "slug",
        "yes_token_id",
        "volume_usd",
        "end_at",
        "closed_at",
        prices.terminal_outcome(F.col("yes_price"), F.col("no_price")).alias("outcome"),
        (F.col("uma_resolution_status") == "resolved").alias("oracle_confirms"),
        F.coalesce("closed_at", "end_at").alias("resolved_at"),
    )


def fct_resolutions(stg_markets: DataFrame) -> DataFrame:
    """One row per resolved binary market with an unambiguous outcome."""
    return resolution_candidates(stg_markets).dropna(
        subset=["outcome", "yes_token_id", "resolved_at"]
    )


# --- price fact ------------------------------------------------------------------


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """The stored price fact, empty before its first build."""
    return table_or_empty(spark, FCT_PRICES, path)


def rebuild_prices(
    raw: DataFrame,
    path: str,
    dates: Sequence[date | str] | None = None,
    left_out: Observation | None = None,
) -> None:
    """Full refresh of the price fact from the raw rows, or of some `dates` only.

    The raw log is the truth, so this also repairs dates a crashed driver left half swapped. With
    `left_out` the rows that staging leaves out are counted on the way (see `left_out_counts`).
    """
    if left_out is not None:
        raw = raw.observe(left_out, *left_out_counts())
    points = price_points(raw)
    if dates is not None:
        days = [F.lit(day).cast("date") for day in dates]
        points = points.filter(F.to_date("price_ts").isin(days))
    write_price_partitions(best_points(points), path)


def left_out_counts() -> list[Column]:
    """One count for each reason for which staging leaves a raw price row out."""
    reason = prices.unusable_reason(F.col("token_id"), F.col("t"), F.col("p"))
    return [
        F.count_if(reason == name).alias(name.replace(" ", "_"))
        for name in prices.UNUSABLE_REASONS
    ]


def touched_dates(raw_batch: DataFrame, left_out: Observation | None = None) -> list[date]:
    """The dates that a batch of raw rows has points of.

    Points outside `EARLIEST` to `LATEST` are gone, so there are some 33,000 days at most.
    """
    if left_out is not None:
        raw_batch = raw_batch.observe(left_out, *left_out_counts())
    days = price_points(raw_batch).select(F.to_date("price_ts").alias("price_date")).distinct()
    return [row.price_date for row in days.collect()]


def merged_dates(
    spark: SparkSession, path: str, raw_batch: DataFrame, touched: list[date]
) -> DataFrame:
    """The fact's points of the touched dates after the batch.

    Old and new rows compete under the same total order as in a full rebuild, so any batch split
    ends equal to it.
    """
    old = read_prices(spark, path).filter(F.col("price_date").isin(touched))
    return best_points(old.select(*POINT_COLUMNS).unionByName(price_points(raw_batch)))


def merge_prices(spark: SparkSession, path: str, raw_batch: DataFrame) -> None:
    """Merge a batch of raw rows into the price fact; replaying a batch changes nothing.

    Only the dates the batch touches are read and rewritten. One writer at a time.
    """
    touched = touched_dates(raw_batch)
    if touched:
        write_price_partitions(merged_dates(spark, path, raw_batch, touched), path)


def newer_than_fact(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged rows ingested after the fact's newest row: the high-water-mark filter.

    Loses rows that load late with old stamps (see `late_rows`); `merge_prices` fed from
    a load checkpoint does not.
    """
    mark = fact.agg(
        F.coalesce(F.max("ingested_at"), F.timestamp_seconds(F.lit(0))).alias("mark")
    )
    return staged.filter(F.col("ingested_at") > mark.scalar())


def late_rows(late_batch: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of a late batch that the high-water-mark filter would never pick up."""
    mark = fact.agg(F.max("ingested_at").alias("mark"))
    return late_batch.filter(F.col("ingested_at") <= mark.scalar())


# --- market history --------------------------------------------------------------


def _history_args() -> dict:
    return {
        "key": "market_id",
        "updated_at": "updated_at",
        "order": [F.asc("ingested_at"), F.asc("run_id"), F.asc("payload_hash")],
        "chunk": F.to_date("ingested_at"),
        "cut": stored,
    }


def tracked(log: DataFrame) -> DataFrame:
    """What the history reads of a landing log: nothing else of it has to be parsed or stored."""
    return log.select(*TRACKED_COLUMNS, "ingested_at", "run_id", "payload_hash")


def markets_history(log: DataFrame, builds: Sequence[datetime] | None = None) -> DataFrame:
    """Validity intervals of every market from its landing log.

    Without `builds` every landed version counts. With them, only what was current at
    each build does, as a snapshot job run at those moments would have recorded.
    """
    rows = tracked(log)
    if builds is not None:
        rows = history.seen_at_builds(
            rows, key="market_id", landed_at="ingested_at", order=newest_first(), builds=builds
        )
    versions = history.scd2_from_log(rows, **_history_args())
    return versions.select(*HISTORY_COLUMNS)


def history_schema() -> T.StructType:
    """Columns of the stored history."""
    return T.StructType(
        [T.StructField(name, HISTORY_TYPES.get(name, T.StringType())) for name in HISTORY_COLUMNS]
    )


def extend_history(versions: DataFrame, new_log: DataFrame) -> DataFrame:
    """The history after the landings of one more batch."""
    return history.scd2_apply(versions, tracked(new_log), **_history_args())
