"""Data behind the report. Everything here reads marts of a few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.display import bucket_label, compact_number

# Fixed captions.
HORIZON_LABELS = {24: "1 day before resolution", 168: "1 week before", 720: "30 days before"}


def warehouse_stats(
    dim_markets: DataFrame, fct_resolutions: DataFrame, fct_prices: DataFrame
) -> DataFrame:
    """Table sizes and the newest ingest, as one row. Three one-row aggregates are stacked
    and folded; nothing is joined."""
    def one(df: DataFrame, name: str, newest) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"), newest.alias("last")).withColumn(
            "name", F.lit(name)
        )

    none = F.max(F.lit(None).cast("timestamp"))
    stacked = (
        one(dim_markets, "markets", none)
        .unionByName(one(fct_resolutions, "resolutions", none))
        .unionByName(one(fct_prices, "prices", F.max("ingested_at")))
    )
    return stacked.agg(
        *[
            F.max(F.when(F.col("name") == name, F.col("n"))).alias(name)
            for name in ("markets", "resolutions", "prices")
        ],
        F.max("last").alias("last_ingested"),
    )


def horizon_brier(calibration: DataFrame) -> DataFrame:
    """Brier score per horizon, weighted by bucket size, and its sample size."""
    weighted = F.sum(F.col("n_markets") * F.col("brier_score")) / F.sum("n_markets")
    return calibration.groupBy("horizon_hours").agg(
        F.sum("n_markets").alias("n_total"), weighted.alias("brier")
    )


def favorite_longshot(calibration: DataFrame) -> DataFrame:
    """Bias of the extreme buckets: how much more often than priced it happened."""
    return calibration.filter(F.col("price_bucket").isin(0, 9)).select(
        "horizon_hours",
        "price_bucket",
        "n_markets",
        (F.col("outcome_rate") - F.col("avg_price")).alias("bias"),
    )


def report_dataset(calibration: DataFrame) -> DataFrame:
    """Calibration rows ready to draw: labels, horizon totals and bar heights.

    The windows run over the calibration mart, at most ten rows per horizon.
    """
    w = Window.partitionBy("horizon_hours")
    label = F.when(F.lit(False), F.lit(""))
    for hours, text in HORIZON_LABELS.items():
        label = label.when(F.col("horizon_hours") == hours, F.lit(text))
    total = F.sum("n_markets").over(w)
    return calibration.select(
        "horizon_hours",
        label.alias("horizon_label"),
        "price_bucket",
        bucket_label(F.col("price_bucket")).alias("bucket_label"),
        "n_markets",
        "avg_price",
        "outcome_rate",
        "wilson_low",
        "wilson_high",
        "brier_score",
        total.alias("horizon_markets"),
        (F.sum(F.col("n_markets") * F.col("brier_score")).over(w) / total).alias("horizon_brier"),
        (F.col("n_markets") / F.max("n_markets").over(w)).alias("bar_share"),
    )


def report_tiles(stats: DataFrame, calibration: DataFrame) -> DataFrame:
    """The headline numbers as label and compact text."""
    sample = calibration.agg(F.sum("n_markets").alias("n")).select(
        F.lit("Calibration sample").alias("label"), "n"
    )
    labels = {
        "markets": "Markets cataloged",
        "resolutions": "Resolved & scored",
        "prices": "Price points",
    }
    tiles = F.array(
        *[
            F.struct(F.lit(text).alias("label"), F.col(name).alias("n"))
            for name, text in labels.items()
        ]
    )
    counts = stats.select(F.inline(tiles))
    return counts.unionByName(sample).select("label", "n", compact_number(F.col("n")).alias("value"))
