"""The declared checks of every table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.prices import unusable_reason
from marketlake.operators import quality as q

# Fixed service levels per source, in hours: (warn after, error after).
FRESHNESS_HOURS = {"raw_markets": (24, 72), "raw_price_history": (24, 48)}

# Fixed declarations: table -> columns that must never be NULL.
NOT_NULL = {
    "stg_markets": ["market_id"],
    "stg_prices": ["price_id", "token_id", "price", "fidelity_minutes"],
    "dim_markets": ["market_id"],
    "fct_prices": ["price_id", "price_ts", "price"],
    "fct_resolutions": ["market_id", "outcome", "resolved_at"],
    "mart_calibration": ["n_markets"],
    "mart_price_dynamics": ["days_before", "n_markets"],
    "mart_event_coherence": ["event_id", "sum_yes_prices"],
}

# Table -> key that must be unique.
UNIQUE = {
    "stg_markets": ["market_id"],
    "stg_prices": ["price_id"],
    "dim_markets": ["market_id"],
    "fct_prices": ["price_id"],
    "fct_resolutions": ["market_id"],
    "mart_price_dynamics": ["days_before"],
    "mart_event_coherence": ["event_id", "price_date"],
    "mart_daily_volume": ["market_id", "snap_date"],
}

OUTCOMES = ("yes", "no")


def value_checks() -> dict[str, list[q.RowCheck]]:
    """Accepted values and ranges, per table."""
    return {
        "stg_prices": [
            q.RowCheck("range:stg_prices.price", q.out_of_bounds("price", 0, 1)),
        ],
        "fct_resolutions": [
            q.RowCheck("values:fct_resolutions.outcome", q.not_in("outcome", OUTCOMES)),
        ],
        "mart_calibration": [
            q.RowCheck("range:mart_calibration.outcome_rate",
                       q.out_of_bounds("outcome_rate", 0, 1)),
        ],
        "mart_daily_volume": [
            # A negative delta is a restatement at the source: worth a look, no failure.
            q.RowCheck("range:mart_daily_volume.volume_delta_usd",
                       q.out_of_bounds("volume_delta_usd", 0), "warn"),
        ],
    }


def not_null_counts(tables: dict[str, DataFrame]) -> list[DataFrame]:
    return [
        q.row_check_counts(
            tables[table],
            [q.RowCheck(f"not_null:{table}.{c}", q.is_missing(c)) for c in columns],
        )
        for table, columns in NOT_NULL.items()
        if table in tables
    ]


def unique_counts(tables: dict[str, DataFrame], width: int | None = None) -> list[DataFrame]:
    """Uniqueness checks, all or only those on keys of `width` columns."""
    return [
        q.count_check(f"unique:{table}.{'+'.join(keys)}", q.duplicates(tables[table], keys))
        for table, keys in UNIQUE.items()
        if table in tables and width in (None, len(keys))
    ]


def value_counts(tables: dict[str, DataFrame]) -> list[DataFrame]:
    return [
        q.row_check_counts(tables[table], rows)
        for table, rows in value_checks().items()
        if table in tables
    ]


def relationship_counts(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Prices whose market is not catalogued. A warning: both sweeps run on their own."""
    lost = q.orphan_counts(tables["fct_prices"], tables["dim_markets"], "market_id")
    return [q.count_check("relationship:fct_prices.market_id", lost, "warn", F.col("n_rows"))]


def row_checks(table: str) -> list[q.RowCheck]:
    """The checks of a table that look at one row at a time."""
    missing = [
        q.RowCheck(f"not_null:{table}.{c}", q.is_missing(c)) for c in NOT_NULL.get(table, [])
    ]
    return missing + value_checks().get(table, [])


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared check on the given tables, one row each."""
    counts = [
        q.row_check_counts(df, row_checks(table)) for table, df in tables.items() if row_checks(table)
    ]
    related = relationship_counts(tables) if {"fct_prices", "dim_markets"} <= set(tables) else []
    return q.severity_report(counts + unique_counts(tables) + related)


def freshness_report(sources: dict[str, DataFrame], now: Column) -> DataFrame:
    rows = [
        q.freshness(df, name, now, *FRESHNESS_HOURS[name]) for name, df in sources.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def parse_quality(log: DataFrame) -> DataFrame:
    """Fetched markets and those without a usable token, per ingest day: counted, not failed."""
    return log.groupBy(F.to_date("ingested_at").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("yes_token_id").isNull()).alias("n_without_token"),
    )


def unusable_points(raw_prices: DataFrame) -> DataFrame:
    """Raw price rows that staging leaves out, by reason and run."""
    reason = unusable_reason(F.col("token_id"), F.col("t"), F.col("p"))
    bad = raw_prices.select("_run_id", reason.alias("reason")).filter("reason is not null")
    return bad.groupBy("_run_id", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def require_fresh(report: DataFrame) -> None:
    """Raise when a source of a freshness report is too old or empty."""
    stale = [row["source"] for row in report.filter("status = 'error'").collect()]
    if stale:
        raise RuntimeError(f"stale sources: {', '.join(sorted(stale))}")
