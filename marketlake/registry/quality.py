"""Data-quality checks. Tables are stored once, then each check scans what it needs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.prices import out_of_range, price_key
from marketlake.operators import quality
from marketlake.plans import checks, facts, marts
from marketlake.registry.core import Inputs, emit, query
from marketlake.registry.fixtures import NOW
from marketlake.registry.history import _unordered_history
from marketlake.session import stored

DUCK_TABLES = {
    "stg_markets": "stg_markets",
    "stg_prices": "stg_prices",
    "dim_markets": "dim_markets",
    "fct_prices": "fact_with_lost",
    "fct_resolutions": "fct_resolutions",
    "mart_calibration": "calibration",
    "mart_price_dynamics": "dynamics",
    "mart_event_coherence": "coherence",
    "mart_daily_volume": "unordered_changes",
}


def _tables(
    x: Inputs, *names: str, keep: Callable[[DataFrame], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The named tables, or all. The volume mart comes from the restating log, and the price fact
    has some more rows of unknown markets, so that warnings have something to find. The marts
    are stored, for checks that read one more than once, unless `keep` does something else."""
    keep = keep or stored
    markets, points = stored(x.stg_markets), stored(x.stg_prices)
    dims = facts.dim_markets(markets)
    resolutions = facts.fct_resolutions(markets)
    recipes = {
        "stg_markets": lambda: markets,
        "stg_prices": lambda: points,
        "dim_markets": lambda: dims,
        "fct_prices": lambda: points.union(_lost(points)),
        "fct_resolutions": lambda: resolutions,
        "mart_calibration": lambda: keep(marts.mart_calibration(resolutions, points)),
        "mart_price_dynamics": lambda: keep(marts.mart_price_dynamics(resolutions, points)),
        "mart_event_coherence": lambda: keep(marts.mart_event_coherence(dims, points)),
        "mart_daily_volume": lambda: keep(marts.mart_daily_volume(_unordered_history(x))),
    }
    return {name: recipes[name]() for name in names or recipes}


def _lost(points: DataFrame) -> DataFrame:
    """The points of the coarsest series again, under keys of their own and unknown markets."""
    prefixed = {c: F.concat(F.lit("lost-"), c) for c in ("price_id", "token_id", "market_id")}
    return points.filter("fidelity_minutes = 1440").withColumns(prefixed)


def _union(counts: list[DataFrame]) -> DataFrame:
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def _unique_sql(table: str, keys: list[str]) -> str:
    cols = ", ".join(keys)
    present = f"where {keys[0]} is not null" if len(keys) == 1 else ""
    return (
        f"select 'unique:{table}.{'+'.join(keys)}' as name, 'error' as severity, count(*) as "
        f"failures from (select {cols} from {DUCK_TABLES[table]} {present} group by {cols} "
        "having count(*) > 1)"
    )


def _not_null_sql(table: str, column: str) -> str:
    return (
        f"select 'not_null:{table}.{column}' as name, 'error' as severity, "
        f"count(*) filter (where {column} is null) as failures from {DUCK_TABLES[table]}"
    )


UNIQUE_SQL = [_unique_sql(t, k) for t, k in checks.UNIQUE.items()]
NOT_NULL_SQL = [_not_null_sql(t, c) for t, cols in checks.NOT_NULL.items() for c in cols]
VALUES_SQL = """select 'values:fct_resolutions.outcome' as name, 'error' as severity,
    count(*) filter (where outcome not in ('yes', 'no')) as failures from fct_resolutions"""
RANGE_SQL = [
    """select 'range:stg_prices.price' as name, 'error' as severity,
       count(*) filter (where price < 0 or price > 1) as failures from stg_prices""",
    """select 'range:mart_calibration.outcome_rate' as name, 'error' as severity,
       count(*) filter (where outcome_rate < 0 or outcome_rate > 1) as failures from calibration""",
    """select 'range:mart_daily_volume.volume_delta_usd' as name, 'warn' as severity,
       count(*) filter (where volume_delta_usd < 0) as failures from unordered_changes""",
]
ORPHAN_SQL = """select 'relationship:fct_prices.market_id' as name, 'warn' as severity,
    count(*) as failures from fact_with_lost where market_id is not null and market_id not in (
      select market_id from dim_markets)"""
RAW_DUPLICATES_SQL = """select 'unique:raw_price_history.token_id+t' as name, 'warn' as severity,
    count(*) as failures from (select token_id, t from fx_raw_price_history group by 1, 2
      having count(*) > 1)"""
ALL = " union all "


@query(
    "dq_unique",
    ALL.join(
        [_unique_sql(t, k) for t, k in checks.UNIQUE.items() if len(k) == 1]
        + ["""select 'unique:raw_price_history.price_id', 'warn', count(*) from (
             select price_id from price_points group by 1 having count(*) > 1)"""]
    ),
)
def dq_unique(x: Inputs) -> DataFrame:
    keys = x.raw_prices.select(price_key(F.col("token_id"), F.col("t")).alias("price_id"))
    raw = quality.duplicates(keys, ["price_id"])
    # A mart has one such key at most, so none is read twice.
    return _union(
        checks.unique_counts(_tables(x, keep=lambda df: df), width=1)
        + [quality.count_check("unique:raw_price_history.price_id", raw, "warn")]
    )


@query("dq_not_null", ALL.join(NOT_NULL_SQL))
def dq_not_null(x: Inputs) -> DataFrame:
    return _union(checks.not_null_counts(_tables(x)))


@query("dq_accepted_values", VALUES_SQL)
def dq_accepted_values(x: Inputs) -> DataFrame:
    return _union(checks.value_counts(_tables(x, "fct_resolutions")))


@query("dq_accepted_range", ALL.join(RANGE_SQL))
def dq_accepted_range(x: Inputs) -> DataFrame:
    names = ("stg_prices", "mart_calibration", "mart_daily_volume")
    return _union(checks.value_counts(_tables(x, *names)))


@query(
    "dq_unique_combination",
    ALL.join(
        [_unique_sql(t, k) for t, k in checks.UNIQUE.items() if len(k) == 2] + [RAW_DUPLICATES_SQL]
    ),
)
def dq_unique_combination(x: Inputs) -> DataFrame:
    raw = quality.duplicates(x.raw_prices, ["token_id", "t"])
    return _union(
        checks.unique_counts(_tables(x, "mart_event_coherence", "mart_daily_volume"), width=2)
        + [quality.count_check("unique:raw_price_history.token_id+t", raw, "warn")]
    )


@query("dq_relationships", ORPHAN_SQL)
def dq_relationships(x: Inputs) -> DataFrame:
    return _union(checks.relationship_counts(_tables(x, "fct_prices", "dim_markets")))


@query(
    "dq_severity_report",
    "select name, severity, failures, case when failures > 0 then severity else 'pass' end "
    f"as status from ({ALL.join([*UNIQUE_SQL, *NOT_NULL_SQL, VALUES_SQL, *RANGE_SQL, ORPHAN_SQL])})",
)
def dq_severity_report(x: Inputs) -> DataFrame:
    return checks.quality_report(_tables(x))


def _age_sql(source: str, warn: int, error: int, table: str) -> str:
    return f"""select '{source}' as source, last_ingested_at,
        ({NOW} - epoch(last_ingested_at)) / 3600.0 as age_hours,
        case when last_ingested_at is null or ({NOW} - epoch(last_ingested_at)) / 3600.0 > {error}
          then 'error' when ({NOW} - epoch(last_ingested_at)) / 3600.0 > {warn} then 'warn'
          else 'pass' end as status
      from (select max(_ingested_at) as last_ingested_at from {table})"""


@query(
    "freshness",
    _age_sql("raw_markets", 24, 72, "fx_raw_markets")
    + ALL
    + _age_sql("raw_price_history", 24, 48, "fx_raw_price_history"),
)
def freshness(x: Inputs) -> DataFrame:
    sources = {"raw_markets": x.raw_markets, "raw_price_history": x.raw_prices}
    return emit(checks.freshness_report(sources, F.timestamp_seconds(F.lit(NOW))))


@query(
    "parse_quality",
    """select cast(ingested_at as date) as ingest_date, count(*) as n_rows,
         count(*) filter (where yes_token_id is null) as n_without_token
       from market_log where market_id is not null group by 1""",
)
def parse_quality(x: Inputs) -> DataFrame:
    return checks.parse_quality(x.market_log)


@query(
    "raw_out_of_range",
    "select token_id, t, p, _run_id from fx_raw_price_history where p < 0 or p > 1",
)
def raw_out_of_range(x: Inputs) -> DataFrame:
    return x.raw_prices.filter(out_of_range(F.col("p"))).select("token_id", "t", "p", "_run_id")
