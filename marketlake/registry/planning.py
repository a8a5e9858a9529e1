"""Fetch planning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.plans import planning
from marketlake.registry.core import Inputs, emit, query
from marketlake.registry.fixtures import NOW, NOW_FRESH

FETCHED = "cast(substring(_run_id, 5, 12) as bigint) % 5"


def _now(seconds: int = NOW):
    return F.lit(seconds).cast("bigint")


def _marked(x: Inputs) -> DataFrame:
    with_token = x.stg_markets.filter(F.col("yes_token_id").isNotNull())
    marked = planning.with_watermark(with_token, planning.token_watermarks(x.raw_prices))
    return marked.select("market_id", "yes_token_id", "watermark")


def _harvest(x: Inputs) -> DataFrame:
    scope = planning.harvest_scope(x.stg_markets)
    return planning.plan_harvest(scope, planning.token_watermarks(x.raw_prices), _now(NOW_FRESH))


@query("fetch_window", "select * from windows")
def fetch_window(x: Inputs) -> DataFrame:
    return planning.with_window(_marked(x), _now())


@query(
    "fetch_chunks",
    """select market_id, yes_token_id, watermark, uncovered_seconds, chunk_start,
         least(chunk_start + 1209600, end_ts) as chunk_end
       from (select *, unnest(range(start_ts, end_ts, 1209600)) as chunk_start from windows)""",
)
def fetch_chunks(x: Inputs) -> DataFrame:
    return planning.with_chunks(planning.with_window(_marked(x), _now()))


@query(
    "skip_fresh",
    "select market_id, yes_token_id, watermark from harvest_plan where status = 'fetch'",
)
def skip_fresh(x: Inputs) -> DataFrame:
    due = _harvest(x).filter("status = 'fetch'")
    return due.select("market_id", "yes_token_id", "watermark")


@query(
    "harvest_scope",
    """select market_id, yes_token_id, volume_usd from stg_markets
       where not is_closed and volume_usd >= 10000""",
)
def harvest_scope(x: Inputs) -> DataFrame:
    scope = planning.harvest_scope(x.stg_markets)
    return scope.select("market_id", "yes_token_id", "volume_usd")


@query(
    "backfill_scope",
    """select market_id, yes_token_id, volume_usd, end_at from stg_markets
       where is_closed and volume_usd >= 10000 and cast(end_at as date) >= date '2024-01-10'""",
)
def backfill_scope(x: Inputs) -> DataFrame:
    scope = planning.backfill_scope(x.stg_markets, end_date_min="2024-01-10")
    return emit(scope.select("market_id", "yes_token_id", "volume_usd", "end_at"))


@query(
    "finest_fidelity",
    """select token_id, t, p, fidelity_minutes, _run_id from fx_raw_price_history h
       where fidelity_minutes in (60, 180, 360, 720, 1440) and fidelity_minutes = (
         select min(fidelity_minutes) from fx_raw_price_history i
         where i.token_id = h.token_id and i.fidelity_minutes in (60, 180, 360, 720, 1440))""",
)
def finest_fidelity(x: Inputs) -> DataFrame:
    finest = planning.finest_fidelity(x.raw_prices)
    return finest.select("token_id", "t", "p", "fidelity_minutes", "_run_id")


@query("advance_watermark", "select token_id, watermark from token_marks")
def advance_watermark(x: Inputs) -> DataFrame:
    before = planning.token_watermarks(x.raw_prices.filter(f"{FETCHED} <> 4"))
    return planning.advance_watermarks(before, x.raw_prices.filter(f"{FETCHED} = 4"))


@query(
    "gap_report",
    """select token_id, prev_ts, price_ts, fidelity_minutes,
         cast(epoch(price_ts) - epoch(prev_ts) as bigint) as gap_seconds
       from (select *, lag(price_ts) over (partition by token_id order by price_ts) as prev_ts
             from stg_prices)
       where epoch(price_ts) - epoch(prev_ts) > 2 * 60 * fidelity_minutes""",
)
def gap_report(x: Inputs) -> DataFrame:
    return emit(planning.gap_report(x.stg_prices, factor=2))


@query(
    "window_coverage",
    """select * from (with pieces as (
         select w.yes_token_id, w.start_ts, w.end_ts, greatest(h.t, w.start_ts) as s,
           least(h.t + 60 * h.fidelity_minutes, w.end_ts) as e
         from windows w left join fx_raw_price_history h on h.token_id = w.yes_token_id
           and h.t < w.end_ts and h.t + 60 * h.fidelity_minutes > w.start_ts),
       islands as (
         select *, sum(if(s > reach, 1, 0)) over (partition by yes_token_id order by s, e) as island
         from (select *, max(e) over (partition by yes_token_id order by s, e
                 rows between unbounded preceding and 1 preceding) as reach from pieces)),
       merged as (
         select yes_token_id, start_ts, end_ts, max(e) - min(s) as seconds
         from islands group by yes_token_id, start_ts, end_ts, island)
       select yes_token_id, cast(end_ts - start_ts as bigint) as window_seconds,
         cast(coalesce(sum(seconds), 0) as bigint) as covered_seconds,
         cast(end_ts - start_ts - coalesce(sum(seconds), 0) as bigint) as uncovered_seconds
       from merged group by yes_token_id, start_ts, end_ts)""",
)
def window_coverage(x: Inputs) -> DataFrame:
    return planning.window_coverage(planning.with_window(_marked(x), _now()), x.raw_prices)


@query(
    "run_summary",
    """select count(*) as markets_targeted,
         count(*) filter (where status = 'fetch') as tokens_fetched,
         count(*) filter (where status = 'fresh') as skipped_fresh,
         count(*) filter (where status = 'no_token') as skipped_no_token
       from harvest_plan""",
)
def run_summary(x: Inputs) -> DataFrame:
    return planning.harvest_summary(_harvest(x))


@query(
    "run_points",
    """select _run_id, count(*) as points_landed, count(distinct token_id) as tokens_landed
       from fx_raw_price_history group by 1""",
)
def run_points(x: Inputs) -> DataFrame:
    return planning.run_points(x.raw_prices)


@query(
    "fidelity_counts",
    """select fidelity_minutes, count(distinct token_id) as n_tokens, count(*) as n_points
       from fx_raw_price_history group by 1""",
)
def fidelity_counts(x: Inputs) -> DataFrame:
    return planning.fidelity_counts(x.raw_prices)


@query(
    "failure_gate",
    """select count(*) as attempted, count(*) filter (where yes_token_id is null) as failed,
         not (count(*) filter (where yes_token_id is null) > 0.1 * count(*)) as passed
       from market_log""",
)
def failure_gate(x: Inputs) -> DataFrame:
    return planning.failure_gate(x.market_log, F.col("yes_token_id").isNull())
