"""Joins, aggregations, windows, sorts and the marts they make up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators import quality
from marketlake.operators.dedupe import first_by
from marketlake.plans import facts, marts, planning, report
from marketlake.registry.core import Inputs, emit, query
from marketlake.registry.oracle import r6

CALIBRATION_FLOATS = ("avg_price", "outcome_rate", "wilson_low", "wilson_high", "brier_score")
CALIBRATION_SQL = f"""select horizon_hours, price_bucket, n_markets,
    {', '.join(f'{r6(c)} as {c}' for c in CALIBRATION_FLOATS)} from calibration"""

# --- joins -----------------------------------------------------------------------


@query("horizon_cross_join", "select * from horizon_targets")
def horizon_cross_join(x: Inputs) -> DataFrame:
    return emit(marts.horizon_targets(x.resolutions))


@query("asof_price", "select * from horizon_prices")
def asof_price(x: Inputs) -> DataFrame:
    return emit(marts.price_at_targets(marts.horizon_targets(x.resolutions), x.stg_prices))


@query(
    "price_until_resolution",
    "select * from final_month",
)
def price_until_resolution(x: Inputs) -> DataFrame:
    joined = marts.prices_before_resolution(x.resolutions, x.stg_prices)
    return emit(joined.select("market_id", "token_id", "price_ts", "price", "resolved_at"))


@query(
    "event_roster_join",
    "select * from roster_closes",
)
def event_roster_join(x: Inputs) -> DataFrame:
    members = marts.roster_members(marts.exclusive_roster(facts.dim_markets(x.stg_markets)))
    return marts.priced_roster(members, x.stg_prices)


@query(
    "orphan_prices",
    """select concat('lost-', cast(user_id % 7 as varchar)) as market_id, count(*) as n_prices
       from events where event_type = 'view' group by 1
       union all
       select market_id, count(*) from stg_prices p
       where market_id is not null
         and not exists (select 1 from dim_markets d where d.market_id = p.market_id)
       group by 1""",
)
def orphan_prices(x: Inputs) -> DataFrame:
    """Price rows without a market: those of the data, and one added for each view event."""
    lost = x.events.filter("event_type = 'view'").selectExpr(
        "concat('lost-', cast(user_id % 7 as string)) as market_id"
    )
    rows = x.stg_prices.select("market_id").union(lost)
    counts = quality.orphan_counts(rows, facts.dim_markets(x.stg_markets), "market_id")
    return counts.withColumnRenamed("n_rows", "n_prices")


@query(
    "hwm_scalar_subquery",
    """select * from stg_prices where ingested_at > (
         select coalesce(max(ingested_at), timestamp '1970-01-01') from stg_prices
         where price_date <= (select max(price_date) - 10 from stg_prices))""",
)
def hwm_scalar_subquery(x: Inputs) -> DataFrame:
    """The fact so far ends ten days before the newest point."""
    newest = x.stg_prices.agg(F.date_sub(F.max("price_date"), 10).alias("d"))
    fact = x.stg_prices.filter(F.col("price_date") <= newest.scalar())
    return emit(facts.newer_than_fact(x.stg_prices, fact))


@query("watermark_left_join", "select market_id, yes_token_id, watermark from marked")
def watermark_left_join(x: Inputs) -> DataFrame:
    joined = planning.with_watermark(x.stg_markets, planning.token_watermarks(x.raw_prices))
    return joined.select("market_id", "yes_token_id", "watermark")


# --- aggregations ----------------------------------------------------------------


@query(
    "calibration_agg",
    f"""select horizon_hours, price_bucket, n as n_markets, {r6('prices / n')} as avg_price,
         {r6('wins / n')} as outcome_rate, {r6('squares / n')} as brier_score
       from decile_sums""",
)
def calibration_agg(x: Inputs) -> DataFrame:
    targets = marts.horizon_targets(x.resolutions).drop("volume_usd")
    rows = marts.calibration_agg(marts.scored(marts.price_at_targets(targets, x.stg_prices)))
    return emit(rows, "avg_price", "outcome_rate", "brier_score")


@query("eod_price", "select * from day_close")
def eod_price(x: Inputs) -> DataFrame:
    return marts.eod_prices(x.stg_prices)


@query("multi_outcome_events", "select event_id, n_markets from rosters")
def multi_outcome_events(x: Inputs) -> DataFrame:
    return marts.multi_outcome_events(marts.exclusive_roster(facts.dim_markets(x.stg_markets)))


@query(
    "event_day_sum",
    f"""select event_id, n_markets, price_date, n_priced,
         {r6('sum_yes_prices')} as sum_yes_prices from event_days""",
)
def event_day_sum(x: Inputs) -> DataFrame:
    members = marts.roster_members(marts.exclusive_roster(facts.dim_markets(x.stg_markets)))
    rows = marts.event_day_sums(marts.priced_roster(members, x.stg_prices))
    return emit(rows, "sum_yes_prices")


DYNAMICS_SQL = f"""select days_before, n_markets, {r6('avg_abs_error')} as avg_abs_error,
    {r6('avg_abs_daily_move')} as avg_abs_daily_move from dynamics"""


@query("dynamics_agg", DYNAMICS_SQL)
def dynamics_agg(x: Inputs) -> DataFrame:
    daily = marts.daily_before_resolution(
        marts.prices_before_resolution(x.resolutions, x.stg_prices)
    )
    rows = marts.dynamics_agg(marts.with_moves(daily))
    return emit(rows, "avg_abs_error", "avg_abs_daily_move")


@query("token_watermarks", "select token_id, watermark from token_marks")
def token_watermarks(x: Inputs) -> DataFrame:
    return planning.token_watermarks(x.raw_prices)


@query(
    "warehouse_stats",
    """select (select count(*) from dim_markets) as markets,
         (select count(*) from fct_resolutions) as resolutions,
         (select count(*) from stg_prices) as prices,
         (select max(ingested_at) from stg_prices) as last_ingested""",
)
def warehouse_stats(x: Inputs) -> DataFrame:
    return emit(
        report.warehouse_stats(facts.dim_markets(x.stg_markets), x.resolutions, x.stg_prices)
    )


@query(
    "weighted_brier",
    f"""select horizon_hours, cast(sum(n_markets) as bigint) as n_total,
         {r6('sum(n_markets * brier_score) / sum(n_markets)')} as brier
       from calibration group by 1""",
)
def weighted_brier(x: Inputs) -> DataFrame:
    return emit(report.horizon_brier(x.calibration), "brier")


@query(
    "favorite_longshot",
    f"""select horizon_hours, price_bucket, n_markets, {r6('outcome_rate - avg_price')} as bias
       from calibration where price_bucket in (0, 9)""",
)
def favorite_longshot(x: Inputs) -> DataFrame:
    return emit(report.favorite_longshot(x.calibration), "bias")


# --- windows ---------------------------------------------------------------------


@query(
    "latest_market",
    """select payload, _ingested_at, _run_id from fx_raw_markets
       qualify row_number() over (partition by json_extract_string(payload, '$.id')
         order by _ingested_at desc, _run_id desc) = 1""",
)
def latest_market(x: Inputs) -> DataFrame:
    keyed = x.raw_markets.withColumn("id", F.get_json_object("payload", "$.id"))
    order = [F.desc("_ingested_at"), F.desc("_run_id"), F.desc("payload")]
    return emit(first_by(keyed, ["id"], order).select("payload", "_ingested_at", "_run_id"))


@query(
    "dedupe_price_points",
    """select token_id, t, p, fidelity_minutes, _ingested_at, _run_id from fx_raw_price_history
       qualify row_number() over (partition by token_id, t
         order by fidelity_minutes, _ingested_at desc, _run_id desc) = 1""",
)
def dedupe_price_points(x: Inputs) -> DataFrame:
    order = [F.asc("fidelity_minutes"), F.desc("_ingested_at"), F.desc("_run_id"), F.desc("p")]
    winners = first_by(x.raw_prices, ["token_id", "t"], order)
    return emit(
        winners.select("token_id", "t", "p", "fidelity_minutes", "_ingested_at", "_run_id")
    )


@query(
    "asof_rank",
    """select g.market_id, g.horizon_hours, q.price_ts, q.price,
         1 + count(*) over (partition by g.market_id, g.horizon_hours order by q.price_ts desc
           rows between unbounded preceding and 1 preceding) as recency_rank
       from horizon_targets g join stg_prices q on q.token_id = g.yes_token_id
       where g.target_ts >= q.price_ts and g.target_ts - to_hours(50) < q.price_ts""",
)
def asof_rank(x: Inputs) -> DataFrame:
    ranked = marts.ranked_prices(marts.horizon_targets(x.resolutions), x.stg_prices)
    return emit(ranked.select("market_id", "horizon_hours", "price_ts", "price", "recency_rank"))


@query("eod_version", "select * from eod_volume")
def eod_version(x: Inputs) -> DataFrame:
    return marts.eod_volume(x.history)


@query("lag_volume", "select market_id, snap_date, cum_volume_usd, volume_delta_usd from volume_changes")
def lag_volume(x: Inputs) -> DataFrame:
    return marts.volume_changes(marts.eod_volume(x.history)).drop("days_since_prev")


@query("lag_date_gap", "select market_id, snap_date, days_since_prev from volume_changes")
def lag_date_gap(x: Inputs) -> DataFrame:
    changes = marts.volume_changes(marts.eod_volume(x.history))
    return changes.select("market_id", "snap_date", "days_since_prev")


@query(
    "lag_price_move",
    f"""select market_id, days_before, eod_price, {r6('abs_daily_move')} as abs_daily_move
       from month_moves""",
)
def lag_price_move(x: Inputs) -> DataFrame:
    daily = marts.daily_before_resolution(
        marts.prices_before_resolution(x.resolutions, x.stg_prices)
    )
    return emit(marts.with_moves(daily).drop("outcome_int"), "abs_daily_move")


# --- sort and top-k --------------------------------------------------------------


@query("order_marts", CALIBRATION_SQL + " order by horizon_hours, price_bucket")
def order_marts(x: Inputs) -> DataFrame:
    return emit(x.calibration, *CALIBRATION_FLOATS)


@query(
    "top_markets_by_volume",
    """select market_id, yes_token_id, volume_usd from stg_markets
       where not is_closed and volume_usd >= 10000 order by volume_usd desc, market_id limit 50""",
)
def top_markets_by_volume(x: Inputs) -> DataFrame:
    top = planning.top_by_volume(planning.harvest_scope(x.stg_markets), 50)
    return top.select("market_id", "yes_token_id", "volume_usd")


# --- marts -----------------------------------------------------------------------


@query("stg_markets", "select * from stg_markets")
def stg_markets(x: Inputs) -> DataFrame:
    return emit(x.stg_markets)


@query("stg_prices", "select * from stg_prices")
def stg_prices(x: Inputs) -> DataFrame:
    return emit(x.stg_prices)


@query("dim_markets", "select * from dim_markets")
def dim_markets(x: Inputs) -> DataFrame:
    return emit(facts.dim_markets(x.stg_markets))


@query("fct_resolutions", "select * from fct_resolutions")
def fct_resolutions(x: Inputs) -> DataFrame:
    return emit(x.resolutions)


@query("mart_calibration", CALIBRATION_SQL)
def mart_calibration(x: Inputs) -> DataFrame:
    return emit(x.calibration, *CALIBRATION_FLOATS)


@query("mart_price_dynamics", DYNAMICS_SQL)
def mart_price_dynamics(x: Inputs) -> DataFrame:
    rows = marts.mart_price_dynamics(x.resolutions, x.stg_prices)
    return emit(rows, "avg_abs_error", "avg_abs_daily_move")


@query(
    "mart_event_coherence",
    f"""select event_id, price_date, n_markets, {r6('sum_yes_prices')} as sum_yes_prices,
         {r6('deviation')} as deviation from coherence""",
)
def mart_event_coherence(x: Inputs) -> DataFrame:
    rows = marts.mart_event_coherence(facts.dim_markets(x.stg_markets), x.stg_prices)
    return emit(rows, "sum_yes_prices", "deviation")


@query("mart_daily_volume", "select * from daily_volume")
def mart_daily_volume(x: Inputs) -> DataFrame:
    return marts.mart_daily_volume(x.history)


@query(
    "report_dataset",
    f"""select horizon_hours,
         case horizon_hours when 24 then '1 day before resolution' when 168 then '1 week before'
           else '30 days before' end as horizon_label,
         price_bucket, concat(cast(price_bucket * 10 as varchar), '–',
           cast(price_bucket * 10 + 10 as varchar), '¢') as bucket_label,
         n_markets, {', '.join(f'{r6(c)} as {c}' for c in CALIBRATION_FLOATS)},
         cast(sum(n_markets) over w as bigint) as horizon_markets,
         {r6('sum(n_markets * brier_score) over w / sum(n_markets) over w')} as horizon_brier,
         {r6('n_markets / max(n_markets) over w')} as bar_share
       from calibration window w as (partition by horizon_hours)""",
)
def report_dataset(x: Inputs) -> DataFrame:
    rows = report.report_dataset(x.calibration)
    return emit(rows, *CALIBRATION_FLOATS, "horizon_brier", "bar_share")


@query(
    "report_tiles",
    """select label, n, case when n >= 1e6 then printf('%.1fM', n / 1e6)
         when n >= 1e3 then printf('%.1fK', n / 1e3) else cast(n as varchar) end as value
       from (
         select 'Markets cataloged' as label, count(*) as n from dim_markets
         union all select 'Resolved & scored', count(*) from fct_resolutions
         union all select 'Price points', count(*) from stg_prices
         union all select 'Calibration sample', cast(sum(n_markets) as bigint) from calibration)""",
)
def report_tiles(x: Inputs) -> DataFrame:
    stats = report.warehouse_stats(facts.dim_markets(x.stg_markets), x.resolutions, x.stg_prices)
    return report.report_tiles(stats, x.calibration)
