"""Runs: what they attempted, loaded and counted, and what the event catalog says."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.plans import attempts, planning
from marketlake.plans.run_log import RunFailed, RunLog
from marketlake.registry.core import Inputs, emit, query
from marketlake.registry.fixtures import NOW_FRESH
from marketlake.registry.sources import SINCE, land_in_runs
from marketlake.session import shared_dir
from marketlake.sources import events, sweeps
from marketlake.streaming import load

EVENT_FLOOR = 300_000
FIRST_FLOOR = 2_500_000  # the first backfill run takes the most liquid markets


def _backfilled(x: Inputs) -> tuple[attempts.AttemptLedger, RunLog, DataFrame]:
    """Two backfill runs, with a compaction of the ledger between them; the scope of the second."""
    ledger = attempts.AttemptLedger(x.spark, shared_dir(x.spark, "attempts"))
    log = RunLog(x.spark, shared_dir(x.spark, "runs"))
    by_token = x.raw_prices.groupBy("token_id")
    lowest = by_token.agg(F.min("p").alias("p")).filter("p < 0.005")
    highest = by_token.agg(F.max("p").alias("p")).filter("p > 2.5")
    scope = planning.backfill_scope(x.stg_markets)
    runs = [
        ("backfill-1", planning.backfill_scope(x.stg_markets, FIRST_FLOOR), "fidelity_minutes >= 720", lowest),
        ("backfill-2", scope, "fidelity_minutes < 720", highest),
    ]
    for day, (run, wanted, landed, failed) in enumerate(runs, 30):
        with suppress(RunFailed):  # the gate is red for so many failures; all is recorded
            attempts.finish_backfill(
                wanted, x.raw_prices.filter(landed), failed, ledger=ledger, log=log, run_id=run,
                at=F.lit(f"2024-01-{day}"),
            )
        if run == "backfill-1":
            ledger.compact()
    return ledger, log, scope


@query(
    "backfill_todo",
    """select market_id, yes_token_id, volume_usd from closed_scope
       where yes_token_id in (select token_id from last_attempts where outcome = 'failed')""",
)
def backfill_todo(x: Inputs) -> DataFrame:
    """What a third backfill run takes: every token was attempted, some failed each time."""
    ledger, _, scope = _backfilled(x)
    return attempts.plan_backfill(scope, ledger).select("market_id", "yes_token_id", "volume_usd")


@query("backfill_attempts", "select * from last_attempts")
def backfill_attempts(x: Inputs) -> DataFrame:
    ledger, _, _ = _backfilled(x)
    return emit(ledger.last())


def _backfill_counters(run: str, table: str, scope: str) -> str:
    def total(counter: str, value: str) -> str:
        return f"select '{counter}' as counter, {value} as value from {table}"

    parts = [
        f"select 'markets_targeted' as counter, count(*) as value from {scope}",
        f"select 'skipped_no_token', count(*) filter (where yes_token_id is null) from {scope}",
        f"select 'already_done', (select count(yes_token_id) from {scope}) - count(*) from {table}",
        total("attempted", "count(*)"),
        total("no_history", "count(*) filter (where outcome = 'empty')"),
        total("token_failures", "count(*) filter (where outcome = 'failed')"),
        total("points_landed", "coalesce(sum(points) filter (where outcome = 'landed'), 0)"),
        f"select concat('fidelity_', finest), count(*) from {table} where outcome = 'landed' group by 1",
    ]
    return f"select 'backfill-prices' as job, *, '{run}' as run_id from ({' union all '.join(parts)})"


_HARVEST = """
    select 'harvest-prices' as job, counter, value, 'harvest-1' as run_id from (
      select 'markets_targeted' as counter, count(*) as value from harvest_plan
      union all select 'tokens_fetched', count(*) from harvest_plan where status = 'fetch'
      union all select 'skipped_fresh_watermark', count(*) from harvest_plan where status = 'fresh'
      union all select 'skipped_no_token', count(*) from harvest_plan where status = 'no_token'
      union all select 'token_failures', count(*) from harvest_plan
        where status = 'fetch' and yes_token_id in (select token_id from broken_second)
      union all select 'points_landed', count(*) from fx_raw_price_history where fidelity_minutes = 60)
"""
_SYNC = """
    select 'sync-catalog' as job, counter, value, 'sync-1' as run_id from (
      select concat('markets_', sweep) as counter, count(*) as value from swept_markets group by 1
      union all select concat('events_', sweep), count(*) from swept_events group by 1)
"""
_LOAD = """
    select 'load-raw' as job, counter, value, 'load-1' as run_id from (
      select 'rows_loaded' as counter, count(*) as value from fx_raw_price_history
      union all select 'bad_lines', 0 union all select 'files_failed', 0
      union all select 'tables_failed', 0)
"""


@query(
    "run_counters",
    "select job, counter, cast(value as bigint) as value, run_id from ("
    + " union all ".join(
        [
            _HARVEST, _SYNC, _LOAD,
            _backfill_counters(
                "backfill-1", "first_attempts", "(select * from closed_scope where volume_usd >= 2500000)"
            ),
            _backfill_counters("backfill-2", "second_attempts", "closed_scope"),
        ]
    )
    + ")",
)
def run_counters(x: Inputs) -> DataFrame:
    """Every counter of a sync, a load, a harvest and two backfill runs, as recorded."""
    _, log, _ = _backfilled(x)
    planned = planning.plan_harvest(
        planning.harvest_scope(x.stg_markets),
        planning.token_watermarks(x.raw_prices),
        F.lit(NOW_FRESH).cast("bigint"),
    )
    highest = x.raw_prices.groupBy("token_id").agg(F.max("p").alias("p")).filter("p > 2.5")
    with suppress(RunFailed):
        attempts.finish_harvest(
            planned, x.raw_prices.filter("fidelity_minutes = 60"), highest, log=log, run_id="harvest-1"
        )
    arms = {"markets": x.stg_markets, "events": events.latest_events(x.raw_events)}
    floors = {"markets": None, "events": EVENT_FLOOR}
    swept = {
        name: sweeps.sweep(rows, since=SINCE, volume_floor=floors[name]) for name, rows in arms.items()
    }
    log.record("sync-catalog", "sync-1", sweeps.arm_counters(swept))
    root, house = shared_dir(x.spark, "landing"), shared_dir(x.spark, "warehouse")
    land_in_runs(x, root)
    load.load_pending(x.spark, root, house, log=log, run_id="load-1")
    # How many files a landing writes is up to Spark.
    return log.read().filter("counter <> 'files_loaded'")


@query(
    "loaded_dates",
    """select cast(date '2024-01-29' + cast(run as int) as varchar) as dt, run as place,
         count(*) as n_rows, cast(0 as bigint) as bad_lines, true as all_whole
       from (select cast(substr(_run_id, 5) as bigint) % 3 as run from fx_raw_price_history)
       group by run""",
)
def loaded_dates(x: Inputs) -> DataFrame:
    """Date folders in the order in which a load of small batches took them."""
    root, house = shared_dir(x.spark, "landing"), shared_dir(x.spark, "warehouse")
    land_in_runs(x, root, newest_first=True)
    load.load_pending(x.spark, root, house, files_per_batch=1)
    files = load.finished_files(x.spark, house, "raw_price_history")
    by_date = files.groupBy("dt").agg(
        F.min("batch").alias("first"),
        F.max("batch").alias("last"),
        F.sum("rows").alias("n_rows"),
        F.sum("bad_lines").alias("bad_lines"),
        F.every(F.col("state") == load.WHOLE).alias("all_whole"),
    )
    earlier = by_date.select(F.col("dt").alias("_dt"), F.col("last").alias("_last"))
    # Of three dates, how many were finished before this one began.
    met = by_date.join(earlier, F.col("_last") < F.col("first"), "left")
    return met.groupBy("dt", "n_rows", "bad_lines", "all_whole").agg(
        F.count("_dt").alias("place")
    )


@query("event_sweep", "select event_id, slug, is_closed, volume_usd, end_at, sweep from swept_events")
def event_sweep(x: Inputs) -> DataFrame:
    """Open and recently closed events above their own floor."""
    rows = events.latest_events(x.raw_events).drop("ingested_at")
    return emit(sweeps.sweep(rows, since=SINCE, volume_floor=EVENT_FLOOR))


_COMPARED = ", ".join(events.COMPARED)


@query(
    "event_market_comparison",
    f"""select coalesce(m.market_id, e.market_id) as market_id,
         case when e.market_id is null then 'only_markets' when m.market_id is null then 'only_events'
              when e.updated_at < m.updated_at or (e.updated_at is null and m.updated_at is not null)
                then 'older_in_events'
              when m.updated_at < e.updated_at or (m.updated_at is null and e.updated_at is not null)
                then 'older_in_markets'
              when m.content is distinct from e.content then 'different' else 'same' end as status,
         m.updated_at as markets_updated_at, e.updated_at as events_updated_at
       from (select market_id, updated_at, row({_COMPARED}) as content from stg_markets) m
       full join (select market_id, updated_at, row({_COMPARED}) as content from copied_markets) e
         on e.market_id = m.market_id""",
)
def event_market_comparison(x: Inputs) -> DataFrame:
    """The latest fetch of each market against the latest copy of it in an event."""
    return emit(events.compare_markets(x.raw_markets, x.raw_events))
