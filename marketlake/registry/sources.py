"""Landing, loading, layout and sweeps."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.plans import facts
from marketlake.plans.warehouse import Warehouse
from marketlake.registry.core import Inputs, emit, query
from marketlake.registry.oracle import r6
from marketlake.session import shared_dir
from marketlake.sources import landing, sweeps

from marketlake.sources.schemas import CORRUPT, RAW_PRICES
from marketlake.streaming import load, upsert



def _stamped(df: DataFrame, run: str, day: int = 31) -> DataFrame:
    plain = df.drop("_ingested_at", "_run_id", "_source")
    return landing.with_lineage(
        plain, run, "catalog", F.to_timestamp(F.lit(f"2024-01-{day:02d} 06:00:00"))
    )


@query(
    "land_raw_rows",
    """select timestamp '2024-01-31 06:00:00' as _ingested_at, 'sync-1' as _run_id,
         'catalog' as _source, payload, date '2024-01-31' as dt
       from fx_raw_markets""",
)
def land_raw_rows(x: Inputs) -> DataFrame:
    root = shared_dir(x.spark, "landing")
    landing.land(_stamped(x.raw_markets, "sync-1"), root, "raw_markets")
    good, _ = landing.split_corrupt(landing.scan_landed(x.spark, root, "raw_markets"))
    return emit(good)


@query(
    "lineage_counts",
    """select _run_id, _source, count(*) as n_rows, min(_ingested_at) as first_ingested_at,
         max(_ingested_at) as last_ingested_at
       from fx_raw_price_history group by 1, 2""",
)
def lineage_counts(x: Inputs) -> DataFrame:
    return emit(landing.lineage_counts(x.raw_prices))


@query("raw_price_scan", "select * from fx_raw_price_history")
def raw_price_scan(x: Inputs) -> DataFrame:
    path = shared_dir(x.spark, "raw_prices")
    x.raw_prices.select(*RAW_PRICES.fieldNames()).write.parquet(path)
    return emit(x.spark.read.schema(RAW_PRICES).parquet(path))


def land_in_runs(x: Inputs, root: str, runs: int = 3, newest_first: bool = False) -> None:
    """Price rows landed by several runs, on different days."""
    number = F.substring("_run_id", 5, 12).cast("bigint")
    for i in reversed(range(runs)) if newest_first else range(runs):
        part = x.raw_prices.filter(number % runs == i)
        landing.land(_stamped(part, f"harvest-{i}", 29 + i), root, "raw_price_history")


@query(
    "load_pending",
    """select timestamp '2024-01-29 06:00:00' + to_days(cast(substr(_run_id, 5) as int) % 3)
           as _ingested_at,
         concat('harvest-', cast(cast(substr(_run_id, 5) as bigint) % 3 as varchar)) as _run_id,
         'catalog' as _source, token_id, market_id, condition_id, t, p, fidelity_minutes
       from fx_raw_price_history""",
)
def load_pending(x: Inputs) -> DataFrame:
    root, warehouse = shared_dir(x.spark, "landing"), shared_dir(x.spark, "warehouse")
    land_in_runs(x, root)
    load.load_pending(x.spark, root, warehouse)
    load.load_pending(x.spark, root, warehouse)  # nothing is pending any more
    path = load.raw_path(warehouse, "raw_price_history")
    return emit(load.scan_raw(x.spark, path, "raw_price_history"))


@query(
    "load_quarantine",
    """select bad as quarantined, _run_id, token_id, if(bad, null, t) as t, if(bad, null, p) as p
       from (select *, cast(substr(_run_id, 5) as bigint) % 100 = 0 as bad
             from fx_raw_price_history)""",
)
def load_quarantine(x: Inputs) -> DataFrame:
    root, warehouse = shared_dir(x.spark, "landing"), shared_dir(x.spark, "warehouse")
    number = F.substring("_run_id", 5, 12).cast("bigint")
    rows = x.raw_prices.withColumn("a_new_field", F.lit("ignored"))
    line = landing.json_line(rows)
    broken = F.when(number % 100 == 0, F.concat(F.left(line, F.length(line) - 5))).otherwise(line)
    (
        rows.select(broken.alias("value"))
        .withColumn("dt", F.lit(date(2024, 1, 31)))
        .write.partitionBy("dt")
        .text(landing.table_path(root, "raw_price_history"))
    )
    load.load_pending(x.spark, root, warehouse, strict=False)
    path = load.raw_path(warehouse, "raw_price_history")
    good = load.scan_raw(x.spark, path, "raw_price_history").select(
        F.lit(False).alias("quarantined"), "_run_id", "token_id", "t", "p"
    )
    text = load.quarantine(x.spark, path, "raw_price_history")
    bad = text.select(
        F.lit(True).alias("quarantined"),
        F.regexp_extract(CORRUPT, '"_run_id":"([^"]*)"', 1).alias("_run_id"),
        F.regexp_extract(CORRUPT, '"token_id":"([^"]*)"', 1).alias("token_id"),
        F.lit(None).cast("bigint").alias("t"),
        F.lit(None).cast("double").alias("p"),
    )
    return good.unionByName(bad)


@query(
    "include_events",
    """select flag as include_events, 'raw_markets' as table_name, payload
       from fx_raw_markets, (values (false), (true)) flags(flag)
       union all
       select true, 'raw_events', concat('{"id":"e","markets":[', payload, ']}')
       from fx_raw_markets""",
)
def include_events(x: Inputs) -> DataFrame:
    root = shared_dir(x.spark, "landing")
    event = F.concat(F.lit('{"id":"e","markets":['), F.col("payload"), F.lit("]}"))
    landing.land(_stamped(x.raw_markets, "sync-1"), root, "raw_markets", packed=True)
    events = x.raw_markets.withColumn("payload", event)
    landing.land(_stamped(events, "sync-1"), root, "raw_events", packed=True)
    landing.land(
        _stamped(x.raw_prices.limit(0), "sync-1"), root, "raw_price_history", packed=True
    )
    loaded = []
    for flag in (False, True):
        warehouse = shared_dir(x.spark, "warehouse")
        for table in load.load_pending(x.spark, root, warehouse, include_events=flag):
            rows = load.scan_raw(x.spark, load.raw_path(warehouse, table), table)
            if "payload" in rows.columns:
                loaded.append(
                    rows.select(
                        F.lit(flag).alias("include_events"),
                        F.lit(table).alias("table_name"),
                        "payload",
                    )
                )
    return reduce(DataFrame.unionByName, loaded)


@query(
    "prices_by_partition",
    """select price_date, count(*) as n_prices, min(token_id) as first_token,
         max(token_id) as last_token
       from stg_prices where price_date between date '2024-01-10' and date '2024-01-19'
       group by 1""",
)
def prices_by_partition(x: Inputs) -> DataFrame:
    path = shared_dir(x.spark, "fct_prices")
    facts.rebuild_prices(x.raw_prices, path)
    pruned = facts.read_prices(x.spark, path).filter(
        F.col("price_date").between(F.lit(date(2024, 1, 10)), F.lit(date(2024, 1, 19)))
    )
    return pruned.groupBy("price_date").agg(
        F.count(F.lit(1)).alias("n_prices"),
        F.min("token_id").alias("first_token"),
        F.max("token_id").alias("last_token"),
    )


SINCE = sweeps.closed_since(date(2024, 1, 31))
SWEEP_COLUMNS = ["market_id", "is_closed", "end_at", "volume_usd", "sweep"]


@query(
    "sweep_open_or_recent",
    """select market_id, is_closed, end_at, volume_usd,
         case when is_closed then 'recently-closed' else 'open' end as sweep
       from stg_markets
       where not is_closed or (is_closed and cast(end_at as date) >= date '2024-01-17')""",
)
def sweep_open_or_recent(x: Inputs) -> DataFrame:
    return emit(sweeps.sweep(x.stg_markets, since=SINCE).select(*SWEEP_COLUMNS))


@query(
    "sweep_full",
    """select market_id, is_closed, end_at, volume_usd,
         case when is_closed then 'closed' else 'open' end as sweep
       from stg_markets where is_closed is not null and volume_usd >= 10000""",
)
def sweep_full(x: Inputs) -> DataFrame:
    return emit(sweeps.sweep(x.stg_markets, full=True, volume_floor=10_000).select(*SWEEP_COLUMNS))


@query(
    "max_rows_cap",
    """select market_id, is_closed, end_at, volume_usd,
         case when is_closed then 'closed' else 'open' end as sweep
       from stg_markets where is_closed is not null
       qualify row_number() over (partition by is_closed order by market_id) <= 25""",
)
def max_rows_cap(x: Inputs) -> DataFrame:
    first = sweeps.first_of_arms(sweeps.sweep(x.stg_markets, full=True), 25)
    return emit(first.select(*SWEEP_COLUMNS))


MATERIALISED = {  # table -> (the same table for the oracle, a column that is summed)
    "stg_markets": ("stg_markets", "volume_usd"),
    "stg_prices": ("stg_prices", "price"),
    "dim_markets": ("dim_markets", "volume_usd"),
    "fct_prices": ("stg_prices", "price"),
    "fct_resolutions": ("fct_resolutions", "volume_usd"),
    "markets_history": ("history", "volume_usd"),
    "mart_calibration": ("calibration", "brier_score"),
    "mart_price_dynamics": ("dynamics", "avg_abs_error"),
    "mart_event_coherence": ("coherence", "deviation"),
    "mart_daily_volume": ("daily_volume", "volume_delta_usd"),
}


@query(
    "materialize_marts",
    " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows, round(sum({column}), 3) as total "
        f"from {source}"
        for name, (source, column) in MATERIALISED.items()
    ),
)
def materialize_marts(x: Inputs) -> DataFrame:
    """A build in two batches, markets in the order of their landing: rows and a sum per table."""
    house = Warehouse(x.spark, shared_dir(x.spark, "warehouse"))
    later = F.col("_ingested_at") >= F.lit("1996-06-01").cast("timestamp")
    odd = F.substring("_run_id", 5, 12).cast("bigint") % 2 == 1
    house.build(x.raw_markets.filter(~later), x.raw_prices.filter(~odd), strict=False)
    built = house.build(
        x.raw_markets.filter(later), x.raw_prices.filter(odd), full_refresh=False, strict=False
    )
    counts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.round(F.sum(MATERIALISED[name][1]), 3).alias("total"),
        )
        for name, df in built.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "report_sources",
    f"""select horizon_hours, price_bucket, n_markets, {r6('avg_price')} as avg_price,
         {r6('outcome_rate')} as outcome_rate, {r6('wilson_low')} as wilson_low,
         {r6('wilson_high')} as wilson_high, {r6('brier_score')} as brier_score
       from calibration""",
)
def report_sources(x: Inputs) -> DataFrame:
    house = Warehouse(x.spark, shared_dir(x.spark, "warehouse"))
    house.write("mart_calibration", x.calibration)
    columns = ("avg_price", "outcome_rate", "wilson_low", "wilson_high", "brier_score")
    return emit(house.read("mart_calibration"), *columns)


@query("stream_upsert_prices", "select * from stg_prices")
def stream_upsert_prices(x: Inputs) -> DataFrame:
    raw, fact = shared_dir(x.spark, "raw_prices"), shared_dir(x.spark, "fct_prices")
    x.raw_prices.select(*RAW_PRICES.fieldNames()).repartition(3, "_run_id").write.parquet(raw)
    upsert.upsert_prices(x.spark, raw, fact, shared_dir(x.spark, "checkpoint"), files_per_merge=1)
    return emit(facts.read_prices(x.spark, fact).drop("run_id"))
