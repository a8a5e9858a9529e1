"""Headline timings; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_COPIES  copies of the price history under new tokens, the first copy's busiest third
              under one single token (default 1: the given data as it is)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)

The landed raw tables are stored first, untimed. Staging and history read them; the marts
read the stored fact tables, as they do in a built warehouse.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.plans import checks, facts, marts, planning, staging
from marketlake.registry import fixtures
from marketlake.session import local_session, shared_dir, stored
from marketlake.sources import landing
from marketlake.streaming import load, upsert


def replicated(raw_prices: DataFrame, copies: int) -> DataFrame:
    """The price history `copies` times over; a third of all rows belongs to one token."""
    if copies == 1:
        return raw_prices
    copy = raw_prices.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    busy = F.pmod(F.xxhash64("_run_id", "copy"), F.lit(3)) == 0
    token = F.when(F.col("copy") == 1, F.col("token_id")).otherwise(
        F.concat("token_id", F.lit("-"), F.col("copy").cast("string"))
    )
    spread = F.col("t") + F.pmod(F.xxhash64("copy"), F.lit(3600))
    return copy.withColumns(
        {
            "token_id": F.when(busy, F.lit("tok-1")).otherwise(token),
            "t": F.when(busy, F.col("t") + F.pmod(F.xxhash64("_run_id", "copy"), F.lit(3600)))
            .otherwise(spread),
        }
    ).drop("copy")


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, runs: int) -> float:
    run()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = set(sys.argv[1:])
    spark = local_session(cores=cores, partitions=cores, **{"spark.driver.memory": "16g"})

    raw_markets = stored(fixtures.raw_markets(spark, sf_dir))
    raw_prices = stored(replicated(fixtures.raw_price_history(spark, sf_dir), copies))
    batch = raw_prices.filter(F.pmod(F.xxhash64("_run_id"), F.lit(10)) == 0)
    log = stored(staging.market_log(raw_markets))
    markets = stored(staging.latest_markets(log))
    resolutions = stored(facts.fct_resolutions(markets))
    # A build observes these while it writes the table.
    moment = F.col("resolved_at").cast("timestamp_ntz")
    reach = marts.resolved_reach(
        resolutions, *resolutions.agg(F.count("*"), F.min(moment), F.max(moment)).head()
    )
    prices_path = shared_dir(spark, "fct_prices")
    facts.rebuild_prices(raw_prices, prices_path)
    prices = facts.read_prices(spark, prices_path)
    history = stored(facts.markets_history(log))
    merge_path = shared_dir(spark, "merged")
    facts.rebuild_prices(raw_prices, merge_path)
    now = F.lit(fixtures.NOW).cast("bigint")
    landed = shared_dir(spark, "landing")
    one_run = {"_run_id": F.lit("bench")}
    landing.land(raw_prices.withColumns(one_run), landed, "raw_price_history")
    landing.land(raw_markets.limit(1).withColumns(one_run), landed, "raw_markets")
    recent = F.col("ingested_at") >= F.lit("1998-01-01").cast("timestamp")
    open_before = stored(
        facts.markets_history(log.filter(~recent)).filter(F.col("valid_to").isNull())
    )
    late_log = stored(log.filter(recent))

    def upsert_all() -> None:
        house = shared_dir(spark, "house")
        load.load_pending(spark, landed, house)
        upsert.upsert_prices(
            spark, load.raw_path(house, "raw_price_history"), f"{house}/fct", f"{house}/cp"
        )

    def tables() -> dict[str, DataFrame]:
        return {
            "stg_markets": markets,
            "dim_markets": facts.dim_markets(markets),
            "fct_prices": prices,
            "fct_resolutions": resolutions,
        }

    work = {
        "stage_markets": lambda: noop(staging.stg_markets(raw_markets)),
        "stage_prices": lambda: noop(staging.stg_prices(raw_prices)),
        "fct_prices_rebuild": lambda: facts.rebuild_prices(
            raw_prices, shared_dir(spark, "rebuilt")
        ),
        "fct_prices_merge": lambda: facts.merge_prices(spark, merge_path, batch),
        "mart_calibration": lambda: noop(marts.mart_calibration(resolutions, prices, reach)),
        "mart_price_dynamics": lambda: noop(marts.mart_price_dynamics(resolutions, prices, reach)),
        "mart_event_coherence": lambda: noop(
            marts.mart_event_coherence(facts.dim_markets(markets), prices)
        ),
        "markets_history": lambda: noop(facts.markets_history(log)),
        "markets_history_extend": lambda: noop(facts.extend_history(open_before, late_log)),
        "load_pending": lambda: load.load_pending(spark, landed, shared_dir(spark, "house")),
        "load_and_upsert": upsert_all,
        "mart_daily_volume": lambda: noop(marts.mart_daily_volume(history)),
        "finest_fidelity": lambda: noop(planning.finest_fidelity(raw_prices)),
        "gap_report": lambda: noop(planning.gap_report(prices, 24)),
        "window_coverage": lambda: noop(
            planning.window_coverage(
                planning.with_window(
                    planning.with_watermark(markets, planning.token_watermarks(raw_prices)), now
                ),
                raw_prices,
            )
        ),
        "fetch_plan": lambda: noop(
            planning.plan_fetches(
                planning.harvest_scope(markets), planning.token_watermarks(raw_prices), now
            )
        ),
        "quality_report": lambda: noop(checks.quality_report(tables())),
        "calibration_from_raw": lambda: noop(
            marts.mart_calibration(
                facts.fct_resolutions(staging.stg_markets(raw_markets)),
                staging.stg_prices(raw_prices),
            )
        ),
    }
    seconds = {name: timed(run, runs) for name, run in work.items() if not only or name in only}
    print(
        json.dumps(
            {
                "metric": "total of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "price_rows": raw_prices.count(),
                "cpus": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
