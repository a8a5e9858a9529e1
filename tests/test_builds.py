"""Builds that checks can stop, what they count, and what they publish."""

from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import functions as F
from test_pipeline import T0, market_payload, points_table, rows_of

from marketlake.operators.quality import RowCheck, out_of_bounds
from marketlake.plans import checks, facts, history_store, staging
from marketlake.plans.run_log import RunLog
from marketlake.plans.warehouse import BuildBlocked, Warehouse
from marketlake.session import stored
from marketlake.sources.schemas import RAW_CATALOG, RAW_PRICES


def raw_markets(spark, day=0, n=6):
    rows = [(T0 + timedelta(days=day), f"r{day}-{i}", "s",
             market_payload(i, volumeNum=100 * day + i, updatedAt=f"2024-01-{3 + day:02d}T00:00:00Z"))
            for i in range(n)]
    return spark.createDataFrame(rows, RAW_CATALOG)


def contents(house, names):
    return {name: rows_of(house.spark.read.parquet(house.location(name))) for name in names}


TABLES = ["stg_markets", "dim_markets", "fct_resolutions", "fct_prices", "mart_calibration",
          "mart_price_dynamics", "mart_daily_volume", "newest_markets"]


def failing(table, bound):
    real = checks.value_checks

    def more():
        found = real()
        column = {"stg_prices": "price", "mart_calibration": "n_markets", "dim_markets": "volume_usd"}
        check = RowCheck(f"test:{table}", out_of_bounds(column[table], None, bound))
        return {**found, table: [*found.get(table, []), check]}

    return more


def test_a_failing_check_leaves_every_published_table(spark, tmp_path, monkeypatch):
    house, log = Warehouse(spark, str(tmp_path / "house")), RunLog(spark, str(tmp_path / "runs"))
    prices = points_table(spark, n=200)
    number = F.substring("_run_id", 5, 4).cast("int")
    house.build(raw_markets(spark), prices.filter(number % 4 < 2), batch="b0", log=log)
    before = contents(house, TABLES)
    history = house.build(raw_markets(spark).limit(0), prices.limit(0), full_refresh=False, batch="none")[
        "markets_history"]
    versions = rows_of(history)
    batch = (raw_markets(spark, 1), prices.filter(number % 4 == 2))

    for table, built_before in (("stg_prices", "dim_markets"), ("mart_calibration", "fct_prices")):
        with monkeypatch.context() as patched:
            patched.setattr(checks, "value_checks", failing(table, -1))
            with pytest.raises(BuildBlocked, match=f"test:{table}") as caught:
                house.build(*batch, full_refresh=False, batch="b1", log=log)
        assert caught.value.table == table
        assert contents(house, TABLES) == before
        counted = {r.counter: r.value for r in log.read().filter("run_id = 'b1'").collect()}
        assert counted[f"test:{table}"] > 0 and f"rows:{built_before}" in counted
        assert "rows:mart_daily_volume" not in counted  # what follows was not built

    # The same batch, once the check is right, ends as a full build of all rows.
    built = house.build(*batch, full_refresh=False, batch="b1", log=log)
    whole = Warehouse(spark, str(tmp_path / "whole")).build(
        raw_markets(spark).union(raw_markets(spark, 1)), prices.filter(number % 4 < 3)
    )
    for name in whole:
        assert rows_of(built[name].select(whole[name].columns)) == rows_of(whole[name]), name
    assert len(rows_of(built["markets_history"])) > len(versions)
    counted = {r.counter: r.value for r in log.read().filter("run_id = 'b1'").collect()}
    assert counted["rows:dim_markets"] == 6 and counted["unique:fct_prices.price_id"] == 0


def test_a_failing_rebuild_leaves_the_old_one(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "house"))
    prices = points_table(spark, n=100)
    house.build(raw_markets(spark), prices, batch="b0")
    before = contents(house, TABLES)
    monkeypatch.setattr(checks, "value_checks", failing("dim_markets", 3))
    with pytest.raises(BuildBlocked, match="test:dim_markets"):
        house.build(raw_markets(spark, 1), prices.limit(5), batch="b0")
    assert contents(house, TABLES) == before
    # Not strict: counted, and published.
    built = house.build(raw_markets(spark, 1), prices.limit(5), batch="b0", strict=False)
    assert rows_of(house.read("dim_markets")) == rows_of(built["dim_markets"]) != before["dim_markets"]
    assert built["markets_history"].count() == 6


def test_points_left_out_are_counted(spark, tmp_path):
    nan = float("nan")
    good = 1704067200
    points = [(None, good, 0.5), ("t", None, 0.5), ("t", 5, 0.5), ("t", good * 1000, 0.5),
              ("t", good, None), ("t", good + 60, nan), ("t", good + 120, 0.5)]
    rows = [(T0, "r", "s", t, "m", "c", at, p, 60) for t, at, p in points]
    prices = spark.createDataFrame(rows, RAW_PRICES)
    want = {"no_token": 1, "no_time": 1, "implausible_time": 2, "no_price": 2}
    house, log = Warehouse(spark, str(tmp_path / "house")), RunLog(spark, str(tmp_path / "runs"))
    house.build(raw_markets(spark), prices, batch="whole", log=log)
    house.build(raw_markets(spark, 1), prices, full_refresh=False, batch="batch", log=log)
    for run in ("whole", "batch"):
        counted = {r.counter: r.value for r in log.read().filter(F.col("run_id") == run).collect()}
        assert {k: counted[f"left_out:{k}"] for k in want} == want
        assert counted["rows:fct_prices"] == 1


def test_history_stays_in_few_folders(spark, tmp_path, monkeypatch):
    """Compactions bound what a reader lists; a moment prunes years; a replayed batch is known."""
    monkeypatch.setattr(history_store, "MOST_FOLDERS", 3)
    store = history_store.HistoryStore(spark, str(tmp_path / "history"))
    logs = []
    for year in range(2015, 2023):
        rows = [(datetime(year, 6, 1), f"r{year}-{i}", "s",
                 market_payload(i, volumeNum=year + i, updatedAt=f"{year}-0{1 + i % 3}-01T00:00:00Z"))
                for i in range(4)]
        logs.append(stored(staging.market_log(spark.createDataFrame(rows, RAW_CATALOG))))
    for k, log in enumerate(logs):
        store.extend(log, f"b{k}")
        assert len(store.folders()) <= 4
    store.extend(logs[3], "b3")  # known, whatever was compacted
    assert store.batches() == [f"b{k}" for k in range(8)]
    assert sum(r["compacted"] for r in store._rows()) == 2
    whole = facts.markets_history(reduce(lambda a, b: a.unionByName(b), logs))
    assert rows_of(store.read()) == rows_of(whole)

    moment = datetime(2021, 4, 1)
    then = store.as_of(moment)
    at = F.lit(moment).cast("timestamp")
    want = whole.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
    assert rows_of(then) == rows_of(want) and then.count() == 4
    assert all("closed_year=20" not in f or int(f.split("closed_year=")[1][:4]) >= 2021
               for f in files_read(then))
    old = store.replaced()
    assert len(old) == 8 + 7 and not set(f"{store.root}/closed/batch={f}" for f in store.folders()) & set(old)


def files_read(df):
    return [f for f in df.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]]
