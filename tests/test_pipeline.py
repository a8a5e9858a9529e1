"""Landing, loading, merging and the warehouse, on disk."""

import gzip
import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from marketlake.plans import checks, facts, marts, staging
from marketlake.plans.warehouse import Warehouse
from marketlake.sources import landing
from marketlake.sources.schemas import RAW_PRICES, selected_tables
from marketlake.streaming import load, upsert

T0 = datetime(2024, 1, 5)
BIG_ID = "7" * 77


def points_table(spark, seed=1, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # Half of all rows are copies around one (token, moment).
        hot = i % 2 == 0
        rows.append((
            T0 + timedelta(days=rng.randrange(3)), f"run-{i:04d}", "s",
            "hot" if hot else f"t{rng.randrange(9)}", "m", "c",
            1704067200 + 3600 * (5 if hot else rng.randrange(24 * 6)),
            rng.choice([-0.1, 0.2, 0.7, 1.0025]), rng.choice([60, 720]),
        ))
    return spark.createDataFrame(rows, RAW_PRICES)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_run_ids():
    a, b = landing.new_run_id("harvest-prices"), landing.new_run_id("harvest-prices")
    assert a != b and a.startswith("harvest-prices-")


def test_event_payloads_are_opt_in():
    assert selected_tables() == ["raw_markets", "raw_price_history"]
    assert "raw_events" in selected_tables(include_events=True)


def payload_rows(spark, payloads):
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    return landing.with_lineage(df, "run-1", "catalog", datetime(2026, 7, 5, 1, 2, 3, 999))


def test_landed_lines(spark, tmp_path):
    payload = '{"id": 1.50, "big": %s, "q":"a\\"b"}' % BIG_ID
    assert landing.land(payload_rows(spark, [payload]), str(tmp_path), "raw_markets")
    files = list(Path(tmp_path, "raw/raw_markets/dt=2026-07-05/run=run-1").glob("part-*"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert len(lines) == 1 and payload in lines[0]
    row = json.loads(lines[0])
    assert row["_ingested_at"] == "2026-07-05T01:02:03+00:00" and row["_run_id"] == "run-1"
    back = landing.scan_landed(spark, str(tmp_path), "raw_markets").first()
    assert back.payload == payload


def test_an_empty_run_leaves_nothing(spark, tmp_path):
    assert not landing.land(payload_rows(spark, []), str(tmp_path), "raw_markets")
    assert not list(tmp_path.rglob("dt=*"))


def test_every_payload_comes_back(spark, tmp_path):
    payloads = ['{"id":\n"1",\r\n"a": 2}', '{"id":"2"}', "not json", '{"id":"3"}, "x": {}', None]
    landing.land(payload_rows(spark, payloads), str(tmp_path), "raw_markets")
    rows = landing.scan_landed(spark, str(tmp_path), "raw_markets").collect()
    assert all(r._corrupt_record is None for r in rows)
    back = sorted((r.payload or "") for r in rows)
    assert back == sorted(['{"id": "1",  "a": 2}', '{"id":"2"}', "not json", '{"id":"3"}, "x": {}', ""])


def write_landed(root, table, run, lines, day="2026-07-05"):
    folder = Path(root, "raw", table, f"dt={day}")
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{run}.jsonl").write_text("".join(line + "\n" for line in lines))


def price_line(i, **more):
    return json.dumps({"_ingested_at": "2026-07-05T00:00:00+00:00", "_run_id": "r", "_source": "s",
                       "token_id": BIG_ID, "market_id": "m", "condition_id": "c", "t": i, "p": 0.5,
                       "fidelity_minutes": 60, **more})


def loaded(spark, root, warehouse, **options):
    load.load_pending(spark, str(root), str(warehouse), **options)
    path = load.raw_path(str(warehouse), "raw_price_history")
    return load.scan_raw(spark, path, "raw_price_history"), path


def test_load_takes_every_pending_file_once_and_archives(spark, tmp_path):
    root, house, archive = tmp_path / "land", tmp_path / "house", tmp_path / "loaded"
    write_landed(root, "raw_markets", "m", [])
    for i in range(4):
        write_landed(root, "raw_price_history", f"run-{i}", [price_line(i)], f"2026-07-0{i + 1}")
    options = {"archive_dir": str(archive), "files_per_batch": 1}
    good, _ = loaded(spark, root, house, **options)  # four batches, one call
    assert sorted(r.t for r in good.collect()) == [0, 1, 2, 3]
    good, _ = loaded(spark, root, house, **options)
    assert good.count() == 4 and good.first().token_id == BIG_ID
    write_landed(root, "raw_price_history", "run-9", [price_line(9)], "2026-06-01")  # an old date
    good, _ = loaded(spark, root, house, **options)
    assert sorted(r.t for r in good.collect()) == [0, 1, 2, 3, 9]
    archived = [str(p) for p in archive.rglob("*.jsonl")]
    assert any(p.endswith("raw/raw_price_history/dt=2026-07-01/run-0.jsonl") for p in archived)


def test_a_replayed_load_batch_changes_nothing(spark, tmp_path):
    root, house = tmp_path / "land", tmp_path / "house"
    write_landed(root, "raw_markets", "m", [])
    write_landed(root, "raw_price_history", "a", [price_line(1), price_line(2)])
    good, path = loaded(spark, root, house)
    assert good.count() == 2
    # A crash after the write and before the commit: the commit of the batch is gone.
    commits = house / "checkpoints" / "load_raw_price_history" / "commits"
    for name in ("0", ".0.crc"):
        if (commits / name).exists():
            (commits / name).unlink()
    good, path = loaded(spark, root, house)
    assert sorted(r.t for r in good.collect()) == [1, 2]


def test_bad_lines_and_files_fail_the_run_at_the_end(spark, tmp_path):
    root, house = tmp_path / "land", tmp_path / "house"
    write_landed(root, "raw_markets", "ok", [json.dumps({"_run_id": "r", "payload": {"id": "1"}})])
    Path(root, "raw/raw_markets/dt=2026-07-05/broken.json.gz").write_bytes(b"no gzip at all")
    write_landed(root, "raw_price_history", "a", [price_line(1), "{broken", price_line(2, t="x")])
    write_landed(root, "raw_price_history", "b", [price_line(3, brand_new_field={"x": 1})])
    with pytest.raises(load.LoadFailed, match="2 line") as caught:
        loaded(spark, root, house)
    results = caught.value.results
    assert results["raw_markets"].unreadable_files == 1 and results["raw_markets"].rows == 1
    assert (results["raw_price_history"].rows, results["raw_price_history"].bad_lines) == (2, 2)
    path = load.raw_path(str(house), "raw_price_history")
    good = load.scan_raw(spark, path, "raw_price_history")
    assert sorted(r.t for r in good.collect()) == [1, 3]
    bad = [r[0] for r in load.quarantine(spark, path, "raw_price_history").collect()]
    assert len(bad) == 2 and "{broken" in bad
    # The next run has nothing new, and old bad lines do not make it red.
    results = load.load_pending(spark, str(root), str(house))
    assert not any(r.failed for r in results.values())


def test_a_compressed_file_that_breaks_off_fails_the_run(spark, tmp_path):
    root, house, archive = tmp_path / "land", tmp_path / "house", tmp_path / "loaded"
    write_landed(root, "raw_markets", "m", [])
    write_landed(root, "raw_price_history", "a", [price_line(1)])
    folder = Path(root, "raw/raw_price_history/dt=2026-07-05")
    lines = "".join(f"{price_line(i)}\n" for i in range(20_000)).encode()
    (folder / "whole.json.gz").write_bytes(gzip.compress(lines))
    packed = gzip.compress(lines)
    (folder / "half.json.gz").write_bytes(packed[: len(packed) // 2])
    with pytest.raises(load.LoadFailed, match="half.json.gz") as caught:
        loaded(spark, root, house, archive_dir=str(archive))
    result = caught.value.results["raw_price_history"]
    assert result.unreadable_files == 1 and 20_001 < result.rows < 40_001
    assert [p.rsplit("/", 1)[1] for p in result.partly_read] == ["half.json.gz"]


def test_loaded_merged_and_rebuilt_agree(spark, tmp_path):
    root, house = tmp_path / "land", str(tmp_path / "house")
    good_t = 1704067200
    write_landed(root, "raw_markets", "m", [])
    write_landed(root, "raw_price_history", "a", [
        price_line(good_t), price_line(good_t + 60, fidelity_minutes="abc"), "{broken",
        price_line(good_t * 1000), price_line(good_t * 1_000_000), price_line(5)])
    load.load_pending(spark, str(root), house, strict=False)
    path, fact = load.raw_path(house, "raw_price_history"), str(tmp_path / "fct")
    upsert.upsert_prices(spark, path, fact, str(tmp_path / "cp"))
    write_landed(root, "raw_price_history", "b", [price_line(good_t), price_line(good_t + 120)])
    load.load_pending(spark, str(root), house)
    upsert.upsert_prices(spark, path, fact, str(tmp_path / "cp"))
    raw = load.scan_raw(spark, path, "raw_price_history")
    facts.rebuild_prices(raw, str(tmp_path / "whole"))
    merged = rows_of(facts.read_prices(spark, fact))
    assert merged == rows_of(facts.read_prices(spark, str(tmp_path / "whole")))
    assert len(merged) == 2  # the line with a text for a number is quarantined, odd times are not
    counted = {r.reason: r.n_rows for r in checks.unusable_points(raw).collect()}
    assert counted == {"implausible time": 3}


def test_finest_then_newest_wins(spark):
    rows = [
        (T0, "r1", "s", "a", "m", "c", 1704070800, 0.1, 720),
        (T0, "r1", "s", "a", "m", "c", 1704070800, 0.2, 60),
        (T0 + timedelta(days=1), "r2", "s", "a", "m", "c", 1704070800, 0.3, 60),
        (T0 + timedelta(days=2), "r3", "s", "a", "m", "c", 1704070800, 0.4, 1440),
        (T0, "r1", "s", "b", "m", "c", 1704070800, 0.5, 60),
        (T0, "r2", "s", "b", "m", "c", 1704070800, 0.6, 60),  # same second: the later run
    ]
    staged = staging.stg_prices(spark.createDataFrame(rows, RAW_PRICES))
    assert {r.token_id: r.price for r in staged.collect()} == {"a": 0.3, "b": 0.6}


@pytest.mark.parametrize("modulus", [1, 4])
def test_any_batch_split_equals_a_rebuild(spark, tmp_path, modulus):
    raw = points_table(spark)
    number = F.substring("_run_id", 5, 4).cast("int")
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    facts.rebuild_prices(raw, whole)
    for i in [*range(modulus), 0]:  # the last one replays the first batch
        facts.merge_prices(spark, parts, raw.filter(number % modulus == i))
    assert rows_of(facts.read_prices(spark, parts)) == rows_of(facts.read_prices(spark, whole))


def test_rebuild_of_single_dates(spark, tmp_path):
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    raw = points_table(spark)
    facts.rebuild_prices(raw, whole)
    facts.rebuild_prices(raw.filter("t < 1704240000"), broken)  # two dates of six
    facts.rebuild_prices(raw, broken, ["2024-01-03", "2024-01-04", "2024-01-05", "2024-01-06"])
    assert rows_of(facts.read_prices(spark, broken)) == rows_of(facts.read_prices(spark, whole))


def test_merge_leaves_other_dates_alone(spark, tmp_path):
    path = str(tmp_path / "fct")
    raw = points_table(spark)
    facts.merge_prices(spark, path, raw)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    one_day = raw.filter(F.to_date(F.timestamp_seconds("t")) == F.lit("2024-01-03"))
    facts.merge_prices(spark, path, one_day.limit(5))
    after = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    same = {p for p in before if after.get(p) == before[p]}
    assert all("price_date=2024-01-03" in str(p) for p in set(before) - same)
    facts.merge_prices(spark, path, raw.limit(0))


def test_stream_upsert_equals_a_rebuild(spark, tmp_path):
    raw_path, fact = str(tmp_path / "raw"), str(tmp_path / "fct")
    raw = points_table(spark, n=200)
    checkpoint = str(tmp_path / "cp")
    for half in (0, 1):
        raw.filter(F.substring("_run_id", 5, 4).cast("int") % 3 % 2 == half).coalesce(1).write.mode(
            "append").parquet(raw_path)
        upsert.upsert_prices(spark, raw_path, fact, checkpoint)
    facts.rebuild_prices(raw, str(tmp_path / "whole"))
    assert rows_of(facts.read_prices(spark, fact)) == rows_of(
        facts.read_prices(spark, str(tmp_path / "whole")))


def market_payload(i, closed=True, **more):
    return json.dumps({
        "id": str(i), "clobTokenIds": json.dumps([f"t{i}", f"n{i}"]),
        "outcomePrices": json.dumps(["1", "0"] if i % 2 else ["0", "1"]), "closed": closed,
        "negRisk": True, "events": [{"id": "e"}], "closedTime": "2024-01-06 00:00:00+00",
        "volumeNum": 10 + i, "updatedAt": f"2024-01-0{1 + i % 5}T00:00:00Z", **more,
    })


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    payloads = [market_payload(i) for i in range(9)] + ['{"question":"no id"}']
    raw = spark.createDataFrame(
        [(T0, f"r{i}", "s", p) for i, p in enumerate(payloads)],
        "_ingested_at timestamp, _run_id string, _source string, payload string",
    )
    prices = points_table(spark)
    house = Warehouse(spark, str(tmp_path_factory.mktemp("house")))
    return house, house.build(raw, prices), raw, prices


def test_warehouse_tables(spark, built):
    house, tables, raw, prices = built
    assert tables["dim_markets"].count() == 9
    assert rows_of(tables["stg_markets"]) == rows_of(staging.stg_markets(raw))
    assert rows_of(tables["fct_prices"].drop("run_id").select(*staging.PRICE_COLUMNS)) == rows_of(
        staging.stg_prices(prices))
    assert tables["fct_resolutions"].count() == 9
    report = checks.quality_report(tables)
    assert {r.status for r in report.collect()} <= {"pass", "warn"}
    assert spark.table("stg_markets").count() == 9


def test_warehouse_rerun_on_a_batch(built):
    house, tables, raw, prices = built
    before = {name: rows_of(df) for name, df in tables.items()}
    tables.update(house.build(raw, prices.limit(20), full_refresh=False))
    assert {name: rows_of(df) for name, df in tables.items()} == before


def test_batches_end_as_a_full_build(spark, tmp_path):
    rows = [
        (T0 + timedelta(days=day), f"r{day}-{i}", "s",
         market_payload(i, volumeNum=100 * day + i, updatedAt=f"2024-01-{3 + day + i % 2:02d}T00:00:00Z"))
        for day in range(4) for i in range(6)
    ] + [(None, "r-null", "s", market_payload(1, updatedAt="2024-01-02T00:00:00Z"))]
    raw = spark.createDataFrame(
        rows, "_ingested_at timestamp, _run_id string, _source string, payload string")
    prices = points_table(spark)
    number = F.substring("_run_id", 5, 4).cast("int")
    whole = Warehouse(spark, str(tmp_path / "whole")).build(raw, prices)
    house = Warehouse(spark, str(tmp_path / "parts"))
    first = F.col("_ingested_at").isNull() | (F.col("_ingested_at") < T0 + timedelta(days=1))
    house.build(raw.filter(first), prices.filter(number % 3 == 0))
    for k in (1, 2):
        later = F.col("_ingested_at") >= T0 + timedelta(days=k)
        if k == 1:
            later = later & (F.col("_ingested_at") < T0 + timedelta(days=2))
        batch = (raw.filter(later), prices.filter(number % 3 == k))
        parts = house.build(*batch, full_refresh=False, batch=f"b{k}")
    parts = house.build(*batch, full_refresh=False, batch="b2")  # a replay
    for name in whole:
        assert rows_of(parts[name].select(whole[name].columns)) == rows_of(whole[name]), name
    open_ones = parts["markets_history"].filter("valid_to is null")
    assert open_ones.groupBy("market_id").count().filter("count > 1").count() == 0


def test_a_stale_source_stops_the_build(built):
    house, _, raw, prices = built
    with pytest.raises(RuntimeError, match="stale"):
        house.build(raw, prices, now=F.lit("2025-01-01").cast("timestamp"))


def test_prices_after_resolution_do_not_count(spark):
    resolutions = spark.createDataFrame(
        [("m", "t", "yes", datetime(2024, 1, 31, 12))],
        "market_id string, yes_token_id string, outcome string, resolved_at timestamp",
    )
    rows = [("t", datetime(2024, 1, 31, 12), 0.9), ("t", datetime(2024, 1, 31, 13), 0.1),
            ("t", datetime(2024, 1, 28, 1), 0.5), ("t", datetime(2024, 1, 28, 2), 0.6),
            ("t", datetime(2024, 1, 1, 0), 0.2), ("t", datetime(2023, 12, 31, 23), 0.3)]
    points = spark.createDataFrame(rows, "token_id string, price_ts timestamp, price double")
    points = points.withColumn("price_date", F.to_date("price_ts"))
    daily = marts.daily_before_resolution(marts.prices_before_resolution(resolutions, points))
    got = {r.days_before: (r.eod_price, r.abs_daily_move) for r in marts.with_moves(daily).collect()}
    assert got[0] == (0.9, pytest.approx(0.3))
    assert got[3] == (0.6, pytest.approx(0.4))
    assert got[30] == (0.2, None) and len(got) == 3


def test_coherence_needs_every_market(spark):
    markets = spark.createDataFrame(
        [("e", str(i), f"t{i}", True) for i in range(3)]
        + [("e", "9", None, True), ("small", "7", "t7", True), ("small", "8", "t8", True),
           ("loose", "4", "t0", None)],
        "event_id string, market_id string, yes_token_id string, is_neg_risk boolean",
    )
    rows = [(f"t{i}", datetime(2024, 1, 1, h), 0.1 * (i + 1) + h / 100) for i in range(3) for h in (1, 2)]
    rows += [("t0", datetime(2024, 1, 2), 0.5), ("t7", datetime(2024, 1, 1), 0.5)]
    points = spark.createDataFrame(rows, "token_id string, price_ts timestamp, price double")
    points = points.withColumn("price_date", F.to_date("price_ts"))
    got = marts.mart_event_coherence(markets, points).collect()
    assert len(got) == 1 and got[0].n_markets == 3
    assert got[0].sum_yes_prices == pytest.approx(0.66)
    assert got[0].deviation == pytest.approx(-0.34)


# --- plans -----------------------------------------------------------------------


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def test_marts_without_nested_loops_or_python(built, no_broadcast):
    _, t, _, _ = built
    for mart in (
        marts.mart_calibration(t["fct_resolutions"], t["fct_prices"]),
        marts.mart_price_dynamics(t["fct_resolutions"], t["fct_prices"]),
        marts.mart_event_coherence(t["dim_markets"], t["fct_prices"]),
        marts.mart_daily_volume(t["markets_history"]),
        checks.quality_report(t),
    ):
        plan = plan_of(mart)
        for bad in ("CartesianProduct", "NestedLoop", "Python", "ObjectHashAggregate"):
            assert bad not in plan, bad


def test_daily_aggregate_reuses_the_join_partitioning(built, no_broadcast):
    _, t, _, _ = built
    joined = marts.prices_before_resolution(t["fct_resolutions"], t["fct_prices"])
    assert plan_of(marts.daily_before_resolution(joined)).count("Exchange") == plan_of(joined).count(
        "Exchange")


def test_days_out_of_reach_are_pruned(spark, built):
    _, t, _, _ = built
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    targets = marts.horizon_targets(t["fct_resolutions"])
    for df in (
        marts.price_at_targets(targets, t["fct_prices"]),
        marts.prices_before_resolution(t["fct_resolutions"], t["fct_prices"]),
    ):
        scans = [x for x in plan_of(df).splitlines() if "PartitionFilters" in x and "token_id" in x]
        assert any("price_date" in x and ">=" in x and "<=" in x for x in scans), scans


def test_other_tokens_go_before_closing_prices_are_taken(built, no_broadcast):
    _, t, _, _ = built
    plan = plan_of(marts.mart_event_coherence(t["dim_markets"], t["fct_prices"]))
    lines = plan.splitlines()
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    closing = [i for i, x in enumerate(lines) if "max_by(price" in x]
    assert closing and max(closing) < semi  # parents are printed before their children


def test_calibration_is_ordered(built):
    _, t, _, _ = built
    mart = marts.mart_calibration(t["fct_resolutions"], t["fct_prices"])
    keys = [(r.horizon_hours, r.price_bucket) for r in mart.collect()]
    assert keys == sorted(keys)


def test_a_payload_is_parsed_once_and_comes_back(spark, tmp_path):
    """Odd payloads through landing: JSON in its place, anything else as text."""
    whole = ['{"a":1}', "1", "null", '"x"', "[1]", '{"a":\n[2,\r\n3]}']
    texts = ["", "  ", "1, 2", "abc", "{'a':1}", '{"a":1,"a":2}', '{"a":', '{"a":NaN}', "01"]
    raw = spark.createDataFrame([(p,) for p in [*whole, *texts, None]], "payload string")
    rows = landing.with_lineage(raw, "r", "s", F.to_timestamp(F.lit("2024-01-31")))
    lines = rows.select("payload", landing.json_line(rows).alias("line"))
    assert "from_json" not in plan_of(lines)
    got = {r.payload: r.line for r in lines.collect()}
    assert not any("\n" in x or "\r" in x for x in got.values())
    for p in whole:
        assert json.loads(got[p])["payload"] == json.loads(p)
    for p in texts:
        assert json.loads(got[p])["payload"] == p
    assert json.loads(got[None])["payload"] is None and json.loads(got["1"])["_run_id"] == "r"
