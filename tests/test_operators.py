"""Operators against brute force, with hot keys and boundary values."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.operators import history, periods, quality
from marketlake.operators.asof import asof_join
from marketlake.operators.coverage import coverage_sum
from marketlake.operators.dedupe import first_by
from marketlake.operators.skew import salted_join
from marketlake.plans import marts

T0 = datetime(2024, 1, 10, 5, 30)


def asof(targets, points, day="day", hours=50):
    return asof_join(
        targets, points, on={"k": "token"}, left_ts="at", right_ts="ts",
        tolerance_hours=hours, values=["v"], right_day=day,
    )


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def point_table(spark, rows):
    df = spark.createDataFrame(rows, "token string, ts timestamp, v double")
    return df.withColumn("day", F.to_date("ts"))


def test_asof_bounds(spark):
    targets = spark.createDataFrame(
        [("at", T0), ("edge", T0), ("inside", T0), ("after", T0), ("none", T0)],
        "k string, at timestamp",
    )
    points = point_table(spark, [
        ("at", T0, 1.0),  # the moment itself counts
        ("at", T0 - timedelta(hours=1), 9.0),
        ("edge", T0 - timedelta(hours=50), 2.0),  # exactly the tolerance does not
        ("inside", T0 - timedelta(hours=50) + timedelta(seconds=1), 3.0),
        ("after", T0 + timedelta(seconds=1), 4.0),
    ])
    got = {r.k: r.v for r in asof(targets, points).collect()}
    assert got == {"at": 1.0, "inside": 3.0}


@pytest.mark.parametrize("hours", [1, 50, 24 * 9])
def test_asof_random_with_a_hot_key(spark, hours):
    rng = random.Random(hours)
    seconds = rng.sample(range(30 * 86_400), 1500)
    points = [
        ("hot" if i % 3 == 0 else f"k{i % 40}", T0 + timedelta(seconds=s), float(i))
        for i, s in enumerate(seconds)
    ]
    targets = [
        (rng.choice(["hot", *[f"k{i}" for i in range(45)]]),
         T0 + timedelta(seconds=rng.randrange(31 * 86_400), microseconds=i))
        for i in range(200)
    ]
    expected = []
    for key, at in targets:
        window = [(ts, v) for k, ts, v in points
                  if k == key and at - timedelta(hours=hours) < ts <= at]
        if window:
            expected.append((key, at, *max(window)))
    df = asof(
        spark.createDataFrame(targets, "k string, at timestamp"), point_table(spark, points),
        hours=hours,
    )
    assert as_rows(df) == sorted(expected)


def test_first_by_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id", F.lit("x").alias("s"))
    best = first_by(df, ["k"], [F.desc("id")])
    assert {r.k: r.id for r in best.collect()} == {0: 999, 1: 997, 2: 998}
    lines = [line.strip(" :+-") for line in plan_of(best).splitlines()]
    limit = next(i for i, l in enumerate(lines) if l.startswith("WindowGroupLimit") and "Partial" in l)
    exchange = next(i for i, l in enumerate(lines) if l.startswith("Exchange"))
    assert exchange < limit


def test_lag_lead_and_running_max_by_chunk(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(8)}", i, rng.randrange(50))
            for i in rng.sample(range(5000), 600)]
    df = spark.createDataFrame(rows, "k string, t int, v int").withColumn(
        "c", F.floor(F.col("t") / 97)
    )
    w = Window.partitionBy("k").orderBy("t")
    plain = df.withColumns({
        "lag": F.lag("t").over(w),
        "lead": F.lead("t").over(w),
        "seen": F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)),
    })
    lagged = periods.lag_by_chunk(df, ["k"], "c", "t", "lag")
    led = periods.lead_by_chunk(df, ["k"], "c", "t", "lead")
    seen = periods.running_max_by_chunk(df, ["k"], "c", [F.asc("t")], "v", "seen")
    for got, name in ((lagged, "lag"), (led, "lead"), (seen, "seen")):
        key = lambda r: (r[0], r[1])
        want = plain.select("k", "t", name).collect()
        assert sorted(got.select("k", "t", name).collect(), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    small = spark.range(0, 50, 2).select(F.col("id").alias("k"))
    if how in ("inner", "left"):
        small = small.withColumn("w", F.col("k") * 2)
    salted = salted_join(big, small, ["k"], spread=["id"], how=how, salts=7)
    plain = big.join(small, "k", how)
    key = lambda r: (r.k, r.id)
    assert sorted(salted.select(plain.columns).collect(), key=key) == sorted(plain.collect(), key=key)


# --- history ---------------------------------------------------------------------


def replay(log):
    """Row by row: a new version iff `updated_at` exceeds the open version's."""
    versions = {}
    for key, _seq, updated, value in sorted(log, key=lambda r: r[1]):
        mine = versions.setdefault(key, [])
        if not mine or updated > mine[-1][0]:
            mine.append([updated, None, value])
            if len(mine) > 1:
                mine[-2][1] = updated
    return sorted((k, v[0], v[1] or datetime.max, v[2]) for k, vs in versions.items() for v in vs)


def make_log(seed, n=500):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else f"m{rng.randrange(9)}", seq,
         T0 + timedelta(hours=rng.randrange(seq // 4 + 5)), float(seq))
        for seq in range(n)
    ]


def log_frame(spark, log):
    return spark.createDataFrame(log, "k string, seq int, u timestamp, v double")


def versions_of(df):
    return sorted((r.k, r.valid_from, r.valid_to or datetime.max, r.v) for r in df.collect())


def scd2_args(width):
    return {"key": "k", "updated_at": "u", "order": [F.asc("seq")],
            "chunk": F.floor(F.col("seq") / width)}


@pytest.mark.parametrize("width", [1, 13, 10_000])
def test_scd2_equals_replay(spark, width):
    log = make_log(width)
    got = history.scd2_from_log(log_frame(spark, log), **scd2_args(width))
    assert versions_of(got) == replay(log)


def test_scd2_ignores_null_updates_and_keeps_first_landing(spark):
    log = [("a", 1, T0, 1.0), ("a", 2, T0, 2.0), ("a", 3, None, 3.0)]
    got = history.scd2_from_log(log_frame(spark, log), **scd2_args(10))
    assert versions_of(got) == [("a", T0, datetime.max, 1.0)]


@pytest.mark.parametrize("cuts", [[250], [100, 101, 400]])
def test_scd2_any_split_equals_the_whole(spark, cuts):
    log = make_log(7)
    bounds = [0, *cuts, len(log)]
    frame = log_frame(spark, log)
    got = history.scd2_from_log(frame.filter(F.col("seq") < bounds[1]), **scd2_args(20)).drop("u")
    for low, high in zip(bounds[1:], bounds[2:]):
        batch = frame.filter((F.col("seq") >= low) & (F.col("seq") < high))
        got = history.scd2_apply(
            spark.createDataFrame(got.collect(), got.schema), batch, **scd2_args(20)
        )
    assert versions_of(got) == replay(log)


def test_current_and_as_of(spark):
    got = history.scd2_from_log(
        log_frame(spark, [("a", 1, T0, 1.0), ("a", 2, T0 + timedelta(days=1), 2.0)]), **scd2_args(5)
    )
    assert [r.v for r in history.current(got).collect()] == [2.0]
    at = lambda t: [r.v for r in history.as_of(got, F.lit(t)).collect()]
    assert at(T0) == [1.0]
    assert at(T0 + timedelta(days=1)) == [2.0]
    assert at(T0 - timedelta(seconds=1)) == []


def test_builds_see_only_the_last_landing(spark):
    log = [("a", 1, T0, 1.0), ("a", 2, T0 + timedelta(hours=1), 2.0),
           ("a", 3, T0 + timedelta(hours=30), 3.0), ("a", 4, T0 + timedelta(hours=60), 4.0)]
    frame = log_frame(spark, log).withColumn("landed", F.col("u"))
    seen = history.seen_at_builds(
        frame, key="k", landed_at="landed", order=[F.desc("seq")],
        builds=[T0 + timedelta(hours=40), T0 + timedelta(hours=2)],
    )
    assert sorted(r.v for r in seen.collect()) == [2.0, 3.0]


# --- periods and quality ------------------------------------------------------------


def test_diff_cumulative_uses_the_previous_observed_day(spark):
    rows = [("m", date(2024, 1, 1), 5.0), ("m", date(2024, 1, 4), 9.0), ("m", date(2024, 1, 5), 8.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    out = periods.diff_cumulative(df, "k", "d", "v", "delta", "gap").orderBy("d").collect()
    assert [(r.delta, r.gap) for r in out] == [(None, None), (4.0, 3), (-1.0, 1)]


def test_checks(spark):
    df = spark.createDataFrame([(1, "yes", 0.5), (1, "maybe", 1.5), (None, None, None)],
                               "k int, o string, p double")
    counts = quality.row_check_counts(df, [
        quality.RowCheck("null", quality.is_missing("k")),
        quality.RowCheck("values", quality.not_in("o", ["yes", "no"])),
        quality.RowCheck("range", quality.out_of_bounds("p", 0, 1), "warn"),
        quality.RowCheck("clean", F.lit(False)),
    ])
    parents = spark.createDataFrame([(2,)], "k int")
    report = quality.severity_report([
        counts,
        quality.count_check("unique", quality.duplicates(df, ["k"])),
        quality.count_check("orphans", quality.orphan_counts(df, parents, "k"), "warn", F.col("n_rows")),
    ])
    got = {r.name: (r.failures, r.status) for r in report.collect()}
    assert got == {
        "null": (1, "error"), "values": (1, "error"), "range": (1, "warn"), "clean": (0, "pass"),
        "unique": (1, "error"), "orphans": (2, "warn"),
    }
    with pytest.raises(RuntimeError, match="unique"):
        quality.raise_on_errors(report)
    quality.raise_on_errors(report.filter("status <> 'error'"))


@pytest.mark.parametrize(
    "age_hours, status", [(1, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error")]
)
def test_freshness(spark, age_hours, status):
    raw = spark.createDataFrame([(T0 - timedelta(hours=age_hours),)], "_ingested_at timestamp")
    assert quality.freshness(raw, "s", F.lit(T0), 24, 48).first().status == status


def test_freshness_of_nothing_is_an_error(spark):
    raw = spark.createDataFrame([], "_ingested_at timestamp")
    assert quality.freshness(raw, "s", F.lit(T0), 24, 48).first().status == "error"


# --- coverage and reach -----------------------------------------------------------------


def test_coverage_equals_counting_seconds(spark):
    """Overlaps, copies, gaps, midnights, empty and reversed intervals, against sets of seconds."""
    rng, day = random.Random(4), 86_400
    windows = [("a", day - 500, 3 * day + 500), ("b", 0, 100), ("c", 50, 50), ("d", 10, 20), ("e", 90, 10)]
    spans = [("a", s, s + rng.choice([0, 1, 60, 4000, 2 * day])) for s in
             (rng.randrange(0, 4 * day) for _ in range(12))]
    spans += [spans[0]] * 5 + [("b", -50, 10), ("b", 5, 20), ("b", 20, 30), ("b", 99, 300), ("b", 40, 35),
                               ("c", 0, 100), ("x", 0, 9), ("b", None, 50), ("b", 60, None)]
    schema = "k string, start long, end long"
    got = coverage_sum(spark.createDataFrame(windows, schema), spark.createDataFrame(spans, schema), "k")
    want = {}
    for key, a, b in windows:
        inside = set(range(a, b))
        seen = set()
        for k, s, e in spans:
            if k == key and s is not None and e is not None:
                seen |= inside.intersection(range(s, e))
        want[key] = (len(inside), len(seen), len(inside) - len(seen))
    assert {r.k: tuple(r)[1:] for r in got.collect()} == want


def test_a_hot_token_spreads_by_day(spark):
    schema = "k string, start long, end long"
    df = spark.createDataFrame([("a", 0, 10)], schema)
    windows = [x for x in plan_of(coverage_sum(df, df, "k")).splitlines() if "Window [" in x]
    assert windows and all("_day" in x for x in windows)


def test_reach_cuts_days_and_tokens_before_the_shuffle(spark, tmp_path):
    """100 times the prices with 1 % of the tokens resolved: the joins see that share."""
    resolutions = spark.createDataFrame(
        [("m0", "t0", "yes", datetime(2024, 3, 1, 12)), ("m1", "t1", "no", datetime(2024, 3, 2))],
        "market_id string, yes_token_id string, outcome string, resolved_at timestamp",
    ).withColumn("volume_usd", F.lit(1.0))
    points = spark.range(200 * 80).select(
        F.concat(F.lit("t"), F.col("id") % 200).alias("token_id"),
        F.timestamp_seconds(F.lit(1703980800) + F.floor(F.col("id") / 200) * 86_400).alias("price_ts"),
        ((F.col("id") % 10) / 10).alias("price"),
        F.lit(60).cast("bigint").alias("fidelity_minutes"),
    ).withColumn("price_date", F.to_date("price_ts"))
    path = str(tmp_path / "prices")
    points.write.partitionBy("price_date").parquet(path)
    prices = spark.read.parquet(path)
    reach = marts.resolved_reach(resolutions, 2, datetime(2024, 3, 1, 12), datetime(2024, 3, 2))
    near = marts.calibration_prices(prices, reach), marts.dynamics_prices(prices, reach)
    assert [df.count() for df in near] == [2 * 34, 2 * 32]  # of 16,000
    with_reach = marts.mart_calibration(resolutions, prices, reach)
    assert with_reach.collect() == marts.mart_calibration(resolutions, prices).collect()
    assert marts.mart_price_dynamics(resolutions, prices, reach).collect() == (
        marts.mart_price_dynamics(resolutions, prices).collect())
    plan = plan_of(with_reach)
    assert "LeftSemi" in plan and "scalar-subquery" not in plan and "BroadcastHashJoin" in plan
    # Too many keys to broadcast: days alone. No resolution: nothing.
    assert marts.resolved_reach(resolutions, 10**7, datetime(2024, 3, 1), datetime(2024, 3, 2)).keys is None
    none = marts.resolved_reach(resolutions.limit(0), 0, None, None)
    assert marts.mart_calibration(resolutions.limit(0), prices, none).count() == 0


def test_exploded_days_are_never_broadcast(spark):
    """Spark takes an explode for as small as its input: thirty days of many tokens went to the driver."""
    resolutions = spark.createDataFrame(
        [("m0", "t0", "yes", datetime(2024, 3, 1, 12), 1.0)],
        "market_id string, yes_token_id string, outcome string, resolved_at timestamp, volume_usd double",
    )
    prices = spark.createDataFrame(
        [("t0", datetime(2024, 2, 29), datetime(2024, 2, 29).date(), 0.5, 60)],
        "token_id string, price_ts timestamp, price_date date, price double, fidelity_minutes long",
    )
    for mart in (marts.mart_calibration, marts.mart_price_dynamics):
        df = mart(resolutions, prices)
        assert "SortMergeJoin" in plan_of(df) and "BroadcastExchange" not in plan_of(df)
        assert df.count() == 1
    parent = prices.select("token_id")
    assert "BroadcastExchange" not in plan_of(quality.orphan_counts(prices, parent, "token_id"))
