"""Fetch planning: windows, chunks, scopes, gates, sweeps."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlake.plans import planning
from marketlake.sources import sweeps

DAY = 86_400
NOW = 1_800_000_000


def now():
    return F.lit(NOW).cast("bigint")


def window(spark, watermark):
    df = spark.createDataFrame([("m", "t", watermark)],
                               "market_id string, yes_token_id string, watermark long")
    row = planning.with_window(df, now()).first()
    return row.start_ts, row.end_ts


def test_first_fetch_looks_back(spark):
    assert window(spark, None) == (NOW - 30 * DAY, NOW)


def test_incremental_fetch_overlaps_its_watermark(spark):
    mark = NOW - 6 * 3600
    assert window(spark, mark) == (mark - 3600, NOW)


def test_stale_watermark_is_capped_and_the_rest_counted(spark):
    assert window(spark, NOW - 90 * DAY)[0] == NOW - 30 * DAY
    df = spark.createDataFrame([(NOW - 90 * DAY,), (NOW - DAY,), (None,)], "watermark long")
    rows = planning.with_window(df, now()).collect()
    assert [r.uncovered_seconds for r in rows] == [60 * DAY + 3600, 0, 0]


@pytest.mark.parametrize(
    "start, chunks",
    [
        (NOW - 30 * DAY, [(NOW - 30 * DAY, NOW - 16 * DAY), (NOW - 16 * DAY, NOW - 2 * DAY),
                          (NOW - 2 * DAY, NOW)]),
        (NOW - 28 * DAY, [(NOW - 28 * DAY, NOW - 14 * DAY), (NOW - 14 * DAY, NOW)]),
        (NOW - 3600, [(NOW - 3600, NOW)]),
        (NOW, []),
        (NOW + 5, []),
    ],
)
def test_chunks_cover_the_window(spark, start, chunks):
    df = spark.createDataFrame([("m", start, NOW)], "market_id string, start_ts long, end_ts long")
    rows = planning.with_chunks(df).orderBy("chunk_start").collect()
    assert [(r.chunk_start, r.chunk_end) for r in rows] == chunks


def test_status_is_strict_about_freshness(spark):
    rows = [(None, None), ("a", None), ("b", NOW - 1799), ("c", NOW - 1800)]
    df = spark.createDataFrame(rows, "yes_token_id string, watermark long")
    got = {r.yes_token_id: r.s for r in df.select("yes_token_id", planning.fetch_status(now()).alias("s")).collect()}
    assert got == {None: "no_token", "a": "fetch", "b": "fresh", "c": "fetch"}


def market_table(spark):
    rows = [
        ("1", "t1", False, 20_000.0, datetime(2024, 3, 1)),
        ("2", "t2", False, 9_999.0, datetime(2024, 3, 1)),
        ("3", None, False, 50_000.0, datetime(2024, 3, 1)),
        ("4", "t4", True, 10_000.0, datetime(2024, 1, 17)),
        ("5", "t5", True, 90_000.0, datetime(2024, 1, 16)),
        ("6", "t6", None, 90_000.0, datetime(2024, 1, 20)),
        ("7", "t7", True, 90_000.0, None),
    ]
    return spark.createDataFrame(
        rows, "market_id string, yes_token_id string, is_closed boolean, volume_usd double, "
        "end_at timestamp"
    )


def ids(df):
    return sorted(r.market_id for r in df.collect())


def test_scopes(spark):
    markets = market_table(spark)
    assert ids(planning.harvest_scope(markets)) == ["1", "3"]
    assert [r.market_id for r in planning.top_by_volume(planning.harvest_scope(markets), 1).collect()] == ["3"]
    assert ids(planning.backfill_scope(markets)) == ["4", "5", "7"]
    assert ids(planning.backfill_scope(markets, end_date_min="2024-01-17")) == ["4"]
    attempted = spark.createDataFrame([("t5",), ("t5",), ("zz",)], "token_id string")
    assert ids(planning.backfill_todo(planning.backfill_scope(markets), attempted)) == ["4", "7"]


def test_sweeps_name_both_states(spark):
    markets = market_table(spark)
    since = sweeps.closed_since(date(2024, 1, 31))
    assert since == date(2024, 1, 17)
    recent = {r.market_id: r.sweep for r in sweeps.sweep(markets, since=since).collect()}
    assert recent == {"1": "open", "2": "open", "3": "open", "4": "recently-closed"}
    assert ids(sweeps.sweep(markets, full=True)) == ["1", "2", "3", "4", "5", "7"]
    assert ids(sweeps.sweep(markets, full=True, volume_floor=50_000)) == ["3", "5", "7"]
    assert ids(sweeps.first_of_arms(sweeps.sweep(markets, full=True), 1)) == ["1", "4"]


def test_nan_is_below_every_floor(spark):
    nan = float("nan")
    markets = spark.createDataFrame(
        [("1", False, nan), ("2", False, 20_000.0), ("3", True, nan), ("4", False, None)],
        "market_id string, is_closed boolean, volume_usd double",
    )
    assert ids(planning.harvest_scope(markets)) == ["2"]
    assert ids(planning.backfill_scope(markets)) == []
    assert ids(sweeps.sweep(markets, full=True, volume_floor=1.0)) == ["2"]
    assert [r.market_id for r in planning.top_by_volume(markets, 2).collect()] == ["2", "1"]


def raw_points(spark, rows):
    return spark.createDataFrame(
        rows, "token_id string, t long, p double, fidelity_minutes long, _run_id string"
    )


def test_whole_series_at_the_finest_rung(spark):
    raw = raw_points(spark, [
        ("a", 1, 0.1, 720, "r"), ("a", 2, 0.2, 60, "r"), ("a", 3, 0.3, 60, "r"),
        ("b", 1, 0.4, 1440, "r"), ("c", 1, 0.5, 5, "r"),
    ])
    got = sorted((r.token_id, r.t) for r in planning.finest_fidelity(raw).collect())
    assert got == [("a", 2), ("a", 3), ("b", 1)]  # 5 minutes is no rung of the ladder


def test_watermarks_never_go_back(spark):
    marks = planning.token_watermarks(raw_points(spark, [("a", 9, 0.1, 60, "r"), (None, 99, 0.1, 60, "r")]))
    late = raw_points(spark, [("a", 5, 0.1, 60, "r"), ("b", 7, 0.1, 60, "r")])
    got = {r.token_id: r.watermark for r in planning.advance_watermarks(marks, late).collect()}
    assert got == {"a": 9, "b": 7}
    nothing = planning.advance_watermarks(marks, late.limit(0))
    assert [tuple(r) for r in nothing.collect()] == [("a", 9)]


@pytest.mark.parametrize("failed, passes", [(0, True), (1, True), (2, False)])
def test_failure_gate_is_strict(spark, failed, passes):
    outcomes = spark.range(10).select((F.col("id") < failed).alias("bad"))
    gate = planning.failure_gate(outcomes, F.col("bad"))
    assert gate.first().passed is passes
    if passes:
        planning.enforce(gate)
    else:
        with pytest.raises(RuntimeError, match="2/10"):
            planning.enforce(gate)


def test_nothing_attempted_passes(spark):
    outcomes = spark.range(0).select(F.lit(True).alias("bad"))
    planning.enforce(planning.failure_gate(outcomes, F.col("bad")))


def test_gaps_across_days(spark):
    rows = [("a", datetime(2024, 1, d, h), 60) for d, h in ((1, 22), (1, 23), (2, 0), (2, 5), (4, 5))]
    points = spark.createDataFrame(rows, "token_id string, price_ts timestamp, fidelity_minutes long")
    points = points.withColumn("price_date", F.to_date("price_ts"))
    got = sorted(r.gap_seconds for r in planning.gap_report(points).collect())
    assert got == [5 * 3600, 48 * 3600]
    assert [r.gap_seconds for r in planning.gap_report(points, factor=5).collect()] == [48 * 3600]


def test_summaries(spark):
    planned = spark.createDataFrame([("fetch",), ("fetch",), ("fresh",), ("no_token",)], "status string")
    assert tuple(planning.harvest_summary(planned).first()) == (4, 2, 1, 1)
    raw = raw_points(spark, [("a", 1, 0.1, 60, "r"), ("a", 2, 0.1, 60, "r"), ("b", 1, 0.1, 60, "s"),
                             ("b", 1, 0.1, 720, "s")])
    got = sorted(tuple(r) for r in planning.fidelity_counts(raw).collect())
    assert got == [(60, 2, 3), (720, 1, 1)]
    assert sorted(tuple(r) for r in planning.run_points(raw).collect()) == [("r", 2, 1), ("s", 2, 1)]
