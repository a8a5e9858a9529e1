"""Scalar expressions on hand-made edge values."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlake.functions import casts, display, payload, prices


def one(spark, column, *values, schema="x string"):
    names = [part.split()[0] for part in schema.split(",")]
    df = spark.createDataFrame([tuple(values)], schema)
    return df.select(column(*[F.col(n) for n in names]).alias("out")).first().out


@pytest.mark.parametrize(
    "text, expected",
    [
        ('["Yes", "No"]', ["Yes", "No"]),
        ('["a","b"]', ["a", "b"]),
        (None, None),
        ("", None),
        ("not json", None),
        ('{"a": 1}', None),
        ("42", None),
        ("[]", []),
    ],
)
def test_stringified_list(spark, text, expected):
    assert one(spark, payload.string_list, text) == expected


@pytest.mark.parametrize(
    "market, token",
    [
        ('{"clobTokenIds":"[\\"111\\", \\"222\\"]"}', "111"),
        ('{"clobTokenIds":["111", "222"]}', "111"),
        ("{}", None),
        ('{"clobTokenIds":"[]"}', None),
        ('{"clobTokenIds":"[\\"\\", \\"222\\"]"}', None),
        ('{"clobTokenIds":"broken"}', None),
        ('{"clobTokenIds":null}', None),
        ('{"clobTokenIds":[%s]}' % ("9" * 77), "9" * 77),
    ],
)
def test_yes_token(spark, market, token):
    df = spark.createDataFrame([(market,)], "payload string")
    fields = df.select(payload.fields(F.col("payload")))
    assert fields.select(payload.yes_token(F.col("token_list")).alias("t")).first().t == token


def test_scalars_are_null_for_containers(spark):
    body = '{"id":["1"],"question":"[Test] Will it?","slug":{"a":1},"conditionId":7}'
    df = spark.createDataFrame([(body,)], "payload string")
    row = df.select(payload.fields(F.col("payload"))).select(
        *[c.alias(n) for n, c in payload.scalar_fields().items()]
    ).first()
    assert (row.market_id, row.slug) == (None, None)
    assert (row.question, row.condition_id) == ("[Test] Will it?", "7")


@pytest.mark.parametrize(
    "text, number",
    [("1", 1.0), ("0.5", 0.5), (".5", 0.5), ("1e3", 1000.0), ("n/a", None), ("1d", None),
     ("", None), (None, None), ("[1]", None)],
)
def test_safe_double(spark, text, number):
    assert one(spark, casts.safe_double, text) == number


@pytest.mark.parametrize(
    "text, flag",
    [("true", True), ("FALSE", False), ("yes", None), ("1", None), (None, None), ("null", None)],
)
def test_safe_bool(spark, text, flag):
    assert one(spark, casts.safe_bool, text) is flag


@pytest.mark.parametrize(
    "text, moment",
    [
        ("2024-11-06 15:17:41+00", datetime(2024, 11, 6, 15, 17, 41)),
        ("2024-11-06T15:17:41Z", datetime(2024, 11, 6, 15, 17, 41)),
        ("2024-11-06T17:17:41+02:00", datetime(2024, 11, 6, 15, 17, 41)),
        ("2024", None),
        ("garbage", None),
        (None, None),
    ],
)
def test_timestamps(spark, text, moment):
    df = spark.createDataFrame([(text,)], "x string")
    out = df.select(
        casts.repaired_timestamp(F.col("x")).cast("timestamp_ntz").alias("t")
    ).first().t
    assert out == moment


@pytest.mark.parametrize(
    "p, price", [(-0.1, 0.0), (1.0025, 1.0), (0.0, 0.0), (1.0, 1.0), (0.3, 0.3), (None, None)]
)
def test_clamp(spark, p, price):
    assert one(spark, prices.clamp_unit, p, schema="x double") == price


@pytest.mark.parametrize("p, bucket", [(0.0, 0), (0.0999, 0), (0.1, 1), (0.95, 9), (1.0, 9)])
def test_bucket(spark, p, bucket):
    assert one(spark, prices.price_bucket, p, schema="x double") == bucket


@pytest.mark.parametrize(
    "yes, no, outcome",
    [(1.0, 0.0, "yes"), (0.0, 1.0, "no"), (0.5, 0.5, None), (1.0, 1.0, None), (0.999, 0.001, None),
     (None, 1.0, None)],
)
def test_outcome(spark, yes, no, outcome):
    assert one(spark, prices.terminal_outcome, yes, no, schema="x double, y double") == outcome


def test_nan_and_null_points_are_unusable(spark):
    t = 1704067200
    rows = [("a", t, 0.5), ("a", t, math.nan), ("a", t, None), (None, t, 0.5), ("a", None, 0.5)]
    df = spark.createDataFrame(rows, "token_id string, t long, p double")
    usable = prices.usable_point(F.col("token_id"), F.col("t"), F.col("p"))
    assert df.filter(usable).count() == 1
    reason = prices.unusable_reason(F.col("token_id"), F.col("t"), F.col("p"))
    assert df.filter(reason.isNull()).count() == 1


def test_both_edges_of_the_plausible_range(spark):
    first, last = 1262304000, 4102444799  # 2010-01-01 and the last second of 2099
    rows = [("a", t, 0.5) for t in (first - 1, first, last, last + 1)]
    df = spark.createDataFrame(rows, "token_id string, t long, p double")
    usable = prices.usable_point(F.col("token_id"), F.col("t"), F.col("p"))
    assert sorted(r.t for r in df.filter(usable).collect()) == [first, last]
    reason = prices.unusable_reason(F.col("token_id"), F.col("t"), F.col("p"))
    assert df.filter(reason == "implausible time").count() == 2


@pytest.mark.parametrize("rate, n", [(0.0, 1), (1.0, 1), (0.5, 10), (0.07, 300)])
def test_wilson_contains_the_rate(spark, rate, n):
    df = spark.createDataFrame([(rate, n)], "r double, n long")
    low, high = df.select(
        prices.wilson_bound(F.col("r"), F.col("n"), -1), prices.wilson_bound(F.col("r"), F.col("n"), 1)
    ).first()
    z = 1.96
    middle = (rate + z * z / (2 * n)) / (1 + z * z / n)
    half = z * math.sqrt(rate * (1 - rate) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    assert low == pytest.approx(middle - half) and high == pytest.approx(middle + half)
    assert low - 1e-12 <= rate <= high + 1e-12


def test_minus_hours_and_days(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 31, 1), 50)], "t timestamp_ntz, h int")
    row = df.select(
        prices.minus_hours(F.col("t"), F.col("h")).alias("a"),
        prices.days_between(F.lit(date(2024, 3, 1)), F.lit(date(2024, 2, 28))).alias("d"),
    ).first()
    assert (row.a, row.d) == (datetime(2024, 1, 28, 23), 2)


def test_compact_number_like_python(spark):
    values = [0.0, 7.0, 999.0, 999.7, 1000.0, 1250.0, 1350.0, 1450.0, 1850.0, 4_000.0, 23_456.0,
              999_950.0, 2_300_000.0, 1_500_000_000.0, 12_345_678_901_234.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.s for r in df.select(display.compact_number(F.col("x")).alias("s")).collect()]

    def expected(n):
        for size, unit in ((1e9, "B"), (1e6, "M"), (1e3, "K")):
            if n >= size:
                return f"{n / size:.1f}{unit}"
        return f"{n:,.0f}"

    assert got == [expected(v) for v in values]
    labels = spark.range(1).select(display.bucket_label(F.lit(9))).first()
    assert labels[0] == "90–100¢"
