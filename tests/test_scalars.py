import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from swipelens.config import window_micros
from swipelens.functions import scalars as S


def column(spark, values, build, kind="DOUBLE"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
    return [r["y"] for r in rows.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def ages(spark, pairs):
    rows = spark.createDataFrame(
        [(i, dt.date.fromisoformat(a) if a else None, dt.date.fromisoformat(b) if b else None) for i, (a, b) in enumerate(pairs)],
        "i INT, a DATE, b DATE",
    )
    return [r["y"] for r in rows.select("i", S.age_years("a", "b").alias("y")).orderBy("i").collect()]


def test_leading_digit(spark):
    # Amounts and digits that the operator is defined by.
    fixed = {0.99: 9, 0.05: 5, 45.67: 4, 100.0: 1, 0.0: 0}
    assert column(spark, list(fixed), S.leading_digit) == list(fixed.values())
    own = {0.08: 8, 23.4: 2, 7000.01: 7, 0.30: 3, 0.60: 6, 0.70: 7, 9.996: 9, 3e10: 3, 0.004: 4, -6.5: 0, None: None}
    assert column(spark, list(own), S.leading_digit) == list(own.values())
    powers = [10.0 ** k for k in range(-3, 9)]
    assert column(spark, powers, S.leading_digit) == [1] * len(powers)


def test_last_cents_digit(spark):
    for cents in range(0, 120, 7):
        assert column(spark, [12 + cents / 100], S.last_cents_digit) == [cents % 10]
    assert column(spark, [8.1, 8.0, -8.13, None], S.last_cents_digit) == [0, 0, 7, None]


def test_age_counts_birthdays(spark):
    born = "1971-10-03"
    on = {"1971-10-03": 0, "1972-10-02": 0, "1972-10-03": 1, "2011-10-02": 39, "2011-10-03": 40, "2012-01-31": 40}
    assert ages(spark, [(born, day) for day in on]) == list(on.values())
    # Born on a leap day: a year older on 1 March of common years. A missing date has no age.
    leap = [("2016-02-29", "2017-02-28"), ("2016-02-29", "2017-03-01"), (None, "2001-05-05"), ("2001-05-05", None)]
    assert ages(spark, leap) == [0, 1, None, None]


def test_cyclical_wraps(spark):
    hours = [float(h) for h in range(24)]
    points = list(zip(*(column(spark, hours, lambda x, i=i: S.cyclical(x, 24)[i]) for i in (0, 1))))
    steps = [math.dist(points[h], points[(h + 1) % 24]) for h in range(24)]
    # Midnight is no further from 23 h than any hour from the next.
    assert steps == [pytest.approx(2 * math.sin(math.pi / 24))] * 24


def test_haversine(spark):
    # One point; a quarter of the equator; pole to pole; two of anywhere; a missing coordinate.
    points = [
        (51.5, -0.1, 51.5, -0.1), (0.0, 15.0, 0.0, 105.0), (90.0, 0.0, -90.0, 0.0),
        (59.3, 18.1, -33.9, 151.2), (-1.3, 36.8, -1.2, 36.9), (None, 1.0, 1.0, 1.0),
    ]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    km = [r["y"] for r in rows.select("i", S.haversine_km("a", "b", "c", "d").alias("y")).orderBy("i").collect()]
    quarter = 6371 * math.pi / 2
    assert km[0] == 0.0 and km[1:3] == pytest.approx([quarter, 2 * quarter]) and km[5] is None
    for (a, b, c, d), got in zip(points[3:5], km[3:5]):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        assert got == pytest.approx(2 * 6371 * math.asin(math.sqrt(h)))


def test_log_clips_negatives_and_keeps_missing(spark):
    assert column(spark, [0.0, -5.0, math.e - 1, None], S.log_amount) == [0.0, 0.0, pytest.approx(1.0), None]


def test_nan_becomes_null(spark):
    assert column(spark, [1.0, float("nan"), None], S.nan_to_null) == [1.0, None, None]


def test_calendar(spark):
    rows = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 3, 59),), (dt.datetime(2024, 1, 6, 22, 0),), (dt.datetime(2024, 1, 7, 12, 0),)], "t TIMESTAMP"
    )
    found = rows.select(
        S.day_of_week("t"), S.is_weekend("t"), S.is_night("t"), S.day_name(S.day_of_week("t")), S.hour_of_day("t")
    ).collect()
    assert [tuple(r) for r in found] == [(1, 0, 1, "Monday", 3), (6, 1, 1, "Saturday", 22), (7, 1, 0, "Sunday", 12)]


def test_window_text():
    assert window_micros("24h") == 86_400_000_000 and window_micros("7d") == 7 * 86_400_000_000
    with pytest.raises(ValueError):
        window_micros("day")
