import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from swipelens.operators import ordering as O
from swipelens.operators import quantiles as N
from swipelens.operators import series as R


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(3)
    # A third of all rows share one value.
    rows = [(i, 5.0 if i % 3 == 0 else round(rng.random() * 100, 1), i % 2) for i in range(900)]
    return spark.createDataFrame(rows, "id INT, x DOUBLE, g INT").repartition(7), rows


def test_positions(numbers):
    df, rows = numbers
    got = {r["id"]: r["_position"] for r in O.with_position(df, "x", "id").collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}


def test_running_totals(numbers):
    df, rows = numbers
    got = {r["id"]: r["upto"] for r in O.running_totals(df, [F.desc("x"), "id"], {"upto": "g"}).collect()}
    total = 0
    for r in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += r[2]
        assert got[r[0]] == total


def test_rows_at(numbers):
    df, rows = numbers
    order = [F.col("x"), F.col("id")]
    found = O.rows_at(df, F.floor(order[0] / 10), order, {(0,): [0, 10, 449, 450], (1,): [7]}, ["g"])
    for g in (0, 1):
        want = sorted((r[1], r[0]) for r in rows if r[2] == g)
        assert found[(g,)] == {p: want[p] for p in found[(g,)]}
    assert sorted(found[(0,)]) == [0, 10, 449]


def test_exact_quantiles(numbers, monkeypatch):
    df, rows = numbers
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    want = {(g, p): np.quantile([r[1] for r in rows if r[2] == g], p) for g in (0, 1) for p in probs}
    brackets = N._brackets
    changes = [
        ("DRIVER_ROWS", 100_000),
        ("DRIVER_ROWS", 40),  # too many counts, few totals
        ("_brackets", lambda df, c, p, b: brackets(df, c, [0.4] * len(p), b)),  # most ranks missed
        ("DRIVER_GROUPS", 1),
        ("DRIVER_ROWS", 0),
    ]
    for name, value in changes:
        monkeypatch.setattr(N, name, value)
        got = {(r["g"], r["prob"]): r["quantile"] for r in N.exact_quantiles(df, ["x"], probs, ["g"]).collect()}
        assert got == pytest.approx(want)


def test_medians_of_missing(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "a DOUBLE, b DOUBLE")
    assert N.medians(df, ["a", "b"]) == {"a": 2.5, "b": None}


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(10, 3, 240).round(3)
    y = (np.roll(x, 3) + rng.normal(0, 1, 240)).round(3)
    x[[20, 77, 200]] += 40
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "t INT, x DOUBLE, y DOUBLE").repartition(5), x, y


def values(df, column, key="t"):
    return {r[key]: r[column] for r in df.collect()}


def test_centered_average_and_band(series):
    df, x, _ = series
    n, w = len(x), 10
    mean = [x[max(0, i - 5):min(n, i + 5)].mean() for i in range(n)]
    got = values(R.centered_moving_avg(df, ["t"], "x", w, block_rows=13), "moving_avg")
    assert [got[i] for i in range(n)] == pytest.approx(mean)
    gap = (x - mean)[5:n - 5]
    width = np.abs(gap).mean() + 1.96 * gap.std()
    want = {i for i in range(n) if abs(x[i] - mean[i]) > width}
    assert set(values(R.band_anomalies(df, ["t"], "x", w, block_rows=13), "x")) == want and {20, 77, 200} <= want


def test_rolling_and_lagged_correlation(series):
    df, x, y = series
    got = values(R.rolling_corr(df, ["t"], "x", "y", 20, block_rows=17), "rolling_corr")
    assert sorted(got) == list(range(19, 240))
    assert got[100] == pytest.approx(np.corrcoef(x[81:101], y[81:101])[0, 1])
    found = R.lagged_corr(df, ["t"], "x", "y", 5, block_rows=17).collect()
    want = {-k: np.corrcoef(x[:240 - k], y[k:])[0, 1] for k in range(6)}
    assert {r["shift"]: r["corr"] for r in found} == pytest.approx(want)
    assert [r["shift"] for r in found if r["is_best"]] == [-3]


def test_autocorrelation_and_trend(series):
    df, x, _ = series
    d = x - x.mean()
    rows = R.autocorrelation(df, ["t"], "x", 6, block_rows=11).orderBy("lag").collect()
    acf = [float((d[k:] * d[:-k]).sum() / (d * d).sum()) for k in range(1, 7)]
    assert [r["acf"] for r in rows] == pytest.approx(acf)
    half = 1.959963984540054 * ((1 + 2 * acf[0] ** 2) / 240) ** 0.5
    assert rows[1]["upper"] - rows[1]["acf"] == pytest.approx(half)
    slope, intercept = np.polyfit(np.arange(240), x, 1)
    got = R.linear_trend(df, ["t"], "x").first()
    assert (got["slope"], got["intercept"]) == pytest.approx((slope, intercept))


def test_lag_difference(series):
    df, x, _ = series
    got = values(R.lag_difference(df, ["t"], "x", 3, block_rows=7), "difference")
    assert got == pytest.approx({i: x[i] - x[i - 3] for i in range(3, 240)})


def test_interpolation_over_long_gaps(spark):
    known = {4: 1.0, 6: 5.0, 150: 29.0, 151: 0.0}
    df = spark.createDataFrame([(i, known.get(i)) for i in range(200)], "t INT, x DOUBLE").repartition(6)
    got = values(R.interpolate_bfill(df, ["t"], ["x"]), "x")
    assert [got[i] for i in range(8)] == pytest.approx([1, 1, 1, 1, 1, 3, 5, 5 + 24 / 144])
    assert got[78] == pytest.approx(17.0) and got[199] == 0.0 and all(v is not None for v in got.values())


def test_last_rows(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "t INT, x DOUBLE")
    newest = [F.desc("t")]
    assert R.last_n_mean(df, newest, "x", 3).first()[0] == 8.0
    assert R.last_n_mean(df, newest, "x", 11).first()[0] is None
    assert R.last_n_weighted_mean(df, newest, "x", [3.0, 1.0]).first()[0] == (27 + 8) / 4
    assert R.last_n_weighted_mean(df.where("t < 1"), newest, "x", [3.0, 1.0]).first()[0] == 0.0
    assert R.last_n_weighted_mean(df, newest, "x", [0.0, 0.0]).first()[0] == 8.5


def test_empty_days_count_zero(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-01 11:00:00",), ("2024-01-04 09:00:00",)], "s STRING")
    days = R.period_counts(df.select(F.col("s").cast("timestamp").alias("t")), "t").orderBy("period").collect()
    assert [r["n"] for r in days] == [2, 0, 0, 1]
