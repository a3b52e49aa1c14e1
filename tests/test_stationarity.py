import math

import numpy as np
import pytest

from swipelens.operators import stationarity as T


def series(spark, values, parts=3):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "t INT, x DOUBLE").repartition(parts)


def walk(n, seed, keep):
    rng, x = np.random.default_rng(seed), [0.0]
    for e in rng.normal(size=n - 1):
        x.append(keep * x[-1] + e)
    return 5 + np.array(x)


def fit(y, columns):
    x = np.column_stack([np.ones(len(y)), *columns])
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rss = float(((y - x @ beta) ** 2).sum())
    inverse, n = np.linalg.inv(x.T @ x), len(y)
    aic = -2 * (-n / 2 * math.log(2 * math.pi) - n / 2 * math.log(rss / n) - n / 2) + 2 * x.shape[1]
    return beta, aic, beta[1] / math.sqrt(rss / (n - x.shape[1]) * inverse[1, 1]) if x.shape[1] > 1 else None


def adf(x):
    """Lag choice on the shortest common sample, then the regression on all rows it has."""
    most, d = min(len(x) // 2 - 2, math.ceil(12 * (len(x) / 100) ** 0.25)), np.diff(x)

    def columns(lag, skip):
        at = np.arange(skip, len(d))
        return d[at], [x[at], *[d[at - k] for k in range(1, lag + 1)]]

    _, used = min((fit(*columns(lag, most))[1], lag) for lag in range(most + 1))
    return fit(*columns(used, used))[2], used, len(d) - used


def kpss(x):
    e, n = x - x.mean(), len(x)
    products = [float(e[k:] @ e[:n - k]) for k in range(n)]
    first = int(n ** (2 / 9))
    s0 = products[0] / n + sum(products[k] / (n / 2) for k in range(1, first + 1))
    s1 = sum(k * products[k] / (n / 2) for k in range(1, first + 1))
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    variance = (products[0] + sum(2 * products[k] * (1 - k / (lags + 1)) for k in range(1, lags + 1))) / n
    return float((e.cumsum() ** 2).sum()) / n ** 2 / variance, lags


@pytest.mark.parametrize("seed,keep,n,block", [(1, 0.2, 150, 40), (2, 1.0, 120, 31), (3, 0.9, 64, 1000)])
def test_all_three_equal_brute_force(spark, seed, keep, n, block):
    x = walk(n, seed, keep)
    df = series(spark, x)
    row = T.adf_test(df, ["t"], "x", block_rows=block).first()
    statistic, used, rows = adf(x)
    assert (row["used_lags"], row["n_rows"]) == (used, rows) and row["statistic"] == pytest.approx(statistic, rel=1e-6)
    assert row["is_stationary"] == (row["p_value"] < 0.05)
    row = T.kpss_test(df, ["t"], "x", block_rows=block).first()
    statistic, lags = kpss(x)
    assert row["used_lags"] == lags and row["statistic"] == pytest.approx(statistic, rel=1e-9)
    found = {r["lag"]: r["pacf"] for r in T.partial_autocorrelation(df, ["t"], "x", 12, block_rows=block).collect()}
    for k in range(1, 13):
        beta, _, _ = fit(x[k:], [x[k - j:n - j] for j in range(1, k + 1)])
        assert found[k] == pytest.approx(beta[-1], rel=1e-6, abs=1e-9)


def test_known_p_values():
    # The p-value at a tabulated critical value is its level.
    assert T.adf_p_value(-2.86154) == pytest.approx(0.05, abs=5e-4)
    assert T.adf_p_value(-3.43035) == pytest.approx(0.01, abs=5e-4)
    assert T.adf_p_value(5.0) == 1.0 and T.adf_p_value(-30.0) == 0.0


def test_missing_values_are_left_out_and_bounds(spark):
    x = walk(60, 4, 0.5)
    holes = [v for i, v in enumerate(x) for v in ((None, v) if i % 7 == 0 else (v,))]
    plain, holed = (T.partial_autocorrelation(series(spark, s), ["t"], "x", 5, block_rows=16).collect() for s in (x, holes))
    assert [r["pacf"] for r in plain] == pytest.approx([r["pacf"] for r in holed])
    half = 1.959963984540054 / math.sqrt(60)
    assert all(r["upper"] - r["pacf"] == pytest.approx(half) for r in plain)


def test_short_and_constant_series(spark):
    flat = series(spark, [3.0] * 40)
    for run in (T.adf_test, T.kpss_test):
        with pytest.raises(ValueError):
            run(flat, ["t"], "x")
        with pytest.raises(ValueError):
            run(series(spark, [1.0]), ["t"], "x")
    with pytest.raises(ValueError):
        T.partial_autocorrelation(series(spark, [1.0, 2.0]), ["t"], "x")
