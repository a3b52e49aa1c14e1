"""Partial autocorrelation and unit-root tests of one series, from sums over blocks of rows.

A series may be far longer than a task can hold, so nothing here needs it in one place. It is put
in order once and cut into blocks that overlap by the largest lag. Every block gives its part of
the products between lagged values, and these add up to one small matrix on which the driver
solves its least-squares problems; regressions that leave out the first rows subtract those, of
which there are no more than lags.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelens.operators.ordering import BLOCK_ROWS, POSITION, row_blocks, running_totals
from swipelens.session import materialize, ship

#: Rows whose lagged values are laid side by side at once.
CHUNK = 1 << 15

# The published response surface of the unit-root statistic with a constant
# (p-value polynomials below and above the switch point, and critical values by 1 / n), and the
# critical values of the stationarity statistic around a level.
ADF_LOWEST, ADF_SWITCH, ADF_HIGHEST = -18.83, -1.61, 2.74
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_CRITICAL = {
    "1": (-3.43035, -6.5393, -16.786, -79.433), "5": (-2.86154, -2.8903, -4.234, -40.040),
    "10": (-2.56677, -1.5384, -2.809, 0.0),
}
KPSS_CRITICAL = {"10": 0.347, "5": 0.463, "2_5": 0.574, "1": 0.739}
# End of fixed values.


def _series(df: DataFrame, order: list[str], value: str) -> tuple[DataFrame, int]:
    """Known values less their mean, as (order, x), and how many."""
    clean = df.where(F.col(value).isNotNull())
    stats = clean.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(value).cast("double")).alias("mean")).first()
    mean = stats["mean"] if stats["n"] else 0.0
    return clean.select(*order, (F.col(value).cast("double") - F.lit(mean)).alias("x")), stats["n"]


def _summed(
    series: DataFrame, order: list[str], reach: int, part: Callable[[np.ndarray, int], np.ndarray], block_rows: int
) -> np.ndarray:
    """Sum over blocks of ``part``(values, first): values from ``reach`` rows before the block's
    own ones, zeros where the series has not begun, and the place of the first own value."""
    ship(series.sparkSession)
    rows, _ = row_blocks(series, order, reach, 0, block_rows)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(POSITION)
        # A block has its own rows and those that its first ones look back to.
        own = np.flatnonzero(block["_block"].iat[0] * block_rows <= block[POSITION].to_numpy())
        if not len(own):
            return pd.DataFrame({"i": [], "v": []})
        before = block["x"].to_numpy()[:own[0]]
        values = np.concatenate([np.zeros(reach - len(before)), before, block["x"].to_numpy()[own[0]:]])
        found = part(values, reach).ravel()
        return pd.DataFrame({"i": np.arange(len(found)), "v": found})

    # As many rows as the matrix has cells.
    cells = rows.groupBy("_block").applyInPandas(run, "i INT, v DOUBLE").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i")
    return np.array([r["v"] for r in cells.collect()])


def _gram(columns: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Callable[[np.ndarray, int], np.ndarray]:
    """Products between columns of lagged values, summed over a block chunk by chunk."""
    def part(values: np.ndarray, first: int) -> np.ndarray:
        total = 0.0
        for at in range(first, len(values), CHUNK):
            z = columns(values, np.arange(at, min(len(values), at + CHUNK)))
            total = total + z.T @ z
        return total

    return part


def _head(series: DataFrame, order: list[str], rows: int) -> np.ndarray:
    """The first values; no more than lags."""
    return np.array([r["x"] for r in series.orderBy(*order).limit(rows).collect()])


def _less_head(gram: np.ndarray, columns: Callable, head: np.ndarray, reach: int, skip: int) -> np.ndarray:
    """The products without the first ``skip`` rows."""
    if not skip:
        return gram
    z = columns(np.concatenate([np.zeros(reach), head[:skip]]), np.arange(reach, reach + skip))
    return gram - z.T @ z


def partial_autocorrelation(
    df: DataFrame, order: list[str], value: str, lags: int | None = None, level: float = 0.95,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(lag, pacf, lower, upper): the last coefficient of the regression on 1..lag earlier values.

    Each regression has a constant and all rows with so many earlier ones. Missing values are
    left out first; the default is min(40, n/2 - 1) lags. ``order`` must be unique.
    """
    series, n = _series(df, order, value)
    lags = min(40, n // 2 - 1) if lags is None else lags
    if lags < 1:
        raise ValueError("the series is too short for one lag")
    series = materialize(series)

    def columns(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(at)), *[values[at - k] for k in range(1, lags + 1)], values[at]])

    gram = _summed(series, order, lags, _gram(columns), block_rows).reshape(lags + 2, lags + 2)
    head, half = _head(series, order, lags), NormalDist().inv_cdf(1 - (1 - level) / 2) / math.sqrt(n)
    rows = []
    for k in range(1, lags + 1):
        own = _less_head(gram, columns, head, lags, k)
        found = float(np.linalg.lstsq(own[:k + 1, :k + 1], own[:k + 1, -1], rcond=None)[0][-1])
        rows.append((k, found, found - half, found + half))
    return df.sparkSession.createDataFrame(rows, "lag INT, pacf DOUBLE, lower DOUBLE, upper DOUBLE")


def _regress(gram: np.ndarray, k: int, n: int) -> tuple[float, float]:
    """AIC of the regression of the last column on the first ``k``, and t of the second one."""
    inverse = np.linalg.pinv(gram[:k, :k], hermitian=True)
    beta = inverse @ gram[:k, -1]
    rss = max(float(gram[-1, -1] - gram[:k, -1] @ beta), 0.0)
    aic = n * (math.log(2 * math.pi) + math.log(rss / n) + 1) + 2 * k if rss else -math.inf
    spread = math.sqrt(rss / (n - k) * inverse[1, 1])
    return aic, float(beta[1]) / spread if spread else math.nan


def adf_p_value(statistic: float) -> float:
    if statistic > ADF_HIGHEST:
        return 1.0
    if statistic < ADF_LOWEST:
        return 0.0
    powers = ADF_SMALL_P if statistic <= ADF_SWITCH else ADF_LARGE_P
    return NormalDist().cdf(sum(c * statistic ** i for i, c in enumerate(powers)))


def adf_test(df: DataFrame, order: list[str], value: str, level: float = 0.05, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row: unit-root test of the differences on level and lagged differences, with a constant.

    Lags are chosen by AIC among 0..12 (n / 100)^(1/4), on the rows that the longest regression
    has; the statistic then comes from all rows that the chosen one has.
    """
    series, n = _series(df, order, value)
    most = min(n // 2 - 2, math.ceil(12 * (n / 100) ** 0.25))
    if most < 0:
        raise ValueError("the series is too short")
    series, reach = materialize(series), most + 2

    def columns(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        def step(k: int) -> np.ndarray:
            return values[at - k] - values[at - k - 1]

        return np.column_stack([np.ones(len(at)), values[at - 1], *[step(k) for k in range(1, most + 1)], step(0)])

    gram = _summed(series, order, reach, _gram(columns), block_rows).reshape(most + 3, most + 3)
    head = _head(series, order, most + 1)
    if gram[-1, -1] == 0 or n - most - 1 <= most + 2:
        raise ValueError("the series is constant or too short")
    widest = _less_head(gram, columns, head, reach, most + 1)
    _, used = min((_regress(widest, lag + 2, n - most - 1)[0], lag) for lag in range(most + 1))
    # The regression with the chosen lags has more rows.
    rows = n - used - 1
    _, statistic = _regress(_less_head(gram, columns, head, reach, used + 1), used + 2, rows)
    p = adf_p_value(statistic)
    critical = {f"critical_{k}": sum(c / rows ** i for i, c in enumerate(v)) for k, v in ADF_CRITICAL.items()}
    return df.sparkSession.createDataFrame(
        [(statistic, p, used, rows, *critical.values(), int(p < level))],
        "statistic DOUBLE, p_value DOUBLE, used_lags INT, n_rows BIGINT, "
        + ", ".join(f"{k} DOUBLE" for k in critical) + ", is_stationary INT",
    )


def _lag_products(lags: int) -> Callable[[np.ndarray, int], np.ndarray]:
    """Sums of each value with the one 0..lags rows earlier."""
    def part(values: np.ndarray, first: int) -> np.ndarray:
        own = values[first:]
        return np.array([float(own @ values[first - k:len(values) - k]) for k in range(lags + 1)])

    return part


def kpss_test(df: DataFrame, order: list[str], value: str, level: float = 0.05, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row: stationarity around a level; p-values end at those of the table, 0.01 and 0.1.

    The long-run variance takes Bartlett weights and as many lags as the automatic bandwidth for
    them gives. The partial sums are running totals over the sorted series.
    """
    series, n = _series(df, order, value)
    if n < 2:
        raise ValueError("the series is too short")
    series = materialize(series)
    first = int(n ** (2 / 9))
    products = _summed(series, order, first, _lag_products(first), block_rows)
    if products[0] == 0:
        raise ValueError("the series is constant")
    s0 = products[0] / n + 2 * products[1:].sum() / n
    s1 = 2 * float(np.arange(1, first + 1) @ products[1:]) / n
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    products = _summed(series, order, lags, _lag_products(lags), block_rows)
    weights = 1 - np.arange(1, lags + 1) / (lags + 1)
    variance = (products[0] + 2 * float(weights @ products[1:])) / n
    sums = running_totals(series, [F.col(c) for c in order], {"through": "x"}).agg(F.sum(F.col("through") * F.col("through"))).first()[0]
    statistic = float(sums) / n ** 2 / float(variance)
    table = sorted(KPSS_CRITICAL.items(), key=lambda x: x[1])
    p = float(np.interp(statistic, [v for _, v in table], [float(k.replace("_", ".")) / 100 for k, _ in table]))
    return df.sparkSession.createDataFrame(
        [(statistic, p, lags, *KPSS_CRITICAL.values(), int(p >= level))],
        "statistic DOUBLE, p_value DOUBLE, used_lags INT, " + ", ".join(f"critical_{k} DOUBLE" for k in KPSS_CRITICAL)
        + ", is_stationary INT",
    )
