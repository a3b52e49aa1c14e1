"""Time series: period counts, smoothing, anomalies, correlation over lags, trend, gaps."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipelens.functions.scalars import correlation
from swipelens.operators.ordering import (
    BLOCK_ROWS, INDEX, POSITION, SEGMENT, ordered_segments, row_blocks, with_position,
)


def period_counts(df: DataFrame, time: str, period: str = "day") -> DataFrame:
    """Rows per day, month or year; empty days count 0.

    Rows are counted before the calendar is laid out, so the calendar join is as long as
    the period covered and no longer.
    """
    counts = df.groupBy(F.to_date(F.date_trunc(period, F.col(time))).alias("period")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if period != "day":
        return counts
    days = counts.agg(F.sequence(F.min("period"), F.max("period")).alias("_days")).select(
        F.explode("_days").alias("period")
    )
    return days.join(counts, "period", "left").select("period", F.coalesce("n", F.lit(0)).alias("n"))


def series_overview(df: DataFrame, time: str, value: str) -> DataFrame:
    """Observations, nulls, first and last time, and length in years, months and days."""
    days = F.floor(
        (F.unix_micros(F.max(time).cast("timestamp")) - F.unix_micros(F.min(time).cast("timestamp")))
        / F.lit(86_400_000_000)
    )
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(value).isNull()).alias("n_null"),
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
        F.floor(days / 365).alias("years"), F.floor(days % 365 / 30).alias("months"),
        (days % 365 % 30).alias("days"),
    )


def centered_moving_avg(
    df: DataFrame, order: list[str], value: str, window: int, into: str = "moving_avg",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean of ``window`` rows around each row; frames are cut short at both ends."""
    before, after = window // 2, (window - 1) // 2
    rows, along = row_blocks(df, order, before, after, block_rows)
    around = along.rowsBetween(-before, after)
    return rows.withColumn(into, F.avg(value).over(around)).where("_own").drop("_block", "_own")


def band_anomalies(
    df: DataFrame, order: list[str], value: str, window: int, scale: float = 1.96,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows outside moving average +- (MAE + scale * population std of the residuals).

    The residuals of the first and last ``window // 2`` rows do not enter the band width.
    """
    rows = df.count()
    smooth = centered_moving_avg(df, order, value, window, block_rows=block_rows)
    gap = F.col(value) - F.col("moving_avg")
    half = window // 2
    inner = smooth.where((F.col(POSITION) >= half) & (F.col(POSITION) < rows - half))
    band = inner.agg(F.avg(F.abs(gap)).alias("mae"), F.stddev_pop(gap).alias("std")).first()
    if band["mae"] is None:
        raise ValueError("the series has no row inside the window margins")
    width = band["mae"] + scale * band["std"]
    return (
        smooth.withColumns(
            {"lower_bound": F.col("moving_avg") - width, "upper_bound": F.col("moving_avg") + width}
        )
        .where((F.col(value) < F.col("lower_bound")) | (F.col(value) > F.col("upper_bound")))
        .drop(POSITION)
    )


def last_n_mean(df: DataFrame, order: list[Column], value: str, n: int) -> DataFrame:
    """Mean of the last ``n`` rows; null if there are fewer. ``order`` runs newest first."""
    last = df.orderBy(*order).limit(n)
    return last.agg(F.when(F.count(F.lit(1)) == n, F.avg(value)).alias("last_n_mean"))


def last_n_weighted_mean(
    df: DataFrame, order: list[Column], value: str, weights: list[float]
) -> DataFrame:
    """Weighted mean of the last rows; the first weight belongs to the newest row.

    With fewer rows than weights the first weights are used. A zero weight sum gives the
    plain mean. ``order`` runs newest first.
    """
    if not weights:
        raise ValueError("weights must not be empty")
    # Bounded by the number of weights.
    last = df.orderBy(*order).limit(len(weights)).withColumn(
        "_age", F.row_number().over(Window.orderBy(*order))
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_age"))
    total = F.sum(weight)
    return last.agg(
        F.when(total == 0, F.avg(value))
        .otherwise(F.sum(weight * F.col(value)) / F.nullif(total, F.lit(0.0)))
        .alias("weighted_mean")
    )


def rolling_corr(
    df: DataFrame, order: list[str], x: str, y: str, window: int = 30, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Pearson correlation over the trailing ``window`` rows; full windows only."""
    rows, along = row_blocks(df, order, window - 1, 0, block_rows)
    trailing = along.rowsBetween(-(window - 1), 0)
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    spread = F.sqrt(F.var_pop(a).over(trailing) * F.var_pop(b).over(trailing))
    return (
        rows.withColumn("rolling_corr", F.covar_pop(a, b).over(trailing) / F.nullif(spread, F.lit(0.0)))
        .where(F.col("_own") & (F.col(POSITION) >= window - 1))
        .drop("_block", "_own", POSITION)
    )


def lag_difference(
    df: DataFrame, order: list[str], value: str, n: int = 1, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Value minus the value ``n`` rows earlier; rows without one are left out."""
    rows, along = row_blocks(df, order, n, 0, block_rows)
    return (
        rows.withColumn("difference", F.col(value) - F.lag(value, n).over(along))
        .where(F.col("_own") & F.col("difference").isNotNull())
        .drop("_block", "_own", POSITION)
    )


def lagged_corr(
    df: DataFrame, order: list[str], x: str, y: str, max_shift: int = 30, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Correlation of x with y moved back by 0..max_shift rows, and the strongest shift."""
    rows, along = row_blocks(df, order, 0, max_shift, block_rows)
    moved = {f"_y{k}": F.lead(F.col(y).cast("double"), k).over(along) for k in range(max_shift + 1)}
    cells = [
        F.struct(F.lit(-k).alias("shift"), correlation(x, f"_y{k}").alias("corr"))
        for k in range(max_shift, -1, -1)
    ]
    found = (
        rows.withColumns(moved).where("_own")
        .agg(F.array(*cells).alias("_cells"))
        .select(F.explode("_cells").alias("_cell")).select("_cell.*")
    )
    # max_shift + 1 rows; the first of equal strength wins.
    strength = F.coalesce(F.abs("corr"), F.lit(-1.0))
    best = F.row_number().over(Window.orderBy(F.desc(strength), "shift")) == 1
    return found.withColumn("is_best", best.cast("int"))


def autocorrelation(
    df: DataFrame, order: list[str], value: str, lags: int | None = None, level: float = 0.95,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Autocorrelation for lags 1..lags with Bartlett bounds; default min(40, n/2 - 1) lags."""
    clean = df.where(F.col(value).isNotNull())
    stats = clean.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean")).first()
    n, mean = stats["n"], stats["mean"]
    lags = min(40, n // 2 - 1) if lags is None else lags
    if lags < 1:
        raise ValueError("the series is too short for one lag")
    rows, along = row_blocks(clean, order, 0, lags, block_rows)
    gap = F.col(value) - F.lit(mean)
    moved = {f"_g{k}": F.lead(gap, k).over(along) for k in range(1, lags + 1)}
    cells = [
        F.struct(F.lit(k).alias("lag"), (F.sum(gap * F.col(f"_g{k}")) / F.nullif(F.sum(gap * gap), F.lit(0.0))).alias("acf"))
        for k in range(1, lags + 1)
    ]
    found = (
        rows.withColumns(moved).where("_own")
        .agg(F.array(*cells).alias("_cells"))
        .select(F.explode("_cells").alias("_cell")).select("_cell.*")
    )
    z = NormalDist().inv_cdf(1 - (1 - level) / 2)
    # One row per lag.
    shorter = Window.orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    variance = (1 + F.coalesce(F.sum(F.col("acf") * F.col("acf")).over(shorter), F.lit(0.0)) * 2) / n
    return found.withColumn("_half", F.sqrt(variance) * z).select(
        "lag", "acf", (F.col("acf") - F.col("_half")).alias("lower"),
        (F.col("acf") + F.col("_half")).alias("upper"),
    )


def linear_trend(df: DataFrame, order: list[str], value: str) -> DataFrame:
    """Least-squares slope and intercept of the value on its row position from 0."""
    rows = with_position(df.where(F.col(value).isNotNull()), *order)
    x, y = F.col(POSITION).cast("double"), F.col(value).cast("double")
    return rows.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def interpolate_bfill(df: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """Fill gaps linearly by row position; the last value runs on, the first runs back.

    The nearest known values of a row may lie any number of rows away. Each sort segment
    looks inside itself, and takes from a small table the last known value before it and
    the first one after it.
    """
    segments = ordered_segments(df, *order)
    at = F.col(INDEX)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("v"), at.alias("i"))) for c in columns}
    edges = segments.groupBy(SEGMENT).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.max_by(known[c], F.when(known[c].isNotNull(), at)).alias(f"_last_{c}") for c in columns],
        *[F.min_by(known[c], F.when(known[c].isNotNull(), at)).alias(f"_first_{c}") for c in columns],
    )
    # One row per sort partition.
    earlier = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy(SEGMENT).rowsBetween(1, Window.unboundedFollowing)
    edges = edges.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))

    def placed(name: str) -> Column:
        cell = F.col(name)
        return F.when(cell.isNotNull(), F.struct(cell["v"].alias("v"), (cell["i"] + F.col("_offset")).alias("i")))

    edges = edges.select(
        SEGMENT, "_offset",
        *[F.last(placed(f"_last_{c}"), ignorenulls=True).over(earlier).alias(f"_before_{c}") for c in columns],
        *[F.first(placed(f"_first_{c}"), ignorenulls=True).over(later).alias(f"_after_{c}") for c in columns],
    )
    rows = segments.join(F.broadcast(edges), SEGMENT).withColumn(POSITION, at + F.col("_offset"))
    along = Window.partitionBy(SEGMENT).orderBy(POSITION)
    back = along.rowsBetween(Window.unboundedPreceding, 0)
    # The same frame from the far end: one that grows costs one step per row, one that
    # shrinks is read again for every row.
    ahead = Window.partitionBy(SEGMENT).orderBy(F.desc(POSITION)).rowsBetween(Window.unboundedPreceding, 0)
    here = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("v"), F.col(POSITION).alias("i"))) for c in columns}
    rows = rows.withColumns(
        {f"_p_{c}": F.coalesce(F.last(here[c], ignorenulls=True).over(back), F.col(f"_before_{c}")) for c in columns}
    ).withColumns(
        {f"_n_{c}": F.coalesce(F.last(here[c], ignorenulls=True).over(ahead), F.col(f"_after_{c}")) for c in columns}
    )

    def filled(c: str) -> Column:
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        step = (F.col(POSITION) - p["i"]) / F.nullif(n["i"] - p["i"], F.lit(0))
        return (
            F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
            .when(p.isNull(), n["v"]).when(n.isNull(), p["v"])
            .otherwise(p["v"] + (n["v"] - p["v"]) * step)
        )

    return rows.withColumns({c: filled(c) for c in columns}).select(*df.columns)
