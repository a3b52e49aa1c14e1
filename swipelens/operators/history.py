"""What a card's past says about each of its transactions.

Every feature of a row reads only rows that come before it: the previous transaction, the
mean and spread of all earlier amounts, and the count and sum over a trailing window that
ends just before the row's own instant. Amounts are summed as decimals with eight places, so
the trailing sum is the same in whatever order it is made.

Two layouts give the same values, and each card takes the one that fits its size.

* By card. One shuffle and one sort serve all windows. A trailing range frame visits the
  rows inside the window again for every row, so this is for cards up to ``dense_rows``.
* By card and period. For larger cards the trailing window becomes a running total: each row
  enters it at its instant and leaves it one window later, as a second narrow row, so the cost
  per row no longer grows with the window. Cards above ``hot_rows`` are also cut into periods;
  each period starts from the merged totals of the earlier ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.functions.scalars import haversine_km, micros
from swipelens.session import materialize
from swipelens.sizing import KeyProfile, broadcast_if_small

#: Largest card for which the trailing range frame is used.
DENSE_ROWS = 50_000
#: A card below this many rows is never cut into periods.
HOT_ROWS = 1_000_000
#: Longest and shortest period of a cut card, in microseconds.
LONGEST_PERIOD = 3_600_000_000
SHORTEST_PERIOD = 1_000_000

PREVIOUS = ["prev_lat", "prev_long", f"prev_{C.TIME}"]
SPREAD = ["avg_amt_expanding", "stddev_amt_expanding"]
RECENT = ["txn_count_recent", "amt_sum_recent"]

_AT = "_micros"


def _exact(amount: Column) -> Column:
    """The amount for sums that must not depend on their order; NaN counts as missing."""
    return F.when(~F.isnan(amount), amount).cast("decimal(28,8)")


def _past_frame(*partition: str, order: list[str]) -> Window:
    return (
        Window.partitionBy(*partition).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )


def _by_card(df: DataFrame, key: str, time: str, tie: str, span: int) -> DataFrame:
    past = _past_frame(key, order=[_AT, tie])
    recent = Window.partitionBy(key).orderBy(_AT).rangeBetween(-span, -1)
    previous = Window.partitionBy(key).orderBy(_AT, tie)
    amount = F.col(C.AMOUNT)
    return df.withColumn(_AT, micros(time)).withColumns(
        {
            "_previous": F.lag(F.struct("lat", "long", F.col(time).alias("at"), F.col(_AT).alias("us"))).over(previous),
            "avg_amt_expanding": F.avg(amount).over(past),
            "stddev_amt_expanding": F.stddev_samp(amount).over(past),
            "txn_count_recent": F.count(amount).over(recent).cast("double"),
            "amt_sum_recent": F.coalesce(F.sum(_exact(amount)).over(recent).cast("double"), F.lit(0.0)),
        }
    )


def _by_period(
    df: DataFrame, key: str, time: str, tie: str, span: int, hot: DataFrame, period: int
) -> DataFrame:
    amount = F.col(C.AMOUNT)
    rows = df.withColumns({_AT: micros(time), "_is_row": F.lit(1), "_enters": F.lit(1)})
    leaving = rows.select(
        key, F.col(tie), amount, (F.col(_AT) + span).alias(_AT),
        F.lit(0).alias("_is_row"), F.lit(-1).alias("_enters"),
    )
    moves = rows.unionByName(leaving, allowMissingColumns=True)
    moves = moves.join(hot.withColumn("_hot", F.lit(True)), key, "left").withColumn(
        "_period",
        F.when(F.col("_hot"), F.floor(F.col(_AT) / period)).otherwise(F.lit(0)).cast("bigint"),
    )

    own = F.when(F.col("_is_row") == 1, amount)
    here = F.when(
        F.col("_is_row") == 1,
        F.struct("lat", "long", F.col(time).alias("at"), F.col(_AT).alias("us")),
    )
    signed = F.when(F.col("_enters") == 1, _exact(amount)).otherwise(-_exact(amount))
    signed_count = F.when(amount.isNotNull(), F.col("_enters"))

    # Totals of each period of a cut card, and of all its earlier periods. The number of
    # periods of a card is bounded by the time the table covers, not by its rows.
    totals = moves.where("_hot").groupBy(key, "_period").agg(
        F.count(own).alias("n"),
        F.avg(own).alias("mean"),
        (F.var_pop(own) * F.count(own)).alias("m2"),
        F.min(own).alias("low"),
        F.max(own).alias("high"),
        F.max_by(here, F.when(F.col("_is_row") == 1, F.struct(_AT, tie))).alias("last"),
        F.sum(signed_count).alias("inside_n"),
        F.sum(signed).alias("inside_sum"),
    )
    whole = Window.partitionBy(key).orderBy("_period").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    earlier = _past_frame(key, order=["_period"])
    # Sums of squares are taken around the card's first period, to keep their digits.
    pivot = F.first("mean", ignorenulls=True).over(whole)
    offset = F.coalesce(F.col("n") * (F.col("mean") - F.col("_pivot")), F.lit(0.0))
    offset2 = F.coalesce(F.col("n") * F.pow(F.col("mean") - F.col("_pivot"), 2), F.lit(0.0))
    carried = (
        totals.withColumn("_pivot", pivot)
        .withColumns({"_s1": offset, "_s2": offset2, "_m2": F.coalesce("m2", F.lit(0.0))})
        .select(
            key, "_period",
            F.sum("n").over(earlier).alias("c_n"),
            (F.col("_pivot") + F.sum("_s1").over(earlier) / F.nullif(F.sum("n").over(earlier), F.lit(0))).alias("c_mean"),
            (
                F.sum("_m2").over(earlier) + F.sum("_s2").over(earlier)
                - F.pow(F.sum("_s1").over(earlier), 2) / F.nullif(F.sum("n").over(earlier), F.lit(0))
            ).alias("c_m2"),
            F.min("low").over(earlier).alias("c_low"),
            F.max("high").over(earlier).alias("c_high"),
            F.last("last", ignorenulls=True).over(earlier).alias("c_last"),
            F.sum("inside_n").over(earlier).alias("c_inside_n"),
            F.sum("inside_sum").over(earlier).alias("c_inside_sum"),
        )
    )

    nothing = F.lit(0).cast("decimal(38,8)")
    part = [key, "_period"]
    past = _past_frame(*part, order=[_AT, "_is_row", tie])
    before = Window.partitionBy(*part).orderBy(_AT).rangeBetween(Window.unboundedPreceding, -1)
    inside = moves.withColumns(
        {
            "w_last": F.last(here, ignorenulls=True).over(past),
            "w_n": F.count(own).over(past),
            "w_mean": F.avg(own).over(past),
            "w_m2": F.var_pop(own).over(past) * F.count(own).over(past),
            "w_low": F.min(own).over(past),
            "w_high": F.max(own).over(past),
            "w_inside_n": F.coalesce(F.sum(signed_count).over(before), F.lit(0)),
            "w_inside_sum": F.coalesce(F.sum(signed).over(before), nothing),
        }
    ).where("_is_row = 1")

    zero = F.lit(0)
    n_c, n_w = F.coalesce("c_n", zero), F.col("w_n")
    n = n_c + n_w
    gap = F.coalesce(F.col("w_mean") - F.col("c_mean"), F.lit(0.0))
    mean = F.when(n_c == 0, F.col("w_mean")).when(n_w == 0, F.col("c_mean")).otherwise(
        F.col("c_mean") + gap * n_w / F.nullif(n, zero)
    )
    m2 = (
        F.coalesce("c_m2", F.lit(0.0)) + F.coalesce("w_m2", F.lit(0.0))
        + F.coalesce(gap * gap * n_c * n_w / F.nullif(n, zero), F.lit(0.0))
    )
    flat = F.least("c_low", "w_low") == F.greatest("c_high", "w_high")
    spread = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(flat, F.lit(0.0))
        .otherwise(F.sqrt(F.greatest(m2, F.lit(0.0)) / F.nullif(n - 1, zero)))
    )
    inside_n = F.coalesce("c_inside_n", zero) + F.col("w_inside_n")
    inside_sum = (F.coalesce("c_inside_sum", nothing) + F.col("w_inside_sum")).cast("double")
    return (
        inside.join(carried, part, "left")
        .withColumns(
            {
                "_previous": F.coalesce("w_last", "c_last"),
                "avg_amt_expanding": mean,
                "stddev_amt_expanding": spread,
                "txn_count_recent": inside_n.cast("double"),
                "amt_sum_recent": F.when(inside_n == 0, F.lit(0.0)).otherwise(inside_sum),
            }
        )
        .select(*df.columns, _AT, "_previous", *SPREAD, *RECENT)
    )


def _period(profile: KeyProfile, rows: int, period: str | None) -> int:
    """Period length that leaves about ``rows`` rows of the largest card in each."""
    if period is not None:
        return C.window_micros(period)
    even = profile.span * max(rows, 1) // max(profile.max_rows, 1)
    return max(SHORTEST_PERIOD, min(LONGEST_PERIOD, even))


def card_windows(
    df: DataFrame,
    window: str = C.RECENT_WINDOW,
    key: str = C.KEY,
    time: str = C.TIME,
    tie: str = C.ROW_ID,
    dense_rows: int = DENSE_ROWS,
    hot_rows: int = HOT_ROWS,
    period: str | None = None,
) -> DataFrame:
    """Previous position and time, expanding mean and spread, trailing count and sum.

    ``tie`` orders the rows of one instant. Cards are counted once, and the counts written, so
    that both the choice of layouts and the choice of cards read them. While no card is
    dense there is one layout; otherwise only the dense cards take the second one.
    """
    span = C.window_micros(window)
    profile = KeyProfile.measure(df, key, micros(time))
    if profile.max_rows <= dense_rows:
        found = _by_card(df, key, time, tie, span)
    else:
        dense = profile.keys.where(F.col("n") > dense_rows).select(key, (F.col("n") > hot_rows).alias("_hot"))
        dense = broadcast_if_small(materialize(dense))
        found = _by_period(
            df.join(dense.select(key), key, "left_semi"), key, time, tie, span,
            dense.where("_hot").select(key), _period(profile, hot_rows, period),
        ).unionByName(
            _by_card(df.join(dense.select(key), key, "left_anti"), key, time, tie, span)
        )
    return found.withColumns(
        {
            "prev_lat": F.col("_previous.lat"),
            "prev_long": F.col("_previous.long"),
            f"prev_{time}": F.col("_previous.at"),
            "time_diff_hours": (F.col(_AT) - F.col("_previous.us")) / F.lit(3.6e9),
        }
    ).drop("_previous", _AT)


def prev_distance_km() -> Column:
    """Distance to the previous position; null without one."""
    return haversine_km("lat", "long", "prev_lat", "prev_long")


def velocity_kmh() -> Column:
    """Speed since the previous transaction; null when no time has passed."""
    hours = F.col("time_diff_hours")
    return F.when(hours > 0, prev_distance_km() / F.nullif(hours, F.lit(0.0)))


def above(value: Column | str, limit: float) -> Column:
    """1 above the limit, otherwise 0, also for a missing value."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value > limit, 1).otherwise(0)


def amount_zscore() -> Column:
    """Deviation from the card's earlier amounts; 0.0 without spread."""
    spread = F.col("stddev_amt_expanding")
    return F.when(
        spread > 0, (F.col(C.AMOUNT) - F.col("avg_amt_expanding")) / F.nullif(spread, F.lit(0.0))
    ).otherwise(F.lit(0.0))


def card_profile(df: DataFrame, key: str = C.KEY) -> DataFrame:
    """Mean and sample spread of a card over its whole history. Not point-in-time."""
    return df.groupBy(key).agg(
        F.avg(C.AMOUNT).alias("card_avg_amt"), F.stddev_samp(C.AMOUNT).alias("card_stddev_amt")
    )


def with_card_profile(df: DataFrame, key: str = C.KEY) -> DataFrame:
    """Left join of the card statistics onto every row.

    The statistics are summed on the map side. No hint is given: Spark broadcasts them when
    they are small, and splits a hot card at run time when they are not.
    """
    return df.join(card_profile(df, key), key, "left")


def profile_zscore(df: DataFrame, key: str = C.KEY, limit: float = C.OUTLIER_Z) -> DataFrame:
    """Whole-history z-score and flag. Reads the future too; for profiling only."""
    spread = F.col("card_stddev_amt")
    z = F.when(spread > 0, (F.col(C.AMOUNT) - F.col("card_avg_amt")) / F.nullif(spread, F.lit(0.0)))
    return (
        with_card_profile(df, key)
        .withColumn("profile_zscore", F.coalesce(z, F.lit(0.0)))
        .withColumn("profile_outlier", above(F.abs("profile_zscore"), limit))
    )
