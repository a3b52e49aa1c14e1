"""The full feature table in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.functions import scalars as S
from swipelens.operators import history as H


def row_features(df: DataFrame) -> DataFrame:
    """Features that need the row only: a projection over the scan."""
    hour_sin, hour_cos = S.cyclical("hour_of_day", S.HOURS_PER_DAY)
    dow_sin, dow_cos = S.cyclical("day_of_week", S.DAYS_PER_WEEK)
    return df.withColumns(
        {
            "hour_of_day": S.hour_of_day(C.TIME),
            "day_of_week": S.day_of_week(C.TIME),
            "month": S.month_of_year(C.TIME),
            "distance_km": S.haversine_km("lat", "long", "merch_lat", "merch_long"),
            "first_digit": S.leading_digit(C.AMOUNT),
            "last_digit": S.last_cents_digit(C.AMOUNT),
            "amt_log": S.log_amount(C.AMOUNT),
            "city_pop_log": S.log_amount("city_pop"),
            "idade": S.age_years("dob", C.TIME),
        }
    ).withColumns(
        {"hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos}
    )


def history_features(
    df: DataFrame,
    short_window: str = C.RECENT_WINDOW,
    velocity_limit: float = C.VELOCITY_LIMIT_KMH,
    outlier_z: float = C.OUTLIER_Z,
    **layout: int | str,
) -> DataFrame:
    """Features that read the card's past."""
    return (
        H.card_windows(df, short_window, **layout)
        .withColumns(
            {
                "prev_distance_km": H.prev_distance_km(),
                "transaction_velocity_kmh": H.velocity_kmh(),
                "amt_zscore_expanding": H.amount_zscore(),
            }
        )
        .withColumns(
            {
                "impossible_velocity": H.above("transaction_velocity_kmh", velocity_limit),
                "amt_is_outlier": H.above(F.abs("amt_zscore_expanding"), outlier_z),
            }
        )
    )


def feature_engineering(
    df: DataFrame, short_window: str = C.RECENT_WINDOW, history: DataFrame | None = None, **options
) -> DataFrame:
    """All row and history features; one output row per input row.

    The history windows run on the raw columns and the row features are added after them,
    so that the shuffle carries no derived column. With ``history``, earlier rows of another
    table (say, the training table) seed each card's past and are left out of the result.
    """
    if history is None:
        found = history_features(df, short_window, **options)
    else:
        marked = df.withColumn("_seed", F.lit(False)).unionByName(
            history.select(*df.columns).withColumn("_seed", F.lit(True))
        )
        found = history_features(marked, short_window, **options).where(~F.col("_seed")).drop("_seed")
    return row_features(found).drop(*H.PREVIOUS, "prev_distance_km")


def leak_probe(df: DataFrame, cut: str, alter: float = 99999.0, **options) -> DataFrame:
    """Feature rows up to ``cut`` that change when every later amount is altered.

    Empty when no feature reads the future.
    """
    checked = [*H.SPREAD, *H.RECENT, "amt_zscore_expanding", "amt_is_outlier", "transaction_velocity_kmh"]
    late = F.col(C.TIME) > F.lit(cut).cast(df.schema[C.TIME].dataType)
    altered = df.withColumn(C.AMOUNT, F.when(late, F.lit(alter)).otherwise(F.col(C.AMOUNT)))
    tables = [
        history_features(t, **options).where(~late).select(C.ROW_ID, F.struct(*checked).alias(n))
        for t, n in ((df, "before"), (altered, "after"))
    ]
    return tables[0].join(tables[1], C.ROW_ID).where(~F.col("before").eqNullSafe(F.col("after")))
