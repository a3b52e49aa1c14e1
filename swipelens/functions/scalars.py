"""Row-wise column expressions: dates, distance, digits, scaling."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants the results depend on.
EARTH_RADIUS_KM = 6371.0
HOURS_PER_DAY = 24
DAYS_PER_WEEK = 7
NIGHT_STARTS = 22
NIGHT_ENDS = 4
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch; the order and distance of instants as one BIGINT."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(_c(ts))


def day_of_week(ts: Column | str) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(_c(ts)) + 1


def month_of_year(ts: Column | str) -> Column:
    return F.month(_c(ts))


def day_of_month(ts: Column | str) -> Column:
    return F.dayofmonth(_c(ts))


def is_weekend(ts: Column | str) -> Column:
    return (day_of_week(ts) >= 6).cast("int")


def is_night(ts: Column | str) -> Column:
    hour = hour_of_day(ts)
    return ((hour >= NIGHT_STARTS) | (hour < NIGHT_ENDS)).cast("int")


def unix_seconds(ts: Column | str) -> Column:
    return F.unix_seconds(_c(ts).cast("timestamp"))


def day_name(number: Column | str) -> Column:
    """Name of day 1..7; null outside that range."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    number = _c(number).cast("int")
    return F.when(number.between(1, DAYS_PER_WEEK), F.try_element_at(names, number))


def cyclical(values: Column | str, period: int) -> tuple[Column, Column]:
    """Sine and cosine of the position within a period."""
    angle = _c(values) * (2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in kilometres."""
    phi1, phi2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((F.radians(_c(lon2)) - F.radians(_c(lon1))) / 2)
    chord = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    # Not least(): it would turn a missing coordinate into the antipode.
    return F.asin(F.sqrt(F.when(chord > 1, 1.0).otherwise(chord))) * (2 * EARTH_RADIUS_KM)


def log_amount(x: Column | str) -> Column:
    """ln(1 + x), with negative values counted as 0."""
    x = _c(x)
    return F.when(x.isNotNull(), F.log1p(F.greatest(x.cast("double"), F.lit(0.0))))


def _cents(amount: Column | str) -> Column:
    return F.rint(_c(amount).cast("double") * 100).cast("bigint")


def last_cents_digit(amount: Column | str) -> Column:
    return F.pmod(_cents(amount), F.lit(10)).cast("int")


def leading_digit(amount: Column | str) -> Column:
    """First significant decimal digit of a positive amount, otherwise 0.

    Read from the printed number: a floating division would turn 0.30 into 2.
    """
    amount = _c(amount).cast("double")
    first = F.regexp_extract(amount.cast("string"), "[1-9]", 0)
    return (
        F.when(amount.isNull(), F.lit(None).cast("int"))
        .when(amount <= 0, F.lit(0))
        .otherwise(first.cast("int"))
    )


def age_years(dob: Column | str, on: Column | str) -> Column:
    """Whole years between two dates by calendar; null if either is missing."""
    dob, on = _c(dob), _c(on)
    birthday_ahead = (F.month(on) * 100 + F.dayofmonth(on)) < (F.month(dob) * 100 + F.dayofmonth(dob))
    return F.year(on) - F.year(dob) - birthday_ahead.cast("int")


def nan_to_null(x: Column | str) -> Column:
    """Missing numbers are null everywhere: Spark orders NaN above every number."""
    x = _c(x)
    return F.when(~F.isnan(x), x)


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over complete pairs as an aggregate; null without spread.

    Spark's own ``corr`` fails on a constant side when division by zero is an error.
    """
    x, y = _c(x).cast("double"), _c(y).cast("double")
    both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.sqrt(F.var_pop(both_x) * F.var_pop(both_y))
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
