"""Column roles and default parameters."""

from __future__ import annotations

# Column names and parameters that results depend on.
KEY = "cc_num"
TIME = "trans_date_trans_time"
ROW_ID = "trans_num"
AMOUNT = "amt"
TARGET = "is_fraud"
SEED = 42

ID_COLUMNS = [
    "cc_num", "trans_num", "first", "last", "street", "dob", "trans_date_trans_time",
    "unix_time", "prev_unix_time", "zip", "lat", "long", "merch_lat", "merch_long",
    "prev_lat", "prev_long", "city_pop", "amt",
]
ONE_HOT_COLUMNS = ["gender"]
TARGET_ENCODED_COLUMNS = ["job", "city", "state", "category", "merchant"]
SCALED_COLUMNS = [
    "amt_log", "city_pop_log", "distance_km", "time_diff_hours", "transaction_velocity_kmh",
    "avg_amt_expanding", "stddev_amt_expanding", "amt_zscore_expanding", "idade",
    "txn_count_recent", "amt_sum_recent",
]
PASSTHROUGH_COLUMNS = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month", "first_digit", "last_digit",
    "impossible_velocity", "amt_is_outlier",
]

RECENT_WINDOW = "24h"
VELOCITY_LIMIT_KMH = 1000.0
OUTLIER_Z = 3.0
ENCODING_SMOOTHING = 20.0
ENCODING_MIN_SAMPLES = 10
UNDERSAMPLE_RATIO = 10
FALSE_ALARM_COST = 5.0
FPR_TARGET = 0.001
COST_SCENARIO_WEIGHTS = [10, 50, 100]
# End of fixed values.

FEATURE_COLUMNS = ONE_HOT_COLUMNS + TARGET_ENCODED_COLUMNS + SCALED_COLUMNS + PASSTHROUGH_COLUMNS

_UNIT_MICROS = {"s": 1_000_000, "min": 60_000_000, "m": 60_000_000, "h": 3_600_000_000,
                "d": 86_400_000_000}


def window_micros(text: str) -> int:
    """Length of a window such as ``24h``, ``90min`` or ``7d`` in microseconds."""
    digits = "".join(c for c in text if c.isdigit())
    unit = text[len(digits):].strip().lower()
    if not digits or unit not in _UNIT_MICROS:
        raise ValueError(f"window must be a whole number and one of {sorted(_UNIT_MICROS)}: {text!r}")
    return int(digits) * _UNIT_MICROS[unit]
