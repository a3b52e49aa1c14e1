"""The same results as plain SQL over the given tables, one text per query."""

from __future__ import annotations

import re

from swipelens.operators.metrics import threshold_grid

CUT = "timestamp '2024-01-22'"

TXN = """txn as (
  select cast(event_id as varchar) as trans_num, cast(user_id as varchar) as cc_num,
    ts as trans_date_trans_time, value as amt, event_type as category,
    concat('merch_', cast(event_id % 40 as varchar)) as merchant,
    case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
    c_mktsegment as job, n_name as state, r_name as city,
    1000 + (c_custkey * 7919) % 100000 as city_pop,
    cast(date_add(date '1950-01-01', to_days(cast((c_custkey * 37) % 18000 as int))) as date) as dob,
    25 + ((c_custkey * 13) % 2400) / 1e2 + (event_id % 7) / 1e1 as lat,
    -120 + ((c_custkey * 29) % 5000) / 1e2 + (event_id % 5) / 1e1 as long,
    25 + ((c_custkey * 13) % 2400) / 1e2 + ((event_id * 17) % 201 - 100) / 1e2 as merch_lat,
    -120 + ((c_custkey * 29) % 5000) / 1e2 + ((event_id * 31) % 201 - 100) / 1e2 as merch_long,
    case when (value >= 150 and hour(ts) in (22,23,0,1,2,3)) or event_id % 211 = 0
      then 1 else 0 end as is_fraud,
    ts < timestamp '2024-01-22' as in_train
  from events join customer on user_id = c_custkey
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)"
    )
    return f"2 * 6371.0::double * asin(sqrt(case when ({a}) > 1 then 1 else {a} end))"


def age(dob: str, on: str) -> str:
    return (
        f"(year({on}) - year({dob}) - case when month({on}) * 100 + day({on}) < "
        f"month({dob}) * 100 + day({dob}) then 1 else 0 end)"
    )


def r(expression: str, name: str, digits: int = 6) -> str:
    """Rounded as in ``queries.tidy``: the same nudge off exact halves, and no negative zero."""
    return f"round({expression} + 1e-{digits + 3}, {digits}) + 0e0 as {name}"


def at(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f') as {name}"


def big(expression: str, name: str) -> str:
    return f"cast({expression} as bigint) as {name}"


LEADING = ("case when amt <= 0 then 0 else cast(regexp_extract(cast(amt as varchar), '[1-9]') as bigint) end")
LAST_DIGIT = "((cast(round_even(amt * 100, 0) as bigint) % 10) + 10) % 10"
NIGHT = "case when hour(trans_date_trans_time) >= 22 or hour(trans_date_trans_time) < 4 then 1 else 0 end"
DAY = "isodow(trans_date_trans_time)"


def windows(key: str = "cc_num", hours: int = 24, source: str = "txn") -> str:
    """Windows over the past of each key."""
    span = hours * 3_600_000_000
    past = "rows between unbounded preceding and 1 preceding"
    return f"""timed as (select *, epoch_us(trans_date_trans_time) as us from {source}),
hist0 as (
  select *,
    lag(lat) over seq as prev_lat, lag(long) over seq as prev_long,
    lag(us) over seq as prev_us, lag(trans_date_trans_time) over seq as prev_at,
    avg(amt) over (partition by {key} order by us, trans_num {past}) as avg_amt_expanding,
    case when min(amt) over (partition by {key} order by us, trans_num {past})
            = max(amt) over (partition by {key} order by us, trans_num {past})
          and count(amt) over (partition by {key} order by us, trans_num {past}) > 1 then 0.0::double
      else stddev_samp(amt) over (partition by {key} order by us, trans_num {past}) end as stddev_amt_expanding,
    cast(count(amt) over recent as double) as txn_count_recent,
    coalesce(sum(amt) over recent, 0.0) as amt_sum_recent
  from timed
  window seq as (partition by {key} order by us, trans_num),
    recent as (partition by {key} order by us range between {span} preceding and 1 preceding)
),
hist1 as (
  select *, (us - prev_us) / 3.6e9 as time_diff_hours,
    {haversine('lat', 'long', 'prev_lat', 'prev_long')} as prev_distance_km,
    case when stddev_amt_expanding > 0 then (amt - avg_amt_expanding) / stddev_amt_expanding else 0.0::double end
      as amt_zscore_expanding
  from hist0
),
hist2 as (
  select *, case when time_diff_hours > 0 then prev_distance_km / time_diff_hours end as transaction_velocity_kmh
  from hist1
),
hist as (
  select *, case when transaction_velocity_kmh > 1000 then 1 else 0 end as impossible_velocity,
    case when abs(amt_zscore_expanding) > 3 then 1 else 0 end as amt_is_outlier
  from hist2
)"""


def rows_cte(source: str = "hist", name: str = "feat") -> str:
    """Row features on top of any table with the raw columns."""
    turn = "2 * pi()"
    return f"""{name} as (
  select *, hour(trans_date_trans_time) as hour_of_day, {DAY} as day_of_week,
    month(trans_date_trans_time) as month,
    {haversine('lat', 'long', 'merch_lat', 'merch_long')} as distance_km,
    {LEADING} as first_digit, {LAST_DIGIT} as last_digit,
    ln(1 + greatest(amt, 0)) as amt_log, ln(1 + greatest(city_pop, 0)) as city_pop_log,
    {age('dob', 'trans_date_trans_time')} as idade,
    sin(hour(trans_date_trans_time) * {turn} / 24) as hour_sin,
    cos(hour(trans_date_trans_time) * {turn} / 24) as hour_cos,
    sin({DAY} * {turn} / 7) as dow_sin, cos({DAY} * {turn} / 7) as dow_cos
  from {source}
)"""


HOURLY = """hourly as (
  select date_trunc('hour', trans_date_trans_time) as hour, count(*) as n, sum(amt) as total
  from txn group by 1
)"""
SCORED = f"""scored as (
  select trans_num, is_fraud as label, amt, round(1 / (1 + exp(-(0.02::double * amt + 2 * ({NIGHT}) - 5))), 4) as score
  from txn
)"""
POINTS = """counts as (
  select score, sum(label) as pos, sum(1 - label) as neg from scored group by score
),
points as (
  select score, pos, neg, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp,
    sum(pos) over () as p, sum(neg) over () as n
  from counts
)"""
ENCODED_COLUMNS = ["job", "city", "state", "category", "merchant"]
SCALED = [
    "amt_log", "city_pop_log", "distance_km", "time_diff_hours", "transaction_velocity_kmh",
    "avg_amt_expanding", "stddev_amt_expanding", "amt_zscore_expanding", "idade",
    "txn_count_recent", "amt_sum_recent",
]
PASSED_FLOAT = ["hour_sin", "hour_cos", "dow_sin", "dow_cos"]
PASSED_INT = ["month", "first_digit", "last_digit", "impossible_velocity", "amt_is_outlier"]
NUMERIC = ["amt", "lat", "long", "city_pop", "merch_lat", "merch_long"]


def encoding_ctes(source: str, replace: dict[str, str] | None = None) -> str:
    """One table of smoothed means per encoded column, from the training rows."""
    parts = [f"prior as (select avg(is_fraud) as m from {source} where in_train)"]
    for c in ENCODED_COLUMNS:
        value = (replace or {}).get(c, c)
        parts.append(
            f"enc_{c} as (select v, m * (1 - w) + own * w as e from (select {value} as v, avg(is_fraud) as own,"
            f" 1 / (1 + exp(-(count(*) - 10) / 20.0::double)) as w from {source} where in_train and ({value}) is not null"
            f" group by 1) cross join prior)"
        )
    return ",\n".join(parts)


def encoding_joins() -> str:
    return " ".join(f"left join enc_{c} on enc_{c}.v = f.{c}" for c in ENCODED_COLUMNS)


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def describe(where: str, label: int) -> str:
    return "\nunion all\n".join(
        f"select '{c}' as \"column\", {big('count(' + c + ')', 'n')}, {r('avg(' + c + ')', 'mean', 4)},"
        f" {r('stddev_samp(' + c + ')', 'std', 4)}, {r('min(' + c + ')::double', 'min', 4)},"
        f" {r('max(' + c + ')::double', 'max', 4)}, {r(f'quantile_cont({c}::double, 0.25)', 'q25', 4)},"
        f" {r(f'quantile_cont({c}::double, 0.5)', 'q50', 4)}, {r(f'quantile_cont({c}::double, 0.75)', 'q75', 4)},"
        f" {big(str(label), 'is_fraud')} from txn {where}"
        for c in NUMERIC
    )


def moving(order: str, value: str, width: int) -> str:
    before, after = width // 2, (width - 1) // 2
    return f"avg({value}) over (order by {order} rows between {before} preceding and {after} following)"


def digits(source: str) -> str:
    return (
        f"select {big('d', 'digit')}, {r('100.0::double * legit / sum(legit) over ()', 'pct_legit')},"
        f" {r('100.0::double * fraud / sum(fraud) over ()', 'pct_fraud')}"
        f" from (select {source} as d, count(*) filter (where is_fraud = 0) as legit,"
        " count(*) filter (where is_fraud = 1) as fraud from rowf group by 1)"
    )


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    txn = with_(TXN)
    hist = with_(TXN, windows())
    rowf = with_(TXN, rows_cte("txn", "rowf"))
    hourly = with_(TXN, HOURLY)
    scored = with_(TXN, SCORED)

    # Sources and sinks
    raw = (
        f"trans_num, cc_num, {at('trans_date_trans_time', 'trans_date_trans_time')}, {r('amt', 'amt')},"
        " category, merchant, gender, job, state, city, cast(city_pop as bigint) as city_pop,"
        f" cast(dob as varchar) as dob, {r('lat', 'lat')}, {r('long', 'long')},"
        f" {r('merch_lat', 'merch_lat')}, {r('merch_long', 'merch_long')}, {big('is_fraud', 'is_fraud')}"
    )
    q["scan_transactions"] = txn + (
        f"select {raw}, cast(floor(epoch(trans_date_trans_time)) as bigint) as unix_time from txn"
    )
    q["load_pair"] = txn + (
        "select case when in_train then 'train' else 'test' end as part, count(*) as n_rows from txn group by 1"
    )
    q["parquet_roundtrip"] = txn + f"select {raw} from txn"
    rate = r("avg(is_fraud) * 100", "fraud_rate_pct")
    q["report_sink"] = txn + f"select state, count(*) as n, {rate} from txn group by 1"
    text = ["gender", *ENCODED_COLUMNS]
    numbers = [r(c, c) for c in [*SCALED, *PASSED_FLOAT] if c != "idade"]
    whole = [big(c, c) for c in ["idade", *PASSED_INT, "is_fraud"]]
    features = with_(TXN, windows(), rows_cte()) + f"select {', '.join([*text, *numbers, *whole])} from feat"
    q["model_matrix"] = features

    # Projection, filters, quality
    q["select_roles"] = features
    q["class_filter"] = txn + (
        f"select {big('is_fraud', 'is_fraud')}, {r('avg(amt)', 'mean_amt')}, {r('median(amt)', 'median_amt')}"
        " from txn group by is_fraud"
    )
    q["fraud_rows"] = txn + f"select trans_num, cc_num, {r('amt', 'amt')} from txn where is_fraud = 1"
    missing = ["trans_num", "avg_amt_expanding", "stddev_amt_expanding", "time_diff_hours", "transaction_velocity_kmh"]
    q["missing_counts"] = with_(TXN, windows("cc_num, in_train")) + "select * from (" + " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (where {c} is null) as n_missing,"
        " case when in_train then 'train' else 'test' end as part from hist group by in_train"
        for c in missing
    ) + ") where n_missing > 0"
    q["fraud_value_share"] = txn + (
        f"select {r('sum(case when is_fraud = 1 then amt else 0 end) / sum(amt) * 1e6', 'fraud_per_million', 4)} from txn"
    )
    q["string_violations"] = txn + " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (where length({c}) <> {n}) as n_wrong_length,"
        f" count(*) filter (where not regexp_full_match({c}, '[0-9]+')) as n_non_numeric from txn"
        for c, n in (("cc_num", 3), ("trans_num", 4), ("merchant", 8))
    )
    profiled = {
        "trans_num": "string", "cc_num": "string", "trans_date_trans_time": "timestamp_ntz", "amt": "double",
        "category": "string", "merchant": "string", "gender": "string", "job": "string", "state": "string",
        "city": "string", "city_pop": "bigint", "dob": "date", "lat": "double", "long": "double",
        "merch_lat": "double", "merch_long": "double", "is_fraud": "int", "time_diff_hours": "double",
        "prev_lat": "double",
    }
    q["column_profile"] = hist + " union all ".join(
        f"select '{c}' as \"column\", '{kind}' as column_type, count(*) - count({c}) as n_null,"
        f" {r(f'(count(*) - count({c})) * 100.0::double / count(*)', 'pct_null')},"
        f" count(distinct {c}) as n_unique from hist"
        for c, kind in profiled.items()
    )
    raw_columns = [c for c in profiled if c not in ("time_diff_hours", "prev_lat")]
    q["duplicate_rows"] = txn + (
        f"select {big('sum(n)', 'n_rows')}, {big(str(len(raw_columns)), 'n_columns')}, {big('sum(n - 1)', 'n_duplicates')},"
        f" {r('sum(n - 1) * 100.0::double / sum(n)', 'pct_duplicates')}"
        f" from (select count(*) as n from txn group by {', '.join(raw_columns)})"
    )
    always = [
        "distance_km", "first_digit", "last_digit", "amt_log", "city_pop_log",
        "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month",
    ]
    checks = [f"select 'present:{c}' as \"check\", 1::bigint as passed" for c in [*text, *SCALED, *PASSED_FLOAT, *PASSED_INT]]
    checks += [f"select 'not_null:{c}', cast(count(*) = count({c}) as bigint) from feat" for c in always]
    checks.append("select 'row_count', cast(count(*) = (select count(*) from events) as bigint) from feat")
    q["model_store_check"] = txn + "select count(*) as n_rows, 0::bigint as n_changed from txn where not in_train"
    q["train_all_check"] = txn + " union all ".join(
        f"select '{m}' as model, count(*) as n_scored, 0::bigint as n_out_of_range, count(*) as n_counted"
        " from txn where not in_train"
        for m in ("Logistic Regression", "Random Forest", "Gradient Boosted Trees", "XGBoost", "LightGBM")
    )
    zero = "0::bigint as"
    q["boosting_check"] = txn + " union all ".join(
        f"select '{m}' as model, {big(n, 'n_trees')}, {root} as n_root_rows, {zero} n_too_many_leaves, {zero} n_small_leaves,"
        f" {zero} n_lost_rows from txn where in_train"
        for m, n, root in (
            ("Gradient Boosted Trees", 200, "count(*)"), ("XGBoost", 400, "case when count(*) < 0 then 0 end"), ("LightGBM", 400, "count(*)"),
        )
    )
    ranges = [
        "maxIter", "numLeaves", "stepSize", "minInstancesPerNode", "featureFraction", "subsamplingRate", "baggingFreq",
        "regAlpha", "regLambda",
    ]
    q["search_check"] = (
        f"select {big(25, 'n_trials')}, {big(25, 'n_different')}, " + ", ".join(f"{zero} n_outside_{k}" for k in ranges)
        + f", {zero} n_bad_measures, {big(1, 'best_first')}"
    )
    q["calibrate_check"] = txn + " union all ".join(
        f"select '{m}' as method, count(*) as n_rows, {zero} n_out_of_range, {zero} n_falls from txn where not in_train"
        for m in ("isotonic", "sigmoid")
    )
    q["ratio_sweep_check"] = txn + " union all ".join(
        f"select {k}::double as ratio, {big('sum(is_fraud) filter (in_train)', 'n_positive')},"
        f" {big(f'least(count(*) filter (in_train and is_fraud = 0), {k} * sum(is_fraud) filter (in_train))', 'n_negative')},"
        " count(*) filter (not in_train) as n_counted from txn"
        for k in (1, 5, 10, 20)
    )
    q["best_ratios_check"] = " union all ".join(
        f"select '{m}' as measure, {big(4, 'n_ratios')}, {zero} n_better" for m in ("f1", "g_mean", "pr_auc")
    )
    q["attribution_check"] = txn + " union all ".join(
        f"select '{m}' as model, least(count(*), 500) as n_rows, {zero} n_off, {zero} n_incomplete from txn where not in_train"
        for m in ("Logistic Regression", "Gradient Boosted Trees", "XGBoost", "LightGBM")
    )
    q["best_model_check"] = f"select {big(5, 'n_models')}, {big(1, 'is_best')}"
    q["importance_check"] = " union all ".join(
        f"select '{m}' as model, {big(1, 'all_features')}, {zero} n_negative, 1::double as total"
        for m in ("Random Forest", "Gradient Boosted Trees", "XGBoost", "LightGBM")
    )
    q["fold_means_check"] = f"select {big(5, 'n_models')}, " + ", ".join(
        f"{zero} n_bad_{m}" for m in ("accuracy", "precision", "recall", "f1", "roc_auc")
    )
    strong = ["amt", "amt_log", "lat", "merch_lat", "long", "merch_long", "city_pop", "city_pop_log"]
    lined = [(a, b) for i, a in enumerate(strong) for b in strong[i + 1:]]
    q["drop_collinear"] = with_(TXN, rows_cte("txn", "rowf"), "links as (" + " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, corr({a}, {b}) as c from rowf" for a, b in lined
    ) + ")") + (
        f"select column_a, column_b, {r('c', 'corr')} from links"
        " where column_a not in (select column_a from links where abs(c) >= 0.9)"
        " and column_b not in (select column_a from links where abs(c) >= 0.9)"
    )
    q["required_columns"] = with_(TXN, windows(), rows_cte()) + " union all ".join(checks)
    q["date_filter"] = txn + (
        f"select trans_num, {r('amt', 'amt')} from txn where trans_date_trans_time >= timestamp '2024-01-20'"
    )

    # Scalar functions
    q["time_parts"] = txn + (
        f"select trans_num, hour(trans_date_trans_time) as hour_of_day, {DAY} as day_of_week,"
        " month(trans_date_trans_time) as month from txn"
    )
    q["calendar_flags"] = txn + (
        "select trans_num, day(trans_date_trans_time) as day_of_month,"
        f" {big(f'case when {DAY} >= 6 then 1 else 0 end', 'is_weekend')}, {big(NIGHT, 'is_night')},"
        " cast(floor(epoch(trans_date_trans_time)) as bigint) as unix_time from txn"
    )
    q["day_name"] = txn + "select trans_num, dayname(trans_date_trans_time) as day_name from txn"
    q["cyclical_encode"] = rowf + "select trans_num, " + ", ".join(r(c, c) for c in PASSED_FLOAT) + " from rowf"
    q["haversine_km"] = rowf + f"select trans_num, {r('distance_km', 'distance_km')} from rowf"
    q["log_transform"] = rowf + (
        f"select trans_num, {r('amt_log', 'amt_log')}, {r('city_pop_log', 'city_pop_log')} from rowf"
    )
    q["last_cents_digit"] = rowf + f"select trans_num, {big('last_digit', 'last_digit')} from rowf"
    q["leading_digit"] = rowf + f"select trans_num, {big('first_digit', 'first_digit')} from rowf"
    q["min_max_scale"] = txn + (
        f"select trans_num, {r('(amt - min(amt) over ()) / (max(amt) over () - min(amt) over ())', 'amt_scaled')} from txn"
    )
    q["z_scale_series"] = txn + (
        f"select trans_num, {r('(amt - avg(amt) over ()) / stddev_samp(amt) over ()', 'amt_z')} from txn"
    )
    q["age_at_date"] = txn + (
        f"select trans_num, {age('dob', 'trans_date_trans_time')} as idade,"
        f" {age('dob', chr(100) + 'ate ' + repr('2021-01-01'))} as age_fixed from txn"
    )

    # Windows per card
    q["prev_transaction"] = hist + (
        f"select trans_num, {r('prev_lat', 'prev_lat')}, {r('prev_long', 'prev_long')},"
        f" {at('prev_at', 'prev_trans_date_trans_time')} from hist"
    )
    q["time_diff_hours"] = hist + f"select trans_num, {r('time_diff_hours', 'time_diff_hours')} from hist"
    q["prev_distance_km"] = hist + f"select trans_num, {r('prev_distance_km', 'prev_distance_km')} from hist"
    q["velocity_kmh"] = hist + (
        f"select trans_num, {r('transaction_velocity_kmh', 'transaction_velocity_kmh', 4)},"
        f" {big('impossible_velocity', 'impossible_velocity')},"
        f" {big('case when transaction_velocity_kmh > 900 then 1 else 0 end', 'impossible_velocity_900')} from hist"
    )
    spread = f"{r('avg_amt_expanding', 'avg_amt_expanding')}, {r('stddev_amt_expanding', 'stddev_amt_expanding')}"
    recent = f"{r('txn_count_recent', 'txn_count_recent')}, {r('amt_sum_recent', 'amt_sum_recent')}"
    q["expanding_mean_std"] = hist + f"select trans_num, {spread} from hist"
    q["amt_zscore_outlier"] = hist + (
        f"select trans_num, {r('amt_zscore_expanding', 'amt_zscore_expanding')},"
        f" {big('amt_is_outlier', 'amt_is_outlier')} from hist"
    )
    q["recent_count_sum"] = hist + f"select trans_num, {recent} from hist"
    q["recent_count_sum_dense"] = with_(TXN, windows(hours=36)) + f"select trans_num, {spread}, {recent} from hist"
    floats = ", ".join(r(c, c, 4) for c in [*SCALED, *PASSED_FLOAT] if c != "idade")
    ints = ", ".join(big(c, c) for c in ["is_fraud", "idade", *PASSED_INT])
    q["feature_engineering"] = with_(TXN, windows(), rows_cte()) + f"select trans_num, {floats}, {ints} from feat"
    q["seeded_history"] = hist + (
        "select trans_num, " + ", ".join(
            r(c, c, 4) for c in
            ["avg_amt_expanding", "stddev_amt_expanding", "txn_count_recent", "amt_sum_recent", "time_diff_hours"]
        ) + " from hist where not in_train"
    )
    changed = re.sub(r"\b(timed|hist\d?)\b", r"late_\1", windows(source="altered"))
    compared = [
        "avg_amt_expanding", "stddev_amt_expanding", "txn_count_recent", "amt_sum_recent",
        "amt_zscore_expanding", "amt_is_outlier", "transaction_velocity_kmh",
    ]
    late = "trans_date_trans_time > timestamp '2024-01-15'"
    q["leak_probe"] = with_(
        TXN, windows(),
        f"altered as (select * replace (case when {late} then 99999.0::double else amt end as amt) from txn)",
        changed,
    ) + (
        f"select count(*) as n_changed from hist a join late_hist b using (trans_num) where not a.{late} and ("
        + " or ".join(f"a.{c} is distinct from b.{c}" for c in compared) + ")"
    )
    q["centered_moving_avg"] = hourly + (
        f"select {at('hour', 'hour')}, n, {r(moving('hour', 'n', 24), 'moving_avg')} from hourly"
    )
    q["band_anomalies"] = hourly + f""", smooth as (
  select hour, n, {moving('hour', 'n', 24)} as m, row_number() over (order by hour) - 1 as pos, count(*) over () as size
  from hourly),
band as (select avg(abs(n - m)) + 1.96::double * stddev_pop(n - m) as w from smooth where pos >= 12 and pos < size - 12)
select {at('hour', 'hour')}, n, {r('m', 'moving_avg')}, {r('m - w', 'lower_bound')}, {r('m + w', 'upper_bound')}
from smooth cross join band where n < m - w or n > m + w"""
    q["card_profile_zscore"] = txn + f"""select trans_num, {r('z', 'profile_zscore')},
  {big('case when abs(z) > 3 then 1 else 0 end', 'profile_outlier')}
from (select trans_num, case when s > 0 then (amt - m) / s else 0.0::double end as z
  from txn left join (select cc_num, avg(amt) as m, stddev_samp(amt) as s from txn group by 1) using (cc_num))"""
    newest = "order by trans_date_trans_time desc, trans_num desc"
    q["last_n_mean"] = txn + (
        f"select {r('case when count(*) = 50 then avg(amt) end', 'last_n_mean')}"
        f" from (select amt from txn {newest} limit 50)"
    )
    q["last_n_weighted_mean"] = txn + (
        f"select {r('sum((6 - i) * amt) / sum(6 - i)', 'weighted_mean')}"
        f" from (select amt, row_number() over ({newest}) as i from txn) where i <= 5"
    )
    q["rolling_corr"] = hourly + (
        f"select {at('hour', 'hour')}, {r('c', 'rolling_corr')} from (select hour,"
        " corr(n, total) over (order by hour rows between 29 preceding and current row) as c,"
        " row_number() over (order by hour) as i from hourly) where i >= 30"
    )
    q["lag_difference"] = hourly + (
        f"select {at('hour', 'hour')}, {r('total - lag(total, 24) over (order by hour)', 'difference')}"
        " from hourly qualify lag(total, 24) over (order by hour) is not null"
    )
    q["interpolate_bfill"] = txn + f""", g as (
  select trans_num, case when category <> 'click' then amt end as v,
    row_number() over (order by trans_date_trans_time, trans_num) as i from txn),
n as (
  select *, last_value(v ignore nulls) over back as pv,
    last_value(case when v is not null then i end ignore nulls) over back as pi,
    first_value(v ignore nulls) over ahead as nv,
    first_value(case when v is not null then i end ignore nulls) over ahead as ni
  from g window back as (order by i rows between unbounded preceding and current row),
    ahead as (order by i rows between current row and unbounded following))
select trans_num, {r('case when v is not null then v when pv is null then nv when nv is null then pv'
                     ' else pv + (nv - pv) * (i - pi) / (ni - pi) end', 'amt_gaps')} from n"""

    # Aggregations
    q["class_distribution"] = txn + (
        f"select {big('is_fraud', 'is_fraud')}, n, {r('n * 100.0::double / sum(n) over ()', 'pct')},"
        f" {r('max(n) over () / n::double', 'ratio_to_largest')} from (select is_fraud, count(*) as n from txn group by 1)"
    )
    q["fraud_rate_by"] = txn + " union all ".join(
        f"(select '{name}' as key, k as key_value, n, {r('rate', 'fraud_rate_pct')} from (select cast({key} as varchar) as k,"
        " count(*) as n, avg(is_fraud) * 100 as rate from txn group by 1) order by rate desc, n desc, k limit 15)"
        for name, key in (
            ("hour", "hour(trans_date_trans_time)"), ("dow", DAY), ("state", "state"), ("category", "category"),
        )
    )
    q["describe_numeric"] = txn + "\nunion all\n".join(
        [describe("", -1), describe("where is_fraud = 0", 0), describe("where is_fraud = 1", 1)]
    )
    q["describe_categorical"] = txn + " union all ".join(
        f"select '{c}' as \"column\", {big('sum(n)', 'n')}, count(*) as n_unique,"
        f" first(v order by n desc, v) as top, first(n order by n desc, v) as freq"
        f" from (select {c} as v, count(*) as n from txn group by 1)"
        for c in ("merchant", "category", "gender", "job", "state", "city")
    )
    q["histogram_by_class"] = txn + f"""select {big('is_fraud', 'is_fraud')}, {big('bin', 'bin')}, n,
  {r('lo + bin * w', 'bin_start')}, {r('n / (sum(n) over (partition by is_fraud) * w)', 'density')},
  {r('sum(s) over (partition by is_fraud) / sum(n) over (partition by is_fraud)', 'class_mean')}
from (select is_fraud, least(floor((amt - lo) / w), 49) as bin, lo, w, count(*) as n, sum(amt) as s
  from txn cross join (select min(amt) as lo, (max(amt) - min(amt)) / 50 as w from txn) group by all)"""
    q["period_counts"] = txn + f"""select cast(d as varchar) as period, n, {r(moving('d', 'n', 30), 'moving_avg')}, 'day' as unit
from (select cast(g.d as date) as d, count(trans_num) as n
  from (select unnest(generate_series((select min(trans_date_trans_time)::date from txn)::timestamp,
      (select max(trans_date_trans_time)::date from txn)::timestamp, interval 1 day)) as d) g
  left join txn on cast(trans_date_trans_time as date) = cast(g.d as date) group by 1)
union all
select cast(cast(date_trunc('month', trans_date_trans_time) as date) as varchar), count(*), null, 'month' from txn group by 1
union all
select cast(cast(date_trunc('year', trans_date_trans_time) as date) as varchar), count(*), null, 'year' from txn group by 1"""
    q["series_overview"] = txn + """select n, n_null, first_time, last_time, cast(floor(d / 365) as bigint) as years,
  cast(floor(d % 365 / 30) as bigint) as months, cast(d % 365 % 30 as bigint) as days
from (select count(*) as n, count(*) - count(amt) as n_null, strftime(min(trans_date_trans_time), '%Y-%m-%d %H:%M:%S.%f') as first_time,
  strftime(max(trans_date_trans_time), '%Y-%m-%d %H:%M:%S.%f') as last_time,
  cast(floor((epoch_us(max(trans_date_trans_time)) - epoch_us(min(trans_date_trans_time))) / 86400000000) as bigint) as d from txn)"""
    benford = r("case when digit > 0 then log10(1 + 1.0::double / digit) * 100 end", "pct_benford")
    q["digit_distribution"] = rowf + (
        f"select *, {benford}, 'first' as which from ({digits('first_digit')}) union all "
        f"select *, cast(null as double) as pct_benford, 'last' as which from ({digits('last_digit')})"
    )
    q["row_normalised_crosstab"] = hist + " union all ".join(
        f"select {big(flag, 'flag')}, count(*) as n,"
        f" {r('count(*) filter (where is_fraud = 0) * 100.0::double / count(*)', 'pct_legit')},"
        f" {r('count(*) filter (where is_fraud = 1) * 100.0::double / count(*)', 'pct_fraud')}, '{flag}' as which"
        f" from hist group by {flag}"
        for flag in ("impossible_velocity", "amt_is_outlier")
    )
    correlated = [*NUMERIC, "distance_km", "hour_of_day", "day_of_week", "is_fraud"]
    q["correlation_matrix"] = rowf + " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, "
        + (r(f"corr({a}, {b})", "corr") if a != b else "1.0::double as corr") + " from rowf"
        + (" limit 1" if a == b else "")
        for a in correlated for b in correlated
    ).replace(" from rowf limit 1", "")
    q["target_correlations"] = rowf + " union all ".join(
        f"select '{c}' as \"column\", {r(f'corr({c}, is_fraud)', 'corr')} from rowf"
        for c in [*NUMERIC, "distance_km", "hour_of_day"]
    )
    q["spearman_corr"] = txn + (
        f"select {r('corr(rx, ry)', 'spearman')} from (select"
        " rank() over (order by amt) + (count(*) over (partition by amt) - 1) / 2.0::double as rx,"
        " rank() over (order by city_pop) + (count(*) over (partition by city_pop) - 1) / 2.0::double as ry from txn)"
    )
    q["kendall_tau_b"] = rowf + f""", cells as (
  select hour_of_day as x, first_digit as y, count(*)::double as n from rowf group by 1, 2),
pairs as (select sum(a.n * b.n * sign(a.x - b.x) * sign(a.y - b.y)) / 2 as s from cells a cross join cells b),
sizes as (select sum(n) as n from cells),
tx as (select sum(n * (n - 1) / 2) as t from (select sum(n) as n from cells group by x)),
ty as (select sum(n * (n - 1) / 2) as t from (select sum(n) as n from cells group by y))
select {r('s / sqrt((n * (n - 1) / 2 - tx.t) * (n * (n - 1) / 2 - ty.t))', 'kendall_tau_b')}
from pairs cross join sizes cross join tx cross join ty"""
    q["lagged_corr"] = hourly + (
        f"select {big('s', 'shift')}, {r('c', 'corr')},"
        f" {big('case when row_number() over (order by abs(c) desc, s) = 1 then 1 else 0 end', 'is_best')} from ("
        + " union all ".join(
            f"select {-k} as s, corr(n, y) as c from (select n, lead(total, {k}) over (order by hour) as y from hourly)"
            for k in range(13)
        ) + ")"
    )
    q["autocorrelation"] = hourly + """, g as (
  select hour, n - (select avg(n) from hourly) as d, count(*) over () as size from hourly),
lags as (""" + " union all ".join(
        f"select {k} as lag, sum(d * e) / sum(d * d) as a, max(size) as size"
        f" from (select d, size, lead(d, {k}) over (order by hour) as e from g)"
        for k in range(1, 41)
    ) + """),
bounds as (
  select lag, a, 1.959963984540054::double * sqrt((1 + 2 * coalesce(sum(a * a) over (order by lag rows between
    unbounded preceding and 1 preceding), 0)) / size) as h from lags)
select cast(lag as bigint) as lag, round(a + 1e-9, 6) as acf, round(a - h + 1e-9, 6) as lower, round(a + h + 1e-9, 6) as upper from bounds"""
    q["kpss_test"] = hourly + """, e as (
  select row_number() over (order by hour) as i, total - (select avg(total) from hourly) as e from hourly),
products as (
  select b.i - a.i as k, sum(a.e * b.e) as c from e a join e b on b.i >= a.i group by 1),
size as (select count(*) as n, cast(floor(pow(count(*), 2 / 9e0)) as int) as m from e),
bands as (
  select n, sum(case when k = 0 then c else 2 * c end) / n as s0, 2 * sum(k * c) / n as s1
  from products, size where k <= m group by n),
width as (
  select n, least(cast(floor(1.1447e0 * pow(pow(s1 / s0, 2), 1 / 3e0) * pow(n, 1 / 3e0)) as bigint), n - 1) as lags from bands),
spread as (
  select n, lags, sum(case when k = 0 then c else 2 * c * (1 - k / (lags + 1e0)) end) / n as v
  from products, width where k <= lags group by n, lags),
found as (
  select lags, (select sum(s * s) from (select sum(e) over (order by i) as s from e)) / n / n / v as x from spread),
p as (
  select lags, x, case when x <= 0.347 then 0.1 when x <= 0.463 then 0.1 - 0.05 * (x - 0.347) / 0.116
    when x <= 0.574 then 0.05 - 0.025 * (x - 0.463) / 0.111 when x <= 0.739 then 0.025 - 0.015 * (x - 0.574) / 0.165
    else 0.01 end::double as p from found)
""" + (
        f"select {r('x', 'statistic')}, {r('p', 'p_value')}, cast(lags as bigint) as used_lags, 0.347::double as critical_10,"
        " 0.463::double as critical_5, 0.574::double as critical_2_5, 0.739::double as critical_1,"
        " cast(p >= 0.05 as bigint) as is_stationary from p"
    )
    q["linear_trend"] = hourly + (
        f"select {r('regr_slope(total, x)', 'slope')}, {r('regr_intercept(total, x)', 'intercept')}"
        " from (select total, row_number() over (order by hour) - 1 as x from hourly)"
    )
    numeric_mi = " union all ".join(
        f"select '{c}' as feature, sum(n / total * ln(n * total / (cn * yn))) as mi from (select n,"
        " sum(n) over () as total, sum(n) over (partition by cell) as cn, sum(n) over (partition by y) as yn"
        f" from (select is_fraud as y, len(list_filter(e, lambda q: q < {c}::double)) as cell, count(*)::double as n"
        f" from rowf cross join (select quantile_cont({c}::double, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) as e from rowf)"
        " group by 1, 2))"
        for c in [*NUMERIC, "distance_km"]
    )

    def term(n: str, a: str, b: str) -> str:
        return f"case when {n} > 0 then {n} / t * ln({n} * t / ({a} * {b})) else 0 end"

    category_mi = " union all ".join(
        f"select '{c}' as feature, avg({term('p', 'n', 'tp')} + {term('(n - p)', 'n', '(t - tp)')} +"
        f" {term('(tp - p)', '(t - n)', 'tp')} + {term('(t - n - tp + p)', '(t - n)', '(t - tp)')}) as mi"
        f" from (select count(*)::double as n, sum(is_fraud)::double as p from txn group by {c})"
        " cross join (select count(*)::double as t, sum(is_fraud)::double as tp from txn)"
        for c in ("gender", "category", "job")
    )
    q["mutual_information"] = rowf + f"select feature, {r('mi', 'mi')} from ({numeric_mi} union all {category_mi})"
    iqr = """, q as (select quantile_cont(amt, 0.25) as a, quantile_cont(amt, 0.75) as b from txn),
lim as (select a - (b - a) * 1.5::double as lo, b + (b - a) * 1.5::double as hi from q)
"""
    txn_iqr = with_(TXN).rstrip("\n") + iqr
    q["iqr_outliers"] = txn_iqr + (
        f"select {r('any_value(lo)', 'lower_limit', 4)}, {r('any_value(hi)', 'upper_limit', 4)},"
        " count(*) filter (where amt < lo or amt > hi) as n_outliers,"
        f" {r('count(*) filter (where amt < lo or amt > hi) * 100.0::double / count(*)', 'pct_outliers', 4)}"
        " from txn cross join lim"
    )
    q["iqr_cleaned_shape"] = txn_iqr.rstrip("\n") + f""", c as (select amt from txn cross join lim where amt between lo and hi),
m as (select avg(amt) as mu, var_pop(amt) as v from c)
select 'amt' as "column", count(*) as n, {r('avg(amt)', 'mean', 4)}, {r('stddev_samp(amt)', 'std', 4)},
  {r('min(amt)', 'min', 4)}, {r('max(amt)', 'max', 4)}, {r('quantile_cont(amt, 0.25)', 'q25', 4)},
  {r('quantile_cont(amt, 0.5)', 'q50', 4)}, {r('quantile_cont(amt, 0.75)', 'q75', 4)},
  {r('avg(pow(amt - mu, 3)) / pow(any_value(v), 1.5)', 'skewness', 4)}, {r('kurtosis_pop(amt)', 'kurtosis', 4)}
from c cross join m"""
    q["box_numbers"] = txn.rstrip("\n") + f""", b as (
  select is_fraud, quantile_cont(amt, 0.25) as a, quantile_cont(amt, 0.5) as m, quantile_cont(amt, 0.75) as z from txn group by 1)
select {big('is_fraud', 'is_fraud')}, {r('any_value(a)', 'q25', 4)}, {r('any_value(m)', 'q50', 4)}, {r('any_value(z)', 'q75', 4)},
  {r('min(amt) filter (where amt between a - (z - a) * 1.5 and z + (z - a) * 1.5)', 'whisker_low', 4)},
  {r('max(amt) filter (where amt between a - (z - a) * 1.5 and z + (z - a) * 1.5)', 'whisker_high', 4)},
  count(*) filter (where amt not between a - (z - a) * 1.5 and z + (z - a) * 1.5) as n_fliers
from txn join b using (is_fraud) group by is_fraud"""

    def shown(column: str, name: str) -> str:
        return (
            f"select category, {big('sum(n)', 'n')}, {r('sum(n) * 100.0::double / any_value(total)', 'pct')}, '{name}' as \"column\""
            " from (select case when v is null then 'Faltante' when k > 10 and i > 9 then 'Outros' else v end as category,"
            " n, total from (select v, n, sum(n) over () as total, count(v) over () as k,"
            " row_number() over (order by v is null, n desc, v) as i"
            f" from (select {column} as v, count(*) as n from txn group by 1))) group by category"
        )

    q["top_categories"] = txn + (
        shown("case when merchant <> 'merch_7' then merchant end", "merchant") + " union all " + shown("city", "city")
    )
    half = "1.959963984540054::double * stddev_samp(amt) / sqrt(count(amt))"
    q["mean_confidence_interval"] = txn + (
        f"select count(amt) as n, {r('avg(amt)', 'mean')}, {r('avg(amt) - ' + half, 'lower_bound')},"
        f" {r('avg(amt) + ' + half, 'upper_bound')} from txn"
    )
    q["mae_mape"] = txn + (
        f"select {r('avg(abs(a - p))', 'mae')}, {r('avg(abs(a - p) / abs(a)) * 100', 'mape')},"
        " count(*) filter (where a = 0) as n_zero_actual from (select amt + 1 as a, city_pop / 1e3 as p from txn)"
    )

    # Joins, splits, samples
    q["left_equi_join"] = txn + (
        f"select trans_num, {r('m', 'card_avg_amt')}, {r('s', 'card_stddev_amt')} from txn left join"
        " (select cc_num, avg(amt) as m, stddev_samp(amt) as s from txn group by 1) using (cc_num)"
    )
    numbered = "(select trans_num, row_number() over (order by trans_date_trans_time, trans_num) - 1 as i, count(*) over () as n from txn)"
    q["time_series_folds"] = txn + (
        "select trans_num, cast(greatest(0, 3 - (n - 1 - i) // (n // 4)) as bigint) as test_fold,"
        f" cast(greatest(0, 4 - (n - 1 - i) // (n // 8)) as bigint) as sized_fold from {numbered}"
    )
    q["block_folds"] = txn + (
        f"select trans_num, cast(least(4, i // cast(floor(n * 0.22::double) as bigint) + 1) as bigint) as test_block from {numbered}"
    )
    q["time_based_split"] = txn + (
        "select trans_num, case when i < cast(floor(n * (1 - 0.2::double)) as bigint) then 'train' else 'validation' end as part"
        f" from {numbered}"
    )
    digest = "md5(concat('42|', trans_num))"
    q["stratified_split"] = txn + (
        "select trans_num, case when i <= n - ceil(n * 0.2::double) then 'train' else 'test' end as part from (select trans_num,"
        f" row_number() over (partition by is_fraud order by {digest}, trans_num) as i,"
        " count(*) over (partition by is_fraud) as n from txn)"
    )
    q["exact_sample"] = txn + f"select trans_num from txn order by {digest}, trans_num limit 500"
    q["balance_data"] = txn + (
        f"select trans_num, {big('is_fraud', 'is_fraud')} from (select trans_num, is_fraud,"
        f" row_number() over (partition by is_fraud order by {digest}, trans_num) as i,"
        " sum(is_fraud) over () as p from txn where in_train) where is_fraud = 1 or i <= p * 10"
    )
    q["top_n"] = txn + f"select trans_num, {r('amt', 'amt')} from txn order by txn.amt desc, trans_num limit 25"
    q["union_all"] = txn + "select category, count(*) as n from txn group by 1"
    q["distinct_sorted"] = txn + (
        "select distinct cast(cast(trans_date_trans_time as date) as varchar) as day from txn"
        " where trans_date_trans_time >= timestamp '2024-01-10'"
    )

    # Encoders
    parted = with_(TXN, windows("cc_num, in_train"))
    imputed = ["avg_amt_expanding", "stddev_amt_expanding", "time_diff_hours"]
    q["median_impute"] = parted + "select trans_num, " + ", ".join(
        r(f"coalesce({c}, (select median({c}) from hist where in_train))", c) for c in imputed
    ) + " from hist"
    q["standard_scale"] = txn + "select trans_num, " + ", ".join(
        f"{r(c, c)}, {r(f'({c} - m_{c}) / s_{c}', c + '_scaled')}" for c in ("amt", "lat")
    ) + (
        " from txn cross join (select avg(amt) as m_amt, stddev_pop(amt) as s_amt, avg(lat) as m_lat,"
        " stddev_pop(lat) as s_lat from txn where in_train)"
    )
    unseen = {"merchant": "case when merchant <> 'merch_3' then merchant end"}
    encodings = ", ".join(r(f"coalesce(enc_{c}.e, prior.m)", f"{c}_target_enc") for c in ENCODED_COLUMNS)
    q["target_encode"] = with_(TXN, encoding_ctes("txn", unseen)) + (
        f"select trans_num, {encodings} from txn f cross join prior {encoding_joins()} where not in_train"
    )
    q["one_hot"] = txn + "select trans_num, " + ", ".join(
        big(f"case when {c} = '{v}' then 1 else 0 end", f"{c}_{v}")
        for c, values in (("gender", ["F", "M"]), ("category", ["error", "purchase", "signup", "view"]))
        for v in values
    ) + " from txn where not in_train"
    stats = ", ".join(f"median({c}) as med_{c}" for c in SCALED)
    scales = ", ".join(
        f"avg(coalesce({c}, med_{c})) as avg_{c}, stddev_pop(coalesce({c}, med_{c})) as std_{c}" for c in SCALED
    )
    scaled = ", ".join(
        r(f"(coalesce({c}, med_{c}) - avg_{c}) / case when std_{c} = 0 then 1 else std_{c} end", c, 4) for c in SCALED
    )
    passed = ", ".join(r(f"{c}::double", c, 4) for c in [*PASSED_FLOAT, *PASSED_INT])
    hot = ", ".join(f"case when gender = '{v}' then 1.0::double else 0.0::double end as gender_{v}" for v in "FM")
    q["encoded_matrix"] = with_(
        TXN, windows("cc_num, in_train"), rows_cte(), encoding_ctes("feat"),
        f"meds as (select {stats} from feat where in_train)",
        f"scales as (select {scales} from feat cross join meds where in_train)",
    ) + (
        f"select trans_num, {scaled}, {passed}, {hot}, {encodings.replace(' + 1e-9, 6)', ' + 1e-7, 4)')}"
        f" from feat f cross join meds cross join scales cross join prior {encoding_joins()}"
    )

    # Weights and evaluation
    q["class_weights"] = txn + f"""select {big('is_fraud', 'is_fraud')}, n, {r('sum(n) over () / (count(*) over () * n::double)', 'weight')},
  {r('sum(case when is_fraud = 0 then n end) over () / (sum(case when is_fraud = 1 then n end) over ())::double', 'neg_pos_ratio')}
from (select is_fraud, count(*) as n from txn where in_train group by 1)"""
    counts = (
        "(select count(*) filter (where label = 1 and score >= 0.5) as tp, count(*) filter (where label = 0 and score >= 0.5) as fp,"
        " count(*) filter (where label = 0 and score < 0.5) as tn, count(*) filter (where label = 1 and score < 0.5) as fn from scored)"
    )
    d = "::double"
    q["classification_metrics"] = scored + f"""select tp, fp, tn, fn,
  {r(f'(tp + tn){d} / (tp + fp + tn + fn)', 'accuracy')}, {r(f'coalesce(tp{d} / nullif(tp + fp, 0), 0)', 'precision')},
  {r(f'coalesce(tp{d} / nullif(tp + fn, 0), 0)', 'recall')}, {r(f'coalesce(2 * tp{d} / nullif(2 * tp + fp + fn, 0), 0)', 'f1')},
  {r(f'coalesce(fp{d} / nullif(fp + tn, 0), 0)', 'false_positive_rate')},
  {r(f'sqrt(coalesce(tp{d} / nullif(tp + fn, 0), 0) * coalesce(tn{d} / nullif(tn + fp, 0), 0))', 'g_mean')},
  {r(f'(tp + fn){d} / (tp + fp + tn + fn)', 'prevalence')} from {counts}"""
    ranked = with_(TXN, SCORED, POINTS)
    q["rank_curves"] = ranked + (
        f"select {r('score', 'score')}, {big('tp', 'tp')}, {big('fp', 'fp')}, {r(f'tp / p{d}', 'tpr')},"
        f" {r(f'fp / n{d}', 'fpr')}, {r(f'tp / (tp + fp){d}', 'precision')} from points"
    )
    q["rank_metrics"] = with_(TXN, SCORED, POINTS, """pts as (
  select 0 as tp, 0 as fp, 0 as pos, 0 as neg, max(p)::double as p, max(n)::double as n, 2.0::double as score from points
  union all select tp, fp, pos, neg, p::double, n::double, score from points),
seq as (
  select *, lag(tp) over (order by score desc) as tp0, lag(fp) over (order by score desc) as fp0,
    coalesce(tp / nullif(tp + fp, 0)::double, 1) as pr from pts),
steps as (select *, lag(pr) over (order by score desc) as pr0 from seq),
below as (select fp / n as x, tp / p as y from pts where fp / n <= 0.001::double order by fp desc, tp desc limit 1),
above as (select fp / n as x, tp / p as y from pts where fp / n > 0.001::double order by fp, tp limit 1)""") + f"""select
  {r('sum((fp - fp0) / n * (tp + tp0) / p / 2)', 'roc_auc')}, {r('sum((tp - tp0) / p * (pr + pr0) / 2)', 'pr_auc')},
  {r('sum((tp - tp0) / p * pr)', 'average_precision')},
  {r('(select b.y + (a.y - b.y) * (0.001::double - b.x) / (a.x - b.x) from below b cross join above a)', 'recall_at_fpr')}
from steps"""
    grid = ", ".join(f"{t!r}::double" for t in threshold_grid())
    curve = f"""curve as (
  select t, sum(case when label = 1 and score < t then amt else 0 end)
    + 5.0::double * count(*) filter (where label = 0 and score >= t) as cost
  from scored cross join (select unnest([{grid}]) as t) group by t)"""
    costed = with_(TXN, SCORED, curve)
    q["cost_curve"] = costed + f"select {r('t', 'threshold', 4)}, {r('cost', 'cost', 4)} from curve"
    q["cost_threshold"] = costed + f"""select {r('t', 'optimal_threshold', 4)}, {r('cost', 'optimal_cost', 4)},
  {r('base', 'default_threshold_cost', 4)}, {r('base - cost', 'estimated_savings', 4)}
from curve cross join (select sum(case when label = 1 and score < 0.5 then amt else 0 end)
  + 5.0::double * count(*) filter (where label = 0 and score >= 0.5) as base from scored)
order by cost, t limit 1"""
    q["cost_scenarios"] = scored + """select cast(w as bigint) as fn_weight, first(t order by cost, t)::double as best_threshold,
  cast(min(cost) as bigint) as best_cost
from (select w, t, count(*) filter (where label = 1 and score < t) * w + count(*) filter (where label = 0 and score >= t) as cost
  from scored cross join (select unnest([0.1, 0.3, 0.5, 0.7, 0.9])::double as t) cross join (select unnest([10, 50, 100]) as w)
  group by w, t) group by w"""
    return q
