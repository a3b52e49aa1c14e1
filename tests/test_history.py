import random

import pytest
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.operators import history as H
from swipelens.plans.features import feature_engineering, history_features, leak_probe

LAYOUTS = [
    {},
    {"dense_rows": 0},
    {"dense_rows": 0, "hot_rows": 0},
    {"dense_rows": 0, "hot_rows": 0, "period": "7h"},
]
CHECKED = [*H.SPREAD, *H.RECENT, "amt_zscore_expanding", "amt_is_outlier", "time_diff_hours"]


def by_id(df, columns=CHECKED):
    return {r["trans_num"]: tuple(r[c] for c in columns) for r in df.select("trans_num", *columns).collect()}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_future_does_not_reach_the_past(card, layout):
    def history(last):
        return by_id(history_features(card([
            ("2021-06-10 21:15:00", 42.5), ("2021-06-11 21:15:00", 8.25),
            ("2021-06-11 23:45:00", 17.0), ("2021-06-13 04:00:00", last),
        ]), **layout))

    base, altered = history(3.75), history(1e7)
    earlier = ["txn_0", "txn_1", "txn_2"]
    assert [base[k] for k in earlier] == [altered[k] for k in earlier]
    assert base["txn_3"] != altered["txn_3"]
    mean, std, count, total, z, _, gap = base["txn_0"]
    assert (mean, std, z, count, total, gap) == (None, None, 0.0, 0.0, 0.0, None)
    # Exactly 24 hours back still counts; 26.5 hours back does not.
    assert base["txn_1"][:4] == (42.5, None, 1.0, 42.5)
    assert base["txn_2"][2:4] == (1.0, 8.25)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_same_instant_and_window_edges(card, layout):
    rows = by_id(history_features(card([
        ("2020-01-01 08:00:00", 10.0), ("2020-01-01 08:00:00", 20.0),
        ("2020-01-02 08:00:00", 5.0), ("2020-01-02 08:00:00.000001", 7.0),
    ]), **layout))
    # The row order sees the other row of the instant; the time window does not.
    assert rows["txn_1"][:4] == (10.0, None, 0.0, 0.0) and rows["txn_1"][6] == 0.0
    assert rows["txn_2"][2:4] == (2.0, 30.0)
    assert rows["txn_3"][2:4] == (1.0, 5.0)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_constant_and_missing_amounts(card, layout):
    rows = by_id(history_features(card(
        [(f"2020-01-0{d} 08:00:00", 0.1) for d in range(1, 7)] + [("2020-01-07 08:00:00", None), ("2020-01-07 09:00:00", 0.3)]
    ), **layout))
    assert [rows[f"txn_{i}"][1] for i in range(2, 6)] == [0.0] * 4
    assert all(rows[f"txn_{i}"][4] == 0.0 for i in range(6))
    # A missing amount is a row for the clock, but not for counts and sums.
    assert rows["txn_7"][2:4] == (0.0, 0.0) and rows["txn_7"][6] == 1.0


def test_speed_needs_time_and_missing_is_no_flag(card):
    rows = history_features(card([
        ("2020-01-01 08:00:00", 1.0), ("2020-01-01 08:00:00", 1.0), ("2020-01-01 08:00:01", 1.0),
    ])).orderBy("trans_num").collect()
    assert [r["transaction_velocity_kmh"] is None for r in rows] == [True, True, False]
    assert [r["impossible_velocity"] for r in rows] == [0, 0, 1]


def test_layouts_agree_with_brute_force(spark, card):
    rng = random.Random(7)
    rows = []
    for _ in range(400):
        # One card holds most rows, on few instants, so that ties are common.
        which = "hot" if rng.random() < 0.7 else str(rng.randrange(6))
        rows.append((f"2020-01-0{rng.randrange(1, 9)} {rng.randrange(24):02d}:{rng.choice(['00', '30'])}:00", round(rng.random() * 50, 2), which))
    df = card(rows)
    expected = {}
    order = sorted(range(400), key=lambda i: (rows[i][0], f"txn_{i}"))
    import datetime as dt

    for place, i in enumerate(order):
        now = dt.datetime.fromisoformat(rows[i][0])
        past = [rows[j] for j in order[:place] if rows[j][2] == rows[i][2]]
        near = [a for t, a, _ in past if now - dt.timedelta(hours=24) <= dt.datetime.fromisoformat(t) < now]
        amounts = [a for _, a, _ in past]
        mean = sum(amounts) / len(amounts) if amounts else None
        std = (sum((a - mean) ** 2 for a in amounts) / (len(amounts) - 1)) ** 0.5 if len(amounts) > 1 else None
        expected[f"txn_{i}"] = (mean, std, float(len(near)), float(sum(near)))
    for layout in [*LAYOUTS, {"dense_rows": 0, "hot_rows": 50, "period": "3h"}]:
        got = by_id(H.card_windows(df, **layout), [*H.SPREAD, *H.RECENT])
        assert got.keys() == expected.keys()
        for k, want in expected.items():
            for a, b in zip(got[k], want):
                assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=1e-8)), (layout, k)


def trailing(spark, amounts, **layout):
    """Rows of one card, an hour apart, and of a small card beside it."""
    import datetime as dt

    start = dt.datetime(2022, 3, 1)
    rows = [(f"r{i:06d}", "big", start + dt.timedelta(hours=i * 24 / 28), a) for i, a in enumerate(amounts)]
    rows += [(f"s{i}", "small", start + dt.timedelta(hours=7 * i), 0.1 * i) for i in range(9)]
    df = spark.createDataFrame(rows, f"trans_num STRING, {C.KEY} STRING, {C.TIME} TIMESTAMP, {C.AMOUNT} DOUBLE")
    df = df.withColumns({"lat": F.lit(1.0), "long": F.lit(2.0)})
    return by_id(H.card_windows(df, **layout), H.RECENT)


@pytest.mark.parametrize("layout", [{"dense_rows": 20}, {"dense_rows": 20, "hot_rows": 10, "period": "5h"}])
def test_a_large_amount_leaves_the_window_without_a_trace(spark, layout):
    amounts = [0.1 * (1 + i % 7) for i in range(120)]
    amounts[3] = 1e12
    assert trailing(spark, amounts, **layout) == trailing(spark, amounts)


def test_many_amounts_sum_alike_in_both_layouts(spark):
    rng = random.Random(11)
    amounts = [round(rng.random() * 900, 2) for _ in range(20_000)]
    assert trailing(spark, amounts, dense_rows=100, hot_rows=5_000) == trailing(spark, amounts)


def test_feature_table_keeps_rows_and_columns(txn):
    found = feature_engineering(txn)
    assert found.count() == txn.count()
    assert not set(C.FEATURE_COLUMNS) - set(found.columns)
    always = ["distance_km", "first_digit", "last_digit", "amt_log", "city_pop_log", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month"]
    nulls = found.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in always]).first()
    assert all(nulls[c] == 0 for c in always)
    assert found.where("avg_amt_expanding is not null").count() > 0


@pytest.mark.parametrize("layout", [LAYOUTS[0], LAYOUTS[3]])
def test_no_leak_on_the_whole_table(txn, layout):
    assert leak_probe(txn, "2024-01-15", **layout).count() == 0


def test_history_seeds_the_test_rows(txn):
    early = txn.where(F.col(C.TIME) < F.lit("2024-01-22").cast("timestamp_ntz"))
    late = txn.where(F.col(C.TIME) >= F.lit("2024-01-22").cast("timestamp_ntz"))
    whole = by_id(feature_engineering(txn), H.SPREAD)
    seeded = by_id(feature_engineering(late, history=early), H.SPREAD)
    assert seeded == {k: whole[k] for k in seeded} and len(seeded) == late.count()


def test_one_shuffle_serves_all_windows(txn):
    plan = feature_engineering(txn)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Sort [") == 1
