import math
import random

import numpy as np
import pytest

from swipelens.operators import profiles as P
from swipelens.operators import quality as Q


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(6), rng.randrange(5), round(rng.gauss(0, 1), 3), int(rng.random() < 0.3)) for _ in range(400)]
    rows = [(x, min(4, y + x // 3), z + x, k) for x, y, z, k in rows]
    return spark.createDataFrame(rows, "x INT, y INT, z DOUBLE, is_fraud INT").repartition(4), rows


def ranks(values):
    order = np.sort(values)
    return np.array([(np.searchsorted(order, v, "left") + np.searchsorted(order, v, "right") + 1) / 2 for v in values])


def test_rank_correlations(pairs):
    df, rows = pairs
    x, y, z, _ = (np.array(c, dtype=float) for c in zip(*rows))
    assert P.spearman(df, "x", "z").first()[0] == pytest.approx(np.corrcoef(ranks(x), ranks(z))[0, 1])
    dx, dy = (np.sign(np.subtract.outer(v, v)) for v in (x, y))
    tau = (dx * dy).sum() / math.sqrt((dx * dx).sum() * (dy * dy).sum())
    assert P.kendall_tau_b(df, "x", "y").first()[0] == pytest.approx(tau)


def test_kendall_with_many_levels_ties_and_missing(spark):
    rng = random.Random(6)
    rows = [(rng.gauss(0, 1), rng.randrange(900)) for _ in range(1500)]
    rows = [(x, y + int(200 * x)) for x, y in rows] + rows[:80]
    x, y = (np.array(c, dtype=float) for c in zip(*rows))
    dx, dy = (np.sign(np.subtract.outer(v, v)) for v in (x, y))
    tau = (dx * dy).sum() / math.sqrt((dx * dx).sum() * (dy * dy).sum())
    df = spark.createDataFrame([*rows, (None, 3), (1.0, None)], "x DOUBLE, y INT")
    assert df.select("y").distinct().count() > 500
    assert P.kendall_tau_b(df, "x", "y").first()[0] == pytest.approx(tau)
    assert P.kendall_tau_b(df.where("y = 3"), "x", "y").first()[0] is None
    assert P.kendall_tau_b(df.limit(0), "x", "y").first()[0] is None


def test_correlations_with_missing_values(spark):
    rows = [(float(i), float(i * i), None if i % 4 == 0 else float(-i), 7.0) for i in range(20)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, k DOUBLE")
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in P.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    assert len(got) == 16 and got[("a", "c")] == pytest.approx(-1.0) and got[("c", "a")] == got[("a", "c")]
    assert got[("a", "b")] == pytest.approx(np.corrcoef(*[[r[i] for r in rows] for i in (0, 1)])[0, 1])
    assert got[("a", "k")] is None and got[("k", "k")] is None and got[("a", "a")] == 1.0
    # b is dropped for c, a for b.
    assert P.drop_collinear(df, ["a", "b", "c", "k"]) == ["c", "k"]


def test_collinear_scan_order(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=200)
    noise = rng.normal(size=200)
    cols = {"a": a, "b": a + 0.3 * noise, "c": a + 0.6 * noise, "d": noise}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values())], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    corr = np.abs(np.corrcoef(list(cols.values())))
    dropped = set()
    for j in range(4):
        if j not in dropped:
            dropped |= {i for i in range(j) if corr[i, j] >= 0.9}
    assert P.drop_collinear(df, list("abcd")) == [c for i, c in enumerate("abcd") if i not in dropped]


def test_information(pairs):
    df, rows = pairs

    def mi(cells, labels):
        n = len(cells)
        total = 0.0
        for c in set(cells):
            for k in set(labels):
                p = sum(1 for a, b in zip(cells, labels) if (a, b) == (c, k)) / n
                if p:
                    total += p * math.log(p / (cells.count(c) / n * (labels.count(k) / n)))
        return total

    labels = [r[3] for r in rows]
    z = [r[2] for r in rows]
    edges = np.quantile(z, [i / 10 for i in range(1, 10)])
    want = {
        "z": mi([int((v > edges).sum()) for v in z], labels),
        "x": np.mean([mi([int(r[0] == v) for r in rows], labels) for v in {r[0] for r in rows}]),
    }
    got = {r["feature"]: r["mi"] for r in P.mutual_information(df, ["z"], ["x"]).collect()}
    assert got == pytest.approx(want)


def test_constant_columns(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x DOUBLE")
    assert [r["s"] for r in P.min_max_scale(df, "x", "s").collect()] == [0.0, 0.0]
    assert [r["s"] for r in P.z_scale(df, "x", "s").collect()] == [None, None]
    ci = P.mean_confidence_interval(df, "x").first()
    assert (ci["lower_bound"], ci["upper_bound"]) == (2.0, 2.0)
    assert P.mean_confidence_interval(df.limit(1), "x").first()["lower_bound"] is None
    assert P.iqr_summary(df, "x").first()["n_outliers"] == 0
    assert P.histogram_by_class(df.selectExpr("x", "0 as is_fraud"), "x").first()["n"] == 2


def test_mape_reports_zeros(spark):
    df = spark.createDataFrame([(2.0, 1.0), (0.0, 1.0)], "a DOUBLE, p DOUBLE")
    got = P.mae_mape(df, "a", "p").first()
    assert (got["mae"], got["mape"], got["n_zero_actual"]) == (1.0, None, 1)
    assert P.mae_mape(df.where("a > 0"), "a", "p").first()["mape"] == 50.0


@pytest.mark.parametrize("distinct", [10, 11])
def test_top_categories(spark, distinct):
    rows = [(f"c{i:02d}",) for i in range(distinct) for _ in range(distinct - i)] + [(None,)] * 3
    got = [(r["category"], r["n"]) for r in P.top_categories(spark.createDataFrame(rows, "c STRING"), "c").collect()]
    assert dict(got)["Faltante"] == 3 and sum(n for _, n in got) == len(rows)
    assert dict(got).get("Outros") == (None if distinct == 10 else 2 + 1)
    assert len(got) == 11


def test_describe_categorical_breaks_ties_by_name(spark):
    got = P.describe_categorical(spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c STRING"), ["c"]).first()
    assert (got["n"], got["n_unique"], got["top"], got["freq"]) == (4, 2, "a", 2)


def test_string_rules(spark):
    df = spark.createDataFrame([("123",), ("12",), ("1x3",), (None,), ("",)], "s STRING")
    assert tuple(Q.string_violations(df, "s", 3, True).first()) == (2, 2)
    assert tuple(Q.string_violations(df, "s").first()) == (0, 0)


def test_duplicates_and_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None)], "x INT, s STRING")
    assert tuple(Q.duplicate_rows(df).first()) == (4, 2, 2, 50.0)
    assert tuple(Q.duplicate_rows(df.limit(0)).first()) == (0, 2, 0, None)
    for approximate in (False, True):
        got = {r["column"]: tuple(r)[1:] for r in Q.column_profile(df, approximate).collect()}
        assert got == {"x": ("int", 0, 0.0, 2), "s": ("string", 1, 25.0, 1)}


def test_required_columns(spark):
    df = spark.createDataFrame([(1, None)], "x INT, y INT")
    got = {r["check"]: r["passed"] for r in Q.required_columns(df, ["x", "z"], ["x", "y"], 1).collect()}
    assert got == {"present:x": True, "present:z": False, "not_null:x": True, "not_null:y": False, "row_count": True}


def test_date_filter_reaches_the_files(spark):
    from swipelens.config import TIME

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumnRenamed("ts", TIME)
    plan = Q.from_date(events, TIME, "2024-01-20")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual" in plan
