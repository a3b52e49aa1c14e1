import random

import numpy as np
import pytest

from swipelens.operators import metrics as M


def table(spark, rows):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "trans_num STRING, label INT, score DOUBLE, amt DOUBLE")


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(500):
        label = int(rng.random() < 0.2)
        # Two digits, so that scores tie.
        rows.append((label, round(min(1.0, max(0.0, rng.gauss(0.35 + 0.25 * label, 0.2))), 2), round(rng.random() * 90, 2)))
    return table(spark, rows).repartition(6), rows


def curve(rows):
    points = [(0.0, 0.0, 1.0)]
    p = sum(r[0] for r in rows)
    for s in sorted({r[1] for r in rows}, reverse=True):
        tp = sum(r[0] for r in rows if r[1] >= s)
        fp = sum(1 - r[0] for r in rows if r[1] >= s)
        points.append((fp / (len(rows) - p), tp / p, tp / (tp + fp)))
    return np.array(points)


def test_rank_metrics_against_brute_force(scored):
    df, rows = scored
    c = curve(rows)
    for target in (0.0, 0.001, 0.05, 0.3):
        got = M.rank_metrics(df, target).first()
        assert got["recall_at_fpr"] == pytest.approx(np.interp(target, c[:, 0], c[:, 1]))
    assert got["roc_auc"] == pytest.approx(np.trapezoid(c[:, 1], c[:, 0]))
    assert got["pr_auc"] == pytest.approx(np.trapezoid(c[:, 2], c[:, 1]))
    assert got["average_precision"] == pytest.approx((np.diff(c[:, 1]) * c[1:, 2]).sum())
    # The tie-corrected rank statistic is the same area.
    pos, neg = ([s for y, s, _ in rows if y == k] for k in (1, 0))
    pairs = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert got["roc_auc"] == pytest.approx(pairs)


def test_all_scores_tied_and_no_positives(spark):
    tied = M.rank_metrics(table(spark, [(1, 0.4, 1.0), (0, 0.4, 1.0), (0, 0.4, 1.0), (0, 0.4, 1.0)])).first()
    assert tied["roc_auc"] == 0.5 and tied["average_precision"] == 0.25 and tied["pr_auc"] == 0.625
    none = table(spark, [(0, 0.4, 1.0), (0, 0.9, 1.0)])
    assert M.rank_metrics(none).first()["roc_auc"] is None
    counts = M.classification_metrics(none).first()
    assert (counts["precision"], counts["recall"], counts["f1"], counts["fp"]) == (0.0, 0.0, 0.0, 1)


def test_confusion_identities(scored):
    df, rows = scored
    for t in (0.0, 0.5, 1.1):
        m = M.classification_metrics(df, t).first()
        assert m["tp"] + m["fp"] + m["tn"] + m["fn"] == len(rows)
        assert m["accuracy"] == pytest.approx(np.mean([(s >= t) == (y == 1) for y, s, _ in rows]))


def test_published_counts_give_published_rates(spark):
    # Confusion counts and rates of two published models.
    published = [(1825, 19927, 533647, 320, 0.9636, 0.0839, 0.8508, 0.1527), (588, 341, 553233, 1557, 0.9966, 0.6329, 0.2741, 0.3826)]
    counts = spark.createDataFrame([p[:4] for p in published], "tp BIGINT, fp BIGINT, tn BIGINT, fn BIGINT")
    for got, want in zip(M.with_rates(counts).collect(), published):
        assert [round(got[c], 4) for c in ("accuracy", "precision", "recall", "f1")] == list(want[4:])


def cost(rows, t, fee):
    return sum(a for y, s, a in rows if y == 1 and s < t) + fee * sum(1 for y, s, _ in rows if y == 0 and s >= t)


@pytest.mark.parametrize("fee", [5.0, 0.5])
def test_cost_threshold_against_brute_force(scored, fee):
    df, rows = scored
    grid = M.threshold_grid()
    costs = [cost(rows, t, fee) for t in grid]
    got = {r["threshold"]: r["cost"] for r in M.cost_curve(df, fee).collect()}
    assert [got[t] for t in grid] == pytest.approx(costs)
    best = M.cost_threshold(df, fee).first()
    assert best["optimal_threshold"] == grid[int(np.argmin(np.round(costs, 6)))]
    assert best["estimated_savings"] == pytest.approx(cost(rows, 0.5, fee) - min(costs))


def test_own_thresholds(scored):
    df, rows = scored
    best = M.cost_threshold(df, 5.0, [0.9, 0.2]).first()
    assert best["optimal_cost"] == pytest.approx(min(cost(rows, t, 5.0) for t in (0.9, 0.2)))
    assert best["default_threshold_cost"] == pytest.approx(cost(rows, 0.5, 5.0))


def test_scenarios_and_reports(spark):
    results = spark.createDataFrame([("a", 5, 0, 0.5), ("b", 1, 60, 0.7)], "model STRING, fn INT, fp INT, f1 DOUBLE")
    got = {r["fn_weight"]: r["best_model"] for r in M.cost_scenarios(results, "model").collect()}
    assert got == {10: "a", 50: "b", 100: "b"}
    assert M.best_by(results, "f1").first()["model"] == "b"
    folds = spark.createDataFrame([("a", 0.2), ("a", 0.4), ("b", 0.9)], "model STRING, f1 DOUBLE")
    assert [(r["model"], round(r["f1"], 6)) for r in M.fold_means(folds, ["f1"]).collect()] == [("b", 0.9), ("a", 0.3)]
    table = M.importance_table(spark, ["x", "y", "z"], [1.0, 3.0, 0.0], top=2).collect()
    assert [(r["feature"], r["pct"]) for r in table] == [("y", 75.0), ("x", 25.0)]
