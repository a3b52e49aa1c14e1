import itertools
import math
import time
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from swipelens.operators import boosting as B
from swipelens.operators import explain as X
from swipelens.operators import training as G
from swipelens.session import new_path

UNIT = 2 ** 20


def unit(x):
    return int(np.rint(x * UNIT))


def brute(rows, labels, edges, p, weights=(1.0, 1.0)):
    """Trees by trying every edge of every open leaf on the values themselves."""
    weight = [weights[y] for y in labels]
    share = sum(unit(w) for w, y in zip(weight, labels) if y) / sum(map(unit, weight))
    margin = [math.log(share / (1 - share))] * len(rows)
    trees = []

    def soft(g):
        return math.copysign(max(abs(g) - p.regAlpha, 0.0), g)

    def score(g, h):
        return soft(g) ** 2 / max(h + p.regLambda, 1e-15)

    for _ in range(p.maxIter):
        prob = 1 / (1 + np.exp(-np.array(margin)))
        g = [unit(w * (q - y)) for w, q, y in zip(weight, prob, labels)]
        h = [unit(w * q * (1 - q)) for w, q in zip(weight, prob)]

        def best(ids, depth):
            found = (0.0,)
            if p.maxDepth and depth >= p.maxDepth:
                return found
            whole = sum(g[i] for i in ids), sum(h[i] for i in ids)
            for f, cuts in enumerate(edges):
                for b, edge in enumerate(cuts):
                    left = [i for i in ids if rows[i][f] <= edge]
                    if min(len(left), len(ids) - len(left)) < max(1, p.minInstancesPerNode):
                        continue
                    gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                    if min(hl, whole[1] - hl) < p.minHessian * UNIT:
                        continue
                    gain = score(gl / UNIT, hl / UNIT) + score((whole[0] - gl) / UNIT, (whole[1] - hl) / UNIT)
                    gain -= score(whole[0] / UNIT, whole[1] / UNIT)
                    if gain > max(found[0], p.minGain, 1e-12):
                        found = (gain, f, b, left)
            return found

        leaves = [(list(range(len(rows))), 0, best(range(len(rows)), 0))]
        splits = []
        while len(leaves) < p.numLeaves:
            at = max(range(len(leaves)), key=lambda i: leaves[i][2][0])
            ids, depth, found = leaves[at]
            if not found[0]:
                break
            left = set(found[3])
            parts = [[i for i in ids if i in left], [i for i in ids if i not in left]]
            splits.append((found[1], found[2], len(ids)))
            leaves[at:at + 1] = [(part, depth + 1, best(part, depth + 1)) for part in parts]
        for ids, _, _ in leaves:
            value = -p.stepSize * soft(sum(g[i] for i in ids) / UNIT) / max(sum(h[i] for i in ids) / UNIT + p.regLambda, 1e-15)
            for i in ids:
                margin[i] += value
        trees.append(sorted(splits))
    return trees, margin


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(5)
    values = np.round(np.column_stack([rng.normal(size=160), rng.integers(0, 3, 160), rng.exponential(size=160), np.ones(160)]), 2)
    labels = ((values[:, 0] + values[:, 1] * values[:, 2] + rng.normal(size=160)) > 1.5).astype(int).tolist()
    rows = [(v.tolist(), y) for v, y in zip(values, labels)]
    df = spark.createDataFrame(rows, "v ARRAY<DOUBLE>, is_fraud INT").select(array_to_vector("v").alias("features"), "is_fraud")
    return df.cache(), values.tolist(), labels


def splits_of(model):
    inner = model.nodes[model.nodes["feature"] >= 0]
    return [
        sorted(zip(part["feature"], part["bin"], part["rows"]))
        for _, part in ((t, inner[inner["tree"] == t]) for t in range(model.settings.maxIter))
    ]


@pytest.mark.parametrize("params", [
    {"numLeaves": 6, "minInstancesPerNode": 5},
    {"maxDepth": 3, "minInstancesPerNode": 1, "regLambda": 1.0, "minHessian": 1.0},
    {"numLeaves": 9, "minInstancesPerNode": 2, "regAlpha": 0.7, "regLambda": 0.01, "minGain": 0.1},
])
def test_trees_equal_brute_force(spark, small, params):
    df, values, labels = small
    p = B.BoostParams.of({"maxIter": 4, "stepSize": 0.3, **params}, 42)
    bins = G.binned(df, "is_fraud")
    model = B.fit(bins, p, (0.7, 2.5))
    trees, margin = brute(values, labels, bins.edges, p, (0.7, 2.5))
    assert splits_of(model) == trees
    found = B.margins(np.array(values), model.arrays(), model.start)
    assert np.allclose(found, margin, atol=1e-9)


def test_partitions_change_nothing(spark, small, monkeypatch):
    df, _, _ = small
    p = B.BoostParams.of({
        "maxIter": 6, "numLeaves": 12, "minInstancesPerNode": 3, "subsamplingRate": 0.7, "baggingFreq": 2, "featureFraction": 0.6,
    }, 7)
    bins = G.binned(df, "is_fraud")
    one = B.fit(bins, p)
    monkeypatch.setattr(B, "TASK_BYTES", 160)
    assert bins.tasks() == 4
    many = B.fit(bins, p)
    assert many.start == one.start and many.nodes.equals(one.nodes)


def test_cut_equals_a_shorter_fit(spark, small):
    df, _, _ = small
    bins = G.binned(df, "is_fraud")
    p = {"numLeaves": 5, "minInstancesPerNode": 4, "subsamplingRate": 0.5}
    long, short = (B.fit(bins, B.BoostParams.of({**p, "maxIter": n}, 1)) for n in (7, 3))
    assert long.cut(3).nodes.equals(short.nodes) and long.cut(3).getMaxIter() == 3


def test_scores_save_and_importances(spark, small):
    df, values, _ = small
    model = B.fit(G.binned(df, "is_fraud"), B.BoostParams.of({"maxIter": 5, "numLeaves": 4}, 1))
    scored = model.transform(df).select(F.col("prediction"), G.vector_to_array("probability").alias("p")).collect()
    want = 1 / (1 + np.exp(-B.margins(np.array(values), model.arrays(), model.start)))
    assert np.allclose([r["p"][1] for r in scored], want, atol=1e-12)
    assert all(r["prediction"] == (r["p"][1] > 0.5) for r in scored)
    shares = model.featureImportances.toArray()
    assert abs(shares.sum() - 1) < 1e-9 and shares[3] == 0
    folder = new_path(spark)
    G.save_model(model, "LightGBM", folder)
    again = G.load_model("LightGBM", folder)
    assert again.nodes.astype(float).equals(model.nodes.astype(float)) and again.settings == model.settings and again.start == model.start


def test_missing_values_go_right(spark):
    rows = [([float("nan")], 1)] * 30 + [([float(i % 5)], 0) for i in range(60)]
    df = spark.createDataFrame(rows, "v ARRAY<DOUBLE>, y INT").select(array_to_vector("v").alias("features"), "y")
    model = B.fit(G.binned(df, "y"), B.BoostParams.of({"maxIter": 2, "numLeaves": 2, "minInstancesPerNode": 1, "stepSize": 1.0}, 1))
    assert model.nodes["threshold"].iat[0] == 4.0
    assert model.transform(df).where("(y = 1) <> (prediction = 1)").count() == 0


def test_one_class_and_no_rows(spark):
    df = spark.createDataFrame([([1.0], 0), ([2.0], 0)] * 20, "v ARRAY<DOUBLE>, y INT")
    df = df.select(array_to_vector("v").alias("features"), "y")
    model = B.fit(G.binned(df, "y"), B.BoostParams.of({"maxIter": 2, "minInstancesPerNode": 1}, 1))
    assert model.transform(df).where("prediction <> 0").count() == 0
    with pytest.raises(ValueError):
        G.binned(df.limit(0), "y")


def test_unknown_parameters_and_size(spark, small, monkeypatch):
    with pytest.raises(ValueError):
        B.BoostParams.of({"maxIters": 3}, 1)
    monkeypatch.setattr(B, "MOST_BYTES", 10)
    with pytest.raises(ValueError, match="more executors"):
        B.fit(G.binned(small[0], "is_fraud"), B.BoostParams.of({}, 1))


def expected(model, row, known):
    """Margin of a row of which only some features are known: unknown splits go both ways by rows."""
    total = model.start
    for _, tree in model.nodes.groupby("tree"):
        tree = tree.set_index("node")

        def walk(at):
            node = tree.loc[at]
            if node["feature"] < 0:
                return node["value"]
            if node["feature"] in known:
                return walk(node["left"] if row[int(node["feature"])] <= node["threshold"] else node["right"])
            left, right = tree.loc[node["left"]], tree.loc[node["right"]]
            return (left["rows"] * walk(node["left"]) + right["rows"] * walk(node["right"])) / node["rows"]

        total += walk(0)
    return total


def test_contributions_equal_the_sum_over_subsets(spark, small):
    df, values, _ = small
    model = B.fit(G.binned(df, "is_fraud"), B.BoostParams.of({"maxIter": 3, "numLeaves": 8, "minInstancesPerNode": 3, "stepSize": 0.5}, 1))
    paths, n = X.leaf_paths(model), 4
    assert X.base_margin(model, paths) == pytest.approx(expected(model, values[0], set()))
    rows = np.array([*values[:3], [float("nan"), 1.0, 0.5, 1.0]])
    found = X.path_contributions(rows, paths, n)
    for row, own in zip(rows, found):
        for j in range(n):
            others, want = [i for i in range(n) if i != j], 0.0
            for k in range(n):
                weight = math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n)
                for subset in itertools.combinations(others, k):
                    want += weight * (expected(model, row, {*subset, j}) - expected(model, row, set(subset)))
            assert own[j] == pytest.approx(want, abs=1e-9)


def test_contributions_add_up_to_the_margin(spark, small):
    df, values, _ = small
    model = B.fit(G.binned(df, "is_fraud"), B.BoostParams.of({"maxIter": 20, "minInstancesPerNode": 2}, 1))
    rows = df.withColumn("trans_num", F.monotonically_increasing_id().cast("string"))
    parts, base = X.tree_contributions(model, rows, ["a", "b", "c", "d"], sample=50)
    sums = parts.groupBy("trans_num").agg(F.sum("contribution").alias("s"))
    margin = model.transform(rows).select("trans_num", G.vector_to_array("rawPrediction")[1].alias("m"))
    off = sums.join(margin, "trans_num").where(F.abs(F.col("s") + base - F.col("m")) > 1e-9)
    assert sums.count() == 50 and off.count() == 0


@pytest.mark.parametrize("n", [37, 3 * B.FEW_ROWS])
def test_joint_codes_count_like_single_columns(n):
    sizes, rng = [200, 3, 1, 30, 256, 12, 2, 40], np.random.default_rng(3)
    bins = np.stack([rng.integers(0, s, n) for s in sizes], 1).astype(np.uint8)
    columns, weight = B.Columns(bins, sizes), np.rint(rng.normal(0, 1e6, n))
    assert len(columns.groups) < len(sizes)
    rows = np.flatnonzero(rng.random(n) < 0.9)
    for f, size in enumerate(sizes):
        assert (columns.of(f, rows) == bins[rows, f]).all()
        found = columns.count(rows, weight)[:, columns.starts[f]:columns.starts[f + 1]]
        assert (found[0] == np.bincount(bins[rows, f], weight[rows], size)).all()
        assert (found[1] == np.bincount(bins[rows, f], minlength=size)).all()


@pytest.mark.parametrize("folder", ["{}", "file:{}", "file://{}"])
def test_tasks_add_up_through_files(tmp_path, folder):
    parts = [np.array([[0.0, -7, 2.0**50], [5, -(2.0**50), t]]) for t in range(3)]

    def task(own):
        exchange = B.Exchange(folder.format(tmp_path / "sums"), own, 3)
        return [exchange.total(parts[own] * k) for k in range(1, 6)]

    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(task, range(3)))
    for sums in found:
        for k, total in enumerate(sums, start=1):
            assert (total == sum(parts) * k).all()
    # Only the last round is left.
    assert len(list((tmp_path / "sums").iterdir())) <= 3


def test_many_sums_over_tasks_take_no_second_each(spark, small, monkeypatch):
    df, _, _ = small
    bins = G.binned(df, "is_fraud")
    monkeypatch.setattr(B, "TASK_BYTES", 160)
    begin = time.monotonic()
    model = B.fit(bins, B.BoostParams.of({"maxIter": 30, "numLeaves": 12, "minInstancesPerNode": 3}, 7))
    assert model.nodes["tree"].nunique() == 30
    # Root and children of thirty trees: sixty exchanges at least.
    assert time.monotonic() - begin < 40
