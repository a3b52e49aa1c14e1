import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.operators import forest as R
from swipelens.operators import training as G
from swipelens.session import new_path

QUICK = {"numTrees": 12, "maxDepth": 8}


def table(rows=3000, width=5, seed=7):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, [200, 40, 7, 2, 1], (rows, width)).astype(np.uint8)
    label = (bins[:, 0] > 120) & (bins[:, 2] < 3) | (rng.random(rows) < 0.05)
    return bins, label.astype(np.uint8)


@pytest.fixture
def rows(spark):
    bins, label = table()
    data = [(str(i), int(k), [float(x) for x in b]) for i, (b, k) in enumerate(zip(bins, label))]
    df = spark.createDataFrame(data, f"{C.ROW_ID} STRING, {C.TARGET} INT, v ARRAY<DOUBLE>")
    return df.select(C.ROW_ID, C.TARGET, array_to_vector("v").alias("features")).repartition(3)


def walked(tree, bins):
    feature, at, left, pos, neg = tree
    found = []
    for row in bins:
        node = 0
        while feature[node] >= 0:
            node = left[node] + (row[feature[node]] > at[node])
        found.append((pos[node], neg[node]))
    return found


def test_nodes_are_split_alike_alone_in_blocks_and_in_order(monkeypatch):
    bins, label = table()
    found = []
    for few, per_bin in ((1, 256), (1 << 30, 0), (1 << 30, 256), (100, 256)):
        monkeypatch.setattr(R, "FEW_ROWS", few)
        grower = R.Grower(bins, label, (1.0, 3.0), bins.shape[1], 9)
        if not per_bin:
            monkeypatch.setattr(grower, "_by_bins", grower._by_order)
        tree = grower.tree([1, 2])
        found.append((walked(tree, bins), grower.importances(*tree).round(9).tolist(), len(tree[0])))
    assert found[0] == found[1] == found[2] == found[3] and found[0][2] > 20


def test_root_takes_the_best_split():
    bins, label = table()
    grower = R.Grower(bins, label, (1.0, 3.0), bins.shape[1], 1)
    feature, at, left, pos, neg = grower.tree([3, 4])
    times = grower.times.astype(float)

    def impurity(side):
        a, b = 3.0 * (times * label)[side].sum(), (times * (1 - label))[side].sum()
        return 2 * a * b / (a + b) if a + b else 0.0

    best = min(
        (impurity(bins[:, f] <= b) + impurity(bins[:, f] > b), f, b)
        for f in range(bins.shape[1]) for b in range(255) if 0 < times[bins[:, f] <= b].sum() < times.sum()
    )
    assert (feature[0], at[0]) == best[1:] and left[0] == 1
    assert pos[0] == (times * label).sum() and pos[1] + pos[2] == pos[0] and neg[1] + neg[2] == neg[0]


def test_leaves_alike_become_one():
    bins, label = table()
    tree = R.Grower(bins, label, (1.0, 1.0), 3, 30).tree([5, 6])
    feature, _, left, pos, neg = tree
    for node in np.flatnonzero(feature >= 0):
        a, b = left[node], left[node] + 1
        assert not (feature[a] < 0 and feature[b] < 0 and (pos[a] > neg[a]) == (pos[b] > neg[b]))


def test_large_forests_stay_in_files(spark, rows, monkeypatch):
    monkeypatch.setattr(G, "FOREST_ROW_TREES", 1000)
    first, second = (G.train(rows, "Random Forest", **QUICK) for _ in range(2))
    assert isinstance(first, R.StoredForestModel) and first.getNumTrees == 12 and first.totalNumNodes > 12
    # The driver has no trees, only their sums.
    assert set(vars(first)) & {"path", "importances"} and not hasattr(first, "trees")
    assert sum(first.featureImportances.toArray()) == pytest.approx(1)
    got = G.score_rows(first, rows).orderBy(C.ROW_ID).collect()
    assert got == G.score_rows(second, rows.repartition(5)).orderBy(C.ROW_ID).collect() and len(got) == 3000
    folder = new_path(spark)
    G.save_model(first, "Random Forest", folder)
    assert G.score_rows(G.load_model("Random Forest", folder), rows).orderBy(C.ROW_ID).collect() == got
    # Spark's forest on the same rows says nearly the same.
    monkeypatch.setattr(G, "FOREST_ROW_TREES", 10**9)
    spark_model = G.train(rows, "Random Forest", **QUICK)
    want = {r[C.ROW_ID]: r["score"] for r in G.score_rows(spark_model, rows).collect()}
    assert np.corrcoef([r["score"] for r in got], [want[r[C.ROW_ID]] for r in got])[0, 1] > 0.95
    assert first.featureImportances.toArray() == pytest.approx(spark_model.featureImportances.toArray(), abs=0.1)


def test_rows_are_scored_part_by_part(rows, monkeypatch):
    monkeypatch.setattr(G, "FOREST_ROW_TREES", 0)
    model = G.train(rows, "Random Forest", "is_fraud", "undersample", **QUICK)
    want = G.score_rows(model, rows).orderBy(C.ROW_ID).collect()
    monkeypatch.setattr(R, "SCORED_ROWS", 100)
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        assert G.score_rows(model, rows).orderBy(C.ROW_ID).collect() == want
        assert G.score_rows(model, rows.where("false")).count() == 0
    finally:
        rows.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    missing = rows.limit(5).withColumn("features", array_to_vector(F.array(*[F.lit(float("nan"))] * 5)))
    last = rows.limit(5).withColumn("features", array_to_vector(F.array(*[F.lit(1e9)] * 5)))
    scores = [{r["score"] for r in G.score_rows(model, d).collect()} for d in (missing, last)]
    assert scores[0] == scores[1] and len(scores[0]) == 1


def test_other_parameters_and_large_tables_are_left_to_spark(rows, monkeypatch):
    monkeypatch.setattr(G, "FOREST_ROW_TREES", 0)
    assert G.needs_bins("Random Forest", rows, 3000) and G.needs_bins("LightGBM", rows, 3000)
    assert not G.needs_bins("Logistic Regression", rows, 3000)
    assert not G.needs_bins("Random Forest", rows, 3000, {"maxBins": 16})
    assert not G.needs_bins("Random Forest", rows, R.MOST_BYTES)
    drawn = [R.features_drawn(s, 27) for s in ("sqrt", "all", "log2", "onethird", "0.5", "4", "auto", "none")]
    assert drawn == [6, 27, 5, 9, 14, 4, 6, None]


def test_models_of_one_table_share_their_bins(rows, monkeypatch):
    made, known = [], G.binned

    def counted(df, *given):
        made.append(df)
        return known(df, *given)

    monkeypatch.setattr(G, "binned", counted)
    monkeypatch.setattr(G, "FOREST_ROW_TREES", 1000)
    overrides = {"Random Forest": QUICK, "LightGBM": {"maxIter": 2}}
    models = G.train_all(rows, list(overrides), overrides=overrides)
    assert isinstance(models["Random Forest"], R.StoredForestModel) and len(made) == 1
    assert {r["model"]: r["tp"] + r["fp"] + r["tn"] + r["fn"] for r in G.evaluate_all(models, rows).collect()} == dict.fromkeys(overrides, 3000)
