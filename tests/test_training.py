import pytest
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.operators import encoders as E
from swipelens.operators import explain as X
from swipelens.operators import metrics as M
from swipelens.operators import splits as L
from swipelens.operators import training as G
from swipelens.plans.features import feature_engineering
from swipelens.session import materialize, new_path
from swipelens.sources import stand_in


#: Small models, so that the tests end soon; the named queries fit the presets as they are.
QUICK = {
    "Logistic Regression": {"maxIter": 50},
    "Random Forest": {"numTrees": 10, "maxDepth": 6},
    "Gradient Boosted Trees": {"maxIter": 8},
    "XGBoost": {"maxIter": 8, "maxDepth": 4, "stepSize": 0.2},
    "LightGBM": {"maxIter": 8, "maxDepth": 4, "stepSize": 0.2},
}


@pytest.fixture(scope="module")
def matrix(spark):
    txn = stand_in.transactions(spark, "/root/testdata/sf0.01")
    train, test = (materialize(feature_engineering(f(txn))) for f in (stand_in.train_rows, stand_in.test_rows))
    fitted = E.FeatureEncoder().fit(train)
    return fitted, materialize(fitted.transform(train)), materialize(fitted.transform(test))


def rows(df):
    return sorted(map(str, df.collect()))


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "is_fraud INT")
    got = {r["is_fraud"]: (r["n"], r["weight"], r["neg_pos_ratio"]) for r in G.class_weights(df).collect()}
    assert got == {0: (9, 10 / 18, 9.0), 1: (1, 5.0, 9.0)}
    balanced = df.select("is_fraud", G.weight_column(df).alias("w")).groupBy("is_fraud").agg(F.sum("w").alias("s"))
    assert [round(r["s"], 9) for r in balanced.collect()] == [5.0, 5.0]
    only = {r["is_fraud"]: r["w"] for r in df.select("is_fraud", G.weight_column(df, positives_only=True).alias("w")).collect()}
    assert only == {0: 1.0, 1: 9.0}


@pytest.mark.parametrize("name", list(G.PRESETS))
def test_each_model(matrix, name):
    _, train, test = matrix
    model = G.train(train, name, **QUICK[name])
    scored = G.score_rows(model, test)
    edge = scored.agg(F.min("score"), F.max("score"), F.count("score")).first()
    assert edge[0] >= 0 and edge[1] <= 1 and edge[2] == test.count()
    assert scored.where((F.col("score") > 0.5) != (F.col("prediction") == 1)).where("score <> 0.5").count() == 0
    assert M.rank_metrics(scored).first()["roc_auc"] > 0.6


def test_training_repeats_and_reloads(matrix):
    _, train, test = matrix
    first, second = (G.train(train, "Random Forest", **QUICK["Random Forest"]) for _ in range(2))
    want = rows(G.score_rows(first, test))
    assert rows(G.score_rows(second, test)) == want
    folder = new_path(train.sparkSession)
    G.save_model(first, "Random Forest", folder)
    assert rows(G.score_rows(G.load_model("Random Forest", folder), test)) == want


def test_unknown_names(matrix):
    with pytest.raises(ValueError):
        G.train_all(matrix[1], ["Nope"])
    with pytest.raises(ValueError):
        G.train(matrix[1], "Random Forest", strategy="both")
    with pytest.raises(ValueError):
        G.calibrate(matrix[1], "other")


def test_calibration_keeps_order_and_range(matrix):
    _, train, test = matrix
    model = G.train(L.balance_data(train), "Random Forest", strategy="undersample", **QUICK["Random Forest"])
    held_out, scores = G.score_rows(model, train), materialize(G.score_rows(model, test))
    for method in ("isotonic", "sigmoid"):
        found = G.calibrate(held_out, method)(scores)
        joined = scores.select(C.ROW_ID, F.col("score").alias("raw")).join(found, C.ROW_ID).orderBy("raw").collect()
        values = [r["score"] for r in joined]
        assert found.columns == scores.columns and 0 <= min(values) and max(values) <= 1
        assert all(b >= a - 1e-12 for a, b in zip(values, values[1:]))


def test_search_ranks_trials_and_refits(matrix, spark):
    txn = stand_in.transactions(spark, "/root/testdata/sf0.01")
    train = materialize(feature_engineering(stand_in.train_rows(txn)))
    grid = {"maxIter": [2, 3], "maxDepth": [2, 3]}
    table, model = G.param_search([L.time_based_split(train, 0.2)], "Gradient Boosted Trees", grid, 2, full=train)
    found = table.collect()
    assert len(found) == 2 and found[0]["average_precision"] >= found[1]["average_precision"]
    assert model.getMaxIter() == int(found[0]["maxIter"])
    assert G.sample_grid(grid, 2) == G.sample_grid(grid, 2) and len(G.sample_grid(grid, None)) == 4


def test_folds_and_sweep(matrix, spark):
    txn = stand_in.transactions(spark, "/root/testdata/sf0.01")
    folds = materialize(L.time_series_folds(feature_engineering(txn), 2))
    results = G.fold_results([L.fold(folds, k) for k in (1, 2)], ["Logistic Regression"], overrides=QUICK)
    assert sorted(r["fold"] for r in results.collect()) == [1, 2]
    assert G.fold_summary(results).count() == 1
    _, train, test = matrix
    swept = materialize(G.ratio_sweep(train, test, [2, 30], **QUICK["Random Forest"]))
    assert {r["ratio"] for r in swept.collect()} == {2.0, 30.0}
    assert {r["measure"] for r in G.best_ratios(swept).collect()} == {"f1", "g_mean", "pr_auc"}


def test_attribution(matrix):
    fitted, train, test = matrix
    names = fitted.feature_names()
    linear = G.train(train, "Logistic Regression", **QUICK["Logistic Regression"])
    parts = X.linear_contributions(linear, test, names, 100)
    # Contributions add up to the margin less the mean margin.
    sums = {r[C.ROW_ID]: r["s"] for r in parts.groupBy(C.ROW_ID).agg(F.sum("contribution").alias("s")).collect()}
    margins = {
        r[C.ROW_ID]: r["rawPrediction"][1]
        for r in linear.transform(test.where(F.col(C.ROW_ID).isin(list(sums)))).collect()
    }
    mean = sum(margins.values()) / len(margins)
    assert len(sums) == 100 and sums == pytest.approx({k: v - mean for k, v in margins.items()}, abs=1e-9)
    tree = G.train(train, "Random Forest", **QUICK["Random Forest"])
    found = {r["feature"]: r["mean_abs"] for r in X.attribution(tree, test, names, 300).collect()}
    unused = [n for n, v in G.importances(tree, names) if v == 0]
    assert set(found) == set(names) and max(found.values()) > 0 and all(found[n] == 0 for n in unused)


def test_draws_stay_in_their_ranges():
    space = {"C": (1e-3, 10.0, "log"), "stepSize": (0.1, 0.3, "linear"), "maxDepth": (2, 5, "int"), "featureSubsetStrategy": ["0.6", "0.8"]}
    drawn = G.draw_params(space, 200)
    assert drawn == G.draw_params(space, 200) and drawn != G.draw_params(space, 200, seed=1)
    assert all(1e-3 <= d["C"] <= 10 and 0.1 <= d["stepSize"] <= 0.3 and d["maxDepth"] in (2, 3, 4, 5) for d in drawn)
    assert sum(d["C"] < 0.1 for d in drawn) > 60 and {d["featureSubsetStrategy"] for d in drawn} == {"0.6", "0.8"}


def test_search_over_ranges_refits_the_best(matrix, spark):
    train = materialize(feature_engineering(stand_in.train_rows(stand_in.transactions(spark, "/root/testdata/sf0.01"))))
    table, model = G.param_search(
        [L.time_based_split(train, 0.3)], "Logistic Regression", {"C": (1e-2, 10.0, "log"), "maxIter": [20]}, trials=2, full=train
    )
    assert table.count() == 2 and model.numFeatures == len(matrix[0].feature_names())
    with pytest.raises(ValueError):
        G.param_search([L.time_based_split(train, 0.3)], "Logistic Regression", {"C": (1.0, 2.0, "log")}, trials=None)


def test_query_searches_boosted_trees_and_scores_the_refit(spark, monkeypatch):
    from swipelens.plans.queries import QUERIES

    asked, search = [], G.param_search

    def small(splits, name, space, trials, full):
        asked.append((name, space, trials))
        space = {**space, "maxIter": [2], "maxDepth": [2]}
        return search(splits, name, space, trials=2, full=full)

    monkeypatch.setattr(G, "param_search", small)
    found = QUERIES["param_search"](spark, "/root/testdata/sf0.01").collect()
    (name, space, trials), = asked
    assert name == "LightGBM" and trials == 25 and space["stepSize"] == (0.01, 0.2, "log")
    assert set(space) == {
        "maxIter", "numLeaves", "stepSize", "minInstancesPerNode", "featureFraction", "subsamplingRate", "baggingFreq",
        "regAlpha", "regLambda",
    }
    assert found[0]["average_precision"] >= found[1]["average_precision"]
    assert [r["test_f1"] is not None for r in found] == [True, False]


def test_query_walks_the_folds_with_all_presets(spark, monkeypatch):
    from swipelens.plans.queries import QUERIES

    asked = []

    def stub(folds, names):
        asked.append((len(folds), names))
        rows = [(n, *[0.5] * len(G.FOLD_MEASURES)) for n in names]
        return spark.createDataFrame(rows, ["model", *G.FOLD_MEASURES])

    monkeypatch.setattr(G, "fold_results", stub)
    found = QUERIES["fold_means"](spark, "/root/testdata/sf0.001").collect()
    assert asked == [(5, list(G.PRESETS))] and {r["model"] for r in found} == set(G.PRESETS)


def test_forest_keeps_nodes_and_uses_the_slots(spark, matrix, monkeypatch):
    _, train, _ = matrix
    settings = G.estimator("Random Forest", {}, C.TARGET, None, C.SEED, 1.0)
    assert settings.getCacheNodeIds() and settings.getMaxMemoryInMB() > 256
    quick = {**QUICK["Random Forest"], "maxMemoryInMB": 256}
    kept, walked = (G.train(train, "Random Forest", cacheNodeIds=k, **quick) for k in (True, False))
    # The first line names the fit.
    assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]
    # A small table stays as it is, a large one is dealt over the slots.
    slots = spark.sparkContext.defaultParallelism
    width = len(train.first()["features"])
    assert G.forest_tasks(train, 100) == 1
    assert G.forest_tasks(train, 3 * G.FOREST_BYTES // (8 * width)) == min(3, slots)
    assert G.forest_tasks(train, 10**9) == slots
    monkeypatch.setattr(G, "FOREST_BYTES", 1 << 12)
    spread = G.train(train, "Random Forest", **QUICK["Random Forest"])
    assert spread.getNumTrees == 10 and spread.totalNumNodes > 10


def test_forest_deals_its_trees_over_fits(spark, matrix, monkeypatch):
    _, train, test = matrix
    slots = spark.sparkContext.defaultParallelism
    row = 8 * len(train.first()["features"])
    # Few rows leave room for a fit per slot, many take every slot for one.
    assert G.forest_fits(train, 2 * G.FOREST_PART_BYTES // row, 300) == (slots // 2, 2)
    assert G.forest_fits(train, 10**9, 300) == (1, slots)
    assert G.forest_fits(train, G.FOREST_PART_BYTES // row, 3)[0] == 3
    monkeypatch.setattr(G, "FOREST_BYTES", 1 << 12)
    dealt, again = (G.train(train, "Random Forest", **QUICK["Random Forest"]) for _ in range(2))
    assert dealt.getNumTrees == 10 and len({t.toDebugString.split("\n", 1)[1] for t in dealt.trees}) == 10
    assert sum(dealt.featureImportances.toArray()) == pytest.approx(1)
    want = rows(G.score_rows(dealt, test))
    assert rows(G.score_rows(again, test)) == want
    # Every tree has one vote.
    votes = test.select(C.ROW_ID, "features").limit(1).first()
    shares = [t.predictProbability(votes["features"])[1] for t in dealt.trees]
    assert dealt.predictProbability(votes["features"])[1] == pytest.approx(sum(shares) / 10)
    folder = new_path(spark)
    G.save_model(dealt, "Random Forest", folder)
    assert rows(G.score_rows(G.load_model("Random Forest", folder), test)) == want


def test_rows_of_few_files_are_dealt_for_scoring(matrix):
    _, train, test = matrix
    model, linear = (G.train(train, n, **QUICK[n]) for n in ("Random Forest", "Logistic Regression"))
    one = materialize(test.coalesce(1))
    # A file is one task.
    tasks = G.SCORING_TASKS * test.sparkSession.sparkContext.defaultParallelism
    assert G.spread(model, one).rdd.getNumPartitions() == tasks and G.spread(linear, one) is one
    assert rows(G.score_rows(model, one)) == rows(G.score_rows(model, test))


def test_search_begins_with_the_longest_fits(matrix, spark, monkeypatch):
    train = materialize(feature_engineering(stand_in.train_rows(stand_in.transactions(spark, "/root/testdata/sf0.01"))))
    asked, at_once = [], []

    def seen(calls, n=G.AT_ONCE):
        at_once.append(n)
        return [call() for call in calls]

    def small(df, name, *given, maxIter, numLeaves, **params):
        asked.append(maxIter * numLeaves)
        return known(df, name, *given, maxIter=2, numLeaves=4)

    known = G.train
    monkeypatch.setattr(G, "together", seen)
    monkeypatch.setattr(G, "train", small)
    grid = {"maxIter": [2], "numLeaves": [7, 63, 15]}
    table, _ = G.param_search([L.time_based_split(train, 0.2)], "LightGBM", grid, 3)
    assert asked == sorted(asked, reverse=True) and len(asked) == 3 and table.count() == 3
    assert at_once == [max(G.AT_ONCE, spark.sparkContext.defaultParallelism)]
