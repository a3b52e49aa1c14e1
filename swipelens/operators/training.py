"""Spark ML classifiers under one imbalance strategy, search, calibration and folds."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.operators.boosting import (
    Binned, BoostedTreesModel, BoostParams, bin_edges, bin_rows, fit as fit_boosted,
)
from swipelens.operators import forest as R
from swipelens.operators.encoders import FeatureEncoder
from swipelens.operators.metrics import (
    best_by, classification_metrics, evaluate_scores, fold_means, rank_metrics,
)
from swipelens.operators.splits import balance_data
from swipelens.session import materialize

WEIGHT = "weight"
STRATEGIES = ("class_weight", "undersample")

# The five presets, and with them what the libraries behind the last two assume.
# Depth 30 is the deepest tree of Spark's forest and stands for no limit.
PRESETS: dict[str, dict] = {
    "Logistic Regression": {"maxIter": 1000, "C": 1.0, "elasticNetParam": 0.0},
    "Random Forest": {"numTrees": 300, "maxDepth": 30, "featureSubsetStrategy": "sqrt"},
    "Gradient Boosted Trees": {"maxIter": 200, "maxDepth": 3, "stepSize": 0.1, "minInstancesPerNode": 1},
    "XGBoost": {
        "maxIter": 400, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "featureFraction": 0.8,
        "regLambda": 1.0, "minHessian": 1.0, "minInstancesPerNode": 1,
    },
    "LightGBM": {"maxIter": 400, "stepSize": 0.05, "numLeaves": 63, "minInstancesPerNode": 20, "minHessian": 1e-3},
}

# The ranges to search for boosted trees.
BOOSTING_SPACE: dict[str, tuple] = {
    "maxIter": (200, 800, "int"), "numLeaves": (15, 255, "int"), "stepSize": (0.01, 0.2, "log"),
    "minInstancesPerNode": (5, 100, "int"), "featureFraction": (0.5, 1.0, "linear"),
    "subsamplingRate": (0.5, 1.0, "linear"), "baggingFreq": (1, 7, "int"),
    "regAlpha": (1e-8, 10.0, "log"), "regLambda": (1e-8, 10.0, "log"),
}
# End of fixed values.

#: Presets that are grown on bins.
BOOSTED = ("Gradient Boosted Trees", "XGBoost", "LightGBM")
#: Bytes of a matrix per partition: iterations over a small one should not wait for many tasks.
MATRIX_BYTES = 16 << 20
#: Bytes of a forest's rows per task, up to the slots: every task sends the sums of all open nodes.
FOREST_BYTES = 2 << 20
#: Bytes of rows that a task of one of several fits side by side may hold: a forest's trees are dealt
#: over such fits, since what a pass costs is tasks x open nodes and not rows.
FOREST_PART_BYTES = 64 << 20
#: Rows x trees up to which Spark fits a forest: its trees live on the driver, with a node for every few rows.
FOREST_ROW_TREES = 4_000_000
#: Memory in MB of a task's sums of open nodes; with fewer, a level takes several passes.
FOREST_SUMS_MB = 512
#: Models or trials, folds, and ratios that are fitted at a time; their tasks share the slots.
AT_ONCE, FOLDS_AT_ONCE, RATIOS_AT_ONCE = 8, 2, 4
#: Tasks per slot that score rows of few files by trees.
SCORING_TASKS = 2


def class_weights(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """(class, n, weight, ratio): balanced weight n / (classes * n_c), and negatives per positive."""
    # One row per class.
    every = Window.partitionBy(F.lit(1))
    n = F.col("n")
    negatives, positives = (F.sum(F.when(F.col(target) == k, n)).over(every) for k in (0, 1))
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).select(
        target, "n",
        (F.sum(n).over(every) / (F.count(F.lit(1)).over(every) * n)).alias("weight"),
        F.coalesce(negatives / F.nullif(positives, F.lit(0)), F.lit(1.0)).alias("neg_pos_ratio"),
    )


def class_counts(df: DataFrame, target: str = C.TARGET) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(target) == 1).alias("p"), F.count_if(F.col(target) == 0).alias("n")).first()
    return row["p"], row["n"]


def _weights(pos: int, neg: int, positives_only: bool) -> tuple[float, float]:
    """Row weights of a negative and of a positive."""
    if positives_only:
        return 1.0, neg / pos if pos else 1.0
    rows, classes = pos + neg, (pos > 0) + (neg > 0)
    return rows / (classes * neg) if neg else 1.0, rows / (classes * pos) if pos else 1.0


def weight_column(df: DataFrame, target: str = C.TARGET, positives_only: bool = False) -> Column:
    """Row weight: balanced per class, or negatives per positive on the positives alone."""
    negative, positive = _weights(*class_counts(df, target), positives_only)
    return F.when(F.col(target) == 1, F.lit(positive)).otherwise(F.lit(negative))


def estimator(name: str, params: dict, target: str, weight: str | None, seed: int, weight_sum: float):
    """The Spark ML estimator of a preset that is not boosted, with overrides."""
    params = {**PRESETS[name], **params}
    if "featureSubsetStrategy" in params:
        # Spark takes a share of the features as text.
        params["featureSubsetStrategy"] = str(params["featureSubsetStrategy"])
    common = {"featuresCol": "features", "labelCol": target}
    if weight:
        common["weightCol"] = weight
    if name == "Logistic Regression":
        # Spark's loss is a weighted mean and the wanted one a sum, hence the division.
        strength = 1.0 / (max(weight_sum, 1.0) * params.pop("C"))
        return LogisticRegression(**common, **params, regParam=strength, standardization=False)
    # The nodes of rows are kept from level to level: deep trees are not walked again in every pass.
    kept = {"cacheNodeIds": True, "maxMemoryInMB": FOREST_SUMS_MB}
    return RandomForestClassifier(**common, **{**kept, **params}, seed=seed)


def _matrix_bytes(df: DataFrame, rows: int) -> int:
    first = df.select("features").first()
    return rows * len(first[0]) * 8 if first else 0


def _slots(df: DataFrame) -> int:
    return max(1, df.sparkSession.sparkContext.defaultParallelism)


def forest_tasks(df: DataFrame, rows: int) -> int:
    """Tasks that a forest's passes over the rows ask for, at most as many as run at once."""
    return min(max(1, -(-_matrix_bytes(df, rows) // FOREST_BYTES)), _slots(df))


def forest_fits(df: DataFrame, rows: int, trees: int) -> tuple[int, int]:
    """Fits side by side that a forest's trees are dealt over, and the tasks of each."""
    slots = _slots(df)
    parts = min(max(1, -(-_matrix_bytes(df, rows) // FOREST_PART_BYTES)), slots)
    fits = max(1, min(slots // parts, trees))
    # Slots that are left over take rows, but no more than small tasks are worth.
    return fits, max(parts, min(slots // fits, forest_tasks(df, rows) // fits))


def joined_forest(models: list[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One forest of the trees of several, which vote as they would have in one fit."""
    first = models[0]
    sc = SparkSession.getActiveSession().sparkContext
    kind = sc._jvm.org.apache.spark.ml.classification
    found = [tree for model in models for tree in model._java_obj.trees()]
    trees = sc._gateway.new_array(kind.DecisionTreeClassificationModel, len(found))
    for at, tree in enumerate(found):
        trees[at] = tree
    forest = kind.RandomForestClassificationModel(first.uid, trees, first.numFeatures, first.numClasses)
    forest = first._java_obj.copyValues(forest, sc._jvm.org.apache.spark.ml.param.ParamMap.empty())
    return RandomForestClassificationModel(forest.set(forest.getParam("numTrees"), len(found)))


def fit_forest(
    rows: DataFrame, n: int, params: dict, target: str, weight: str | None, seed: int,
) -> RandomForestClassificationModel:
    """A forest on (features, target, weight). Small tables are one fit in one task.

    Every task of a pass sends the sums of all open nodes, most of which hold few rows. So the trees
    are dealt over as many fits as the slots have room for, each over all rows in few tasks.
    """
    def one(part: DataFrame, trees: int, salt: int) -> RandomForestClassificationModel:
        return estimator("Random Forest", {**params, "numTrees": trees}, target, weight, salt, n).fit(part)

    trees = params.get("numTrees", PRESETS["Random Forest"]["numTrees"])
    if forest_tasks(rows, n) == 1:
        return one(rows, trees, seed)
    fits, tasks = forest_fits(rows, n, trees)
    # Every fit reads its rows a few times.
    written = materialize(rows)
    spread = written.repartition(tasks) if tasks > 1 else written.coalesce(1)
    shares = [trees // fits + (k < trees % fits) for k in range(fits)]
    models = together([lambda k=k, t=t: one(spread, t, seed + 1_000_003 * k) for k, t in enumerate(shares)], fits)
    return models[0] if fits == 1 else joined_forest(models)


def needs_bins(name: str, df: DataFrame, rows: int, params: dict | None = None) -> bool:
    """Whether a preset is grown on bins: boosted trees, and forests whose trees would not fit on the driver."""
    if name != "Random Forest":
        return name in BOOSTED
    settings = {**PRESETS[name], **(params or {})}
    if rows * settings["numTrees"] <= FOREST_ROW_TREES:
        return False
    first = df.select("features").first()
    return first is not None and R.fits_here(df, rows, len(first[0]), settings)


def _known(name: str) -> None:
    if name not in PRESETS:
        raise ValueError(f"unknown model {name!r}; choose from {list(PRESETS)}")


def matrix(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """(features, target) written in as many partitions as its counted bytes ask for."""
    rows = df.select("features", target)
    size = rows.agg(F.sum(F.size(vector_to_array("features")).cast("bigint") * 8)).first()[0] or 0
    parts = max(1, -(-size // MATRIX_BYTES))
    return materialize(rows.coalesce(1) if parts == 1 else rows.repartition(parts))


def binned(df: DataFrame, target: str = C.TARGET) -> Binned:
    """The bins of a matrix, for any number of boosted fits."""
    return bin_rows(df, bin_edges(df), target)


def train(
    df: DataFrame, name: str, target: str = C.TARGET, strategy: str = "class_weight",
    seed: int = C.SEED, bins: Binned | None = None, counts: tuple[int, int] | None = None, **params,
) -> Model:
    """Fit one preset on (features, target). Overrides are the parameters of the preset's kind.

    ``bins`` and ``counts`` (positives, negatives) are given where several fits share them.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; choose from {STRATEGIES}")
    _known(name)
    weighted = strategy == "class_weight"
    pos, neg = counts or class_counts(df, target)
    negative, positive = _weights(pos, neg, name == "XGBoost") if weighted else (1.0, 1.0)
    if name in BOOSTED:
        settings = BoostParams.of({**PRESETS[name], **params}, seed)
        return fit_boosted(bins or binned(df, target), settings, (negative, positive))
    if needs_bins(name, df, pos + neg, params):
        # Bins take several passes over the rows.
        bins = bins or binned(materialize(df.select("features", target)), target)
        return R.fit(bins, (negative, positive), {**PRESETS[name], **params}, seed)
    rows = df.select("features", target)
    if weighted:
        rows = rows.withColumn(WEIGHT, F.when(F.col(target) == 1, F.lit(positive)).otherwise(F.lit(negative)))
    total = positive * pos + negative * neg
    if name == "Random Forest":
        return fit_forest(rows, pos + neg, params, target, WEIGHT if weighted else None, seed)
    return estimator(name, params, target, WEIGHT if weighted else None, seed, total).fit(rows)


def together(calls: list[Callable[[], object]], at_once: int = AT_ONCE) -> list:
    """Results of independent fits, several of them at a time."""
    if len(calls) == 1:
        return [calls[0]()]
    with ThreadPoolExecutor(min(at_once, max(1, len(calls)))) as pool:
        return list(pool.map(lambda call: call(), calls))


def train_all(
    df: DataFrame, names: list[str] | None = None, target: str = C.TARGET,
    strategy: str = "class_weight", seed: int = C.SEED, overrides: dict[str, dict] | None = None,
) -> dict[str, Model]:
    """Fit all presets, or those named, on one written matrix; the boosted ones share its bins."""
    names = list(PRESETS) if names is None else names
    for name in names:
        _known(name)
    rows = matrix(df, target)
    counts = class_counts(rows, target)
    own = {n: (overrides or {}).get(n, {}) for n in names}
    bins = binned(rows, target) if any(needs_bins(n, rows, sum(counts), own[n]) for n in names) else None

    def one(name: str) -> Callable[[], Model]:
        return lambda: train(rows, name, target, strategy, seed, bins, counts, **own[name])

    return dict(zip(names, together([one(n) for n in names])))


def safe_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def save_model(model: Model, name: str, folder: str) -> str:
    path = f"{folder.rstrip('/')}/{safe_name(name)}"
    if isinstance(model, (BoostedTreesModel, R.StoredForestModel)):
        model.save(path)
    else:
        PipelineModel(stages=[model]).write().overwrite().save(path)
    return path


def load_model(name: str, folder: str) -> Model:
    path = f"{folder.rstrip('/')}/{safe_name(name)}"
    spark = SparkSession.getActiveSession()
    for part, kind in (("trees", BoostedTreesModel), ("forest", R.StoredForestModel)):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}")
        if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return kind.load(spark, path)
    return PipelineModel.load(path)


def spread(model: Model, df: DataFrame) -> DataFrame:
    """Rows for trees to score: those of few files are dealt over the slots, since a file is one task."""
    inner = model.stages[-1] if isinstance(model, PipelineModel) else model
    tasks = SCORING_TASKS * _slots(df)
    walks = isinstance(inner, (RandomForestClassificationModel, BoostedTreesModel, R.StoredForestModel))
    return df.repartition(tasks) if walks and len(df.inputFiles()) < tasks else df


def score_rows(model: Model, df: DataFrame, target: str = C.TARGET, keep: list[str] | None = None) -> DataFrame:
    """(keys, label, score, amt, prediction): probability of class 1 and the 0.5 prediction."""
    keep = [c for c in ([C.ROW_ID, C.AMOUNT] if keep is None else keep) if c in df.columns]
    df = spread(model, df.select(*keep, target, "features"))
    return model.transform(df).select(
        *keep, F.col(target).alias("label"),
        vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("prediction"),
    )


def evaluate_model(model: Model, df: DataFrame, name: str, target: str = C.TARGET) -> DataFrame:
    """Counts, rates and curve measures; the rows are scored once."""
    return evaluate_scores(materialize(score_rows(model, df, target)), name)


def evaluate_all(models: dict[str, Model], df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """One result row per model."""
    return reduce(DataFrame.unionByName, [evaluate_model(m, df, n, target) for n, m in models.items()])


# Calibration


def calibrate(scores: DataFrame, method: str = "isotonic") -> Callable[[DataFrame], DataFrame]:
    """Learn a map from score to probability on held-out (label, score) rows.

    Returns a function that replaces ``score`` in any score table.
    """
    assemble = VectorAssembler(inputCols=["score"], outputCol="_x")
    if method == "isotonic":
        fitted = IsotonicRegression(featuresCol="_x", labelCol="label", predictionCol="_p")
        value = F.col("_p")
    elif method == "sigmoid":
        fitted = LogisticRegression(
            featuresCol="_x", labelCol="label", probabilityCol="_v", rawPredictionCol="_r",
            predictionCol="_p", standardization=False,
        )
        value = vector_to_array("_v")[1]
    else:
        raise ValueError(f"unknown method {method!r}; choose isotonic or sigmoid")
    if method == "isotonic":
        # Equal scores meet in one weighted point before the fit.
        points = scores.groupBy("score").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("_w"))
        model = Pipeline(stages=[assemble, fitted.setWeightCol("_w")]).fit(points)
    else:
        model = Pipeline(stages=[assemble, fitted]).fit(scores)

    def apply(rows: DataFrame) -> DataFrame:
        found = model.transform(rows).withColumn(
            "score", F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
        )
        return found.select(*rows.columns)

    return apply


# Search and folds


def sample_grid(grid: dict[str, list], trials: int | None, seed: int = C.SEED) -> list[dict]:
    """All combinations, or a seeded sample of them without repeats."""
    combos: list[dict] = [{}]
    for key, values in grid.items():
        combos = [{**c, key: v} for c in combos for v in values]
    if trials is None or trials >= len(combos):
        return combos
    return random.Random(seed).sample(combos, trials)


def draw_params(space: dict[str, tuple | list], trials: int, seed: int = C.SEED) -> list[dict]:
    """Seeded draws: (low, high, "linear", "log" or "int") is a range, a list a choice."""
    draw = random.Random(seed)

    def one(span):
        if isinstance(span, list):
            return draw.choice(span)
        low, high, scale = span
        if scale == "int":
            return draw.randint(low, high)
        if scale == "log":
            return math.exp(draw.uniform(math.log(low), math.log(high)))
        if scale == "linear":
            return draw.uniform(low, high)
        raise ValueError(f"unknown scale {scale!r}; choose linear, log or int")

    return [{k: one(v) for k, v in space.items()} for _ in range(trials)]


def param_search(
    splits: list[tuple[DataFrame, DataFrame]], name: str, grid: dict[str, list | tuple],
    trials: int | None = 25, score: str = "average_precision", target: str = C.TARGET,
    seed: int = C.SEED, strategy: str = "class_weight", encoder: FeatureEncoder | None = None,
    full: DataFrame | None = None,
) -> tuple[DataFrame, Model | None]:
    """Ranked trial table over fixed time splits, and the best setting refitted on ``full``.

    ``grid`` lists values, of which all combinations or a sample are tried; with a range
    among them (see ``draw_params``) every trial is drawn.

    ``splits`` hold feature rows. Each split's encoder is fitted on its own training rows
    and its encoded tables are kept for all trials.
    """
    if score not in ("average_precision", "f1"):
        raise ValueError("score must be average_precision or f1")
    encoder = encoder or FeatureEncoder(target=target)
    prepared = []
    for fit_rows, held_out in splits:
        fitted = encoder.fit(fit_rows)
        rows = matrix(fitted.transform(fit_rows), target)
        # Trials share the matrix, its class counts and, for boosted trees, its bins.
        bins = binned(rows, target) if name in BOOSTED else None
        prepared.append((rows, class_counts(rows, target), bins, materialize(fitted.transform(held_out))))
    ranged = any(isinstance(v, tuple) for v in grid.values())
    if ranged and trials is None:
        raise ValueError("a search over ranges needs a number of trials")
    combos = draw_params(grid, trials, seed) if ranged else sample_grid(grid, trials, seed)
    # Boosted settings that differ in rounds only are one fit, cut after as many rounds.
    alike: dict[tuple, list[int]] = {}
    for number, params in enumerate(combos):
        same = tuple(sorted((k, v) for k, v in params.items() if k != "maxIter")) if name in BOOSTED else (number,)
        alike.setdefault(same, []).append(number)

    def measure(model: Model, held_out: DataFrame) -> float:
        scored = score_rows(model, held_out, target)
        # Either measure reads the scores once.
        if score == "f1":
            return classification_metrics(scored, inclusive=False).first()["f1"]
        return rank_metrics(scored).first()["average_precision"] or 0.0

    def try_out(numbers: list[int]) -> list[tuple[int, float]]:
        longest = max(numbers, key=lambda n: combos[n].get("maxIter", 0))
        sums = dict.fromkeys(numbers, 0.0)
        for rows, counts, bins, held_out in prepared:
            model = train(rows, name, target, strategy, seed, bins, counts, **combos[longest])
            for number in numbers:
                cut = model.cut(combos[number]["maxIter"]) if name in BOOSTED and "maxIter" in combos[number] else model
                sums[number] += measure(cut, held_out)
        return [(n, s / len(prepared)) for n, s in sums.items()]

    # Long fits first, and as many as there are slots: none begins when the others have ended.
    def work(numbers: list[int]) -> int:
        settings = {**PRESETS[name], **combos[numbers[0]]}
        rounds = max(combos[n].get("maxIter", settings.get("maxIter", 1)) for n in numbers)
        return rounds * settings.get("numLeaves", 1)

    groups = sorted(alike.values(), key=work, reverse=True)
    at_once = max(AT_ONCE, _slots(splits[0][0])) if name in BOOSTED else AT_ONCE
    found = dict(r for part in together([lambda n=n: try_out(n) for n in groups], at_once) for r in part)
    results = [(n, found[n], *[str(p[k]) for k in grid]) for n, p in enumerate(combos)]
    spark = splits[0][0].sparkSession
    schema = ", ".join(["trial INT", f"{score} DOUBLE", *[f"{k} STRING" for k in grid]])
    table = spark.createDataFrame(results, schema).orderBy(F.desc(score), "trial")
    if full is None:
        return table, None
    best = max(results, key=lambda r: (r[1], -r[0]))
    return table, train(matrix(encoder.fit(full).transform(full), target), name, target, strategy, seed, **combos[best[0]])


def fold_results(
    folds: list[tuple[DataFrame, DataFrame]], names: list[str], target: str = C.TARGET,
    overrides: dict[str, dict] | None = None, encoder: FeatureEncoder | None = None, seed: int = C.SEED,
) -> DataFrame:
    """One long table (fold, model, measures): encoders and models are fitted per fold.

    A fold whose training rows hold a single class is left out.
    """
    encoder = encoder or FeatureEncoder(target=target)

    def one(number: int, fit_rows: DataFrame, held_out: DataFrame) -> DataFrame | None:
        if 0 in class_counts(fit_rows, target):
            return None
        fitted = encoder.fit(fit_rows)
        models = train_all(fitted.transform(fit_rows), names, target, seed=seed, overrides=overrides)
        results = evaluate_all(models, materialize(fitted.transform(held_out)), target)
        return materialize(results.withColumn("fold", F.lit(number)))

    parts = together([lambda n=n, f=f: one(n, *f) for n, f in enumerate(folds, start=1)], FOLDS_AT_ONCE)
    rows = [p for p in parts if p is not None]
    if not rows:
        raise ValueError("no fold has both classes in its training rows")
    return reduce(DataFrame.unionByName, rows)


FOLD_MEASURES = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def fold_summary(results: DataFrame) -> DataFrame:
    return fold_means(results, FOLD_MEASURES)


def ratio_sweep(
    fit_rows: DataFrame, held_out: DataFrame, ratios: list[float], target: str = C.TARGET,
    name: str = "Random Forest", seed: int = C.SEED, calibrated: bool = False, **params,
) -> DataFrame:
    """Per ratio: undersample the encoded rows, fit without weights, and measure.

    ``calibrated`` maps the scores of every model with an isotonic fit on the training rows,
    since undersampling shifts probabilities.
    """
    def one(ratio: float) -> DataFrame:
        model = train(balance_data(fit_rows, target, ratio, seed), name, target, "undersample", seed, **params)
        scored = score_rows(model, held_out, target)
        if calibrated:
            scored = calibrate(materialize(score_rows(model, fit_rows, target)))(scored)
        return evaluate_scores(materialize(scored), name).withColumn("ratio", F.lit(float(ratio)))

    return reduce(DataFrame.unionByName, together([lambda r=r: one(r) for r in ratios], RATIOS_AT_ONCE))


def best_ratios(results: DataFrame) -> DataFrame:
    """Best ratio by F1, by G-mean and by trapezoid PR-AUC."""
    parts = [
        best_by(results, m, "ratio").select(F.lit(m).alias("measure"), "ratio", F.col(m).alias("value"))
        for m in ("f1", "g_mean", "pr_auc")
    ]
    return reduce(DataFrame.unionByName, parts)


def importances(model: Model, names: list[str]) -> list[tuple[str, float]]:
    """(feature, importance) of a tree model, or absolute coefficients of a linear one."""
    inner = model.stages[-1] if isinstance(model, PipelineModel) else model
    if hasattr(inner, "featureImportances"):
        values = inner.featureImportances.toArray()
    else:
        values = [abs(v) for v in inner.coefficients.toArray()]
    return list(zip(names, [float(v) for v in values], strict=True))
