"""Evaluation of scores on (key, label, score, amt) tables."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.operators.ordering import running_totals

# The default threshold grid, 0.01 to 0.99 in 99 even steps.
GRID_FIRST, GRID_LAST, GRID_SIZE = 0.01, 0.99, 99
DEFAULT_THRESHOLD = 0.5


def threshold_grid() -> list[float]:
    import numpy as np

    return [float(t) for t in np.linspace(GRID_FIRST, GRID_LAST, GRID_SIZE)]


def _ratio(top: Column, bottom: Column) -> Column:
    """0 when the denominator is 0."""
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def confusion_counts(df: DataFrame, predicted: Column, by: list[str] | None = None) -> DataFrame:
    label = F.col("label") == 1
    return df.groupBy(*(by or [])).agg(
        F.count_if(label & predicted).alias("tp"), F.count_if(~label & predicted).alias("fp"),
        F.count_if(~label & ~predicted).alias("tn"), F.count_if(label & ~predicted).alias("fn"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Rates from tp, fp, tn, fn; 0 on a zero denominator."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    rows = tp + fp + tn + fn
    recall = _ratio(tp, tp + fn)
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, rows),
            "precision": _ratio(tp, tp + fp),
            "recall": recall,
            "f1": _ratio(tp * 2, tp * 2 + fp + fn),
            "false_positive_rate": _ratio(fp, fp + tn),
            "g_mean": F.sqrt(recall * _ratio(tn, tn + fp)),
            "prevalence": _ratio(tp + fn, rows),
        }
    )


def classification_metrics(
    df: DataFrame, threshold: float = DEFAULT_THRESHOLD, inclusive: bool = True,
    by: list[str] | None = None,
) -> DataFrame:
    """Confusion counts and rates at one threshold, from one aggregation."""
    predicted = F.col("score") >= threshold if inclusive else F.col("score") > threshold
    return with_rates(confusion_counts(df, predicted, by))


def rank_points(df: DataFrame) -> DataFrame:
    """ROC and precision-recall points, one per distinct score, from the highest down.

    Equal scores are one point. Rows are counted per score before the sort, and the running
    counts come from range-partitioned segments.
    """
    counts = df.groupBy("score").agg(
        F.sum(F.col("label").cast("bigint")).alias("_pos"),
        F.sum(1 - F.col("label").cast("bigint")).alias("_neg"),
    )
    points = running_totals(counts, [F.desc("score")], {"tp": "_pos", "fp": "_neg"})
    totals = points.agg(F.sum("_pos").alias("p"), F.sum("_neg").alias("n")).first()
    positives, negatives = totals["p"] or 0, totals["n"] or 0

    def share(part: Column, whole: int) -> Column:
        return part / F.lit(float(whole)) if whole else F.lit(None).cast("double")

    return points.select(
        "score", "tp", "fp", "_pos", "_neg",
        share(F.col("tp"), positives).alias("tpr"),
        share(F.col("fp"), negatives).alias("fpr"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.lit(positives).cast("bigint").alias("_positives"),
        F.lit(negatives).cast("bigint").alias("_negatives"),
    )


def rank_metrics(df: DataFrame, target_fpr: float = C.FPR_TARGET) -> DataFrame:
    """ROC-AUC, trapezoid PR-AUC, average precision, and recall at a false-positive rate.

    The running counts before a point are its own counts less its own rows, so the areas
    need no second ordering. The PR curve starts at recall 0, precision 1.
    """
    points = rank_points(df)
    p, n = F.max("_positives"), F.max("_negatives")
    tp, fp = F.col("tp"), F.col("fp")
    tp0, fp0 = tp - F.col("_pos"), fp - F.col("_neg")
    precision0 = F.coalesce(tp0 / F.nullif(tp0 + fp0, F.lit(0)), F.lit(1.0))
    below = F.col("fpr") <= target_fpr
    corner = F.struct("fpr", "tpr")
    lower = F.coalesce(
        F.max(F.when(below, corner)), F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    )
    upper = F.min(F.when(~below, corner))
    slope = (upper["tpr"] - lower["tpr"]) / F.nullif(upper["fpr"] - lower["fpr"], F.lit(0.0))
    both = F.nullif(p * n, F.lit(0))
    return points.agg(
        (F.sum(F.col("_neg") * (tp + tp0) / 2) / both).alias("roc_auc"),
        (F.sum(F.col("_pos") * (F.col("precision") + precision0) / 2) / F.nullif(p, F.lit(0))).alias("pr_auc"),
        (F.sum(F.col("_pos") * F.col("precision")) / F.nullif(p, F.lit(0))).alias("average_precision"),
        F.when(both.isNotNull(), lower["tpr"] + F.coalesce(slope * (target_fpr - lower["fpr"]), F.lit(0.0)))
        .alias("recall_at_fpr"),
    )


def evaluate_scores(
    df: DataFrame, model: str, target_fpr: float = C.FPR_TARGET, inclusive: bool = False
) -> DataFrame:
    """One row of counts, rates and curve measures for a named model.

    A score of exactly 0.5 is predicted as class 0, as a classifier's own prediction is.
    """
    left = classification_metrics(df, inclusive=inclusive)
    right = rank_metrics(df, target_fpr)
    return _beside(left.select(F.lit(model).alias("model"), "*"), right)


def _beside(left: DataFrame, one_row: DataFrame) -> DataFrame:
    """The values of a one-row table next to every row of another."""
    row = one_row.first()
    return left.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in one_row.schema})


# Cost


def cost_curve(
    df: DataFrame, cost_fp: float = C.FALSE_ALARM_COST, thresholds: list[float] | None = None
) -> DataFrame:
    """(threshold, cost): missed amounts plus ``cost_fp`` per false alarm.

    Each row is counted once, in the bucket between two thresholds; the costs of all
    thresholds follow from sums over the buckets.
    """
    thresholds = threshold_grid() if thresholds is None else thresholds
    order = sorted(set(thresholds))
    # Bucketizer wants at least three splits; bucket i holds scores that pass i thresholds.
    splits = [-float("inf"), *order, float("inf")]
    buckets = (
        Bucketizer(splits=splits, inputCol="score", outputCol="_bucket")
        .transform(df.select(F.col("score").cast("double"), "label", "amt"))
        .groupBy(F.col("_bucket").cast("int").alias("_bucket"))
        .agg(
            F.sum(F.when(F.col("label") == 1, F.col("amt")).otherwise(0.0)).alias("_missed"),
            F.count_if(F.col("label") == 0).alias("_alarms"),
        )
    )
    # From here on there is one row per bucket, then one per threshold.
    grid = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(order)]
    )
    sides = buckets.agg(F.collect_list(F.struct("_bucket", "_missed", "_alarms")).alias("_all"))
    costs = F.transform(
        F.array_sort("_all"),
        lambda b: F.when(b["_bucket"] <= F.col("_at.i"), b["_missed"]).otherwise(
            b["_alarms"] * float(cost_fp)
        ),
    )
    return sides.select("_all", F.explode(grid).alias("_at")).select(
        "_at.threshold", F.aggregate(costs, F.lit(0.0), lambda a, b: a + b).alias("cost")
    )


def cost_threshold(
    df: DataFrame, cost_fp: float = C.FALSE_ALARM_COST, thresholds: list[float] | None = None
) -> DataFrame:
    """Cheapest threshold (the first of equals), its cost, the cost at 0.5, and the saving."""
    thresholds = threshold_grid() if thresholds is None else list(thresholds)
    curve = cost_curve(df, cost_fp, [*thresholds, DEFAULT_THRESHOLD])
    wanted = F.when(F.col("threshold").isin(thresholds), F.struct("cost", "threshold"))
    best = F.min(wanted)
    default = F.max(F.when(F.col("threshold") == DEFAULT_THRESHOLD, F.col("cost")))
    return curve.agg(
        best["threshold"].alias("optimal_threshold"), best["cost"].alias("optimal_cost"),
        default.alias("default_threshold_cost"), (default - best["cost"]).alias("estimated_savings"),
    )


def confusion_by_threshold(df: DataFrame, thresholds: list[float]) -> DataFrame:
    """(threshold, tp, fp, tn, fn) for several thresholds, in one pass."""
    cells = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            F.count_if((F.col("label") == 1) & (F.col("score") >= t)).alias("tp"),
            F.count_if((F.col("label") == 0) & (F.col("score") >= t)).alias("fp"),
            F.count_if((F.col("label") == 0) & (F.col("score") < t)).alias("tn"),
            F.count_if((F.col("label") == 1) & (F.col("score") < t)).alias("fn"),
        )
        for t in thresholds
    ]
    return df.agg(F.array(*cells).alias("_cells")).select(F.explode("_cells").alias("_c")).select("_c.*")


def cost_scenarios(
    results: DataFrame, key: str, weights: list[float] | None = None
) -> DataFrame:
    """Cheapest row per scenario, when a miss costs ``weight`` and a false alarm costs 1.

    ``results`` holds one row per model, ratio or threshold, with fn and fp.
    """
    weights = C.COST_SCENARIO_WEIGHTS if weights is None else weights
    costed = results.withColumn("fn_weight", F.explode(F.array(*[F.lit(w) for w in weights]))).withColumn(
        "cost", F.col("fn") * F.col("fn_weight") + F.col("fp")
    )
    best = F.min(F.struct("cost", key))
    return costed.groupBy("fn_weight").agg(best[key].alias(f"best_{key}"), best["cost"].alias("best_cost"))


# Reports over models


def best_by(results: DataFrame, measure: str, key: str = "model") -> DataFrame:
    """The row with the largest measure; ties by key."""
    return results.orderBy(F.desc_nulls_last(measure), key).limit(1)


def best_model_summary(
    results: DataFrame, scores: dict[str, DataFrame], cost_fp: float = C.FALSE_ALARM_COST
) -> DataFrame:
    """Best model by trapezoid PR-AUC with its cost threshold, as one row."""
    best = best_by(results, "pr_auc").first()
    row = results.sparkSession.createDataFrame([best], results.schema)
    cost = cost_threshold(scores[best["model"]], cost_fp)
    shown = row.select("model", "average_precision", "pr_auc", "roc_auc", "precision", "recall", "f1")
    return _beside(shown, cost)


def fold_means(results: DataFrame, measures: list[str], key: str = "model") -> DataFrame:
    """Mean of each measure per model over its folds, highest mean F1 first."""
    return results.groupBy(key).agg(*[F.avg(m).alias(m) for m in measures]).orderBy(F.desc("f1"), key)


def importance_table(spark, names: list[str], values: list[float], top: int | None = 25) -> DataFrame:
    """(feature, importance, pct) in falling order; one row per model column."""
    rows = spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values, strict=True)], "feature STRING, importance DOUBLE"
    )
    total = sum(float(v) for v in values)
    rows = rows.withColumn("pct", F.col("importance") * (100.0 / total) if total else F.lit(0.0))
    ordered = rows.orderBy(F.desc("importance"), "feature")
    return ordered if top is None else ordered.limit(top)
