"""Encoders fitted on training rows and applied anywhere."""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.operators.quality import value_counts
from swipelens.operators.quantiles import medians
from swipelens.session import materialize
from swipelens.sizing import BROADCAST_BYTES, BROADCAST_ROWS

#: A column with more categories than this does not become one 0/1 column each.
ONE_HOT_LIMIT = 1_000


class TargetEncoderModel:
    """Fitted encodings: a table (column, value, encoding) and the global mean."""

    def __init__(self, columns: list[str], table: DataFrame, global_mean: float):
        self.columns, self.table, self.global_mean = columns, table, global_mean
        size = F.sum(F.octet_length("value").cast("bigint") + 24)
        counted = table.groupBy("column").agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).collect()
        self._small = {r["column"] for r in counted if r["n"] <= BROADCAST_ROWS and r["bytes"] <= BROADCAST_BYTES}

    def names(self) -> list[str]:
        return [f"{c}_target_enc" for c in self.columns]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add one encoding per column; an unseen or missing value gets the global mean.

        A column's table is broadcast if its counted rows and bytes are few; otherwise the lookup is
        an ordinary join, in which Spark splits hot categories at run time.
        """
        for column, name in zip(self.columns, self.names()):
            lookup = self.table.where(F.col("column") == column).select(
                F.col("value").alias("_value"), F.col("encoding").alias(name)
            )
            if column in self._small:
                lookup = F.broadcast(lookup)
            df = (
                df.join(lookup, F.col(column).cast("string") == F.col("_value"), "left")
                .drop("_value")
                .withColumn(name, F.coalesce(F.col(name), F.lit(self.global_mean)))
            )
        return df


class SmoothedTargetEncoder:
    """Mean target per category, drawn to the global mean for rare categories.

    The category's own mean gets the logistic weight 1 / (1 + exp(-(n - k) / f)) for n rows,
    ``min_samples_leaf`` k and ``smoothing`` f.
    """

    def __init__(
        self, columns: list[str], smoothing: float = C.ENCODING_SMOOTHING,
        min_samples_leaf: int = C.ENCODING_MIN_SAMPLES,
    ):
        self.columns, self.smoothing, self.min_samples_leaf = columns, smoothing, min_samples_leaf

    def get_feature_names_out(self) -> list[str]:
        return [f"{c}_target_enc" for c in self.columns]

    def statistics(self, df: DataFrame, target: str, global_mean: Column | float) -> DataFrame:
        """(column, value, n, encoding) for all columns, from one pass over the rows."""
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in self.columns]
        stats = (
            df.select(F.col(target).cast("double").alias("_y"), F.explode(F.array(*cells)).alias("_cell"))
            .where(F.col("_cell.value").isNotNull())
            .groupBy("_cell.column", "_cell.value")
            .agg(F.count("_y").alias("n"), F.avg("_y").alias("_mean"))
        )
        own = 1 / (1 + F.exp(-(F.col("n") - self.min_samples_leaf) / F.lit(float(self.smoothing))))
        prior = F.lit(global_mean) if not isinstance(global_mean, Column) else global_mean
        return stats.select("column", "value", "n", (prior + (F.col("_mean") - prior) * own).alias("encoding"))

    def fit(self, df: DataFrame, target: str = C.TARGET) -> TargetEncoderModel:
        mean = df.agg(F.avg(F.col(target).cast("double")).alias("m")).first()["m"]
        if mean is None:
            raise ValueError("the target encoder needs rows with a target")
        return TargetEncoderModel(self.columns, materialize(self.statistics(df, target, mean)), mean)


def one_hot_categories(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted categories per column; at most ONE_HOT_LIMIT of them. All columns share one pass."""
    return _categories(materialize(value_counts(df, columns).where("value is not null")), columns)


def _few(table: DataFrame, columns: list[str]) -> list[str]:
    """The columns of a table of (column, value) that have at most ONE_HOT_LIMIT values."""
    counts = table.where(F.col("column").isin(columns)).groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
    many = {r["column"] for r in counts if r["n"] > ONE_HOT_LIMIT}
    return [c for c in columns if c not in many]


def _categories(table: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted values of every column from a table of (column, value), in one bounded collect."""
    few = _few(table, columns)
    if few != list(columns):
        raise ValueError(f"{sorted(set(columns) - set(few))}: over {ONE_HOT_LIMIT} categories, name them in sparse instead")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in table.where(F.col("column").isin(columns)).select("column", "value").orderBy("column", "value").collect():
        found[r["column"]].append(r["value"])
    return found


def one_hot(categories: dict[str, list[str]]) -> dict[str, Column]:
    """One 0/1 column per known category; an unknown or missing value has none set."""
    return {
        f"{column}_{value}": F.when(F.col(column).cast("string") == value, 1.0).otherwise(0.0)
        for column, values in categories.items() for value in values
    }


def one_hot_vector(df: DataFrame, column: str, into: str) -> PipelineModel:
    """Sparse form for any number of categories; unknown values give an all-zero vector."""
    index = StringIndexer(
        inputCol=column, outputCol=f"{into}_index", handleInvalid="keep", stringOrderType="alphabetAsc"
    )
    return Pipeline(stages=[index, OneHotEncoder(inputCol=f"{into}_index", outputCol=into)]).fit(df)


def median_impute(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Fill missing values by the given medians, usually those of the training rows."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in values.items() if v is not None}
    )


def scale_statistics(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """(mean, population std) per column; a constant column is divided by 1."""
    row = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).first()
    return {c: (row[c]["m"] or 0.0, row[c]["s"] or 1.0) for c in columns}


def standard_scale(
    df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = ""
) -> DataFrame:
    """(x - mean) / std, in place or under names with a suffix such as ``_scaled``."""
    return df.withColumns(
        {f"{c}{suffix}": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()}
    )


class FeatureEncoderModel(Model):
    """Imputed and scaled numbers, pass-through numbers, 0/1 columns, target encodings."""

    def __init__(
        self, roles: dict, numeric: dict, categories: dict, targets: TargetEncoderModel,
        sparse: dict[str, PipelineModel] | None = None,
    ):
        super().__init__()
        self.roles, self.numeric, self.categories, self.targets = roles, numeric, categories, targets
        self.sparse = sparse or {}

    def dense_names(self) -> list[str]:
        return (
            self.roles["scaled"] + self.roles["passthrough"] + list(one_hot(self.categories))
            + self.targets.names()
        )

    def feature_names(self) -> list[str]:
        """Names of the vector's places; those of the sparse columns come last."""
        return self.dense_names() + [
            f"{column}_{label}" for column, model in self.sparse.items() for label in model.stages[0].labels
        ]

    def encode(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """The model matrix as columns, in the fixed order; every other column is dropped.

        ``keep`` names columns of the input to carry along, under their own names.
        """
        carried = {f"_keep_{c}": F.col(c) for c in keep or []}
        rows = self.targets.transform(df.withColumns(carried) if carried else df)
        for model in self.sparse.values():
            rows = model.transform(rows)
        scaled = {
            c: ((F.coalesce(F.col(c).cast("double"), F.lit(v["median"])) - F.lit(v["mean"])) / F.lit(v["std"]))
            for c, v in self.numeric.items()
        }
        columns = [scaled[c].alias(c) for c in self.roles["scaled"]]
        columns += [F.col(c).cast("double").alias(c) for c in self.roles["passthrough"]]
        columns += [v.alias(n) for n, v in one_hot(self.categories).items()]
        columns += [F.col(n) for n in self.targets.names()]
        columns += [F.col(f"{c}_onehot") for c in self.sparse]
        return rows.select(*[F.col(f"_keep_{c}").alias(c) for c in keep or []], *columns)

    def _transform(self, df: DataFrame) -> DataFrame:
        """Identifier, target and amount columns if present, plus the ``features`` vector."""
        keep = [c for c in self.roles["keep"] if c in df.columns and c not in self.feature_names()]
        inputs = self.dense_names() + [f"{c}_onehot" for c in self.sparse]
        assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
        return assembler.transform(self.encode(df, keep)).select(*keep, "features")

    def save(self, path: str) -> None:
        spark = self.targets.table.sparkSession
        self.targets.table.write.mode("overwrite").parquet(f"{path}/targets")
        state = json.dumps(
            {
                "roles": self.roles, "numeric": self.numeric, "categories": self.categories,
                "columns": self.targets.columns, "global_mean": self.targets.global_mean,
            }
        )
        spark.createDataFrame([(state,)], "state STRING").write.mode("overwrite").parquet(f"{path}/state")
        for column, model in self.sparse.items():
            model.write().overwrite().save(f"{path}/sparse/{column}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureEncoderModel":
        state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        table = spark.read.parquet(f"{path}/targets")
        targets = TargetEncoderModel(state["columns"], table, state["global_mean"])
        sparse = {c: PipelineModel.load(f"{path}/sparse/{c}") for c in state["roles"].get("sparse", [])}
        return cls(state["roles"], state["numeric"], state["categories"], targets, sparse)


class FeatureEncoder(Estimator):
    """Fits all encoders on training rows; usable as a stage of a Spark ML Pipeline.

    Columns in ``onehot`` become one 0/1 column per category; those in ``sparse``, and those with
    more than ``ONE_HOT_LIMIT`` categories, become one sparse vector each.
    """

    def __init__(
        self,
        scaled: list[str] | None = None,
        passthrough: list[str] | None = None,
        onehot: list[str] | None = None,
        encoded: list[str] | None = None,
        sparse: list[str] | None = None,
        target: str = C.TARGET,
        keep: list[str] | None = None,
        smoothing: float = C.ENCODING_SMOOTHING,
        min_samples_leaf: int = C.ENCODING_MIN_SAMPLES,
    ):
        super().__init__()
        self.roles = {
            "scaled": C.SCALED_COLUMNS if scaled is None else scaled,
            "passthrough": C.PASSTHROUGH_COLUMNS if passthrough is None else passthrough,
            "onehot": C.ONE_HOT_COLUMNS if onehot is None else onehot,
            "encoded": C.TARGET_ENCODED_COLUMNS if encoded is None else encoded,
            "sparse": sparse or [],
            "keep": [C.ROW_ID, target, C.AMOUNT] if keep is None else keep,
        }
        self.target = target
        self.targets = SmoothedTargetEncoder(self.roles["encoded"], smoothing, min_samples_leaf)

    def _fit(self, df: DataFrame) -> FeatureEncoderModel:
        scaled = self.roles["scaled"]
        middle = {c: 0.0 if v is None else v for c, v in medians(df, scaled).items()} if scaled else {}
        # One pass for means, spreads and the prior; one more for all categories and their labels.
        prior = "_prior"
        rows = median_impute(df.select(*scaled, F.col(self.target).cast("double").alias(prior)), middle)
        stats = scale_statistics(rows, [*scaled, prior])
        numeric = {c: {"median": middle[c], "mean": stats[c][0], "std": stats[c][1]} for c in scaled}
        onehot, encoded = self.roles["onehot"], self.roles["encoded"]
        both = SmoothedTargetEncoder([*encoded, *[c for c in onehot if c not in encoded]], self.targets.smoothing, self.targets.min_samples_leaf)
        table = materialize(both.statistics(df, self.target, stats[prior][0]))
        # Columns with too many categories for one column each become sparse vectors.
        few = _few(table, onehot)
        roles = {**self.roles, "onehot": few, "sparse": [*self.roles["sparse"], *[c for c in onehot if c not in few]]}
        categories = _categories(table, few)
        targets = TargetEncoderModel(encoded, table.where(F.col("column").isin(encoded)), stats[prior][0])
        sparse = {c: one_hot_vector(df, c, f"{c}_onehot") for c in roles["sparse"]}
        return FeatureEncoderModel(roles, numeric, categories, targets, sparse)


def out_of_fold_encode(
    df: DataFrame, folds: int, encoder: SmoothedTargetEncoder, target: str = C.TARGET,
    key: str = C.ROW_ID, seed: int = C.SEED,
) -> DataFrame:
    """Training rows encoded by the other folds only, so a row never sees its own label."""
    numbered = df.withColumn("_fold", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(folds)))
    parts = [
        encoder.fit(numbered.where(F.col("_fold") != k), target)
        .transform(numbered.where(F.col("_fold") == k))
        for k in range(folds)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.drop("_fold")
