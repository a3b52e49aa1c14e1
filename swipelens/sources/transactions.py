"""Reading and writing transaction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelens.functions.scalars import nan_to_null

# The raw transaction columns and their types.
TRANSACTION_TYPES = {
    "trans_date_trans_time": T.TimestampType(),
    "cc_num": T.StringType(),
    "merchant": T.StringType(),
    "category": T.StringType(),
    "amt": T.DoubleType(),
    "first": T.StringType(),
    "last": T.StringType(),
    "gender": T.StringType(),
    "street": T.StringType(),
    "city": T.StringType(),
    "state": T.StringType(),
    "zip": T.IntegerType(),
    "lat": T.DoubleType(),
    "long": T.DoubleType(),
    "city_pop": T.LongType(),
    "job": T.StringType(),
    "dob": T.DateType(),
    "trans_num": T.StringType(),
    "unix_time": T.LongType(),
    "merch_lat": T.DoubleType(),
    "merch_long": T.DoubleType(),
    "is_fraud": T.IntegerType(),
}
INDEX_COLUMNS = ["", "_c0", "Unnamed: 0"]


def read_transactions(
    spark: SparkSession, path: str, nrows: int | None = None, **options: str
) -> DataFrame:
    """Typed scan of a transaction CSV.

    Columns are matched to types by header name; an unknown column stays a string and an
    unnamed row-index column is dropped. A value that does not fit its type fails the read.
    """
    header = spark.read.options(**options).option("header", True).csv(path).columns
    schema = T.StructType(
        [T.StructField(name, TRANSACTION_TYPES.get(name, T.StringType())) for name in header]
    )
    rows = (
        spark.read.options(**options)
        .option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)
        .drop(*[name for name in header if name in INDEX_COLUMNS])
    )
    doubles = [f.name for f in rows.schema if isinstance(f.dataType, T.DoubleType)]
    rows = rows.withColumns({name: nan_to_null(name) for name in doubles})
    return rows if nrows is None else rows.limit(nrows)


def read_pair(
    spark: SparkSession, train_path: str, test_path: str, **options: str
) -> tuple[DataFrame, DataFrame]:
    """Train and test scans; they are never joined into one table before fitting."""
    return (
        read_transactions(spark, train_path, **options),
        read_transactions(spark, test_path, **options),
    )


def row_counts(train: DataFrame, test: DataFrame) -> DataFrame:
    return (
        train.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("part", F.lit("train"))
        .unionByName(test.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("part", F.lit("test")))
    )


def save_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A saved table. As on ingest from CSV, NaN is read as missing."""
    rows = spark.read.parquet(path)
    floats = [f.name for f in rows.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return rows.withColumns({name: nan_to_null(name) for name in floats}) if floats else rows


def save_report(df: DataFrame, path: str) -> None:
    """A metric, importance or trial table as CSV with a header in every part file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def load_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def save_matrix(df: DataFrame, path: str, features: list[str], target: str) -> None:
    """Model matrix plus its ordered feature list, as two tables under one folder."""
    df.select(*features, target).write.mode("overwrite").parquet(f"{path}/matrix")
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "position INT, feature STRING")
    names.write.mode("overwrite").parquet(f"{path}/features")


def load_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    names = spark.read.parquet(f"{path}/features").orderBy("position").collect()
    return spark.read.parquet(f"{path}/matrix"), [r["feature"] for r in names]
