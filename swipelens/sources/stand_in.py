"""A transaction table derived from the ``events`` stream and its customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.functions.scalars import is_night

TEST_STARTS = "2024-01-22"


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a card transaction; columns as in the raw transaction schema."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = spark.read.parquet(f"{folder}/region.parquet")
    place = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    customer = spark.read.parquet(f"{folder}/customer.parquet").join(
        F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return events.join(customer, F.col("user_id") == F.col("c_custkey")).selectExpr(
        "cast(event_id as string) as trans_num",
        "cast(user_id as string) as cc_num",
        "ts as trans_date_trans_time",
        "value as amt",
        "event_type as category",
        "concat('merch_', cast(event_id % 40 as string)) as merchant",
        "case when c_custkey % 2 = 0 then 'F' else 'M' end as gender",
        "c_mktsegment as job",
        "n_name as state",
        "r_name as city",
        "1000 + (c_custkey * 7919) % 100000 as city_pop",
        "date_add(date'1950-01-01', cast((c_custkey * 37) % 18000 as int)) as dob",
        "25 + ((c_custkey * 13) % 2400) / 1e2 + (event_id % 7) / 1e1 as lat",
        "-120 + ((c_custkey * 29) % 5000) / 1e2 + (event_id % 5) / 1e1 as long",
        "25 + ((c_custkey * 13) % 2400) / 1e2 + ((event_id * 17) % 201 - 100) / 1e2 as merch_lat",
        "-120 + ((c_custkey * 29) % 5000) / 1e2 + ((event_id * 31) % 201 - 100) / 1e2 as merch_long",
        "case when (value >= 150 and hour(ts) in (22,23,0,1,2,3)) or event_id % 211 = 0 "
        "then 1 else 0 end as is_fraud",
    )


def train_rows(txn: DataFrame) -> DataFrame:
    return txn.where(F.col(C.TIME) < F.lit(TEST_STARTS).cast("timestamp_ntz"))


def test_rows(txn: DataFrame) -> DataFrame:
    return txn.where(F.col(C.TIME) >= F.lit(TEST_STARTS).cast("timestamp_ntz"))


def scored(txn: DataFrame) -> DataFrame:
    """(trans_num, label, score, amt) under a fixed logistic score with real ties."""
    raw = 1 / (1 + F.exp(-(F.col("amt") * 0.02 + is_night(C.TIME) * 2 - 5)))
    return txn.select(
        C.ROW_ID, F.col(C.TARGET).alias("label"), F.round(raw, 4).alias("score"), C.AMOUNT
    )
