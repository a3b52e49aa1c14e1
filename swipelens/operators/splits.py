"""Time-ordered splits, exact seeded samples and class balancing.

None of these sorts or shuffles the table. The order key of the row at each cut is found
first; the split is then a row predicate.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.functions.scalars import micros
from swipelens.operators.ordering import precedes, rows_at, with_position
from swipelens.session import materialize
from swipelens.sizing import broadcast_if_small

#: Hex digits of the digest that form a bucket: 65,536 even buckets.
DIGEST_PREFIX = 4
HOUR_MICROS = 3_600_000_000
#: Up to so many classes a stratified split is one predicate; their sizes reach the driver.
MAX_STRATA = 1_000


def time_order(time: str = C.TIME, tie: str = C.ROW_ID) -> list[Column]:
    return [micros(time), F.col(tie)]


def _time_cuts(df: DataFrame, positions: list[int], order: list[Column]) -> dict[int, tuple]:
    bucket = F.floor(order[0] / HOUR_MICROS)
    return rows_at(df, bucket, order, {(): sorted(set(positions))}).get((), {})


def _block_number(df: DataFrame, starts: list[int], order: list[Column]) -> Column:
    """How many of the cut positions lie at or before the row."""
    cuts = _time_cuts(df, [s for s in starts if s > 0], order)
    passed = [
        F.lit(1) if s <= 0
        else F.when(precedes(order, cuts[s]), 0).otherwise(1) if s in cuts else F.lit(0)
        for s in starts
    ]
    return reduce(Column.__add__, passed)


def time_based_split(
    df: DataFrame, val_fraction: float, time: str = C.TIME, tie: str = C.ROW_ID
) -> tuple[DataFrame, DataFrame]:
    """The first ``int(n * (1 - f))`` rows by time, and the rest."""
    order = time_order(time, tie)
    at = int(df.count() * (1 - val_fraction))
    late = _block_number(df, [at], order) == 1
    return df.where(~late), df.where(late)


def time_series_folds(
    df: DataFrame, n_splits: int = 5, test_size: int | None = None,
    time: str = C.TIME, tie: str = C.ROW_ID,
) -> DataFrame:
    """Add ``test_fold``: 0 for rows that are never tested, else 1..n_splits.

    Test blocks of equal size lie at the end; fold k trains on every row before its block,
    that is on ``test_fold < k``.
    """
    n = df.count()
    size = n // (n_splits + 1) if test_size is None else test_size
    if size < 1 or n_splits * size >= n:
        raise ValueError(f"{n_splits} test blocks of {size} rows leave no training row of {n}")
    starts = [n - (n_splits - k) * size for k in range(n_splits)]
    return df.withColumn("test_fold", _block_number(df, starts, time_order(time, tie)))


def fold(df: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of expanding fold ``k``."""
    return df.where(F.col("test_fold") < k), df.where(F.col("test_fold") == k)


def block_folds(
    df: DataFrame, n_splits: int = 5, test_size: float = 0.2, time: str = C.TIME, tie: str = C.ROW_ID
) -> DataFrame:
    """Add ``test_block`` 1..n_splits; block k is tested by a model of all other rows.

    The last block takes the remainder. The training rows include later ones, so this is
    not a walk-forward scheme. Rows past a last block that ends early do not occur.
    """
    size = int(df.count() * test_size)
    starts = [k * size for k in range(n_splits)]
    return df.withColumn("test_block", _block_number(df, starts, time_order(time, tie)))


def without_block(df: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of block fold ``k``."""
    return df.where(F.col("test_block") != k), df.where(F.col("test_block") == k)


def _digest(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def _digest_order(seed: int, key: str) -> list[Column]:
    return [_digest(seed, key), F.col(key)]


def exact_sample(df: DataFrame, n: int, seed: int = C.SEED, key: str = C.ROW_ID) -> DataFrame:
    """``n`` rows without replacement, the same for the same seed; all rows if fewer."""
    order = _digest_order(seed, key)
    if n <= 0:
        return df.where(F.lit(False))
    cut = rows_at(df, F.substring(order[0], 1, DIGEST_PREFIX), order, {(): [n]}).get((), {})
    return df if n not in cut else df.where(precedes(order, cut[n]))


def shuffled(df: DataFrame, seed: int = C.SEED, key: str = C.ROW_ID) -> DataFrame:
    """Rows in seeded random order: one range-partitioned sort on the digest."""
    return df.orderBy(*_digest_order(seed, key))


def _numbered_split(df: DataFrame, test_fraction: float, by: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    numbered = with_position(df, F.col(by).isNull(), F.col(by), *order, name="_place")
    shares = numbered.groupBy(F.col(by).alias("_by")).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    shares = materialize(shares.withColumn("_cut", F.col("_first") + F.col("_n") - F.ceil(F.col("_n") * test_fraction)))
    placed = numbered.join(broadcast_if_small(shares), F.col(by).eqNullSafe(F.col("_by")))
    train = F.col("_place") < F.col("_cut")
    return tuple(placed.where(side).select(*df.columns) for side in (train, ~train))


def stratified_split(
    df: DataFrame, test_fraction: float = 0.2, by: str = C.TARGET, seed: int = C.SEED, key: str = C.ROW_ID
) -> tuple[DataFrame, DataFrame]:
    """Seeded random split with ``ceil(fraction * n)`` test rows inside each class.

    Up to ``MAX_STRATA`` classes the split is a predicate on the rows. With more, rows are
    numbered by one range-partitioned sort over (class, digest) and compared with their
    class's share; the result is the same.
    """
    order = _digest_order(seed, key)
    strata = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    counted = strata.limit(MAX_STRATA + 1).collect()
    if len(counted) > MAX_STRATA:
        return _numbered_split(df, test_fraction, by, order)
    sizes = {(r[0],): r["n"] for r in counted}
    kept = {g: n - math.ceil(n * test_fraction) for g, n in sizes.items()}
    cuts = rows_at(df, F.substring(order[0], 1, DIGEST_PREFIX), order, {g: [k] for g, k in kept.items()}, [by])
    train = F.lit(False)
    for group, k in kept.items():
        same = F.col(by).eqNullSafe(F.lit(group[0]))
        found = cuts[group].get(k)
        train = F.when(same, precedes(order, found) if found else F.lit(True)).otherwise(train)
    return df.where(train), df.where(~train)


def balance_data(
    df: DataFrame, target: str = C.TARGET, ratio: float = C.UNDERSAMPLE_RATIO, seed: int = C.SEED,
    key: str = C.ROW_ID,
) -> DataFrame:
    """All positives and ``min(positives * ratio, negatives)`` sampled negatives."""
    positives = df.where(F.col(target) == 1)
    wanted = int(positives.count() * ratio)
    return positives.unionByName(exact_sample(df.where(F.col(target) == 0), wanted, seed, key))


def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """Rows with the largest ``by``; ties by key."""
    return df.orderBy(F.desc(by), tie).limit(n)


def union_all(*tables: DataFrame) -> DataFrame:
    """Stack tables with the same columns."""
    return reduce(DataFrame.unionByName, tables)


def distinct_sorted(df: DataFrame, column: str, start: object) -> DataFrame:
    """Sorted distinct values from a reference value on."""
    return df.where(F.col(column) >= F.lit(start)).select(column).distinct().orderBy(column)
