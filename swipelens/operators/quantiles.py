"""Exact quantiles by linear interpolation, for any size of column."""

from __future__ import annotations

import math
from bisect import bisect_right
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelens.operators.ordering import INDEX, SEGMENT, ordered_segments

#: Counts, or rank totals, up to this many rows are matched on the driver.
DRIVER_ROWS = 100_000
#: Groups up to this many get a bracket per column and probability.
DRIVER_GROUPS = 1_000
#: The sketch places a value within 1 / SKETCH_ACCURACY of its rank; brackets are twice as wide.
SKETCH_ACCURACY = 10_000
RANK_MARGIN = 2.0 / SKETCH_ACCURACY


def long_form(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., column, value) with one row per cell, without nulls."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    return (
        df.select(*(by or []), F.explode(F.array(*pairs)).alias("_cell"))
        .select(*(by or []), "_cell.column", "_cell.value")
        .where(F.col("value").isNotNull())
    )


def _merged(bounds: list[float] | None) -> list[float]:
    """Low, high, low, high, ... of disjoint rising intervals."""
    flat: list[float] = []
    for low, high in sorted(zip(bounds[::2], bounds[1::2])) if bounds else []:
        if flat and low <= flat[-1]:
            flat[-1] = max(flat[-1], high)
        else:
            flat += [low, high]
    return flat


def _brackets(
    df: DataFrame, columns: list[str], probs: list[float], by: list[str]
) -> list[tuple] | None:
    """Per group: its key, and per column the value intervals around the wanted ranks.

    One sketch pass. None if there are too many groups to keep on the driver.
    """
    wide = [q for p in probs for q in (max(0.0, p - RANK_MARGIN), min(1.0, p + RANK_MARGIN))]
    sketches = [
        F.percentile_approx(F.col(c).cast("double"), wide, SKETCH_ACCURACY).alias(f"_b_{i}")
        for i, c in enumerate(columns)
    ]
    rows = df.groupBy(*by).agg(*sketches).limit(DRIVER_GROUPS + 1).collect()
    if len(rows) > DRIVER_GROUPS:
        return None
    return [(tuple(r)[:len(by)], [_merged(b) for b in tuple(r)[len(by):]]) for r in rows]


def _condensed_counts(df: DataFrame, columns: list[str], by: list[str], found: list[tuple]) -> DataFrame:
    """(by..., column, value, _n, _gap): one row per value near a wanted rank, and one row
    for all values between two such neighbourhoods, at the smallest of them.

    Only the neighbourhoods are shuffled value by value; everything else is summed on the
    map side.
    """
    width = max((len(b) for _, bounds in found for b in bounds), default=0)
    if by:
        padded = [(*key, *[b + [math.inf] * (width - len(b)) for b in bounds]) for key, bounds in found]
        schema = T.StructType([
            *[T.StructField(f"_g_{c}", df.schema[c].dataType) for c in by],
            *[T.StructField(f"_b_{i}", T.ArrayType(T.DoubleType())) for i in range(len(columns))],
        ])
        held = df.sparkSession.createDataFrame(padded, schema)
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by])
        # At most DRIVER_GROUPS rows.
        rows = df.select(*by, *columns).join(F.broadcast(held), same)
        edges = [[F.col(f"_b_{i}")[k] for k in range(width)] for i in range(len(columns))]
    else:
        rows = df.select(*columns)
        edges = [[F.lit(e) for e in bounds] for bounds in found[0][1]]

    def place(value: Column, marks: list[Column]) -> Column:
        """Marks passed so far: odd inside an interval, even between two."""
        passed = [(value > m if k % 2 else value >= m).cast("int") for k, m in enumerate(marks)]
        return reduce(Column.__add__, passed, F.lit(0))

    cells = [
        F.struct(
            F.lit(c).alias("column"), F.col(c).cast("double").alias("value"),
            place(F.col(c).cast("double"), marks).alias("_place"),
        )
        for c, marks in zip(columns, edges)
    ]
    near = F.when(F.col("_place") % 2 == 1, F.col("value"))
    return (
        rows.select(*by, F.explode(F.array(*cells)).alias("_cell")).select(*by, "_cell.*")
        .where(F.col("value").isNotNull())
        .groupBy(*by, "column", "_place", near.alias("_near"))
        .agg(F.min("value").alias("value"), F.count(F.lit(1)).alias("_n"))
        .select(*by, "column", "value", "_n", F.col("_near").isNull().alias("_gap"))
    )


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None
) -> DataFrame:
    """Rows (by..., column, prob, quantile).

    A sketch brackets each wanted rank, an exact count says how many values lie below the
    bracket, and only the values inside it are sorted. Should a rank fall outside its
    bracket, or should there be too many groups for the driver, all values are counted and
    sorted instead. No task sees a whole column in either case.
    """
    by = by or []
    brackets = _brackets(df, columns, probs, by)
    if brackets is not None:
        found = _ranked(df, _condensed_counts(df, columns, by, brackets), [*by, "column"], probs)
        if found is not None:
            return found
    counts = (
        long_form(df, columns, by).groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("_n")).withColumn("_gap", F.lit(False))
    )
    return _ranked(df, counts, [*by, "column"], probs)


def _read_off(rows: list, group: list[str], probs: list[float]) -> list[tuple] | None:
    """Quantiles of a few counted values; None if a rank falls into a gap."""
    parts: dict[tuple, list] = {}
    for r in sorted(rows, key=lambda r: r["value"]):
        parts.setdefault(tuple(r[c] for c in group), []).append(r)
    result = []
    for key, counted in parts.items():
        upto = list(accumulate(r["_n"] for r in counted))
        for p in probs:
            h = float(p) * (upto[-1] - 1)
            low, high = (counted[bisect_right(upto, rank)] for rank in (math.floor(h), math.ceil(h)))
            if low["_gap"] or high["_gap"]:
                return None
            share = h - math.floor(h)
            result.append((*key, float(p), low["value"] + (high["value"] - low["value"]) * share))
    return result


def _ranked(df: DataFrame, counts: DataFrame, group: list[str], probs: list[float]) -> DataFrame | None:
    """Quantiles from counted values; None if a rank falls into a gap.

    Few counts are read off directly. Many are sorted over the cluster; the totals per sort
    partition then tell which partitions hold a wanted rank, and only those are read again.
    """
    few = counts.limit(DRIVER_ROWS + 1).collect()
    if len(few) <= DRIVER_ROWS:
        result = _read_off(few, group, probs)
        schema = T.StructType([
            *[counts.schema[c] for c in group],
            T.StructField("prob", T.DoubleType()), T.StructField("quantile", T.DoubleType()),
        ])
        return None if result is None else df.sparkSession.createDataFrame(result, schema)
    segments = ordered_segments(counts, *group, "value")
    totals = segments.groupBy(SEGMENT, *group).agg(F.sum("_n").alias("_n"))
    # The sort groups equal keys, so there are at most (groups + sort partitions) totals.
    found = totals.limit(DRIVER_ROWS + 1).collect()
    if len(found) > DRIVER_ROWS:
        return _by_running_counts(segments, totals, group, probs)

    parts: dict[tuple, list[tuple[int, int]]] = {}
    for r in sorted(found, key=lambda r: r[SEGMENT]):
        parts.setdefault(tuple(r[c] for c in group), []).append((r[SEGMENT], r["_n"]))
    wanted = []
    for key, sizes in parts.items():
        rows = sum(n for _, n in sizes)
        for p in probs:
            h = float(p) * (rows - 1)
            for side, rank in ((0, math.floor(h)), (1, math.ceil(h))):
                before = 0
                for segment, n in sizes:
                    if before <= rank < before + n:
                        wanted.append((*key, segment, float(p), h - math.floor(h), side, rank - before))
                        break
                    before += n
    keys = [segments.schema[c] for c in group]
    extra = T.StructType.fromDDL("_s INT, prob DOUBLE, _share DOUBLE, _side INT, _rank BIGINT")
    target = df.sparkSession.createDataFrame(
        wanted, T.StructType([*[T.StructField(f"_g_{f.name}", f.dataType) for f in keys], *extra])
    )
    upto = F.sum("_n").over(
        Window.partitionBy(SEGMENT, *group).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, 0)
    )
    near = segments.where(F.col(SEGMENT).isin(sorted({w[len(group)] for w in wanted}))).withColumn("_upto", upto)
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group]
    # Two target rows per group and probability.
    hits = near.join(
        F.broadcast(target),
        reduce(Column.__and__, same, F.col(SEGMENT) == F.col("_s"))
        & (F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_n") <= F.col("_rank")),
    )
    low, high = (F.max(F.when(F.col("_side") == k, F.col("value"))) for k in (0, 1))
    result = hits.groupBy(*group, "prob").agg(
        (low + (high - low) * F.max("_share")).alias("quantile"), F.max("_gap").alias("_gap")
    )
    # One row per group, column and probability.
    rows = result.collect()
    if any(r["_gap"] for r in rows):
        return None
    return df.sparkSession.createDataFrame(rows, result.schema).drop("_gap")


def _by_running_counts(
    segments: DataFrame, totals: DataFrame, group: list[str], probs: list[float]
) -> DataFrame:
    """The same for any number of groups: ranks come from a table with a row per group."""
    span = Window.partitionBy(*group).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    # A group has as many totals as sort partitions it touches.
    begins = totals.select(
        SEGMENT, *group, F.coalesce(F.sum("_n").over(span), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("_rows"),
    )
    inside = Window.partitionBy(SEGMENT, *group).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [SEGMENT, *group]]
    upto = (
        segments.withColumn("_upto", F.sum("_n").over(inside)).alias("s")
        .join(begins.alias("b"), same)
        .select(*[f"s.{c}" for c in group], "value", "_n", (F.col("_upto") + F.col("_before")).alias("_upto"), "_rows")
    )
    near = (
        upto.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_h", F.col("prob") * (F.col("_rows") - 1))
        .withColumns({"_lo": F.floor("_h"), "_hi": F.ceil("_h"), "_first": F.col("_upto") - F.col("_n")})
        .where((F.col("_first") <= F.col("_hi")) & (F.col("_upto") > F.col("_lo")))
    )
    low = F.max(F.when((F.col("_first") <= F.col("_lo")) & (F.col("_upto") > F.col("_lo")), F.col("value")))
    high = F.max(F.when((F.col("_first") <= F.col("_hi")) & (F.col("_upto") > F.col("_hi")), F.col("value")))
    share = F.max(F.col("_h") - F.col("_lo"))
    return near.groupBy(*group, "prob").agg((low + (high - low) * share).alias("quantile"))


def quantile_values(df: DataFrame, column: str, probs: list[float]) -> dict[float, float | None]:
    """The same for one column, on the driver: one number per probability."""
    found = {r["prob"]: r["quantile"] for r in exact_quantiles(df, [column], probs).collect()}
    return {p: found.get(float(p)) for p in probs}


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact median per column; null where a column has no value."""
    rows = exact_quantiles(df, columns, [0.5]).collect()
    found = {r["column"]: r["quantile"] for r in rows}
    return {c: found.get(c) for c in columns}
