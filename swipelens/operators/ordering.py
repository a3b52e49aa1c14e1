"""Global order without a single task.

A window with no partition key runs in one task. These helpers number rows, cumulate sums
and find the row at a rank with range-partitioned sorts and small per-segment tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipelens.session import materialize

SEGMENT = "_segment"
INDEX = "_index"
POSITION = "_position"

#: Rows per block when bounded row windows run side by side.
BLOCK_ROWS = 1_000_000


def ordered_segments(df: DataFrame, *order: Column | str) -> DataFrame:
    """Sort once, globally, and keep where each row landed.

    The sort is range partitioned on sampled bounds over the whole order key, so neither a
    hot value nor a hot period ends up in one task. The table is written before it is read
    twice: sampled bounds may differ between two runs of one plan. ``order`` must be unique.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialize(
        df.orderBy(*order).withColumns({SEGMENT: F.spark_partition_id(), INDEX: within})
    )


def _carried(segments: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per segment, the totals of all earlier segments. One row per sort partition."""
    earlier = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    per_segment = segments.groupBy(SEGMENT).agg(*[c.alias(n) for n, c in totals.items()])
    carried = per_segment.select(
        SEGMENT, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in totals]
    )
    # One row per partition of the sort, whatever the data.
    return F.broadcast(carried)


def with_position(df: DataFrame, *order: Column | str, name: str = POSITION) -> DataFrame:
    """Exact 0-based global row position. ``order`` must be unique."""
    segments = ordered_segments(df, *order)
    offsets = _carried(segments, {"_offset": F.count(F.lit(1))})
    return (
        segments.join(offsets, SEGMENT)
        .withColumn(name, F.col("_offset") + F.col(INDEX))
        .drop(SEGMENT, INDEX, "_offset")
    )


def running_totals(df: DataFrame, order: list[Column | str], sums: dict[str, str]) -> DataFrame:
    """Add a running sum, own row included, for each ``new name: column`` in ``sums``."""
    segments = ordered_segments(df, *order)
    before = _carried(segments, {f"_before_{n}": F.sum(c) for n, c in sums.items()})
    inside = Window.partitionBy(SEGMENT).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, 0)
    return (
        segments.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
        .join(before, SEGMENT)
        .withColumns(
            {n: F.coalesce(F.col(n), F.lit(0)) + F.col(f"_before_{n}") for n in sums}
        )
        .drop(SEGMENT, INDEX, *[f"_before_{n}" for n in sums])
    )


def row_blocks(
    df: DataFrame, order: list[Column | str], before: int, after: int, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, Window]:
    """Cut a globally ordered table into blocks that overlap by a bounded row window.

    Each row goes to its own block and, near an edge, also to the neighbours whose frames
    reach it. Returns the rows with ``_block`` and ``_own``, and the window spec to use;
    keep the rows with ``_own`` once the window columns are computed.
    """
    numbered = with_position(df, *order)
    first = F.floor(F.greatest(F.col(POSITION) - after, F.lit(0)) / block_rows)
    last = F.floor((F.col(POSITION) + before) / block_rows)
    spread = numbered.withColumn("_block", F.explode(F.sequence(first, last))).withColumn(
        "_own", F.col("_block") == F.floor(F.col(POSITION) / block_rows)
    )
    return spread, Window.partitionBy("_block").orderBy(POSITION)


def rows_at(
    df: DataFrame, bucket: Column, order: list[Column], positions: dict[tuple, list[int]],
    by: list[str] | None = None,
) -> dict[tuple, dict[int, tuple]]:
    """Order keys of the rows at given 0-based positions, per group of ``by``.

    ``bucket`` must not decrease along ``order``. Pass one counts rows per bucket. Pass two
    sorts only the buckets that hold a wanted position. Rows never leave their files but
    for those buckets, and only the wanted keys reach the driver.
    """
    by = by or []
    names = [f"_k{i}" for i in range(len(order))]
    keyed = df.select(*by, bucket.alias("_bucket"), *[c.alias(n) for c, n in zip(order, names)])
    counts = keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.withColumn("_from", F.coalesce(F.sum("_n").over(along), F.lit(0)))

    def wanted(group: tuple) -> Column:
        inside = [
            (F.col("_from") <= p) & (F.col("_from") + F.col("_n") > p) for p in positions[group]
        ]
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, group)]
        return reduce(Column.__and__, same, reduce(Column.__or__, inside))

    asked = {g: p for g, p in positions.items() if p}
    if not asked:
        return {}
    # At most one bucket per wanted position.
    hits = spans.where(reduce(Column.__or__, [wanted(g) for g in asked])).collect()
    found: dict[tuple, dict[int, tuple]] = {g: {} for g in asked}
    if not hits:
        return found
    pieces = reduce(
        Column.__or__,
        [
            reduce(
                Column.__and__, [F.col(c).eqNullSafe(F.lit(h[c])) for c in by],
                F.col("_bucket").eqNullSafe(F.lit(h["_bucket"])),
            )
            for h in hits
        ],
    )
    numbered = with_position(keyed.where(pieces), *by, *names)
    # Positions restart inside each (group, bucket): find where each piece begins.
    begins = {
        tuple(r[c] for c in [*by, "_bucket"]): r["_p"]
        for r in numbered.groupBy(*by, "_bucket").agg(F.min(POSITION).alias("_p")).collect()
    }
    targets: dict[int, list[tuple[tuple, int]]] = {}
    for h in hits:
        group = tuple(h[c] for c in by)
        begin = begins[(*group, h["_bucket"])]
        for p in asked[group]:
            if h["_from"] <= p < h["_from"] + h["_n"]:
                targets.setdefault(begin + p - h["_from"], []).append((group, p))
    for r in numbered.where(F.col(POSITION).isin(list(targets))).collect():
        for group, p in targets[r[POSITION]]:
            found[group][p] = tuple(r[n] for n in names)
    return found


def precedes(order: list[Column], key: tuple, inclusive: bool = False) -> Column:
    """Row predicate: the order key of the row comes before ``key``."""
    result = F.lit(inclusive)
    for column, value in reversed(list(zip(order, key))):
        result = (column < F.lit(value)) | ((column == F.lit(value)) & result)
    return result
