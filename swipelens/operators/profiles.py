"""Aggregations that describe a transaction table."""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.functions.scalars import correlation
from swipelens.operators.ordering import running_totals, with_position
from swipelens.operators.quality import unpivot, value_counts
from swipelens.operators.quantiles import exact_quantiles, quantile_values
from swipelens.session import materialize
from swipelens.sizing import broadcast_if_small

# Labels of the category report.
OTHER_LABEL = "Outros"
MISSING_LABEL = "Faltante"
QUARTILES = [0.25, 0.5, 0.75]


def amount_by_class(df: DataFrame, target: str = C.TARGET, amount: str = C.AMOUNT) -> DataFrame:
    """Mean and exact median amount per class."""
    means = df.groupBy(target).agg(F.avg(amount).alias("mean_amt"))
    middle = exact_quantiles(df, [amount], [0.5], by=[target]).select(
        target, F.col("quantile").alias("median_amt")
    )
    return means.join(broadcast_if_small(middle), target)


def fraud_value_share(*parts: DataFrame, target: str = C.TARGET, amount: str = C.AMOUNT) -> DataFrame:
    """Fraud amount per million of the total amount, over all parts."""
    rows = parts[0].select(target, amount)
    for part in parts[1:]:
        rows = rows.unionByName(part.select(target, amount))
    fraud = F.sum(F.when(F.col(target) == 1, F.col(amount)).otherwise(0.0))
    return rows.agg((fraud / F.nullif(F.sum(amount), F.lit(0.0)) * 1e6).alias("fraud_per_million"))


def class_distribution(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Count, share and ratio of the larger class to each class."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(1))
    return counts.select(
        target, "n",
        (F.col("n") * 100.0 / F.sum("n").over(every)).alias("pct"),
        (F.max("n").over(every) / F.col("n")).alias("ratio_to_largest"),
    )


def fraud_rate_by(df: DataFrame, key: str, target: str = C.TARGET, top: int | None = 15) -> DataFrame:
    """Rows and fraud rate in percent per key, highest rate first."""
    rates = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), (F.avg(target) * 100).alias("fraud_rate_pct")
    )
    ordered = rates.orderBy(F.desc("fraud_rate_pct"), F.desc("n"), key)
    return ordered if top is None else ordered.limit(top)


def describe_numeric(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max; one row per column and group."""
    by = by or []
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    totals = df.groupBy(*by).agg(F.array(*cells).alias("_cells"))
    basic = totals.select(*by, F.explode("_cells").alias("_cell")).select(*by, "_cell.*")
    quartiles = (
        exact_quantiles(df, columns, QUARTILES, by)
        .groupBy(*by, "column")
        .agg(
            *[
                F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                for p, n in zip(QUARTILES, ["q25", "q50", "q75"])
            ]
        )
    )
    # Without groups there is one row per column.
    quartiles = broadcast_if_small(quartiles) if by else F.broadcast(quartiles)
    return basic.join(quartiles, [*by, "column"], "left")


def describe_categorical(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values, most frequent value (ties: smallest) and its frequency."""
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    first = F.min(F.struct((-F.col("n")).alias("minus"), "value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_unique"),
        first["value"].alias("top"), (-first["minus"]).alias("freq"),
    )


def histogram_by_class(
    df: DataFrame, column: str, by: str = C.TARGET, bins: int = 50, upper: float | None = None
) -> DataFrame:
    """Equal bins over the joint range, and the density inside each class.

    ``upper`` leaves out larger values. Each row also carries the class mean.
    """
    rows = df.where(F.col(column).isNotNull())
    if upper is not None:
        rows = rows.where(F.col(column) <= upper)
    edge = rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    lo, hi = edge["lo"], edge["hi"]
    if lo is not None and lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = None if lo is None else (float(hi) - float(lo)) / bins
    place = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    counts = rows.groupBy(by, place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(column).alias("_sum")
    )
    # At most ``bins`` rows per class.
    whole = Window.partitionBy(by)
    return counts.select(
        by, "bin", "n",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
        (F.col("n") / (F.sum("n").over(whole) * F.lit(width))).alias("density"),
        (F.sum("_sum").over(whole) / F.sum("n").over(whole)).alias("class_mean"),
    )


def digit_distribution(df: DataFrame, digit: str, target: str = C.TARGET) -> DataFrame:
    """Share of each digit per class in percent, next to Benford's law for digits 1..9."""
    counts = df.groupBy(digit).pivot(target, [0, 1]).agg(F.count(F.lit(1)))
    every = Window.partitionBy(F.lit(1))

    def share(label: str) -> Column:
        n = F.coalesce(F.col(label), F.lit(0))
        return n * 100.0 / F.nullif(F.sum(n).over(every), F.lit(0))

    benford = F.when(F.col(digit) > 0, F.log10(1 + 1 / F.nullif(F.col(digit), F.lit(0))) * 100)
    return counts.where(F.col(digit).isNotNull()).select(
        digit, share("0").alias("pct_legit"), share("1").alias("pct_fraud"),
        benford.alias("pct_benford"),
    )


def row_normalised_crosstab(df: DataFrame, row: str, target: str = C.TARGET) -> DataFrame:
    """Share of each class inside each row value, in percent."""
    share = [
        (F.count_if(F.col(target) == k) * 100.0 / F.count(F.lit(1))).alias(n)
        for k, n in ((0, "pct_legit"), (1, "pct_fraud"))
    ]
    return df.groupBy(row).agg(F.count(F.lit(1)).alias("n"), *share)


# Correlations


def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]


def correlation_pairs(
    df: DataFrame, columns: list[str], chunk: int = 100, nulls: dict[str, int] | None = None
) -> DataFrame:
    """(column_a, column_b, corr) for each unordered pair; Pearson over complete pairs.

    Columns without missing values share one pass of Spark's vector correlation. Pairs with
    a missing value on either side are aggregated pair by pair, in chunks that keep an
    aggregation buffer small. ``nulls``: missing values per column, if they are known.
    """
    spark = df.sparkSession
    cast = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if nulls is None:
        nulls = cast.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    full = [c for c in columns if nulls[c] == 0]
    found = []
    if len(full) > 1:
        vectors = VectorAssembler(inputCols=full, outputCol="_v").transform(cast).select("_v")
        matrix = Correlation.corr(vectors, "_v").first()[0].toArray()
        at = {c: i for i, c in enumerate(full)}
        cells = [
            (a, b, None if math.isnan(matrix[at[a], at[b]]) else float(matrix[at[a], at[b]]))
            for a, b in _pairs(full)
        ]
        found.append(spark.createDataFrame(cells, "column_a STRING, column_b STRING, corr DOUBLE"))
    rest = [(a, b) for a, b in _pairs(columns) if nulls[a] or nulls[b]]
    for start in range(0, len(rest), chunk):
        cells = [
            F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), correlation(a, b).alias("corr"))
            for a, b in rest[start:start + chunk]
        ]
        found.append(
            cast.agg(F.array(*cells).alias("_cells")).select(F.explode("_cells").alias("_cell")).select("_cell.*")
        )
    return reduce(DataFrame.unionByName, found)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Full matrix in long form: both orders of each pair and the diagonal."""
    # Missing values and spread of all columns in one pass.
    state = df.agg(
        *[F.struct(F.count_if(F.col(c).isNull()).alias("nulls"), (F.min(c) < F.max(c)).alias("spread")).alias(c) for c in columns]
    ).first()
    pairs = correlation_pairs(df, columns, nulls={c: state[c]["nulls"] for c in columns})
    flipped = pairs.select(
        F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "corr"
    )
    diagonal = df.sparkSession.createDataFrame(
        [(c, c, 1.0 if state[c]["spread"] else None) for c in columns], pairs.schema
    )
    return pairs.unionByName(flipped).unionByName(diagonal)


def target_correlations(df: DataFrame, columns: list[str], target: str = C.TARGET) -> DataFrame:
    """Correlation of each column with the target, highest first."""
    totals = df.agg(*[correlation(c, target).alias(c) for c in columns])
    return unpivot(totals, columns, "column", "corr").orderBy(F.desc("corr"), "column")


def _average_ranks(pairs: DataFrame, column: str) -> DataFrame:
    """Average rank of each distinct value; equal values are counted before the sort."""
    counts = pairs.groupBy(column).agg(F.sum("_n").alias("_m"))
    ranked = running_totals(counts, [column], {"_upto": "_m"})
    return ranked.select(column, (F.col("_upto") - (F.col("_m") - 1) / 2).alias(f"_rank_{column}"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman correlation with average ranks for ties, over complete pairs."""
    pairs = materialize(
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(x, y).agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = pairs
    for column in (x, y):
        ranked = ranked.join(broadcast_if_small(_average_ranks(pairs, column)), column)
    n = F.col("_n")
    rows = pairs.agg(F.sum("_n").alias("rows")).first()["rows"] or 0
    dx, dy = (F.col(f"_rank_{c}") - (rows + 1) / 2.0 for c in (x, y))
    return ranked.agg(
        (F.sum(n * dx * dy) / F.nullif(F.sqrt(F.sum(n * dx * dx) * F.sum(n * dy * dy)), F.lit(0.0))).alias("spearman")
    )


def kendall_tau_b(df: DataFrame, x: str, y: str) -> DataFrame:
    """Kendall's tau-b of two columns with any number of distinct values.

    Rows are reduced to cell counts. Two cells whose y differ agree on their higher rank bits
    and part at one bit, so the pairs of each bit are counted apart: inside the cells with
    equal higher bits, those with the bit set meet those without it on smaller x and on
    larger x. Running sums over one range-partitioned sort give both; no pair is formed, and
    the plan does not grow with the values.
    """
    cells = materialize(
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = with_position(cells.select("_y").distinct(), "_y", name="_rank")
    bits = max(1, (cells.select("_y").distinct().count() - 1).bit_length())
    by_bit = (
        cells.join(broadcast_if_small(ranked), "_y")
        .withColumn("_bit", F.explode(F.sequence(F.lit(0), F.lit(bits - 1))))
        .groupBy("_bit", F.expr("shiftright(_rank, _bit + 1)").alias("_high"), "_x").agg(
            F.sum(F.when(F.expr("shiftright(_rank, _bit) & 1") == 0, F.col("_n")).otherwise(0)).alias("_zeros"),
            F.sum(F.when(F.expr("shiftright(_rank, _bit) & 1") == 1, F.col("_n")).otherwise(0)).alias("_ones"),
        )
    )
    group = ["_bit", "_high"]
    by_bit = materialize(by_bit)
    starts = running_totals(by_bit.groupBy(*group).agg(F.sum("_zeros").alias("_all")), group, {"_end": "_all"})
    summed = running_totals(by_bit, [*group, "_x"], {"_through": "_zeros"}).join(broadcast_if_small(starts), group)
    big = "decimal(19,0)"
    # Zeros on smaller x less zeros on larger x, within the group.
    before = F.col("_through") - F.col("_zeros") - (F.col("_end") - F.col("_all"))
    net = 2 * before + F.col("_zeros") - F.col("_all")

    def pairs(n: str) -> Column:
        return F.sum(F.col(n).cast(big) * (F.col(n) - 1).cast(big)) / 2

    balance = summed.agg(F.sum(F.col("_ones").cast(big) * net.cast(big)).alias("_balance"))
    parts = [
        balance,
        cells.agg(F.sum("_n").alias("_n")).agg(pairs("_n").alias("_every")),
        cells.groupBy("_x").agg(F.sum("_n").alias("_n")).agg(pairs("_n").alias("_tied_x")),
        cells.groupBy("_y").agg(F.sum("_n").alias("_n")).agg(pairs("_n").alias("_tied_y")),
    ]
    # Four one-row tables, put side by side by adding up their columns.
    names = ["_balance", "_every", "_tied_x", "_tied_y"]
    lined = reduce(
        DataFrame.unionByName,
        [part.select(*[(F.col(n) if n == own else F.lit(None)).cast("double").alias(n) for n in names]) for own, part in zip(names, parts)],
    )
    sums = {n: F.sum(n) for n in names}
    return lined.agg(
        (
            sums["_balance"]
            / F.nullif(F.sqrt((sums["_every"] - sums["_tied_x"]) * (sums["_every"] - sums["_tied_y"])), F.lit(0.0))
        ).alias("kendall_tau_b")
    )


def drop_collinear(df: DataFrame, columns: list[str], threshold: float = 0.9) -> list[str]:
    """Columns kept after dropping, for each kept column, its earlier strong partners."""
    strength = {
        (r["column_a"], r["column_b"]): abs(r["corr"])
        for r in correlation_pairs(df, columns).where(F.col("corr").isNotNull()).collect()
        if r["corr"] == r["corr"]
    }
    dropped: set[str] = set()
    for at, column in enumerate(columns):
        if column not in dropped:
            dropped.update(c for c in columns[:at] if strength.get((c, column), 0.0) >= threshold)
    return [c for c in columns if c not in dropped]


# Information


def _mutual_information(counts: DataFrame, group: list[str], target: str) -> DataFrame:
    """MI in nats from (group, cell, target, n) counts."""
    whole = Window.partitionBy(*group)
    n, total = F.col("n"), F.sum("n").over(whole)
    joint = counts.select(
        *group, "n", total.alias("_all"),
        F.sum("n").over(Window.partitionBy(*group, "cell")).alias("_cell_n"),
        F.sum("n").over(Window.partitionBy(*group, target)).alias("_class_n"),
    )
    part = n / F.col("_all") * F.ln(n * F.col("_all") / (F.col("_cell_n") * F.col("_class_n")))
    return joint.groupBy(*group).agg(F.sum(part).alias("mi"))


def categorical_information(df: DataFrame, columns: list[str], target: str = C.TARGET) -> DataFrame:
    """Mean, over the 0/1 columns of a category, of their MI with the target."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = materialize(
        df.select(target, F.explode(F.array(*cells)).alias("_cell"))
        .groupBy("_cell.feature", "_cell.value")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(target).alias("_pos"))
    )
    # Every row has one cell per column, so the cells of one column count all rows.
    size = counts.where(F.col("feature") == columns[0]).agg(F.sum("_n").alias("n"), F.sum("_pos").alias("pos")).first()
    all_n, all_pos = float(size["n"] or 0), float(size["pos"] or 0)

    def term(n: Column, side: Column, label_total: float) -> Column:
        return F.when(n > 0, n / all_n * F.ln(n * all_n / (F.nullif(side, F.lit(0)) * F.lit(label_total)))).otherwise(0.0)

    inside, pos = F.col("_n"), F.col("_pos")
    outside = all_n - inside
    mi = (
        term(pos, inside, all_pos) + term(inside - pos, inside, all_n - all_pos)
        + term(all_pos - pos, outside, all_pos) + term(outside - (all_pos - pos), outside, all_n - all_pos)
    )
    return counts.groupBy("feature").agg(F.avg(mi).alias("mi"))


def numeric_information(
    df: DataFrame, columns: list[str], target: str = C.TARGET, bins: int = 10
) -> DataFrame:
    """MI of each numeric column, cut at its exact quantiles, with the target."""
    probs = [i / bins for i in range(1, bins)]
    edges: dict[str, list[float]] = {}
    for r in exact_quantiles(df, columns, probs).collect():
        edges.setdefault(r["column"], []).append(r["quantile"])

    def cell(c: str) -> Column:
        place = F.lit(0)
        for edge in sorted(edges.get(c, [])):
            place = place + (F.col(c).cast("double") > edge).cast("int")
        return F.struct(F.lit(c).alias("feature"), place.alias("cell"))

    counts = (
        df.select(target, F.explode(F.array(*[cell(c) for c in columns])).alias("_cell"))
        .groupBy("_cell.feature", "_cell.cell", target)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("cell").isNotNull())
    )
    return _mutual_information(counts, ["feature"], target)


def mutual_information(
    df: DataFrame, numeric: list[str], categorical: list[str], target: str = C.TARGET, bins: int = 10
) -> DataFrame:
    """Ranked union of the numeric and the categorical scores."""
    return (
        numeric_information(df, numeric, target, bins)
        .unionByName(categorical_information(df, categorical, target))
        .orderBy(F.desc("mi"), "feature")
    )


# Outliers and categories


def iqr_bounds(df: DataFrame, column: str, multiplier: float = 1.5) -> tuple[float, float]:
    q = quantile_values(df, column, [0.25, 0.75])
    low, high = q[0.25], q[0.75]
    if low is None:
        return float("nan"), float("nan")
    return low - (high - low) * multiplier, high + (high - low) * multiplier


def iqr_summary(df: DataFrame, column: str, multiplier: float = 1.5) -> DataFrame:
    """Bounds, number and share of outliers."""
    low, high = iqr_bounds(df, column, multiplier)
    outside = (F.col(column) < low) | (F.col(column) > high)
    return df.agg(
        F.lit(low).alias("lower_limit"), F.lit(high).alias("upper_limit"),
        F.count_if(outside).alias("n_outliers"),
        (F.count_if(outside) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("pct_outliers"),
    )


def iqr_cleaned(df: DataFrame, column: str, multiplier: float = 1.5) -> DataFrame:
    """Rows kept; values outside the bounds become null."""
    low, high = iqr_bounds(df, column, multiplier)
    return df.withColumn(column, F.when(F.col(column).between(low, high), F.col(column)))


def shape_summary(df: DataFrame, column: str) -> DataFrame:
    """Description of one column plus population skewness and excess kurtosis."""
    shape = df.agg(F.skewness(column).alias("skewness"), F.kurtosis(column).alias("kurtosis")).first()
    return describe_numeric(df, [column]).withColumns(
        {name: F.lit(value).cast("double") for name, value in shape.asDict().items()}
    )


def box_numbers(df: DataFrame, column: str, by: str, multiplier: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and number of fliers per class."""
    quartiles = (
        exact_quantiles(df, [column], QUARTILES, [by])
        .groupBy(by)
        .agg(
            *[
                F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                for p, n in zip(QUARTILES, ["q25", "q50", "q75"])
            ]
        )
        .withColumns(
            {
                "_lo": F.col("q25") - (F.col("q75") - F.col("q25")) * multiplier,
                "_hi": F.col("q75") + (F.col("q75") - F.col("q25")) * multiplier,
            }
        )
    )
    value = F.col(column)
    inside = value.between(F.col("_lo"), F.col("_hi"))
    return (
        df.select(by, column).where(value.isNotNull())
        .join(broadcast_if_small(quartiles), by)
        .groupBy(by, "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("n_fliers"),
        )
    )


def top_categories(df: DataFrame, column: str, direct: int = 10) -> DataFrame:
    """Most frequent categories, the others as one row, missing values as their own row.

    With more than ``direct`` categories, ``direct - 1`` are shown. Ties go to the smaller
    name.
    """
    counts = df.groupBy(F.col(column).cast("string").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    label = F.coalesce("category", F.lit(MISSING_LABEL))
    named = counts.groupBy(label.alias("category")).agg(F.sum("n").alias("n"))
    known = named.where(F.col("category") != MISSING_LABEL)
    size = named.agg(
        F.count_if(F.col("category") != MISSING_LABEL).alias("known"),
        F.sum(F.when(F.col("category") != MISSING_LABEL, F.col("n"))).alias("known_n"),
        F.sum("n").alias("all_n"),
    ).first()
    shown = direct - 1 if size["known"] > direct else direct
    top = known.orderBy(F.desc("n"), "category").limit(shown)
    result = top.unionByName(named.where(F.col("category") == MISSING_LABEL))
    if size["known"] > direct:
        rest = top.agg(
            F.lit(OTHER_LABEL).alias("category"), (F.lit(size["known_n"]) - F.sum("n")).alias("n")
        )
        result = result.unionByName(rest)
    return result.select(
        "category", "n", (F.col("n") * 100.0 / F.lit(size["all_n"])).alias("pct")
    ).orderBy(F.desc("n"), "category")


def mean_confidence_interval(df: DataFrame, column: str, level: float = 0.95) -> DataFrame:
    """Normal interval of the mean; null under two rows, the mean itself without spread."""
    z = NormalDist().inv_cdf(1 - (1 - level) / 2)
    n, mean, std = F.count(column), F.avg(column), F.stddev_samp(column)
    margin = F.when(n >= 2, std * z / F.sqrt(F.nullif(n, F.lit(0))))
    return df.agg(
        n.alias("n"), F.when(n >= 2, mean).alias("mean"),
        (mean - margin).alias("lower_bound"), (mean + margin).alias("upper_bound"),
    )


def mae_mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute error, and mean absolute percentage error; null if an actual is 0."""
    gap = F.abs(F.col(actual) - F.col(predicted))
    zeros = F.count_if(F.col(actual) == 0)
    return df.agg(
        F.avg(gap).alias("mae"),
        F.when(zeros == 0, F.avg(gap / F.nullif(F.abs(F.col(actual)), F.lit(0.0))) * 100).alias("mape"),
        zeros.alias("n_zero_actual"),
    )


def min_max_scale(df: DataFrame, column: str, into: str) -> DataFrame:
    """(x - min) / (max - min), 0 for a constant column."""
    edge = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if edge["lo"] is None or edge["lo"] == edge["hi"]:
        return df.withColumn(into, F.when(F.col(column).isNotNull(), F.lit(0.0)))
    return df.withColumn(into, (F.col(column) - edge["lo"]) / F.lit(float(edge["hi"] - edge["lo"])))


def z_scale(df: DataFrame, column: str, into: str) -> DataFrame:
    """(x - mean) / sample std; null for a constant column."""
    stats = df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std")).first()
    if not stats["std"]:
        return df.withColumn(into, F.lit(None).cast("double"))
    return df.withColumn(into, (F.col(column) - stats["mean"]) / F.lit(stats["std"]))
