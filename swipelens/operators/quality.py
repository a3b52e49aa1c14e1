"""Data-quality checks and column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unpivot(one_row: DataFrame, columns: list[str], name: str, value: str) -> DataFrame:
    """One row of totals to one row per column; no shuffle."""
    cells = [F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns]
    return one_row.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, n_missing) for every column, from one pass."""
    columns = columns or df.columns
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return unpivot(totals, columns, "column", "n_missing")


def missing_counts(train: DataFrame, test: DataFrame) -> DataFrame:
    """Columns with missing values, per part."""
    parts = [
        null_counts(part).withColumn("part", F.lit(name))
        for name, part in (("train", train), ("test", test))
    ]
    return parts[0].unionByName(parts[1]).where("n_missing > 0")


def class_rows(df: DataFrame, target: str, label: int) -> DataFrame:
    return df.where(F.col(target) == label)


def string_flags(
    column: Column | str, expected_length: int | None = None, check_numeric_only: bool = False
) -> tuple[Column, Column]:
    """(wrong length, not all digits) as booleans; a missing string breaks no rule."""
    text = F.col(column) if isinstance(column, str) else column
    length = F.lit(False) if expected_length is None else F.length(text) != expected_length
    digits = ~text.rlike("^[0-9]+$") if check_numeric_only else F.lit(False)
    return F.coalesce(length, F.lit(False)), F.coalesce(digits, F.lit(False))


def string_violations(
    df: DataFrame, column: str, expected_length: int | None = None, check_numeric_only: bool = False
) -> DataFrame:
    """Number of rows that break each rule."""
    length, digits = string_flags(column, expected_length, check_numeric_only)
    return df.agg(
        F.count_if(length).alias("n_wrong_length"), F.count_if(digits).alias("n_non_numeric")
    )


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, nulls, null share and distinct values of each column.

    The exact form counts distinct (column, value) pairs after a shuffle on the pair, so a
    hot value is reduced before it moves and all columns share one pass. ``approximate``
    replaces that by a sketch and needs no shuffle of values.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    if approximate:
        cells = df.agg(
            *[
                F.struct(
                    F.count(F.lit(1)).alias("n"), F.count(F.col(c)).alias("present"),
                    F.approx_count_distinct(c).alias("n_unique"),
                ).alias(c)
                for c in df.columns
            ]
        )
        per_column = unpivot(cells, df.columns, "column", "_v").select("column", "_v.*")
    else:
        per_column = (
            value_counts(df, df.columns)
            .groupBy("column")
            .agg(
                F.sum("n").alias("n"),
                F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("present"),
                F.count("value").alias("n_unique"),
            )
        )
    names = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    nulls = F.col("n") - F.col("present")
    return per_column.select(
        "column",
        names[F.col("column")].alias("column_type"),
        nulls.alias("n_null"),
        (nulls * 100.0 / F.col("n")).alias("pct_null"),
        "n_unique",
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for several columns in one pass; values as text, nulls kept."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*cells)).alias("_cell"))
        .groupBy("_cell.column", "_cell.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows, columns, exact copies after the first, and their share."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    rows = F.coalesce(F.sum("_n"), F.lit(0))
    copies = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    return groups.agg(
        rows.alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        copies.alias("n_duplicates"),
        F.when(rows > 0, copies * 100.0 / F.nullif(rows, F.lit(0))).alias("pct_duplicates"),
    )


def required_columns(df: DataFrame, required: list[str], never_null: list[str], rows: int) -> DataFrame:
    """(check, passed): columns present, columns without nulls, row count kept."""
    present = [(f"present:{c}", c in df.columns) for c in required]
    checked = [c for c in never_null if c in df.columns]
    checks = {f"not_null:{c}": F.count_if(F.col(c).isNull()) == 0 for c in checked}
    checks["row_count"] = F.count(F.lit(1)) == rows
    found = df.agg(*[v.alias(k) for k, v in checks.items()])
    cells = [F.struct(F.lit(k).alias("check"), F.lit(ok).alias("passed")) for k, ok in present]
    cells += [F.struct(F.lit(k).alias("check"), F.col(f"`{k}`").alias("passed")) for k in checks]
    return found.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*")


def from_date(df: DataFrame, time: str, start: str) -> DataFrame:
    """Rows from a start date on.

    Compared as an instant of the column's own type, so that the filter reaches the files.
    """
    return df.where(F.col(time) >= F.to_date(F.lit(start)).cast(df.schema[time].dataType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
