"""Measured sizes behind physical choices: broadcast or not, hot keys or not."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelens.session import materialize

#: A lookup side up to this many rows and bytes is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def _bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: lengths of what varies, eight for anything else."""
    total = F.lit(8)
    for field in df.schema:
        kind, column = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("string", "varchar", "char", "binary"):
            total = total + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            total = total + 8
    return total


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when a count of rows and bytes proves the side small.

    Beyond the bounds the frame is returned as it is: Spark then shuffles both sides and
    splits hot keys at run time.
    """
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(_bytes(df).cast("bigint"))).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df


@dataclass(frozen=True)
class KeyProfile:
    """Row counts that decide how windows over one key are laid out."""

    rows: int
    max_rows: int
    span: int
    #: Columns: the key, ``n`` rows, ``lo`` and ``hi`` of the order column.
    keys: DataFrame

    @classmethod
    def measure(cls, df: DataFrame, key: str, at: Column) -> "KeyProfile":
        """One pass over key and order column; ``at`` is a number such as microseconds."""
        per_key = materialize(
            df.select(key, at.alias("_at")).groupBy(key).agg(
                F.count(F.lit(1)).alias("n"), F.min("_at").alias("lo"), F.max("_at").alias("hi")
            )
        )
        row = per_key.agg(
            F.sum("n").alias("rows"), F.max("n").alias("max_rows"),
            (F.max("hi") - F.min("lo")).alias("span"),
        ).first()
        return cls(int(row["rows"] or 0), int(row["max_rows"] or 0), int(row["span"] or 0), per_key)
