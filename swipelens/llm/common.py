"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelens.llm.files import put
from swipelens.session import shared_folder

#: White space between words: space and the controls 9 to 13. Nothing else parts words.
GAP_CHARS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as --py-files would."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root, packed = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    folder, name = shared_folder(spark).rstrip("/"), f"swipelens-{application}.zip"
    put(folder, name, packed.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/{name}")
    _shipped.add(application)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column | str) -> Column:
    """Maximal runs of characters that are not white space; none for null."""
    body = F.btrim(whole(text), F.lit(GAP_CHARS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, GAP))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be no column of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
