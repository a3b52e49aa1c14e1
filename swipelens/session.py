"""Session settings, and the shared folder for tables that cut lineage."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Paths handed out by ``new_path`` and not yet deleted, by application.
_PATHS: dict[str, list[str]] = {}
#: Applications whose executors have this package.
_SHIPPED: set[str] = set()
#: Called when tables are deleted, so that nobody keeps a frame that reads them.
ON_RELEASE: list[Callable[[], None]] = []


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("swipelens")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> None:
    """Pin the session time zone, so wall-clock parts do not depend on the machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder named by the session.

    A temporary folder is used only by a local master that names none, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="swipelens-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession) -> str:
    """A new folder for tables or files that are needed while results are computed."""
    path = f"{shared_folder(spark).rstrip('/')}/swipelens-{uuid.uuid4().hex}"
    _PATHS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete what was written under ``new_path``, from the ``since``-th path on.

    Frames that still read those tables fail afterwards, so call it once results are out.
    """
    for forget in ON_RELEASE:
        forget()
    paths = _PATHS.get(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in paths[since:]:
        place = hadoop(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    del paths[since:]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what the block wrote under ``new_path``."""
    begin = len(_PATHS.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, begin)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later plans read the table instead of repeating the lineage, and an executor that is
    lost takes nothing with it. Parquet keeps column pruning and real size statistics.
    """
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors this package once per application, as --py-files would."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    path = f"{shared_folder(spark).rstrip('/')}/swipelens-package-{application}.zip"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(packed.getvalue())
    finally:
        out.close()
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(application)
