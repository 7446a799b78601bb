"""Working folders every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Folders of local sessions that name none, by application.
_LOCAL: dict[str, str] = {}
#: Folders of the innermost ``released`` block that is open, and of those around it.
_OPEN: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; a cluster session
    is refused, as its executors could not see one.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
        folder = _LOCAL.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="orderflow-")
        _LOCAL[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder and what is in it, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes what is staged within the block when it ends, also by a failure.

    What the block returns must not read staged tables any more.
    """
    mine: list[str] = []
    _OPEN.append(mine)
    try:
        yield
    finally:
        _OPEN.remove(mine)
        for path in mine:
            drop_folder(spark, path)


#: Whether Spark deletes the shuffle files of a query when it ends, rather than when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Has the shuffle files of each query in the block deleted when the query ends; for tables that are written once."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    Cuts the lineage, survives the loss of executors, and lets each reader of the
    table scan only the columns it needs. Shuffle files of the write go when it ends. The table goes at the end of the
    ``released`` block it is made in, or else when the session's process ends.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    if _OPEN:
        _OPEN[-1].append(path)
    else:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
