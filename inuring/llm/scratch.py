"""Tables written in between, in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Paths of the tables that this thread's ``intermediate`` blocks have to remove, the innermost block's last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


def folder(spark: SparkSession) -> str:
    """A new path in ``spark.checkpoint.dir``. Only a local master, as in tests, may leave that unset: a local folder takes its
    place there."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "/tmp/inuring-scratch"
    return f"{base.rstrip('/')}/inuring-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``folder`` named, on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def temporary(spark: SparkSession) -> str:
    """As ``folder``; what is written there goes at the end of the ``intermediate`` block, else when the driver's JVM ends."""
    path = folder(spark)
    if _open.get():
        _open.get()[-1].append(path)
        return path
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return f"{path}/table"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: its lineage ends there and survives lost executors.

    Inside an ``intermediate`` block the table goes at its end, else when the driver's JVM ends.
    """
    spark, path = df.sparkSession, temporary(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables written in the block are removed at its end. The frames put into the list that it gives are written first, as
    tables of the block around, and take their places in the list."""
    around, own = _open.get(), []
    results: list[DataFrame] = []
    _open.set((*around, own))
    try:
        yield results
        _open.set(around)
        results[:] = [written(df) for df in results]
    finally:
        _open.set(around)
        for path in own:
            _forget(spark, path)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session may be gone
        pass
