"""The folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a local master, as in tests, may leave that unset: a local folder takes its place there."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "/tmp/inuring-shared"
    return base.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder: lineage ends there and columns stay prunable. The table is
    removed when the driver's JVM ends, whether the session has been stopped before or not."""
    path = temporary(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def temporary(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, in the application's own part of it, which the driver's JVM removes when it ends."""
    own = f"{shared_folder(spark)}/inuring-{spark.sparkContext.applicationId}"
    files, target = _file_system(spark, own)
    if not files.exists(target):
        files.mkdirs(target)
        files.deleteOnExit(target)
    return f"{own}/{kind}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The ``name=value`` folders in a folder, sorted; none if there is no such folder."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(x.getPath().toString() for x in files.listStatus(target) if x.isDirectory() and "=" in x.getPath().getName())


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the folder around the new name is made if there is none."""
    files, target = _file_system(spark, path)
    _, new = _file_system(spark, to)
    files.mkdirs(new.getParent())
    if not files.rename(target, new):
        raise OSError(f"{path} can't be moved to {to}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    files, target = _file_system(spark, path)
    return [x.getPath().getName() for x in files.listStatus(target)] if files.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    files, target = _file_system(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in its place at once: written beside it and then renamed; an older one is replaced."""
    files, target = _file_system(spark, path)
    _, beside = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(target):
        files.delete(target, False)
    if not files.rename(beside, target):
        raise OSError(f"{path} can't be written")
