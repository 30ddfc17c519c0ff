"""Sinks: versioned loss tables, CSV exports, appends that can be repeated, and runs with an id of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inuring.sources.shared import exists, move, subfolders


def write_versioned(yelt: DataFrame, path: str) -> None:
    """One partition for each (loss_analysis_id, row_version); a rewrite replaces only the partitions it has. Analyses are dealt
    to tasks by size: small ones share one, large ones are split."""
    dealt = yelt.hint("rebalance", F.col("loss_analysis_id"), F.col("row_version")).sortWithinPartitions("loss_analysis_id", "row_version", "day", "year", "peril_id", "event_id")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("loss_analysis_id", "row_version").parquet(path)


def versions(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The version folders of each analysis folder, the oldest first; only folder names are read."""
    return {analysis: sorted(subfolders(spark, analysis), key=lambda x: int(x.rpartition("=")[2])) for analysis in subfolders(spark, path)}


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of each analysis's highest version; superseded ones are not read."""
    latest = [own[-1] for own in versions(spark, path).values() if own]
    return spark.read.option("basePath", path).parquet(*latest)


def archive_superseded(spark: SparkSession, path: str, archive: str) -> int:
    """Move all versions but the highest of each analysis to the archive, under the same names; how many were moved."""
    old = [(analysis, version) for analysis, own in versions(spark, path).items() for version in own[:-1]]
    for analysis, version in old:
        move(spark, version, f"{archive}/{analysis.rpartition('/')[2]}/{version.rpartition('/')[2]}")
    return len(old)


def write_analyses(entries: DataFrame, path: str, slices: int = 64) -> None:
    """Loss tables by analysis (loss_analysis_id, row_version, ...): a folder for each of so many slices of the ids, each sorted by
    analysis. A slice of many entries is split over several files; the number of slices is part of the path."""
    dealt = entries.withColumn("slice", F.pmod("loss_analysis_id", F.lit(slices)).cast("int"))
    dealt = dealt.hint("rebalance", F.col("slice")).sortWithinPartitions("slice", "loss_analysis_id", "row_version")
    dealt.write.mode("overwrite").partitionBy("slice").parquet(f"{path}/slices={slices}")


def read_analyses(spark: SparkSession, path: str, chosen: DataFrame) -> DataFrame:
    """The entries of the chosen analyses (loss_analysis_id, row_version and more) from what ``write_analyses`` wrote: the slices
    without any of them are pruned when the join runs."""
    (stored,) = subfolders(spark, path)
    slices = int(stored.rpartition("=")[2])
    wanted = chosen.withColumn("slice", F.pmod("loss_analysis_id", F.lit(slices)).cast("int"))
    return spark.read.parquet(stored).join(wanted, ["slice", "loss_analysis_id", "row_version"]).drop("slice")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def new_rows(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target lacks; a null key is equal to itself."""
    own = target.select(*[F.col(k).alias(f"{k}_t") for k in keys])
    return df.join(own, [F.col(k).eqNullSafe(F.col(f"{k}_t")) for k in keys], "left_anti")


def append_once(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append the rows whose key the table at ``path`` lacks; it is made if there is none. Appending twice changes nothing; of rows
    that repeat a key, the one whose other columns come first is taken."""
    spark = df.sparkSession
    own = [c for c in df.columns if c not in keys]
    df = df.groupBy(*keys).agg(F.min(F.struct(*own)).alias("_row")).select(*keys, "_row.*").select(*df.columns) if own else df.distinct()
    if exists(spark, f"{path}/_SUCCESS"):
        df = new_rows(df, spark.read.schema(df.schema).parquet(path), keys)
    df.write.mode("append").parquet(path)


def next_id(headers: DataFrame, column: str) -> DataFrame:
    """(next_id): one more than the highest, 1 for an empty table."""
    return headers.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("long").alias("next_id"))


def append_run(rows: DataFrame, path: str, name: str) -> int:
    """Append ``rows`` to ``path``/rows under the next run id and a header (run_id, name, rows) to ``path``/runs; both are made
    if missing. The header comes last, so a run that was cut off has none and its id is given again after its rows are gone."""
    spark = rows.sparkSession
    header = "run_id long, name string, rows long"
    runs = spark.read.schema(header).parquet(f"{path}/runs") if exists(spark, f"{path}/runs/_SUCCESS") else spark.createDataFrame([], header)
    run = next_id(runs, "run_id").first()["next_id"]
    own = f"{path}/rows/run_id={run}"
    rows.write.mode("overwrite").parquet(own)
    spark.createDataFrame([(run, name, spark.read.parquet(own).count())], header).write.mode("append").parquet(f"{path}/runs")
    return run


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all runs that have a header, with ``run_id``."""
    runs = spark.read.parquet(f"{path}/runs").select("run_id")
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").withColumn("run_id", F.col("run_id").cast("long"))
    return rows.join(F.broadcast(runs), "run_id")  # a row for each run


def unique_or_fail(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, or a failure if a key repeats: one aggregate."""
    again = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    found = again.limit(3).collect()
    if found:
        raise ValueError(f"keys repeat: {[tuple(r)[:-1] for r in found]}")
    return df


def missing_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): rows of ``df`` by the keys that ``other`` lacks."""
    return new_rows(df, other, keys).groupBy(*keys).agg(F.count("*").alias("n"))


def join_or_fail(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """The inner join, which fails when it runs if a row of ``df`` finds no partner; a null key never does."""
    out = df.join(other.withColumn("_there", F.lit(True)), keys, "left")
    message = F.concat(F.lit("no partner for "), F.to_json(F.struct(*keys)))
    return out.where(F.coalesce(F.col("_there"), F.raise_error(message).cast("boolean"))).drop("_there")
