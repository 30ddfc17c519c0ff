"""Incremental refresh by row versions: high-water marks, keyed upserts, and a file stream that feeds them."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from inuring.sources.shared import names, read_text, remove, write_text


def high_water_marks(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_version): the highest version of each table, 0 for an empty one."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.coalesce(F.max("row_version"), F.lit(0)).cast("long").alias("row_version")).select(F.lit(name).alias("table_name"), "row_version")
        out = one if out is None else out.union(one)
    return out


def changed(before: DataFrame, now: DataFrame) -> DataFrame:
    """Tables whose mark has risen; a table without an earlier mark counts as changed."""
    old = before.select("table_name", F.col("row_version").alias("old"))
    return now.join(old, "table_name", "left").where(F.col("row_version") > F.coalesce("old", F.lit(-1))).select("table_name", "row_version")


def since(df: DataFrame, mark: int) -> DataFrame:
    return df.where(F.col("row_version") > mark)


def upsert(state: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the highest version of each key; an equal or older version of a key changes nothing."""
    every = batch if state is None else state.unionByName(batch)
    own = [c for c in every.columns if c not in (*keys, "row_version")]
    return every.groupBy(*keys).agg(F.max(F.struct("row_version", *own)).alias("r")).select(*keys, "r.*").select(*every.columns)


def stream_upserts(spark: SparkSession, source: str, schema: StructType, target: Callable[[DataFrame, int], None], checkpoint: str, seconds: float | None = None) -> StreamingQuery:
    """A stream over new Parquet files that hands each micro-batch to ``target``: all there is at once, or every so many seconds."""
    writer = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(target).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")).start()


class Refresh:
    """A job that keeps a table up to date from new files, by a processing-time trigger, until it is stopped.

    ``start`` begins it or goes on where it was stopped; ``stop`` lets the batch at hand end. A batch that fails ends the job, and
    ``start`` runs that batch again.
    """

    def __init__(self, spark: SparkSession, source: str, schema: StructType, target: Callable[[DataFrame, int], None], checkpoint: str, seconds: float):
        self._begin = lambda: stream_upserts(spark, source, schema, target, checkpoint, seconds)
        self._query: StreamingQuery | None = None

    @property
    def running(self) -> bool:
        return self._query is not None and self._query.isActive

    def start(self) -> None:
        if not self.running:
            self._query = self._begin()

    def stop(self, seconds: float = 60) -> None:
        """Wait until there is nothing at hand, for so many seconds at most, and end the job. What made it fail is raised."""
        if self._query is None:
            return
        until = time.monotonic() + seconds
        while self._query.isActive and (self._query.status["isTriggerActive"] or self._query.status["isDataAvailable"]) and time.monotonic() < until:
            time.sleep(0.05)
        self._query.stop()
        failed, self._query = self._query.exception(), None
        if failed is not None:
            raise failed


class VersionedTable:
    """State by key in buckets: ``apply`` upserts batch n into the state and writes only the buckets that the batch touches.

    A manifest lists the current folder of each bucket. Batch n writes its buckets to folders of its own and then its manifest,
    ``manifest/n``, in one rename; so a batch that was cut off is not seen, a replayed one starts from the manifest below its number
    and takes its own place again, and a restart reads one small file. The last ``keep`` manifests stay for replays; folders that
    none of them lists are removed after each batch. When the state's rows outgrow ``rows_a_bucket``, the batch deals the whole
    state out to twice as many buckets, or more.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 8, rows_a_bucket: int = 1_000_000, keep: int = 2):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.buckets, self.rows_a_bucket, self.keep = buckets, rows_a_bucket, keep

    def manifest(self, below: int | None = None) -> dict | None:
        """The newest manifest (below a batch number): its number, schema, and for each bucket its folder and rows."""
        numbers = [int(n) for n in names(self.spark, f"{self.path}/manifest") if n.isdigit() and (below is None or int(n) < below)]
        return json.loads(read_text(self.spark, f"{self.path}/manifest/{max(numbers)}")) if numbers else None

    def _bucketed(self, df: DataFrame, n: int) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int"))

    def apply(self, batch: DataFrame, number: int) -> None:
        schema = batch.schema
        before = self.manifest(number) or {"buckets": self.buckets, "folders": {}, "rows": {}}
        folder = f"data/{number}-{uuid.uuid4().hex[:8]}"
        touched = {r.bucket: r.n for r in self._bucketed(batch, before["buckets"]).groupBy("bucket").agg(F.count("*").alias("n")).collect()}  # as many as there are buckets
        n, most = before["buckets"], max((before["rows"].get(str(b), 0) + k for b, k in touched.items()), default=0)
        while most > self.rows_a_bucket:
            n, most = 2 * n, -(-most // 2)
        old = [f for b, f in before["folders"].items() if n != before["buckets"] or int(b) in touched]
        state = self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in old]) if old else None
        new = self._bucketed(upsert(state, batch, self.keys), n)
        new.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        written = self.spark.read.parquet(f"{self.path}/{folder}") if touched else None
        rows = {str(r.bucket): r.n for r in written.groupBy("bucket").agg(F.count("*").alias("n")).collect()} if touched else {}
        kept = before if n == before["buckets"] else {"folders": {}, "rows": {}}
        manifest = {
            "number": number,
            "schema": schema.json(),
            "buckets": n,
            "folders": kept["folders"] | {b: f"{folder}/bucket={b}" for b in rows},
            "rows": kept["rows"] | rows,
        }
        write_text(self.spark, f"{self.path}/manifest/{number}", json.dumps(manifest))
        self._clean(number)

    def _clean(self, number: int) -> None:
        """Drop manifests beyond the last ones, and the batch folders that none of the rest lists."""
        numbers = sorted(int(n) for n in names(self.spark, f"{self.path}/manifest") if n.isdigit())
        for old in numbers[: -self.keep]:
            remove(self.spark, f"{self.path}/manifest/{old}")
        used = set()
        for n in numbers[-self.keep :]:
            used |= {f.split("/")[1] for f in json.loads(read_text(self.spark, f"{self.path}/manifest/{n}"))["folders"].values()}
        for batch in names(self.spark, f"{self.path}/data"):
            if batch not in used:
                remove(self.spark, f"{self.path}/data/{batch}")

    def read(self, schema: StructType | None = None) -> DataFrame:
        """The state; before the first batch an empty table of the schema given."""
        now = self.manifest()
        if now is None and schema is None:
            raise ValueError(f"{self.path} has no batch yet, so its schema must be given")
        schema = schema or StructType.fromJson(json.loads(now["schema"]))
        folders = [f"{self.path}/{f}" for f in now["folders"].values()] if now else []
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
