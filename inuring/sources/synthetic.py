"""Random loss entries for property tests and benchmarks, made in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDSTORM = 16


def synthetic_yelt(spark: SparkSession, n: int, seed: int = 1, layers: int = 100) -> DataFrame:
    """``n`` entries: year 1 to 10000, day 1 to 364 without 50, event 1 to a thousand million, losses in [0, 1)."""
    draw = lambda k, high: (F.floor(F.rand(seed + k) * high) + 1)
    rows = spark.range(n).select(draw(0, layers).cast("int").alias("layer_id"), draw(1, 10000).cast("int").alias("year"), draw(2, 364).cast("int").alias("day"), draw(3, 1_000_000_000).alias("event_id"), F.rand(seed + 4).alias("loss_pct"), F.rand(seed + 5).alias("rp"))
    return rows.withColumns({"day": F.when(F.col("day") == 50, 51).otherwise(F.col("day")), "peril_id": F.lit(WINDSTORM)})
