"""Synthetic loss entries and exports."""

from pyspark.sql import functions as F

from inuring.operators import yelt
from inuring.plans.exports import EXPORTS, export_all
from inuring.sources.synthetic import synthetic_yelt


def test_event_losses_keep_the_total(spark):
    rows = synthetic_yelt(spark, 5000, seed=3)
    assert rows.where("day = 50 OR day NOT BETWEEN 1 AND 364 OR year NOT BETWEEN 1 AND 10000").isEmpty()
    ceded = rows.select("layer_id").distinct().withColumn("cession", (F.col("layer_id") % 10 + 1) / 20)
    total = rows.join(ceded, "layer_id").agg(F.sum(F.col("loss_pct") * F.col("cession")).alias("s")).first().s
    assert abs(yelt.event_losses(rows, ceded).agg(F.sum("loss").alias("s")).first().s - total) < 1e-6


def test_exports_read_back(spark, sf_dir, tmp_path):
    """Every export has its query's rows, in order over the files."""
    names = [n for n in EXPORTS if n != "retro_layer_metrics"]  # the same plan as retro_metrics
    export_all(spark, sf_dir, str(tmp_path), names)
    for name in names:
        back = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / name))
        # no program of the smallest tables has a premium in the years that the profiles show
        assert (back.count() > 0 or name == "premium_by_profile") and set(EXPORTS[name]) <= set(back.columns)
        first = [tuple(r[c] for c in EXPORTS[name]) for r in back.collect()]
        assert first == sorted(first), name
    # every layer has a line: what became of it, or that it has no analysis
    log = spark.read.option("header", True).csv(str(tmp_path / "simulation_log"))
    assert log.select("layer_id").distinct().count() == spark.read.parquet(f"{sf_dir}/part.parquet").count()
