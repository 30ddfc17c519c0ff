"""Training-corpus pipeline over `documents`: quality rules, near-dedup, decontamination, mixing and sharding.

Each stage takes the documents that the one before kept and returns them with the same columns; the last returns where each
document goes. What a stage keeps is written to the shared folder and read again, so no later action computes it twice and a
lost executor costs one stage. Edge cases (nulls, empty texts, ties, repeated rows, empty tables) are as in the operators that do the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inuring.llm.decontam import decontaminate
from inuring.llm.mixing import label_domains, mix
from inuring.llm.neardup import deduplicate
from inuring.llm.quality import quality_filter
from inuring.llm.scratch import written
from inuring.llm.sharding import assign_shards

SHARDS = 24
#: Factors by which the domains' expected tokens are to change: toxic text goes, the rest stays.
FACTORS = {"good": 1.0, "poor": 1.0, "toxic": 0.01}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of words of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by their fitted rates, each rounded up or down by a hash of its id. Rates are fitted between 0 and 1, as the
    factors ask for no further copies; what that leaves of the targets is the nearest there is."""
    labels = label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mixed = mix(docs, labels, FACTORS, relative=True, most=1.0)
    copies = mixed.columns[-1]
    return mixed.where(f"`{copies}` >= 1").select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of each document and its place there; each shard has the sources in the corpus's proportions."""
    return assign_shards(docs, SHARDS)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]
#: Neither the fit of rates nor the trained classifier can be said in SQL; tests hold the pipeline against a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
