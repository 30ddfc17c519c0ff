"""Joins that account for what they miss.

A row without a partner fails the run, is left out, or stays with a default. What is left out or filled in is counted by
``observe`` in the pass that the run makes anyway; ``report`` gives the counts of all joins of a run at its end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FAIL, DROP, DEFAULT = "fail", "drop", "default"


class Audit:
    """The misses of one run's joins, by the joins' names."""

    def __init__(self) -> None:
        self._observed: dict[str, Observation] = {}

    def settle(self, df: DataFrame, found: Column, name: str, key: Column, missing: str = FAIL) -> DataFrame:
        """``df`` after each row that isn't ``found`` has failed the run with its key, been left out, or been let through."""
        found = F.coalesce(found, F.lit(False))
        if missing == FAIL:
            return df.where(F.when(found, True).otherwise(F.raise_error(F.concat_ws(" ", F.lit(f"{name}: nothing for"), key)).cast("boolean")))
        if missing not in (DROP, DEFAULT):
            raise ValueError(f"missing must be {FAIL}, {DROP} or {DEFAULT}, not {missing}")
        seen = Observation(f"{name} {uuid.uuid4().hex}")
        self._observed[name] = seen
        misses = F.when(~found, 1)
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(misses).alias("misses"), F.min(F.when(~found, key)).alias("first"))
        return counted.where(found) if missing == DROP else counted

    def join(self, df: DataFrame, other: DataFrame, keys: list[str], name: str, missing: str = FAIL, defaults: dict[str, object] | None = None) -> DataFrame:
        """``df`` with the columns of ``other``, which has each key once; with ``default`` the given values where there is none."""
        key = F.concat_ws(" ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
        met = df.join(other.withColumn("_found", F.lit(True)), keys, "left")
        out = self.settle(met, F.col("_found"), name, key, missing).drop("_found")
        return out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in (defaults or {}).items()}) if missing == DEFAULT else out

    def report(self) -> dict[str, dict[str, object]]:
        """(rows, misses, first key missed) of each join that leaves out or fills in, once the run's action has ended; the joins that
        fail have none, as they had no miss."""
        return {name: dict(seen.get) for name, seen in self._observed.items()}
