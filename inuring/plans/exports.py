"""CSV exports of the results that are handed on: cessions, metrics by program and by layer, premium by profile, accounting."""

from __future__ import annotations

from pyspark.sql import SparkSession

from inuring.plans.queries import QUERIES
from inuring.sources.sinks import write_csv

#: Query, and the columns that order its export.
EXPORTS = {
    "retro_cession_view_lod": ["level", "retro_program_id", "layer_id", "start"],
    "portfolio_retro_cession_view": ["level", "retro_program_id", "port_layer_id", "start"],
    "retro_metrics": ["retro_program_id"],
    "retro_layer_metrics": ["retro_program_id", "layer_id", "start"],
    "premium_by_profile": ["retro_profile_id"],
    "conditional_yelt": ["loss_view", "layer_id", "year", "day"],
    "itd_metrics": ["layer_id", "uw_year"],
    "simulation_log": ["layer_id", "loss_view", "place"],
    "scenario_reinstatements": ["scenario_id", "layer_id", "reinstatement_order", "reinstatement_id"],
    "scenario_retro_cessions": ["scenario_id", "retro_program_id"],
}


def export_all(spark: SparkSession, sf_dir: str, path: str, names: list[str] | None = None) -> None:
    """Each export as a folder of CSV files with headers, ordered over all files."""
    for name in names or EXPORTS:
        write_csv(QUERIES[name](spark, sf_dir).orderBy(*EXPORTS[name]), f"{path}/{name}")
