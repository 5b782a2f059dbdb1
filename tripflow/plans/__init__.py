"""Whole stages: the zones, the report and the batch from end to end."""

from tripflow.plans.batch import BatchConfig, run_pipeline
from tripflow.plans.checked import Limits, QualityError, read_quarantine, write_checked_silver
from tripflow.plans.refresh import Refreshed, refresh_zones
from tripflow.plans.report import slow_zone_report, slow_zone_report_sql
from tripflow.plans.speed_index import indexed_report, update_speed_index
from tripflow.plans.zones import build_gold, build_silver, conform_serving, load_serving

__all__ = [
    "BatchConfig",
    "Limits",
    "QualityError",
    "Refreshed",
    "build_gold",
    "build_silver",
    "conform_serving",
    "indexed_report",
    "load_serving",
    "read_quarantine",
    "refresh_zones",
    "run_pipeline",
    "slow_zone_report",
    "slow_zone_report_sql",
    "update_speed_index",
    "write_checked_silver",
]
