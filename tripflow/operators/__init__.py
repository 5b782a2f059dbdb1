"""DataFrame to DataFrame operators, usable with ``DataFrame.transform``."""

from tripflow.operators.clean import (
    conform_serving,
    drop_bad_durations,
    positive_trips,
    project_trips,
    with_trip_duration,
    with_trip_speed,
)
from tripflow.operators.drift import column_presence, schema_drift
from tripflow.operators.enrich import in_month, remap_keys
from tripflow.operators.quality import ColumnRule, check_contract, reject_profile, reject_reason, rejected
from tripflow.operators.ranking import count_by, order_report, top_k_per_group
from tripflow.operators.slow import average_speed, slow_trips

__all__ = [
    "ColumnRule",
    "average_speed",
    "check_contract",
    "column_presence",
    "conform_serving",
    "count_by",
    "drop_bad_durations",
    "in_month",
    "order_report",
    "positive_trips",
    "project_trips",
    "reject_profile",
    "reject_reason",
    "rejected",
    "remap_keys",
    "schema_drift",
    "slow_trips",
    "top_k_per_group",
    "with_trip_duration",
    "with_trip_speed",
]
