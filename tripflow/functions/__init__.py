"""Column expressions: everything here maps columns to a column."""

from tripflow.functions.keys import remapped
from tripflow.functions.times import (
    duration_hours,
    elapsed_seconds,
    epoch_floor,
    iso_week,
    iso_year,
    month_bounds,
    within_month,
)

__all__ = [
    "duration_hours",
    "elapsed_seconds",
    "epoch_floor",
    "iso_week",
    "iso_year",
    "month_bounds",
    "remapped",
    "within_month",
]
