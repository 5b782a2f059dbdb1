"""Slow trips: those under the mean speed of all trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.schemas import SPEED


def average_speed(df: DataFrame, column: str = SPEED) -> DataFrame:
    """One row, ``avg_speed``: the mean over every trip; NULL speeds do not count.

    Partial sums per task and one final merge, so nothing but one pair of
    numbers per task moves.
    """
    return df.agg(F.avg(column).alias("avg_speed"))


def slow_trips(df: DataFrame, column: str = SPEED) -> DataFrame:
    """Keep trips slower than the mean of ``column`` over the same trips.

    The mean is an uncorrelated scalar subquery, run once and handed to the
    filter as a constant: no join, and no window over the whole table.
    """
    return df.filter(F.col(column) < average_speed(df, column).scalar())
