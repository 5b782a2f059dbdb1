"""Counting, top-k per group and the report's order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.schemas import TOP_K, WEEK, ZONE


def count_by(df: DataFrame, *keys: str, name: str = "trip_count") -> DataFrame:
    """Rows per distinct combination of ``keys``; NULL is a key like any other.

    Counts are formed per task before the shuffle, so a key holding a third of
    the rows sends one row per task like every other key.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int = TOP_K,
    name: str = "rank",
) -> DataFrame:
    """Number the rows of each group by ``order`` and keep the first ``k``.

    ``order`` should be total, or the choice among ties is arbitrary. The bound
    sits directly on ROW_NUMBER, so Spark cuts each task's groups to ``k`` rows
    before the shuffle (WindowGroupLimit).
    """
    window = Window.partitionBy(*group).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
    return kept.withColumn(name, F.col(name).cast("bigint"))


def order_report(df: DataFrame, *leading: str) -> DataFrame:
    """Order by week (after any ``leading`` columns), most trips first, then zone."""
    return df.orderBy(
        *[F.asc_nulls_last(c) for c in leading],
        F.asc_nulls_last(WEEK),
        F.desc_nulls_last("trip_count"),
        F.asc_nulls_last(ZONE),
    )
