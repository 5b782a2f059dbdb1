"""Bronze to silver, silver to gold, gold to serving. No stage shuffles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tripflow.operators import (
    conform_serving,
    drop_bad_durations,
    in_month,
    project_trips,
    remap_keys,
    with_trip_duration,
)
from tripflow.schemas import REPORT_MONTH, REPORT_YEAR, ZONE, ZONE_SWAP
from tripflow.sources.jdbc import CONNECTIONS, load_jdbc
from tripflow.sources.zones import read_zone


def build_silver(raw: DataFrame) -> DataFrame:
    """The trip columns, with a duration that is neither NULL nor negative."""
    return raw.transform(project_trips).transform(with_trip_duration).transform(drop_bad_durations)


def build_gold(
    silver: DataFrame,
    year: int = REPORT_YEAR,
    month: int = REPORT_MONTH,
    mapping: Mapping[int, int] | DataFrame = ZONE_SWAP,
) -> DataFrame:
    """One month of trips with their zones corrected.

    The month comes first as it commutes with the correction: the scan then
    skips other months, and a joined mapping meets fewer rows.
    """
    month_only = in_month(silver, year=year, month=month)
    return remap_keys(month_only, ZONE, mapping)


def load_serving(
    spark: SparkSession,
    gold_path: str,
    url: str,
    table: str,
    mode: str = "append",
    connections: int = CONNECTIONS,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Load a gold dataset, with all folders below it, into the serving table."""
    gold = read_zone(spark, gold_path, recurse=True)
    load_jdbc(conform_serving(gold), url, table, mode, connections, properties)
