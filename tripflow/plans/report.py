"""The report: per ISO week, the zones with the most slower-than-average trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions import iso_week, iso_year
from tripflow.operators import (
    count_by,
    order_report,
    positive_trips,
    slow_trips,
    top_k_per_group,
    with_trip_speed,
)
from tripflow.schemas import PICKUP, TOP_K, WEEK, ZONE

ISO_YEAR = "iso_year"


def trip_speeds(trips: DataFrame) -> DataFrame:
    """Week, zone and speed of every trip of positive length."""
    return (
        trips.transform(positive_trips)
        .transform(with_trip_speed)
        .select(
            iso_year(F.col(PICKUP)).alias(ISO_YEAR),
            iso_week(F.col(PICKUP)).alias(WEEK),
            ZONE,
            "trip_speed",
        )
    )


def slow_zone_report(trips: DataFrame, k: int = TOP_K, by_iso_year: bool = False) -> DataFrame:
    """``week``, zone, ``trip_count`` and ``rank``, the ``k`` worst zones per week.

    Weeks of different years count together unless ``by_iso_year``, which adds
    the year in front. Two passes over ``trips``, for the mean and for the
    counts, so pass a stored dataset rather than a long computation; past the
    scan, only counts per week and zone move.
    """
    period = [ISO_YEAR, WEEK] if by_iso_year else [WEEK]
    counts = count_by(slow_trips(trip_speeds(trips)), *period, ZONE)
    order = [F.desc("trip_count"), F.asc_nulls_last(ZONE)]
    top = top_k_per_group(counts, period, order, k)
    return order_report(top.select(*period, ZONE, "trip_count", "rank"), *period[:-1])


_REPORT_SQL = """
WITH moving AS (
    SELECT CAST(weekofyear(tpep_pickup_datetime) AS BIGINT) AS week,
           PULocationID,
           try_divide(trip_distance, (ends - starts) / 1e6D / 3600) AS mph
    FROM (
        SELECT *,
               unix_micros(to_timestamp_ltz(tpep_pickup_datetime, 'yyyy-MM-dd HH:mm:ss')) AS starts,
               unix_micros(to_timestamp_ltz(tpep_dropoff_datetime, 'yyyy-MM-dd HH:mm:ss')) AS ends
        FROM {trips}
    )
    WHERE tpep_dropoff_datetime > tpep_pickup_datetime
),
threshold AS (
    SELECT avg(mph) AS mean_mph FROM moving
),
tally AS (
    SELECT week, PULocationID, count(*) AS trip_count
    FROM moving
    WHERE mph < (SELECT mean_mph FROM threshold)
    GROUP BY ALL
),
placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY week ORDER BY trip_count DESC, PULocationID ASC NULLS LAST
    ) AS place
    FROM tally
)
SELECT week, PULocationID, trip_count, CAST(place AS BIGINT) AS rank
FROM placed
WHERE place <= {k}
ORDER BY week NULLS LAST, trip_count DESC, PULocationID NULLS LAST
"""


def slow_zone_report_sql(spark: SparkSession, trips: DataFrame | str, k: int = TOP_K) -> DataFrame:
    """The report as one SQL statement, over a DataFrame or a table's name."""
    frame = spark.table(trips) if isinstance(trips, str) else trips
    return spark.sql(_REPORT_SQL, trips=frame, k=k)
