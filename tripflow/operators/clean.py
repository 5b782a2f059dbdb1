"""Row-level trip cleaning. All narrow: one scan stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import duration_hours, elapsed_seconds
from tripflow.schemas import DISTANCE, DROPOFF, DURATION, PICKUP, RAW_TRIPS, SERVING_TRIPS, SPEED


def project_trips(df: DataFrame) -> DataFrame:
    """Keep the four trip columns, in the types of the raw contract.

    A column already of its contract type passes untouched, so filters above
    still reach the scan.
    """
    found = {name.lower(): df.schema[name].dataType for name in df.columns}
    return df.select(
        *[
            (
                F.col(f.name)
                if found.get(f.name.lower()) == f.dataType
                else F.col(f.name).cast(f.dataType)
            ).alias(f.name)
            for f in RAW_TRIPS.fields
        ]
    )


def with_trip_duration(df: DataFrame) -> DataFrame:
    """Add ``trip_duration``: hours between pickup and dropoff in whole seconds."""
    return df.withColumn(DURATION, duration_hours(F.col(PICKUP), F.col(DROPOFF)))


def drop_bad_durations(df: DataFrame, keep_zero: bool = True) -> DataFrame:
    """Drop trips whose duration is NULL or negative (or zero, if asked)."""
    duration = F.col(DURATION)
    return df.filter(duration >= 0 if keep_zero else duration > 0)


def positive_trips(df: DataFrame) -> DataFrame:
    """Keep trips that end strictly after they start, to the microsecond."""
    return df.filter(F.col(DROPOFF) > F.col(PICKUP))


def with_trip_speed(df: DataFrame) -> DataFrame:
    """Add ``trip_speed`` in distance units per hour, from the fractional interval.

    NULL where the interval is zero: division would otherwise fail the job.
    """
    hours = elapsed_seconds(F.col(PICKUP), F.col(DROPOFF)) / F.lit(3600)
    return df.withColumn(SPEED, F.try_divide(F.col(DISTANCE), hours))


def conform_serving(df: DataFrame) -> DataFrame:
    """Columns, order and types of the serving table; a zone over 4 bytes fails."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SERVING_TRIPS.fields])
