"""Schema contract of every dataset, and the fixed values of the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
DISTANCE = "trip_distance"
ZONE = "PULocationID"
DURATION = "trip_duration"
SPEED = "trip_speed"
WEEK = "week"

RAW_TRIPS = T.StructType(
    [
        T.StructField(PICKUP, T.TimestampNTZType()),
        T.StructField(DROPOFF, T.TimestampNTZType()),
        T.StructField(DISTANCE, T.DoubleType()),
        T.StructField(ZONE, T.LongType()),
    ]
)

# Silver and gold share one schema: the raw columns and the duration in hours.
SILVER_TRIPS = T.StructType([*RAW_TRIPS.fields, T.StructField(DURATION, T.DoubleType())])
GOLD_TRIPS = SILVER_TRIPS

# The relational serving table narrows the zone to a 4-byte integer.
SERVING_TRIPS = T.StructType(
    [
        T.StructField(f.name, T.IntegerType() if f.name == ZONE else f.dataType)
        for f in GOLD_TRIPS.fields
    ]
)

REPORT = T.StructType(
    [
        T.StructField(WEEK, T.LongType()),
        T.StructField(ZONE, T.LongType()),
        T.StructField("trip_count", T.LongType()),
        T.StructField("rank", T.LongType()),
    ]
)

# The two pickup zones recorded the wrong way round, the reporting
# month and the length of the ranking.
ZONE_SWAP = {161: 237, 237: 161}
REPORT_YEAR = 2021
REPORT_MONTH = 3
TOP_K = 5
