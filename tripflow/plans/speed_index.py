"""The report over a growing set of trips, without reading all of them again.

Two datasets stand in for the trips: their speeds, stored by period and by speed
bucket, and a histogram with trips and summed speed per period, week, zone and
bucket. Both follow the periods (days, months or years of pickup) that changed.
The report takes the mean from the histogram's sums. Buckets below the mean's own
count as a whole, those above not at all, and only the trips of that one bucket
are read, to be compared with the mean one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions import iso_week, iso_year
from tripflow.observed import observed
from tripflow.operators import order_report, positive_trips, top_k_per_group, with_trip_speed
from tripflow.plans.report import ISO_YEAR
from tripflow.schemas import PICKUP, SPEED, TOP_K, WEEK, ZONE
from tripflow.sources.files import children, remove
from tripflow.sources.zones import DAY, SHUFFLE_PARTS, folder_of

BUCKET, TRIPS, TOTAL = "speed_bucket", "trips", "total_speed"
# Buckets in an octave of speed; and the bucket of speeds that are not above zero.
PER_OCTAVE = 4
LOWEST = -100_000

_SPEEDS = T.StructType(
    [
        T.StructField(ISO_YEAR, T.LongType()),
        T.StructField(WEEK, T.LongType()),
        T.StructField(ZONE, T.LongType()),
        T.StructField(SPEED, T.DoubleType()),
        T.StructField(BUCKET, T.IntegerType()),
    ]
)
_HISTOGRAM = T.StructType(
    [
        *_SPEEDS.fields[:3],
        T.StructField(BUCKET, T.IntegerType()),
        T.StructField(TRIPS, T.LongType()),
        T.StructField(TOTAL, T.DoubleType()),
    ]
)


def bucket_of(speed: Column) -> Column:
    """The bucket of a speed: a faster trip is never in a lower one. NULL stays NULL."""
    return F.when(speed > 0, F.floor(F.log2(speed) * PER_OCTAVE)).when(speed <= 0, LOWEST).cast("int")


def update_speed_index(
    spark: SparkSession, trips: DataFrame, index: str, periods: Sequence[date] | None = None, by: str = DAY
) -> None:
    """Bring the index up to date with the periods of ``trips``, which must hold all trips of each.

    Periods are days, months or years, by their first day. ``periods`` names those that
    changed, so that one without trips any more goes, too; trips of others are left out.
    Others stay untouched, files included. Trips without a speed have no part in the
    report and none in the index.
    """
    index = index.rstrip("/")
    moving = trips.transform(positive_trips).transform(with_trip_speed).filter(F.col(SPEED).isNotNull())
    speeds = moving.select(
        folder_of(by).alias(by),
        bucket_of(F.col(SPEED)).alias(BUCKET),
        iso_year(F.col(PICKUP)).alias(ISO_YEAR),
        iso_week(F.col(PICKUP)).alias(WEEK),
        ZONE,
        SPEED,
    )
    if periods is not None:
        speeds = speeds.filter(F.col(by).isin(list(periods)))
    seen = Observation()
    (
        speeds.observe(seen, F.collect_set(F.struct(by, BUCKET)).alias("written"))
        .hint("rebalance", SHUFFLE_PARTS, by, BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by, BUCKET)
        .parquet(f"{index}/speeds")
    )
    # Periods and buckets, a few dozen of these in each.
    written: dict[str, set[str]] = {}
    for row in observed(seen, written=[])["written"]:
        written.setdefault(f"{by}={row[by]}", set()).add(f"{BUCKET}={row[BUCKET]}")
    changed = set(written) | {f"{by}={p}" for p in periods or ()}
    for period in sorted(changed):
        for bucket in children(spark, f"{index}/speeds/{period}"):
            if bucket.startswith(f"{BUCKET}=") and bucket not in written.get(period, ()):
                remove(spark, f"{index}/speeds/{period}/{bucket}")
        if period not in written:
            for part in ("speeds", "histogram"):
                remove(spark, f"{index}/{part}/{period}")
    if not written:
        return
    again = _read(spark, f"{index}/speeds", _SPEEDS, by)
    days = [date.fromisoformat(p.partition("=")[2]) for p in written]
    counted = again.filter(F.col(by).isin(days)).groupBy(by, ISO_YEAR, WEEK, ZONE, BUCKET).agg(
        F.count(F.lit(1)).alias(TRIPS), F.sum(SPEED).alias(TOTAL)
    )
    (
        counted.hint("rebalance", SHUFFLE_PARTS, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(f"{index}/histogram")
    )


def _read(spark: SparkSession, path: str, schema: T.StructType, by: str) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(by, T.DateType())])).parquet(path)


def indexed_report(
    spark: SparkSession, index: str, k: int = TOP_K, by_iso_year: bool = False, by: str = DAY
) -> DataFrame:
    """What ``slow_zone_report`` says about all trips of the index.

    The histogram is read twice, and of the speeds the bucket that holds the mean.
    """
    histogram = _read(spark, f"{index.rstrip('/')}/histogram", _HISTOGRAM, by)
    # One row: the mean, known before the plan, so that it names the bucket to read.
    found = histogram.agg((F.sum(TOTAL) / F.sum(TRIPS)).alias("mean")).select(
        "mean", bucket_of(F.col("mean")).alias("bucket")
    )
    mean, bucket = found.first()
    period = [ISO_YEAR, WEEK] if by_iso_year else [WEEK]
    below = histogram.filter(F.col(BUCKET) < F.lit(bucket)).select(*period, ZONE, TRIPS)
    speeds = _read(spark, f"{index.rstrip('/')}/speeds", _SPEEDS, by)
    beside = speeds.filter((F.col(BUCKET) == F.lit(bucket)) & (F.col(SPEED) < F.lit(mean)))
    counts = (
        below.union(beside.select(*period, ZONE, F.lit(1).cast("bigint")))
        .groupBy(*period, ZONE)
        .agg(F.sum(TRIPS).alias("trip_count"))
    )
    order = [F.desc("trip_count"), F.asc_nulls_last(ZONE)]
    top = top_k_per_group(counts, period, order, k)
    return order_report(top.select(*period, ZONE, "trip_count", "rank"), *period[:-1])
