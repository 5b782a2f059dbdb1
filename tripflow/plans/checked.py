"""Silver and its quarantine in one pass, with limits on what may be rejected."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.observed import observed
from tripflow.operators import project_trips, with_trip_duration
from tripflow.operators.quality import reject_reason
from tripflow.schemas import DISTANCE, DURATION, PICKUP, SILVER_TRIPS
from tripflow.sources.files import children, exists, move, put_in_place, remove
from tripflow.sources.zones import DAY, SHUFFLE_PARTS, folder_of

REASON = "reject_reason"
KEPT = "kept"
COUNTS = ("trips", "null_duration", "negative_duration", "null_distance", "null_pickup")


class QualityError(RuntimeError):
    """More trips break the rules than the limits allow."""


@dataclass(frozen=True)
class Limits:
    """What a batch may look like; beyond it the batch stops, and silver stays as it was.

    ``rejected``: the largest share of trips that cleaning may reject; ``trips``: the
    least number of trips; ``null_distance``: the largest share of kept trips without
    a distance.
    """

    rejected: float = 1.0
    trips: int = 0
    null_distance: float = 1.0


def write_checked_silver(
    spark: SparkSession,
    raw: DataFrame,
    silver: str,
    quarantine: str,
    limits: Limits = Limits(),
    by_day: bool = False,
) -> dict[str, int]:
    """Replace silver by the trips of ``raw`` that cleaning keeps, and the quarantine by all others.

    Returns the counts. One scan writes both, to a folder beside silver, and counts while it
    writes: ``trips``, ``null_duration``, ``negative_duration``, ``null_distance``,
    ``null_pickup``. Only when the counts are within ``limits`` does the folder take silver's
    place. If they are not, the rejected trips are put into the quarantine, silver stays, and
    ``QualityError`` says what was exceeded. Silver and quarantine together are the raw trips.
    """
    duration = F.col(DURATION)
    labelled = with_trip_duration(project_trips(raw)).withColumn(REASON, F.coalesce(reject_reason(), F.lit(KEPT)))
    seen = Observation()
    counted = labelled.observe(
        seen,
        F.count(F.lit(1)).alias("trips"),
        F.count_if(duration.isNull()).alias("null_duration"),
        F.count_if(duration < 0).alias("negative_duration"),
        F.count_if(F.col(DISTANCE).isNull() & (duration >= 0)).alias("null_distance"),
        F.count_if(F.col(PICKUP).isNull()).alias("null_pickup"),
    )
    folders = [REASON]
    if by_day:
        counted = counted.withColumn(DAY, folder_of(DAY)).hint("rebalance", SHUFFLE_PARTS, REASON, DAY)
        folders.append(DAY)
    staged = f"{silver.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        counted.write.partitionBy(*folders).parquet(staged)
        counts = observed(seen, **dict.fromkeys(COUNTS, 0))
        broken = _broken(counts, limits)
        _put_rejected(spark, staged, quarantine)
        if broken:
            raise QualityError("; ".join(broken))
        kept = f"{staged}/{REASON}={KEPT}"
        if not exists(spark, kept):  # nothing was kept: a silver without rows
            empty = labelled.drop(REASON).limit(0)
            empty.withColumn(DAY, folder_of(DAY)).write.parquet(kept) if by_day else empty.write.parquet(kept)
        put_in_place(spark, kept, silver)
    finally:
        remove(spark, staged)
    return counts


def _broken(counts: dict[str, int], limits: Limits) -> list[str]:
    trips = counts["trips"]
    rejected = counts["null_duration"] + counts["negative_duration"]
    said = []
    if trips < limits.trips:
        said.append(f"{trips} trips, at least {limits.trips} are expected")
    if rejected > limits.rejected * trips:
        said.append(f"{rejected} of {trips} trips rejected, {limits.rejected:.2%} are allowed")
    if counts["null_distance"] > limits.null_distance * (trips - rejected):
        said.append(
            f"{counts['null_distance']} of {trips - rejected} kept trips lack a distance, "
            f"{limits.null_distance:.2%} are allowed"
        )
    return said


def _put_rejected(spark: SparkSession, staged: str, quarantine: str) -> None:
    """The folders of all reasons but ``kept`` as the new quarantine, a folder per reason."""
    gathered = f"{staged}/_{REASON}"
    for name in children(spark, staged):
        if name.startswith(f"{REASON}=") and name != f"{REASON}={KEPT}":
            move(spark, f"{staged}/{name}", f"{gathered}/{name}")
    if exists(spark, gathered):
        put_in_place(spark, gathered, quarantine)
    else:
        remove(spark, quarantine)


def read_quarantine(spark: SparkSession, quarantine: str, schema: T.StructType = SILVER_TRIPS) -> DataFrame:
    """The rejected trips with their ``reject_reason``; none if nothing was rejected."""
    with_reason = T.StructType([*schema.fields, T.StructField(REASON, T.StringType())])
    if not exists(spark, quarantine):
        return spark.createDataFrame([], with_reason)
    return spark.read.schema(with_reason).parquet(quarantine).select(*with_reason.names)
