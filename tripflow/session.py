"""Spark session with the settings the library's results rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Trips carry wall-clock times without a zone; UTC keeps Spark from shifting them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # Right-size shuffle partitions and split hot keys at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Report the true size of hot shuffle blocks also above 2000 partitions, where
    # Spark otherwise averages them and hot keys go unseen.
    "spark.shuffle.accurateBlockSkewedFactor": "5.0",
}


def get_session(app_name: str = "tripflow", **extra: str) -> SparkSession:
    """Build (or reuse) a session; the master comes from the environment or ``extra``.

    ``extra`` holds further settings, keyed by their full Spark name:
    ``get_session(**{"spark.master": "local[8]"})``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
