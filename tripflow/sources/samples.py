"""Order and event tables reshaped as trips, the inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.schemas import DISTANCE, DROPOFF, PICKUP, ZONE
from tripflow.sources.zones import read_zone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_zone(spark, f"{sf_dir}/{name}.parquet")


def order_trips(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A trip per order line, from order date to ship date; whole days.

    Lines of the largest quantity lack a dropoff. Order keys are unique in
    ``orders``, so each line meets one order and hot order keys only skew the
    lineitem side, which adaptive execution splits.
    """
    full = F.col("l_quantity") >= 50
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        _ntz("o_orderdate").alias(PICKUP),
        F.when(~full, _ntz("l_shipdate")).alias(DROPOFF),
        F.col("l_quantity").alias(DISTANCE),
        F.col("l_suppkey").alias(ZONE),
    )


def event_trips(events: DataFrame) -> DataFrame:
    """A trip per event, with fractions of a second; some negative, some without end."""
    seconds = (F.col("value") - 5).cast("decimal(18,6)")
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return events.select(
        "event_id",
        _ntz("ts").alias(PICKUP),
        F.when(F.col("event_type") != "error", _ntz("ts") + length).alias(DROPOFF),
        F.col("value").alias(DISTANCE),
        F.col("user_id").alias(ZONE),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_trips(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def second_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_trips(table(spark, sf_dir, "events"))


def _ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")
