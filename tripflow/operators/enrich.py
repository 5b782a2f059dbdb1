"""Zone correction and the reporting month."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import remapped, within_month
from tripflow.schemas import PICKUP, REPORT_MONTH, REPORT_YEAR, ZONE, ZONE_SWAP

# A CASE with more branches than this would fall out of generated code; longer
# mappings are joined.
INLINE_KEYS = 64


def remap_keys(
    df: DataFrame,
    column: str = ZONE,
    mapping: Mapping[int, int] | DataFrame = ZONE_SWAP,
) -> DataFrame:
    """Rewrite ``column`` through ``mapping``; unlisted keys and NULL stay.

    The column keeps its type in every form. A short dict becomes a CASE
    expression and adds no shuffle; a longer one is joined like a DataFrame of
    (old, new), its first two columns. Spark broadcasts that side only if its
    size is under its broadcast threshold, and otherwise shuffles both sides,
    where adaptive execution splits the partitions of hot keys. Each key of a
    DataFrame may be listed once: checked up front, as a repeated key would
    multiply trips.
    """
    if isinstance(mapping, DataFrame):
        _require_single_keys(mapping)
        return _remap_by_join(df, column, mapping)
    kind = df.schema[column].dataType
    if len(mapping) > INLINE_KEYS:
        pairs = df.sparkSession.createDataFrame(list(mapping.items()), ["old", "new"])
        return _remap_by_join(df, column, pairs)
    return df.withColumn(column, remapped(F.col(column), mapping).cast(kind))


def _require_single_keys(mapping: DataFrame) -> None:
    old = mapping.columns[0]
    repeated = mapping.filter(F.col(old).isNotNull()).groupBy(old).count().filter("count > 1")
    example = repeated.select(old).take(1)
    if example:
        raise ValueError(f"the mapping lists key {example[0][0]} more than once")


def _remap_by_join(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    old, new = mapping.columns[:2]
    # The lookup goes into the join as read: skewed partitions can only be split
    # where nothing stands between the shuffle and the join.
    lookup = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    replaced = (
        F.when(F.col("_old").isNotNull(), F.col("_new").cast(df.schema[column].dataType))
        .otherwise(F.col(column))
        .alias(column)
    )
    return df.join(lookup, F.col(column) == F.col("_old"), "left").select(
        *[replaced if name == column else F.col(name) for name in df.columns]
    )


def in_month(
    df: DataFrame,
    column: str = PICKUP,
    year: int = REPORT_YEAR,
    month: int = REPORT_MONTH,
) -> DataFrame:
    """Keep the rows whose ``column`` lies in one calendar month."""
    return df.filter(within_month(F.col(column), year, month))
