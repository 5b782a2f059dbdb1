"""Contract checks and an account of rejected trips, each in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import within_month
from tripflow.operators.clean import project_trips, with_trip_duration
from tripflow.schemas import DISTANCE, DURATION, PICKUP, REPORT_MONTH, REPORT_YEAR

_INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


@dataclass(frozen=True)
class ColumnRule:
    """What one column must look like: its type, and the values it may take."""

    name: str
    type: str
    low: Any = None
    high: Any = None


def check_contract(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """One row per column, expected or found, with the rows that break its rule.

    ``actual_type`` is NULL for a missing column and ``expected_type`` for one
    no rule names. All counts come from a single aggregation of the table.
    """
    found = {name.lower(): df.schema[name].dataType.simpleString() for name in df.columns}
    named = {rule.name.lower() for rule in rules}
    facts = [_rule_facts(rule, found.get(rule.name.lower())) for rule in rules]
    facts += [
        _facts(name, None, found[name.lower()], F.count_if(F.col(name).isNull()))
        for name in df.columns
        if name.lower() not in named
    ]
    names = ("null_rows", "uncastable_rows", "out_of_range_rows")
    totals = [F.count(F.lit(1)).alias("rows")]
    totals += [
        count.alias(f"{name}_{i}") for i, (_, counts) in enumerate(facts) for name, count in zip(names, counts)
    ]
    rows = [
        F.struct(*labels, F.col("rows"), *[F.col(f"{name}_{i}").alias(name) for name in names])
        for i, (labels, _) in enumerate(facts)
    ]
    return df.agg(*totals).select(F.inline(F.array(*rows)))


def _facts(
    name: str,
    expected: str | None,
    actual: str | None,
    nulls: Column,
    uncastable: Column | None = None,
    out_of_range: Column | None = None,
) -> tuple[list[Column], list[Column]]:
    none = F.count_if(F.lit(False))
    labels = [
        F.lit(name).alias("column"),
        F.lit(expected).cast("string").alias("expected_type"),
        F.lit(actual).cast("string").alias("actual_type"),
    ]
    return labels, [
        nulls,
        none if uncastable is None else uncastable,
        none if out_of_range is None else out_of_range,
    ]


def _rule_facts(rule: ColumnRule, actual: str | None) -> tuple[list[Column], list[Column]]:
    if actual is None:
        return _facts(rule.name, rule.type, None, F.count(F.lit(1)))
    raw = F.col(rule.name)
    value = _cast_or_null(raw, actual, rule.type)
    outside = F.lit(False)
    if rule.low is not None:
        outside = outside | (value < F.lit(rule.low).cast(rule.type))
    if rule.high is not None:
        outside = outside | (value > F.lit(rule.high).cast(rule.type))
    return _facts(
        rule.name,
        rule.type,
        actual,
        F.count_if(raw.isNull()),
        F.count_if(raw.isNotNull() & value.isNull()),
        F.count_if(outside),
    )


def _cast_or_null(value: Column, actual: str, wanted: str) -> Column:
    """``value`` as ``wanted``, NULL where it does not fit.

    Narrowing an integer is a comparison here: TRY_CAST raises and catches an
    exception for each row that does not fit, which made the check several times
    slower on tables with many such rows.
    """
    if actual == wanted:
        return value
    if actual in _INTEGER_BITS and wanted in _INTEGER_BITS:
        limit = 1 << (_INTEGER_BITS[wanted] - 1)
        return F.when(value.cast("bigint").between(-limit, limit - 1), value.cast("bigint"))
    return value.try_cast(wanted)


def reject_profile(df: DataFrame, year: int = REPORT_YEAR, month: int = REPORT_MONTH) -> DataFrame:
    """One row: how many trips each rule removes, what is left, and the extremes."""
    duration = F.col(DURATION)
    inside = F.coalesce(within_month(F.col(PICKUP), year, month), F.lit(False))
    return with_trip_duration(project_trips(df)).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(duration.isNull()).alias("null_duration"),
        F.count_if(duration < 0).alias("negative_duration"),
        F.count_if(duration == 0).alias("zero_duration"),
        F.count_if(~inside).alias("outside_month"),
        F.count_if(duration >= 0).alias("kept_silver"),
        F.count_if((duration >= 0) & inside).alias("kept_gold"),
        F.min(DURATION).alias("min_duration"),
        F.max(DURATION).alias("max_duration"),
        F.min(DISTANCE).alias("min_distance"),
        F.max(DISTANCE).alias("max_distance"),
    )


def rejected(df: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """The trips cleaning removes, each with the first rule it breaks.

    With ``year`` and ``month`` also the trips outside that month: kept and
    rejected together are then the raw trips of the gold dataset, without them
    those of the silver one.
    """
    if (year is None) != (month is None):
        raise ValueError("give year and month together, or neither")
    return (
        with_trip_duration(project_trips(df))
        .withColumn("reject_reason", reject_reason(year, month))
        .filter(F.col("reject_reason").isNotNull())
    )


def reject_reason(year: int | None = None, month: int | None = None) -> Column:
    """The first rule a trip with its duration breaks, NULL where it breaks none."""
    duration = F.col(DURATION)
    reason = F.when(duration.isNull(), "null_duration").when(duration < 0, "negative_duration")
    if year is not None:
        reason = reason.when(~within_month(F.col(PICKUP), year, month), "outside_month")
    return reason
