"""The report from the speed index equals the report over all trips."""

from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripflow.plans import slow_zone_report
from tripflow.plans.speed_index import bucket_of, indexed_report, update_speed_index
from tripflow.schemas import RAW_TRIPS


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def random_trips(seed, days, n=300):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        start = datetime(2020, 12, 25) + timedelta(days=rng.choice(days), seconds=rng.randrange(86400))
        end = start + timedelta(seconds=rng.choice([-5, 0, 1, 600, 1800, 3600, 7200]))
        distance = rng.choice([None, -1.0, 0.0, 0.5, 1.0, 2.0, 3.0, 5.0, 10.0])
        rows.append((start, rng.choice([end, end, end, None]), distance, rng.choice([None, 1, 2, 3, 4, 5, 6])))
    return rows


def files_of(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet")}


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("by", ["pickup_date", "pickup_month"])
def test_report_after_days_are_added_and_changed(spark, tmp_path, by):
    index = str(tmp_path / "index")
    first, second = random_trips(1, range(0, 8)), random_trips(2, range(8, 12), 120)
    make = lambda rows: spark.createDataFrame(rows, RAW_TRIPS)
    update_speed_index(spark, make(first), index, by=by)
    for year in (False, True):
        assert rows_of(indexed_report(spark, index, by_iso_year=year, by=by)) == rows_of(
            slow_zone_report(make(first), by_iso_year=year)
        )
    before = files_of(tmp_path)
    if by == "pickup_date":  # a month that goes on is given as a whole
        update_speed_index(spark, make(second), index, by=by)
        assert before <= files_of(tmp_path)
    else:
        update_speed_index(spark, make(first + second), index, by=by)
    assert rows_of(indexed_report(spark, index, by=by)) == rows_of(slow_zone_report(make(first + second)))
    # days 8 and 9 lose all of their trips, day 10 gets others
    other = random_trips(3, [10], 30)
    kept = [r for r in second if r[0].day not in (2, 3, 4)]
    if by == "pickup_date":
        update_speed_index(spark, make(other), index, [date(2021, 1, d) for d in (2, 3, 4)], by)
    else:
        january = [r for r in first if r[0].year == 2021] + kept + other
        update_speed_index(spark, make(january), index, [date(2021, 1, 1)], by)
    assert rows_of(indexed_report(spark, index, by=by)) == rows_of(slow_zone_report(make(first + kept + other)))
    assert not [f for f in files_of(tmp_path) if "pickup_date=2021-01-02" in f]


def test_only_the_bucket_of_the_mean_is_read(spark, tmp_path):
    index = str(tmp_path / "index")
    trips = spark.createDataFrame(random_trips(5, range(6)), RAW_TRIPS)
    update_speed_index(spark, trips, index)
    plan = plan_of(indexed_report(spark, index))
    scans = re.findall(r"PartitionFilters: \[(.*)\]", plan)
    assert len(scans) == 1 and re.search(r"speed_bucket#\d+ = -?\d+", scans[0])
    assert "Join" not in plan and "trip_speed" in plan


def test_buckets_keep_the_order_of_speeds(spark):
    speeds = [-3.0, 0.0, 5e-324, 1e-9, 0.1, 0.5, 0.999999999, 1.0, 1.0000000001, 2.0, 3.0, 1e300]
    found = spark.createDataFrame([(s,) for s in speeds], "s double").select("s", bucket_of(F.col("s")).alias("b"))
    buckets = [r.b for r in sorted(found.collect())]
    assert buckets == sorted(buckets) and buckets[0] == buckets[1] < buckets[2]


def test_trips_without_speed_make_no_index(spark, tmp_path):
    trips = spark.createDataFrame([(datetime(2021, 1, 1), datetime(2021, 1, 1), 1.0, 1)], RAW_TRIPS)
    update_speed_index(spark, trips, str(tmp_path / "index"))
    assert files_of(tmp_path) == set()
