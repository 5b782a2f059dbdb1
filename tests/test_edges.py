"""Hand-written trips on every boundary, with their silver, gold and report values."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.functions import duration_hours, elapsed_seconds, epoch_floor, iso_week, iso_year, month_bounds
from tripflow.operators import (
    average_speed,
    drop_bad_durations,
    positive_trips,
    slow_trips,
    with_trip_duration,
    with_trip_speed,
)
from tripflow.plans import build_gold, build_silver, slow_zone_report, slow_zone_report_sql
from tripflow.schemas import GOLD_TRIPS, RAW_TRIPS, REPORT, SILVER_TRIPS


def at(text):
    return None if text is None else datetime.fromisoformat(text)


# id, pickup, dropoff, distance, zone, silver hours, gold zone, speed; "-" where dropped
EDGES = [
    (1, "2021-03-01 10:00:00", "2021-03-01 10:30:00", 5.0, 161, 0.5, 237, 10.0),
    (2, "2021-03-01 10:00:00", "2021-03-01 11:00:00", 5.0, 237, 1.0, 161, 5.0),
    (3, "2021-03-02 10:00:00", "2021-03-02 10:00:00", 1.0, 5, 0.0, 5, "-"),
    (4, "2021-03-02 10:00:00", "2021-03-02 09:00:00", 1.0, 5, "-", "-", "-"),
    (5, "2021-03-02 10:00:00", None, 1.0, 5, "-", "-", "-"),
    (6, "2021-02-28 23:59:59", "2021-03-01 00:10:00", 1.0, 5, 601 / 3600, "-", "-"),
    (7, "2021-03-31 23:59:59.999999", "2021-04-01 00:20:00", 3.0, 9, 1201 / 3600, 9, 8.9999999925),
    (8, "2020-03-15 10:00:00", "2020-03-15 10:20:00", 1.0, 5, 1 / 3, "-", "-"),
    (9, "2021-03-14 01:30:00", "2021-03-14 03:30:00", 20.0, 236, 2.0, 236, 10.0),
    (10, "2021-03-03 10:00:00.900000", "2021-03-03 10:00:00.200000", 1.0, 7, 0.0, 7, "-"),
    (11, "2021-03-03 10:00:00.200000", "2021-03-03 10:00:00.900000", 1.0, 7, 0.0, 7, 5142.857142857143),
    (12, "2021-03-04 10:00:00", "2021-03-04 10:20:00", 2.0, None, 1 / 3, None, 6.0),
    (13, "2021-03-04 10:00:00", "2021-03-04 10:20:00", None, 5, 1 / 3, 5, None),
    (14, "2021-03-05 10:00:00", "2021-03-05 10:20:00", 0.0, 5, 1 / 3, 5, 0.0),
    (15, "2021-03-05 10:00:00", "2021-03-05 10:20:00", -1.0, 5, 1 / 3, 5, -3.0),
]

REPORT_ROWS = [
    (9, 5, 2, 1),
    (9, 161, 1, 2),
    (9, 237, 1, 3),
    (9, None, 1, 4),
    (10, 236, 1, 1),
    (13, 9, 1, 1),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(at(p), at(d), dist, zone) for _, p, d, dist, zone, *_ in EDGES]
    return spark.createDataFrame(rows, RAW_TRIPS)


@pytest.fixture(scope="module")
def gold(raw):
    return build_gold(build_silver(raw))


def multiset(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_silver(raw):
    expected = [(at(p), at(d), dist, zone, hours) for _, p, d, dist, zone, hours, *_ in EDGES if hours != "-"]
    silver = build_silver(raw)
    assert silver.schema == SILVER_TRIPS
    assert multiset(silver.collect()) == multiset(expected)


def test_gold(gold):
    expected = [(at(p), at(d), dist, z, hours) for _, p, d, dist, _, hours, z, _ in EDGES if z != "-"]
    assert gold.schema == GOLD_TRIPS
    assert multiset(gold.collect()) == multiset(expected)


def test_speed(gold):
    speeds = with_trip_speed(positive_trips(gold)).select("trip_speed").collect()
    expected = [s for *_, s in EDGES if s != "-"]
    assert multiset(speeds) == multiset((s,) for s in expected)
    mean = average_speed(with_trip_speed(positive_trips(gold))).first().avg_speed
    assert mean == pytest.approx(647.4821428562)


@pytest.mark.parametrize("form", ["dataframe", "sql", "table"])
def test_report(spark, gold, form):
    if form == "dataframe":
        report = slow_zone_report(gold)
        assert [(f.name, f.dataType) for f in report.schema] == [(f.name, f.dataType) for f in REPORT]
    elif form == "sql":
        report = slow_zone_report_sql(spark, gold)
    else:
        gold.createOrReplaceTempView("edge_gold")
        report = slow_zone_report_sql(spark, "edge_gold")
    assert [tuple(r) for r in report.collect()] == REPORT_ROWS  # in this order


def test_k_bounds_each_week(spark, gold):
    for report in (slow_zone_report(gold, k=2), slow_zone_report_sql(spark, gold, k=2)):
        assert [tuple(r) for r in report.collect()] == [r for r in REPORT_ROWS if r[3] <= 2]


def test_zero_is_kept_unless_asked(raw):
    timed = with_trip_duration(raw)
    assert drop_bad_durations(timed).count() - drop_bad_durations(timed, keep_zero=False).count() == 3


def test_speed_of_a_zero_interval_is_null_not_an_error(raw):
    zero = raw.filter(F.col("tpep_pickup_datetime") == F.col("tpep_dropoff_datetime"))
    assert [r.trip_speed for r in with_trip_speed(zero).collect()] == [None]


def test_unit_of_speed_does_not_change_the_slow_trips(gold):
    mph = with_trip_speed(positive_trips(gold))
    scaled = mph.withColumn("trip_speed", F.col("trip_speed") / 3600 / 3600)
    keep = mph.columns[:-1]
    assert multiset(slow_trips(mph).select(keep).collect()) == multiset(slow_trips(scaled).select(keep).collect())


def test_no_trips_no_report(spark, gold):
    empty = gold.filter(F.lit(False))
    assert slow_zone_report(empty).collect() == []
    assert average_speed(with_trip_speed(empty)).first().avg_speed is None


def test_iso_week_and_year_at_new_year(spark):
    row = (
        spark.sql("SELECT timestamp_ntz'2021-01-03 12:00:00' AS ts")
        .select(iso_week(F.col("ts")), iso_year(F.col("ts")))
        .first()
    )
    assert tuple(row) == (53, 2020)


def test_weeks_of_two_years(spark):
    rows = [
        (datetime(year, 3, 2, 10), datetime(year, 3, 2, hour), 1.0, 4)
        for year in (2020, 2021)
        for hour in (11, 12, 12)
    ]
    trips = spark.createDataFrame(rows, RAW_TRIPS)
    merged = [tuple(r) for r in slow_zone_report(trips).collect()]
    assert merged == [(9, 4, 2, 1), (10, 4, 2, 1)]
    rows += [(datetime(2022, 3, 1, 10), datetime(2022, 3, 1, 12), 1.0, 4)]
    trips = spark.createDataFrame(rows, RAW_TRIPS)
    assert [tuple(r) for r in slow_zone_report(trips).collect()] == [(9, 4, 3, 1), (10, 4, 2, 1)]
    split = [tuple(r) for r in slow_zone_report(trips, by_iso_year=True).collect()]
    assert split == [(2020, 10, 4, 2, 1), (2021, 9, 4, 2, 1), (2022, 9, 4, 1, 1)]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.datetimes(), st.datetimes()), min_size=1, max_size=40))
def test_elapsed_and_epoch_equal_exact_arithmetic(spark, pairs):
    """Against Python's own clock arithmetic, over years 1 to 9999."""
    start = datetime(1970, 1, 1)
    second, micro = timedelta(seconds=1), timedelta(microseconds=1)
    with session(spark, "America/New_York"):
        times = spark.createDataFrame(pairs, "p timestamp_ntz, d timestamp_ntz")
        p, d = F.col("p"), F.col("d")
        found = times.select(epoch_floor(p), epoch_floor(d), elapsed_seconds(p, d)).collect()
    expected = [((p - start) // second, (d - start) // second, ((d - p) // micro) / 1e6) for p, d in pairs]
    assert [tuple(r) for r in found] == expected


@pytest.mark.parametrize(
    ("text", "seconds"),
    [
        ("1970-01-01 00:00:00", 0),
        ("1970-01-01 00:00:00.999999", 0),
        ("1969-12-31 23:59:59.5", -1),
        ("1969-12-31 23:59:59", -1),
        ("0001-01-01 00:00:00", -62135596800),
        ("2021-03-14 02:30:00", 1615689000),
        ("9999-12-31 23:59:59.999999", 253402300799),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_epoch_floor(spark, text, seconds, zone):
    with session(spark, timeZone=zone):
        ts = F.lit(text).cast("timestamp_ntz")
        assert spark.range(1).select(epoch_floor(ts)).first()[0] == seconds
        stored = spark.createDataFrame([(text,)], "t string").select(F.col("t").cast("timestamp_ntz"))
        assert stored.select(epoch_floor(F.col("t"))).first()[0] == seconds


@contextmanager
def session(spark, timeZone, timestampType="TIMESTAMP_LTZ"):
    chosen = {"spark.sql.session.timeZone": timeZone, "spark.sql.timestampType": timestampType}
    before = {key: spark.conf.get(key) for key in chosen}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.fixture(params=["TIMESTAMP_LTZ", "TIMESTAMP_NTZ"])
def new_york(spark, request):
    with session(spark, "America/New_York", request.param):
        yield


# wall-clock hours around the missing hour of spring and the repeated one of autumn
SHIFTS = [
    ("2021-03-14 02:30:00", "2021-03-14 03:30:00", 1.0),
    ("2021-03-14 01:30:00", "2021-03-14 03:30:00", 2.0),
    ("2021-03-14 01:30:00", "2021-03-14 02:30:00", 1.0),
    ("2021-11-07 00:30:00", "2021-11-07 01:30:00", 1.0),
    ("2021-11-07 00:30:00", "2021-11-07 02:30:00", 2.0),
    ("1890-05-01 00:00:00", "2021-05-01 00:00:00", (datetime(2021, 5, 1) - datetime(1890, 5, 1)).days * 24.0),
]


def test_daylight_saving_does_not_matter(spark, gold, new_york):
    times = spark.createDataFrame(SHIFTS, "p string, d string, hours double").select(
        F.col("p").cast("timestamp_ntz").alias("p"), F.col("d").cast("timestamp_ntz").alias("d"), "hours"
    )
    p, d = F.col("p"), F.col("d")
    for row in times.select(duration_hours(p, d), elapsed_seconds(p, d) / 3600, "hours").collect():
        assert row[0] == row[1] == row[2]
    assert [tuple(r) for r in slow_zone_report_sql(spark, gold).collect()] == REPORT_ROWS
    assert [tuple(r) for r in slow_zone_report(gold).collect()] == REPORT_ROWS
    assert {r.trip_duration for r in gold.filter("PULocationID = 236").collect()} == {2.0}


def test_month_bounds():
    assert month_bounds(2021, 3) == ("2021-03-01 00:00:00", "2021-04-01 00:00:00")
    assert month_bounds(2020, 12) == ("2020-12-01 00:00:00", "2021-01-01 00:00:00")
    with pytest.raises(ValueError):
        month_bounds(2021, 13)
