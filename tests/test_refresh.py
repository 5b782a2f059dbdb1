"""Refreshing only touched folders; silver and quarantine in one pass."""

from __future__ import annotations

import os
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_serving import Recorder

from tripflow.operators import rejected
from tripflow.plans import BatchConfig, build_gold, build_silver, conform_serving, run_pipeline
from tripflow.plans.checked import Limits, QualityError, read_quarantine, write_checked_silver
from tripflow.plans.refresh import refresh_zones
from tripflow.schemas import RAW_TRIPS, SILVER_TRIPS
from tripflow.sources import land_files, read_table, read_zone


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def trips(spark, times, zone=161):
    rows = [(t, t and t.replace(hour=23), 2.0, zone) for t in times]
    return spark.createDataFrame(rows, RAW_TRIPS).coalesce(1)


def at(*days, month=3):
    return [datetime(2021, month, d, 10) for d in days]


def add(df, folder, name):
    """One file under a name of the test's choosing."""
    staged = f"{folder}-{name}"
    df.write.mode("overwrite").parquet(staged)
    os.makedirs(folder, exist_ok=True)
    part = next(Path(staged).glob("*.parquet"))
    os.replace(part, f"{folder}/{name}.parquet")


class Zones:
    def __init__(self, spark, root, by="pickup_date"):
        self.spark, self.by = spark, by
        self.bronze, self.silver, self.gold, self.state = (f"{root}/{n}" for n in ("bronze", "silver", "gold", "state"))

    def refresh(self):
        return refresh_zones(self.spark, self.bronze, self.silver, self.gold, self.state, by=self.by)

    def check(self):
        """Equal to a full build of everything."""
        raw = read_zone(self.spark, self.bronze, schema=RAW_TRIPS)
        silver, gold = (self.spark.read.parquet(p).drop(self.by) for p in (self.silver, self.gold))
        assert rows_of(silver) == rows_of(build_silver(raw))
        assert rows_of(gold) == rows_of(build_gold(build_silver(raw)))

    def files(self, zone="silver"):
        root = Path(getattr(self, zone))
        return {str(p.relative_to(root)) for p in root.rglob("*.parquet")}


@pytest.mark.parametrize("by", ["pickup_date", "pickup_month"])
def test_only_touched_folders_are_rebuilt(spark, tmp_path, by):
    zones = Zones(spark, tmp_path, by)
    add(trips(spark, at(1, 2) + at(1, month=4)), zones.bronze, "a")
    add(trips(spark, at(3)), zones.bronze, "b")
    first = zones.refresh()
    assert first.files == 2
    zones.check()
    before = zones.files(), zones.files("gold")
    assert zones.refresh().folders == [] and (zones.files(), zones.files("gold")) == before

    add(trips(spark, at(2, month=4) + at(7, month=5)), zones.bronze, "c")
    done = zones.refresh()
    folder = (lambda m, d: date(2021, m, d)) if by == "pickup_date" else (lambda m, d: date(2021, m, 1))
    assert (done.folders, done.files) == ([folder(4, 2), folder(5, 7)], 1)
    zones.check()
    kept = {f for f in before[0] if f.split("/")[0] not in {f"{by}={d}" for d in done.folders}}
    assert kept and kept <= zones.files()
    assert zones.files("gold") == before[1]


def test_late_changed_and_vanished_files(spark, tmp_path):
    zones = Zones(spark, tmp_path)
    add(trips(spark, at(1, 2)), zones.bronze, "a")
    add(trips(spark, at(2, 3)), zones.bronze, "b")
    add(trips(spark, at(4)), zones.bronze, "only day four")
    zones.refresh()
    add(trips(spark, at(2), zone=7), zones.bronze, "late")
    assert zones.refresh().folders == [date(2021, 3, 2)]
    zones.check()
    add(trips(spark, at(3, 5), zone=8), zones.bronze, "b")  # another file under the same name
    assert zones.refresh().folders == [date(2021, 3, d) for d in (2, 3, 5)]
    zones.check()
    os.remove(f"{zones.bronze}/only day four.parquet")
    assert zones.refresh().folders == [date(2021, 3, 4)]
    zones.check()
    assert not [f for f in zones.files() if "2021-03-04" in f]


def test_awkward_files(spark, tmp_path):
    zones = Zones(spark, tmp_path)
    add(trips(spark, [None, None]), zones.bronze, "no times")
    add(trips(spark, []), zones.bronze, "no rows")
    add(trips(spark, [None, datetime(2021, 3, 31, 23, 59, 59, 999999)]), zones.bronze, "last moment")
    add(trips(spark, at(9)).withColumn("PULocationID", F.col("PULocationID").cast("int")), zones.bronze, "narrow")
    assert zones.refresh().folders == [date(2021, 3, 9), date(2021, 3, 31)]
    zones.check()
    assert zones.refresh().files == 0
    add(trips(spark, at(9)).drop("trip_distance"), zones.bronze, "lacking")
    with pytest.raises(ValueError, match="lack trip_distance, such as lacking"):
        zones.refresh()


def test_a_refresh_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    zones = Zones(spark, tmp_path)
    add(trips(spark, at(1, 2)), zones.bronze, "a")
    zones.refresh()
    add(trips(spark, at(2), zone=9), zones.bronze, "b")
    with monkeypatch.context() as patch:
        patch.setattr("tripflow.plans.refresh.build_gold", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            zones.refresh()
    assert zones.refresh().folders == [date(2021, 3, 2)]
    zones.check()


def test_landing_again_touches_nothing(spark, tmp_path):
    zones, source = Zones(spark, tmp_path), str(tmp_path / "source")
    add(trips(spark, at(1)), source, "a")
    land_files(spark, source, zones.bronze, only_new=True)
    assert zones.refresh().files == 1
    add(trips(spark, at(2)), source, "b")
    manifest = land_files(spark, source, zones.bronze, only_new=True)
    assert {r.file for r in manifest.collect()} == {"b.parquet"}
    assert zones.refresh().folders == [date(2021, 3, 2)]
    zones.check()


# --- silver with its quarantine


def raw_trips(spark):
    start = datetime(2021, 3, 1, 10)
    rows = [(start, datetime(2021, 3, 1, 11), 1.0, 5)] * 6
    rows += [(start, None, 1.0, 5), (None, start, 1.0, 5), (start, datetime(2021, 3, 1, 9), 1.0, 5)]
    rows += [(datetime(2021, 3, 2), datetime(2021, 3, 2), None, None)]
    return spark.createDataFrame(rows, RAW_TRIPS)


@pytest.mark.parametrize("by_day", [False, True])
def test_silver_and_quarantine_are_the_raw_trips(spark, tmp_path, by_day):
    silver, quarantine = str(tmp_path / "silver"), str(tmp_path / "quarantine")
    raw = raw_trips(spark)
    for _ in range(2):  # the second time in place of the first
        counts = write_checked_silver(spark, raw, silver, quarantine, by_day=by_day)
    assert counts == {"trips": 10, "null_duration": 2, "negative_duration": 1, "null_distance": 1, "null_pickup": 1}
    kept = read_zone(spark, silver, schema=SILVER_TRIPS).select(*SILVER_TRIPS.names)
    assert rows_of(kept) == rows_of(build_silver(raw))
    assert rows_of(read_quarantine(spark, quarantine)) == rows_of(rejected(raw))
    assert sorted(os.listdir(tmp_path)) == ["quarantine", "silver"]


def test_one_scan_writes_both(spark, tmp_path):
    source = str(tmp_path / "raw")
    raw_trips(spark).write.parquet(source)
    raw = read_zone(spark, source, schema=RAW_TRIPS)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checked", "one scan")
    write_checked_silver(spark, raw, str(tmp_path / "s"), str(tmp_path / "q"))
    jobs = tracker.getJobIdsForGroup("checked")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


@pytest.mark.parametrize(
    ("limits", "said"),
    [
        (Limits(rejected=0.2), "3 of 10 trips rejected"),
        (Limits(trips=11), "10 trips, at least 11"),
        (Limits(null_distance=0.1), "1 of 7 kept trips lack a distance"),
    ],
)
def test_limits_stop_the_batch_and_leave_silver(spark, tmp_path, limits, said):
    silver, quarantine = str(tmp_path / "silver"), str(tmp_path / "quarantine")
    good = raw_trips(spark).limit(6)
    write_checked_silver(spark, good, silver, quarantine)
    before = sorted(os.listdir(silver))
    with pytest.raises(QualityError, match=said):
        write_checked_silver(spark, raw_trips(spark), silver, quarantine, limits)
    assert sorted(os.listdir(silver)) == before
    assert read_quarantine(spark, quarantine).count() == 3
    write_checked_silver(spark, raw_trips(spark), silver, quarantine, Limits(rejected=0.3, trips=10, null_distance=0.2))
    assert spark.read.parquet(silver).count() == 7


@pytest.mark.parametrize("by_day", [False, True])
def test_nothing_kept_and_nothing_rejected(spark, tmp_path, by_day):
    silver, quarantine = str(tmp_path / "silver"), str(tmp_path / "quarantine")
    bad = raw_trips(spark).filter("tpep_dropoff_datetime IS NULL")
    write_checked_silver(spark, bad, silver, quarantine, by_day=by_day)
    assert spark.read.schema(SILVER_TRIPS).parquet(silver).count() == 0
    assert read_quarantine(spark, quarantine).count() == 1
    write_checked_silver(spark, raw_trips(spark).limit(6), silver, quarantine, by_day=by_day)
    assert spark.read.parquet(silver).count() == 6
    assert read_quarantine(spark, quarantine).count() == 0
    write_checked_silver(spark, raw_trips(spark).limit(0), silver, quarantine, by_day=by_day)
    assert spark.read.schema(SILVER_TRIPS).parquet(silver).count() == 0


# --- the batch


def test_an_incremental_batch_loads_each_row_once(spark, tmp_path, monkeypatch):
    source, sink = str(tmp_path / "source"), Recorder()
    monkeypatch.setattr("tripflow.plans.batch.JdbcSink", lambda *_, **__: sink)
    folders = {n: str(tmp_path / n) for n in ("bronze", "silver", "gold", "state")}
    plan = BatchConfig(
        source=source,
        **folders,
        database="incremental_db",
        jdbc_url="jdbc:x:y",
        serving_table="trips",
        load_checkpoint=str(tmp_path / "checkpoint"),
    )
    add(trips(spark, at(1, 2)), source, "a")
    for name, more in (("b", at(2, 3)), (None, None), ("c", at(1, month=4))):
        run_pipeline(spark, plan)
        if name:
            add(trips(spark, more), source, name)
    sink.fail = "half staged"
    add(trips(spark, at(3)), source, "d")
    with pytest.raises(Exception, match="lost"):
        run_pipeline(spark, plan)
    run_pipeline(spark, plan)
    raw = read_zone(spark, source, schema=RAW_TRIPS)
    assert sorted(sink.rows) == rows_of(conform_serving(build_gold(build_silver(raw))))
    assert rows_of(read_table(spark, "incremental_db.silver").drop("pickup_date")) == rows_of(build_silver(raw))


def test_a_batch_with_quarantine_stops_at_its_limits(spark, tmp_path):
    folders = {n: str(tmp_path / n) for n in ("bronze", "silver", "gold", "quarantine")}
    raw_trips(spark).write.parquet(folders["bronze"])
    with pytest.raises(QualityError, match="3 of 10"):
        run_pipeline(spark, BatchConfig(**folders, limits=Limits(rejected=0.1)))
    assert not os.path.exists(folders["gold"])
    run_pipeline(spark, BatchConfig(**folders, limits=Limits(rejected=0.3)))
    assert spark.read.parquet(folders["silver"]).count() == 7
    assert read_quarantine(spark, folders["quarantine"]).count() == 3


def test_settings_that_do_not_go_together(spark, tmp_path):
    folders = {n: str(tmp_path / n) for n in ("bronze", "silver", "gold")}
    with pytest.raises(ValueError, match="load_checkpoint needs state"):
        run_pipeline(spark, BatchConfig(**folders, jdbc_url="u", serving_table="t", load_checkpoint="/c"))
    with pytest.raises(ValueError, match="not with state"):
        run_pipeline(spark, BatchConfig(**folders, quarantine="/q", state="/s"))
