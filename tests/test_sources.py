"""Zones, catalog, landing, ingest, JDBC settings and the batch."""

from __future__ import annotations

import hashlib
import logging
import os
import subprocess
import sys
from datetime import date, datetime, timedelta
from unittest.mock import MagicMock

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.plans import BatchConfig, build_gold, build_silver, load_serving, run_pipeline, slow_zone_report
from tripflow.schemas import RAW_TRIPS, SERVING_TRIPS
from tripflow.sources import (
    LandingError,
    file_blocks,
    file_checksums,
    land_files,
    load_jdbc,
    read_jdbc,
    read_partitioned,
    read_table,
    read_zone,
    register_zone,
    require_distinct,
    require_match,
    time_slices,
    verify_copy,
    write_partitioned,
    write_zone,
)
from tripflow.sources import landing
from tripflow.sources.scratch import scratch_path
from tripflow.streaming import ingest_new_files


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def trips(spark, days, per_day=1, zone=5):
    rows = [
        (datetime(2021, 3, d, 10), datetime(2021, 3, d, 11), 2.0 + i, zone) for d in days for i in range(per_day)
    ]
    return spark.createDataFrame(rows, RAW_TRIPS)


# --- zones


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "zone")
    write_zone(trips(spark, [1, 2]), path)
    write_zone(trips(spark, [3]), path)
    assert rows_of(read_zone(spark, path)) == rows_of(trips(spark, [3]))
    assert read_zone(spark, path, schema=RAW_TRIPS).schema == RAW_TRIPS


def test_recursive_scan_ignores_folder_names(spark, tmp_path):
    path = str(tmp_path / "zone")
    for year in (1, 2):
        write_zone(trips(spark, [year]), f"{path}/year={year}/deep")
    found = read_zone(spark, path, recurse=True)
    assert found.columns == RAW_TRIPS.names
    assert rows_of(found) == rows_of(trips(spark, [1, 2]))


@pytest.mark.parametrize(
    "paths",
    [("/a/b", "/a/b"), ("/a/b", "/a/b/c"), ("/a/b/", "file:///a/b"), ("file:/a", "/a/x", "/z")],
)
def test_overlapping_paths_are_refused(paths):
    with pytest.raises(ValueError, match="overlap"):
        require_distinct(*paths)


def test_distinct_paths_pass():
    require_distinct("/a/b", "/a/bc", "hdfs://n/a/b", "s3a://x/a")


def test_partitioned_write_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "days")
    write_partitioned(trips(spark, [1, 2, 3]), path)
    write_partitioned(trips(spark, [2], per_day=4), path)
    found = read_partitioned(spark, path)
    assert rows_of(found.drop("pickup_date")) == rows_of(
        trips(spark, [1, 3]).unionAll(trips(spark, [2], per_day=4))
    )
    some = read_partitioned(spark, path, "2021-03-02", "2021-03-02")
    assert {r.pickup_date for r in some.collect()} == {date(2021, 3, 2)}
    assert some.count() == 4


def test_trip_without_pickup_survives_the_partitioned_write(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([(None, datetime(2021, 3, 1), 1.0, 5)], RAW_TRIPS)
    write_partitioned(df.unionAll(trips(spark, [1])), path)
    assert rows_of(read_partitioned(spark, path).drop("pickup_date")) == rows_of(df.unionAll(trips(spark, [1])))


def test_scratch_is_in_the_shared_folder(spark):
    one, other = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != other
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_no_machine_local_scratch_on_a_cluster():
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.master = "spark://somewhere:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session, "x")


# --- catalog


def test_register_and_drift(spark, tmp_path, caplog):
    path = str(tmp_path / "zone")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(path)
    name = register_zone(spark, path, "zones_db", "trips", "silver_")
    assert name == "`zones_db`.`silver_trips`"
    assert read_table(spark, "zones_db.silver_trips").columns == ["a", "b"]

    spark.sql("SELECT 2 AS a, 'y' AS b, 0.5D AS c").write.mode("append").parquet(path)
    register_zone(spark, path, "zones_db", "trips", "silver_")
    assert rows_of(read_table(spark, name)) == [(1, "x", None), (2, "y", 0.5)]

    spark.sql("SELECT 3 AS a").write.mode("overwrite").parquet(path)
    with caplog.at_level(logging.WARNING):
        register_zone(spark, path, "zones_db", "trips", "silver_")
    assert "b, c" in caplog.text
    assert rows_of(read_table(spark, name)) == [(3, None, None)]

    spark.sql("SELECT 4L AS a").write.mode("overwrite").parquet(path)
    register_zone(spark, path, "zones_db", "trips", "silver_")
    table = read_table(spark, name)
    assert table.schema["a"].dataType == T.LongType()
    assert sorted(table.columns) == ["a", "b", "c"]
    assert [r.a for r in table.collect()] == [4]


def test_a_table_follows_its_dataset(spark, tmp_path):
    for i in (1, 2):
        spark.range(i).write.parquet(str(tmp_path / f"zone{i}"))
        name = register_zone(spark, str(tmp_path / f"zone{i}"), "zones_db", "moving")
        assert read_table(spark, name).count() == i
    assert spark.read.parquet(str(tmp_path / "zone1")).count() == 1


def test_registered_days_are_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    write_partitioned(trips(spark, [1, 2]), path)
    name = register_zone(spark, path, "zones_db", "by_day")
    assert read_table(spark, name).filter("pickup_date = DATE'2021-03-02'").count() == 1
    write_partitioned(trips(spark, [3]), path)
    register_zone(spark, path, "zones_db", "by_day")
    assert read_table(spark, name).count() == 3
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 3
    write_partitioned(trips(spark, [4]), path, replace_all=True)
    register_zone(spark, path, "zones_db", "by_day")
    assert [r.pickup_date for r in read_table(spark, name).collect()] == [date(2021, 3, 4)]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 1


def test_a_managed_table_is_left_alone(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS zones_db")
    spark.range(3).write.mode("overwrite").saveAsTable("zones_db.managed")
    spark.range(1).write.parquet(str(tmp_path / "zone"))
    with pytest.raises(ValueError, match="not an external table"):
        register_zone(spark, str(tmp_path / "zone"), "zones_db", "managed")
    assert spark.table("zones_db.managed").count() == 3


# --- landing


@pytest.fixture
def files(tmp_path):
    source = tmp_path / "source"
    (source / "2021" / "march").mkdir(parents=True)
    contents = {
        "a.bin": b"content",
        "2021/march/b one.bin": bytes(range(256)) * 40,
        "2021/march/c.bin": b"z" * 1000,
        "2021/march/_meta.bin": b"m",
        "2021/.hid.bin": b"h",
        "empty.bin": b"",
    }
    for name, content in contents.items():
        (source / name).write_bytes(content)
    return str(source), contents


@pytest.mark.parametrize("tasks", [None, 1, 30])
def test_checksums(spark, files, tasks):
    source, contents = files
    expected = [(name, len(c), hashlib.md5(c).hexdigest()) for name, c in contents.items()]
    assert rows_of(file_checksums(spark, source, tasks)) == sorted(expected, key=repr)
    assert rows_of(file_checksums(spark, f"file://{source}/", tasks)) == sorted(expected, key=repr)


def test_checksum_of_one_file(spark, files):
    source, contents = files
    assert rows_of(file_checksums(spark, f"{source}/a.bin")) == [
        ("a.bin", 7, hashlib.md5(contents["a.bin"]).hexdigest())
    ]


def test_blocks_cover_each_file_once(spark, files):
    source, contents = files
    expected = []
    for name, c in contents.items():
        size = len(c) if len(c) <= 1000 else 1000
        expected += [
            (name, len(c), s, hashlib.md5(c[s : s + size]).hexdigest()) for s in range(0, max(len(c), 1), max(size, 1))
        ]
    assert rows_of(file_blocks(spark, source, 1000)) == sorted(expected, key=repr)


@pytest.mark.parametrize("helper", [landing._digest_files, landing._digest_blocks, landing._copier("/x")])
def test_helpers_run_where_the_package_is_not_installed(helper, tmp_path):
    code = tmp_path / "helper.pickle"
    code.write_bytes(cloudpickle.dumps(helper))
    load = f"from pyspark import cloudpickle; print(cloudpickle.loads(open('{code}', 'rb').read()))"
    done = subprocess.run([sys.executable, "-c", load], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_relative_root_is_refused(spark):
    with pytest.raises(ValueError, match="absolute"):
        file_checksums(spark, "somewhere/else")


@pytest.mark.parametrize("block", [landing.BLOCK_BYTES, 100])
def test_landing_is_verified(spark, files, tmp_path, block):
    source, contents = files
    landed = tmp_path / "landed"
    land_files(spark, source, str(landed))
    for name, content in contents.items():
        assert (landed / name).read_bytes() == content
    assert {str(p.relative_to(landed)) for p in landed.rglob("*") if p.is_file()} == set(contents)
    verified = verify_copy(spark, source, str(landed), block)
    assert {r.status for r in verified.collect()} == {"match"}
    require_match(verified)
    land_files(spark, source, str(landed))  # repeating changes nothing
    require_match(verify_copy(spark, source, str(landed), block))

    damaged = bytearray(contents["2021/march/b one.bin"])
    damaged[5000] ^= 1
    (landed / "2021/march/b one.bin").write_bytes(bytes(damaged))
    (landed / "2021/march/c.bin").unlink()
    (landed / "2021/.hid.bin").unlink()
    (landed / "new.bin").write_bytes(b"?")
    (landed / "a.bin").write_bytes(b"")
    verified = verify_copy(spark, source, str(landed), block)
    assert {r.file: r.status for r in verified.collect()} == {
        "a.bin": "mismatch",
        "empty.bin": "match",
        "2021/march/_meta.bin": "match",
        "2021/.hid.bin": "missing",
        "2021/march/b one.bin": "mismatch",
        "2021/march/c.bin": "missing",
        "new.bin": "extra",
    }
    with pytest.raises(LandingError, match="mismatch"):
        require_match(verified)


def test_a_cut_copy_is_a_mismatch(spark, files, tmp_path):
    source, contents = files
    landed = tmp_path / "landed"
    land_files(spark, source, str(landed))
    (landed / "2021/march/c.bin").write_bytes(contents["2021/march/c.bin"][:900])
    for block in (100, landing.BLOCK_BYTES):
        status = {r.file: r.status for r in verify_copy(spark, source, str(landed), block).collect()}
        assert status["2021/march/c.bin"] == "mismatch"


@pytest.mark.parametrize("spelling", ["{}//src2", "{}/./src2/", "file://{}/src2", "file:{}//src2"])
def test_names_do_not_depend_on_how_the_root_is_spelled(spark, tmp_path, spelling):
    (tmp_path / "src2").mkdir()
    for name in ("a1.bin", "b1.bin"):
        (tmp_path / "src2" / name).write_bytes(b"the same")
    land_files(spark, spelling.format(tmp_path), f"{tmp_path}//landed/")
    assert sorted(os.listdir(tmp_path / "landed")) == ["a1.bin", "b1.bin"]
    assert verify_copy(spark, str(tmp_path / "src2"), str(tmp_path / "landed")).count() == 2


def test_a_failing_copy_leaves_no_part_file(tmp_path, monkeypatch):
    (tmp_path / "a.bin").write_bytes(b"content")
    (tmp_path / "landed" / "a.bin" / "in the way").mkdir(parents=True)  # the rename cannot succeed
    with pytest.raises(OSError):
        landing._copy_file(str(tmp_path / "a.bin"), str(tmp_path / "landed" / "a.bin"))
    assert os.listdir(tmp_path / "landed") == ["a.bin"]


# --- ingest


def test_only_new_files_are_ingested(spark, tmp_path):
    incoming, target, checkpoint = (str(tmp_path / n) for n in ("incoming", "target", "checkpoint"))
    trips(spark, range(1, 11)).write.parquet(incoming)
    ingest_new_files(spark, incoming, target, checkpoint)
    assert read_zone(spark, target).count() == 10
    ingest_new_files(spark, incoming, target, checkpoint)
    assert read_zone(spark, target).count() == 10
    trips(spark, range(11, 16)).write.mode("append").parquet(incoming)
    ingest_new_files(spark, incoming, target, checkpoint, max_bytes_per_batch=1000)
    assert rows_of(read_zone(spark, target)) == rows_of(trips(spark, range(1, 16)))


def test_old_files_that_arrive_late_are_ingested(spark, tmp_path):
    incoming, target, checkpoint = (str(tmp_path / n) for n in ("incoming", "target", "checkpoint"))
    for number, age_days in enumerate((0, 30, 0)):
        known = set((tmp_path / "incoming").glob("*.parquet")) if number else set()
        trips(spark, range(10 * number + 1, 10 * number + 11)).coalesce(1).write.mode("append").parquet(incoming)
        for path in set((tmp_path / "incoming").glob("*.parquet")) - known:
            then = path.stat().st_mtime - age_days * 86400
            os.utime(path, (then, then))
        ingest_new_files(spark, incoming, target, checkpoint)
        assert read_zone(spark, target).count() == 10 * (number + 1)


def test_ingest_with_cleaning(spark, tmp_path):
    incoming, target, checkpoint = (str(tmp_path / n) for n in ("incoming", "target", "checkpoint"))
    bad = spark.createDataFrame([(datetime(2021, 3, 1), None, 1.0, 5)], RAW_TRIPS)
    trips(spark, [1]).unionAll(bad).write.parquet(incoming)
    ingest_new_files(spark, incoming, target, checkpoint, transform=build_silver)
    assert rows_of(read_zone(spark, target)) == rows_of(build_silver(trips(spark, [1])))


def test_ingest_refuses_its_own_output(spark, tmp_path):
    with pytest.raises(ValueError, match="overlap"):
        ingest_new_files(spark, str(tmp_path), str(tmp_path / "out"), str(tmp_path / "check"))


# --- JDBC: the settings handed to Spark; no database is started here


def test_load_settings():
    df = MagicMock()
    load_jdbc(df, "jdbc:x:y", "trips", properties={"user": "u"})
    df.write.format.assert_called_with("jdbc")
    options = df.write.format().options.call_args.kwargs
    assert options["dbtable"] == "trips"
    assert options["user"] == "u"
    assert int(options["numPartitions"]) > 1
    assert "truncate" not in options
    df.write.format().options().mode.assert_called_with("append")
    load_jdbc(df, "jdbc:x:y", "trips", mode="overwrite")
    assert df.write.format().options.call_args.kwargs["truncate"] == "true"
    with pytest.raises(ValueError, match="mode"):
        load_jdbc(df, "jdbc:x:y", "trips", mode="ignore")


def test_load_serving_conforms_and_recurses(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "gold")
    write_zone(build_silver(trips(spark, [1])), f"{path}/day=1")
    write_zone(build_silver(trips(spark, [2])), f"{path}/day=2")
    seen = {}
    monkeypatch.setattr(
        "tripflow.plans.zones.load_jdbc",
        lambda df, url, table, mode, *_: seen.update(df=df, url=url, table=table, mode=mode),
    )
    load_serving(spark, path, "jdbc:x:y", "trips")
    assert seen["df"].schema == SERVING_TRIPS
    assert seen["df"].count() == 2
    assert seen["mode"] == "append"


def test_read_settings():
    session = MagicMock()
    read_jdbc(session, "jdbc:x:y", "trips", partition_column="id", lower=0, upper=100, num_partitions=10)
    options = session.read.format("jdbc").options.call_args.kwargs
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == ("id", "0", "100")
    assert options["preferTimestampNTZ"] == "true"
    read_jdbc(session, "jdbc:x:y", "trips", predicates=["a < 1", "a >= 1"])
    assert session.read.jdbc.call_args.kwargs["predicates"] == ["a < 1", "a >= 1"]
    for wrong in ({}, {"partition_column": "id"}, {"partition_column": "id", "predicates": ["x"]}):
        with pytest.raises(ValueError):
            read_jdbc(session, "jdbc:x:y", "trips", **wrong)


def test_time_slices_cover_every_row_once(spark):
    slices = time_slices("ts", datetime(2021, 3, 1), datetime(2021, 3, 4), timedelta(days=1))
    assert len(slices) == 4
    times = [None, datetime(2020, 1, 1), datetime(2021, 3, 1), datetime(2021, 3, 2, 5), datetime(2025, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    hits = sum((F.coalesce(F.expr(s), F.lit(False)).cast("int") for s in slices), F.lit(0))
    assert {r.hits for r in df.select(hits.alias("hits")).collect()} == {1}


# --- batch


def config(tmp_path, **extra):
    return BatchConfig(
        bronze=str(tmp_path / "bronze"), silver=str(tmp_path / "silver"), gold=str(tmp_path / "gold"), **extra
    )


@pytest.mark.parametrize("by_day", [False, True])
def test_batch(spark, tmp_path, by_day):
    source = str(tmp_path / "source")
    late = spark.createDataFrame([(datetime(2021, 4, 1), datetime(2021, 4, 2), 1.0, 5)], RAW_TRIPS)
    trips(spark, [1, 2], zone=161).unionAll(late).write.parquet(source)
    plan = config(tmp_path, source=source, database="batch_db", table_prefix=f"t{by_day}_", silver_by_day=by_day)
    for _ in range(2):  # repeating the batch changes nothing
        run_pipeline(spark, plan)
        gold = read_table(spark, f"batch_db.t{by_day}_gold")
        assert {r.PULocationID for r in gold.collect()} == {237}
        assert gold.count() == 2
        assert read_table(spark, f"batch_db.t{by_day}_silver").count() == 3
        assert read_table(spark, f"batch_db.t{by_day}_bronze").count() == 3
    assert slow_zone_report(read_zone(spark, plan.gold)).collect() == []

    # a day that is gone from the raw files goes from every later dataset
    bronze_only = config(tmp_path, database="batch_db", table_prefix=f"t{by_day}_", silver_by_day=by_day)
    write_zone(trips(spark, [2], zone=161), plan.bronze)
    run_pipeline(spark, bronze_only)
    for zone in ("silver", "gold"):
        days = {r.tpep_pickup_datetime.day for r in read_table(spark, f"batch_db.t{by_day}_{zone}").collect()}
        assert days == {2}


def test_later_landings_add_up_and_widths_may_differ(spark, tmp_path):
    """A second landing of files that store the zone narrower: as both at once."""
    both = trips(spark, [1, 2], zone=161).unionAll(trips(spark, [3], zone=7))
    narrow = trips(spark, [3], zone=7).withColumn("PULocationID", F.col("PULocationID").cast("int"))
    for number, part in enumerate((trips(spark, [1, 2], zone=161), narrow)):
        source = str(tmp_path / f"source{number}")
        part.write.parquet(source)
        run_pipeline(spark, config(tmp_path, source=source))
    expected = rows_of(build_gold(build_silver(both)))
    assert rows_of(read_zone(spark, str(tmp_path / "gold"))) == expected


def test_a_damaged_landing_stops_the_batch(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "source")
    trips(spark, [1]).write.parquet(source)
    monkeypatch.setattr("tripflow.plans.batch.land_files", lambda *_: (tmp_path / "bronze").mkdir())
    with pytest.raises(LandingError, match="missing"):
        run_pipeline(spark, config(tmp_path, source=source))
    assert not (tmp_path / "silver").exists()


def test_a_failed_stage_stops_the_batch(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "bronze"))
    with pytest.raises(Exception, match="tpep_pickup_datetime"):
        run_pipeline(spark, config(tmp_path))
    assert not (tmp_path / "gold").exists()


def test_load_comes_last(spark, tmp_path, monkeypatch):
    trips(spark, [1]).write.parquet(str(tmp_path / "bronze"))
    calls = []
    monkeypatch.setattr("tripflow.plans.batch.register_zone", lambda _, path, *a: calls.append(a[1]))
    monkeypatch.setattr("tripflow.plans.batch.load_serving", lambda *a, **_: calls.append("load"))
    run_pipeline(
        spark, config(tmp_path, database="d", jdbc_url="jdbc:x:y", serving_table="trips")
    )
    assert calls == ["bronze", "silver", "gold", "load"]


def test_overlapping_zones_are_refused(spark, tmp_path):
    plan = BatchConfig(bronze=str(tmp_path), silver=str(tmp_path / "s"), gold=str(tmp_path / "g"))
    with pytest.raises(ValueError, match="overlap"):
        run_pipeline(spark, plan)
    with pytest.raises(ValueError, match="together"):
        run_pipeline(spark, config(tmp_path, jdbc_url="jdbc:x:y"))
