"""What Spark plans: pushdown, pruning, shuffles and the splitting of hot keys."""

from __future__ import annotations

import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tripflow.operators import remap_keys
from tripflow.plans import build_gold, build_silver, slow_zone_report, slow_zone_report_sql
from tripflow.schemas import ZONE
from tripflow.sources import read_partitioned, read_zone, write_partitioned, write_zone
from tripflow.sources.samples import order_trips, trips


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@contextmanager
def conf(spark, **settings):
    settings = {"spark.sql." + k.replace("__", "."): str(v) for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def silver_path(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("zones") / "silver")
    wide = build_silver(trips(spark, sf_dir)).withColumn("unused", F.lit("x"))
    write_zone(wide, path)
    return path


def test_cleaning_and_enriching_do_not_shuffle(spark, silver_path):
    stored = read_zone(spark, silver_path)
    for df in (build_silver(stored), build_gold(stored)):
        assert "Exchange" not in plan_of(df)


def test_silver_reads_only_its_columns(spark, silver_path):
    read = re.findall(r"ReadSchema: struct<(.*)>", plan_of(build_silver(read_zone(spark, silver_path))))
    assert len(read) == 1
    assert "unused" not in read[0]
    assert "trip_duration" not in read[0]


def test_month_reaches_the_scan(spark, silver_path):
    plan = plan_of(build_gold(read_zone(spark, silver_path), 1995, 7))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThanOrEqual(tpep_pickup_datetime,1995-07-01" in pushed
    assert "LessThan(tpep_pickup_datetime,1995-08-01" in pushed


@pytest.mark.parametrize("by", ["pickup_date", "pickup_month"])
def test_dates_prune_folders(spark, silver_path, tmp_path, by):
    path = str(tmp_path / "folders")
    summer = read_zone(spark, silver_path).filter(
        "year(tpep_pickup_datetime) = 1995 AND quarter(tpep_pickup_datetime) = 3"
    )
    write_partitioned(summer, path, by)
    found = read_partitioned(spark, path, "1995-07-03", "1995-07-09", by)
    plan = plan_of(found)
    pruned = re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)
    assert f"isnotnull({by}" in pruned
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "LessThan(tpep_pickup_datetime,1995-07-10" in pushed
    expected = summer.filter("to_date(tpep_pickup_datetime) BETWEEN '1995-07-03' AND '1995-07-09'").count()
    assert found.count() == expected > 0


@pytest.mark.parametrize("form", [slow_zone_report, lambda df: slow_zone_report_sql(df.sparkSession, df)])
def test_report_plan(spark, silver_path, form):
    plan = plan_of(form(read_zone(spark, silver_path)))
    # groups are cut to k before the shuffle and after it
    assert re.search(r"row_number\(\), 5, Partial", plan)
    assert re.search(r"row_number\(\), 5, Final", plan)
    # the mean is one subquery; no join of any kind
    assert "Subquery" in plan
    assert "Join" not in plan
    assert plan.count("Functions [1]: [partial_count(1)]") == 1
    for read in re.findall(r"ReadSchema: struct<(.*)>", plan):
        assert "unused" not in read
        assert "trip_duration" not in read


PYTHON = {"content_digests", "landing_checksums", "verify_copy"}


@pytest.mark.parametrize("name", sorted(registry.trip_queries()))
def test_no_query_crosses_tables_or_rows_into_python(spark, sf_dir, name):
    plan = plan_of(registry.trip_queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
    if name not in PYTHON:
        assert "Python" not in plan
        assert "InPandas" not in plan


@pytest.fixture
def small_partitions(spark):
    """Thresholds scaled down so that test data shows what large data would."""
    with conf(
        spark,
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__advisoryPartitionSizeInBytes="16k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="32k",
        adaptive__coalescePartitions__minPartitionSize="8k",
    ):
        yield


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    counted = df.groupBy().agg(*[F.count(c) for c in df.columns])
    counted.collect()
    return plan_of(counted)


@pytest.mark.parametrize("share", [0.0, 0.4])
def test_a_hot_zone_is_split_in_the_joined_mapping(spark, silver_path, small_partitions, share):
    hot = F.when(F.rand(1) < share, F.lit(3)).otherwise(F.col(ZONE)).cast("bigint")
    skewed = read_zone(spark, silver_path).withColumn(ZONE, hot).repartition(8)
    mapping = spark.range(0, 100).select("id", (F.col("id") + 1).alias("next")).repartition(4)
    plan = _executed(remap_keys(skewed, ZONE, mapping))
    assert ("SortMergeJoin(skew=true)" in plan) == (share > 0)


@pytest.mark.parametrize("share", [0.0, 0.4])
def test_a_hot_order_is_split_in_the_trip_join(spark, sf_dir, small_partitions, share):
    orders, lineitem = (read_zone(spark, f"{sf_dir}/{n}.parquet") for n in ("orders", "lineitem"))
    hot = lineitem.withColumn(
        "l_orderkey", F.when(F.rand(1) < share, F.lit(7)).otherwise(F.col("l_orderkey")).cast("bigint")
    ).repartition(8)
    plan = _executed(order_trips(orders, hot))
    assert ("SortMergeJoin(skew=true)" in plan) == (share > 0)


def test_a_hot_month_becomes_many_files(spark, silver_path, tmp_path):
    month = F.lit("1995-07-04 08:00:00").cast("timestamp_ntz")
    stored = read_zone(spark, silver_path)
    hot = stored.withColumn(
        "tpep_pickup_datetime", F.when(F.rand(1) < 0.5, month).otherwise(F.col("tpep_pickup_datetime"))
    )
    write_zone(hot.repartition(8), str(tmp_path / "files"))  # slices follow the tasks that read
    hot = read_zone(spark, str(tmp_path / "files"))
    path = tmp_path / "months"
    sizes = {
        "adaptive__advisoryPartitionSizeInBytes": "16k",
        "adaptive__coalescePartitions__minPartitionSize": "16k",
    }
    with conf(spark, **sizes):
        write_partitioned(hot, str(path), "pickup_month")
    files = {d.name: len(list(d.glob("*.parquet"))) for d in Path(path).iterdir() if d.is_dir()}
    assert files.pop("pickup_month=1995-07-01") > 4
    assert set(files.values()) == {1}
    assert read_partitioned(spark, str(path), by="pickup_month").count() == stored.count()
