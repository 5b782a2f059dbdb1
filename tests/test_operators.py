"""Remapping, ranking, quality and drift on small inputs."""

from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException, ArithmeticException, NumberFormatException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators import (
    ColumnRule,
    check_contract,
    column_presence,
    count_by,
    project_trips,
    reject_profile,
    rejected,
    remap_keys,
    schema_drift,
    top_k_per_group,
)
from tripflow.plans import build_gold, build_silver, conform_serving, slow_zone_report
from tripflow.schemas import PICKUP, RAW_TRIPS, SERVING_TRIPS, SILVER_TRIPS, ZONE, ZONE_SWAP

SWAP = {161: 237, 237: 161}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([(161,), (237,), (5,), (None,)], f"{ZONE} bigint")


def test_swap(zones):
    swapped = remap_keys(zones)
    assert [r[0] for r in swapped.collect()] == [237, 161, 5, None]
    assert swapped.schema == zones.schema
    assert [r[0] for r in remap_keys(swapped).collect()] == [161, 237, 5, None]
    assert ZONE_SWAP == SWAP
    assert remap_keys(zones, ZONE, {}).collect() == zones.collect()


def test_joined_mapping_equals_inline(spark, zones):
    mapping = spark.createDataFrame([*SWAP.items(), (None, 9)], "old bigint, new int")
    joined = remap_keys(zones, ZONE, mapping)
    assert joined.schema == zones.schema
    assert rows_of(joined) == rows_of(remap_keys(zones, ZONE, SWAP))


def test_joined_mapping_to_null(spark, zones):
    mapping = spark.createDataFrame([(5, None)], "old bigint, new bigint")
    assert rows_of(remap_keys(zones, ZONE, mapping)) == [(161,), (237,), (None,), (None,)]


def test_mapping_with_a_repeated_key_is_refused(spark, zones):
    mapping = spark.createDataFrame([(5, 6), (5, 7)], "old bigint, new bigint")
    with pytest.raises(ValueError, match="key 5 more than once"):
        remap_keys(zones, ZONE, mapping)


@pytest.mark.parametrize("keys", [3, 64, 65, 5000])
def test_mappings_of_any_length_keep_the_type(spark, keys):
    df = spark.createDataFrame([(i,) for i in (0, 1, 2, 64, 4999, 6000, None)], "zone smallint")
    mapping = {i: i + 1 for i in range(keys)}
    pairs = spark.createDataFrame(list(mapping.items()), "old int, new int")
    one, other = remap_keys(df, "zone", mapping), remap_keys(df, "zone", pairs)
    assert one.schema == other.schema == df.schema
    expected = sorted((mapping.get(r.zone, r.zone) for r in df.collect()), key=repr)
    for found in (one, other):
        assert sorted((r.zone for r in found.collect()), key=repr) == expected


def test_top_k_breaks_ties_by_order(spark):
    df = spark.createDataFrame([(1, z, n) for z, n in [(4, 2), (3, 2), (None, 2), (9, 5)]], "w int, z int, n int")
    top = top_k_per_group(df, ["w"], [F.desc("n"), F.asc_nulls_last("z")], 3)
    assert rows_of(top) == [(1, 3, 2, 2), (1, 4, 2, 3), (1, 9, 5, 1)]


def test_null_is_a_group(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "w int, z int")
    assert rows_of(count_by(df, "w", "z")) == [(1, 2, 1), (1, None, 2)]


def test_projection_takes_the_contract_types(spark):
    odd = spark.sql(
        """SELECT 1 AS vendor, timestamp'2021-03-01 10:00:00' AS tpep_pickup_datetime,
                  timestamp_ntz'2021-03-01 10:30:00' AS tpep_dropoff_datetime,
                  CAST(2 AS FLOAT) AS trip_distance, CAST(5 AS INT) AS pulocationid"""
    )
    found = project_trips(odd)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in RAW_TRIPS]
    assert found.first()[0] == datetime(2021, 3, 1, 10)
    with pytest.raises(AnalysisException):
        project_trips(odd.drop("trip_distance")).collect()


def test_serving_refuses_a_zone_over_four_bytes(spark):
    row = (datetime(2021, 3, 1), datetime(2021, 3, 2), 1.0, 3_000_000_000, 24.0)
    gold = spark.createDataFrame([row], SILVER_TRIPS)
    assert conform_serving(gold).schema == SERVING_TRIPS
    with pytest.raises((ArithmeticException, NumberFormatException)):
        conform_serving(gold).collect()


def test_contract(spark):
    df = spark.createDataFrame(
        [("1", 5.0, 1), ("x", -1.0, 2), (None, None, 3), ("400", 99.0, None)],
        "zone string, distance double, extra int",
    )
    rules = [
        ColumnRule("zone", "smallint", low=1, high=300),
        ColumnRule("distance", "double", low=0),
        ColumnRule("fare", "double"),
    ]
    assert [tuple(r) for r in check_contract(df, rules).collect()] == [
        ("zone", "smallint", "string", 4, 1, 1, 1),
        ("distance", "double", "double", 4, 1, 0, 1),
        ("fare", "double", None, 4, 4, 0, 0),
        ("extra", None, "int", 4, 1, 0, 0),
    ]


@pytest.mark.parametrize("wanted", ["tinyint", "smallint", "int", "bigint"])
def test_integers_fit_as_a_cast_would_have_it(spark, wanted):
    edges = [v for bits in (8, 16, 32, 64) for v in (2 ** (bits - 1) - 1, -(2 ** (bits - 1)))]
    edges += [v + 1 for v in edges[:-2:2]] + [v - 1 for v in edges[1:-2:2]] + [None]
    df = spark.createDataFrame([(v,) for v in edges], "zone bigint")
    found = check_contract(df, [ColumnRule("zone", wanted, low=0)]).first()
    cast = F.col("zone").try_cast(wanted)
    bad, low = df.select(
        F.count_if(F.col("zone").isNotNull() & cast.isNull()), F.count_if(cast < 0)
    ).first()
    assert (found.null_rows, found.uncastable_rows, found.out_of_range_rows) == (1, bad, low)


TIMES = st.none() | st.datetimes(datetime(2021, 2, 26), datetime(2021, 4, 3))
TRIPS = st.lists(
    st.tuples(TIMES, TIMES, st.none() | st.floats(-5, 50), st.sampled_from([161, 237, 5, None])),
    min_size=1,
    max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(TRIPS)
def test_kept_and_rejected_are_the_raw_trips(spark, trips):
    raw = spark.createDataFrame(trips, RAW_TRIPS)
    four = RAW_TRIPS.names
    silver = build_silver(raw)
    assert rows_of(silver.select(four).unionAll(rejected(raw).select(four))) == rows_of(raw)
    gold = build_gold(silver, mapping={})
    parted = gold.select(four).unionAll(rejected(raw, 2021, 3).select(four))
    assert rows_of(parted) == rows_of(raw)
    profile = reject_profile(raw, 2021, 3).first()
    assert profile.kept_silver == silver.count()
    assert profile.kept_gold == gold.count()
    assert profile.trips == len(trips)
    reasons = {r.reject_reason: r["count"] for r in rejected(raw).groupBy("reject_reason").count().collect()}
    assert reasons.get("null_duration", 0) == profile.null_duration
    assert reasons.get("negative_duration", 0) == profile.negative_duration


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(TRIPS)
def test_month_and_swap_commute_and_swap_undoes_itself(spark, trips):
    silver = build_silver(spark.createDataFrame(trips, RAW_TRIPS))
    first_swap = remap_keys(silver).filter((F.month(PICKUP) == 3) & (F.year(PICKUP) == 2021))
    assert rows_of(build_gold(silver)) == rows_of(first_swap)
    assert rows_of(remap_keys(remap_keys(silver))) == rows_of(silver)


def _brute_report(trips, k):
    moving = [(p, z, m / ((d - p).total_seconds() / 3600)) for p, d, m, z in trips
              if p and d and m is not None and d > p]
    if not moving:
        return []
    mean = sum(s for *_, s in moving) / len(moving)
    if any(abs(s - mean) < 1e-9 * max(1.0, abs(mean)) for *_, s in moving):
        return None  # at the mean, the last bit of the sum decides
    counts = {}
    for p, z, s in moving:
        if s < mean:
            key = (p.isocalendar().week, z)
            counts[key] = counts.get(key, 0) + 1
    out = []
    for week in sorted({w for w, _ in counts}):
        group = sorted(
            ((-n, z is None, z or 0, z) for (w, z), n in counts.items() if w == week)
        )
        out += [(week, z, -n, i + 1) for i, (n, _, _, z) in enumerate(group[:k])]
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(TRIPS, st.integers(1, 3))
def test_report_equals_brute_force(spark, trips, k):
    expected = _brute_report(trips, k)
    if expected is not None:
        raw = spark.createDataFrame(trips, RAW_TRIPS)
        assert [tuple(r) for r in slow_zone_report(raw, k).collect()] == expected
        assert [tuple(r) for r in slow_zone_report(build_silver(raw), k).collect()] == expected


def test_drift(spark, tmp_path):
    path = str(tmp_path / "zone")
    spark.sql("SELECT 1L AS a, 'x' AS b UNION ALL SELECT 2L, NULL").coalesce(1).write.parquet(path)
    spark.sql("SELECT 3L AS a, 'y' AS b, 0.5D AS c").coalesce(1).write.mode("append").parquet(path)
    contract = T.StructType(
        [
            T.StructField("a", T.IntegerType()),
            T.StructField("b", T.StringType()),
            T.StructField("gone", T.DoubleType()),
        ]
    )
    assert rows_of(schema_drift(spark, path, contract)) == sorted(
        [
            ("a", "int", "bigint", "type_changed", 2, 0, 3, 3),
            ("b", "string", "string", "same", 2, 0, 3, 2),
            ("gone", "double", None, "removed", 2, 2, 3, 0),
            ("c", None, "double", "added", 2, 1, 3, 1),
        ],
        key=repr,
    )
    lacking = column_presence(spark, path).filter("column = 'c' AND non_null_rows = 0")
    assert [r.rows for r in lacking.collect()] == [2]


def test_types_that_cannot_be_merged_are_rows(spark, tmp_path):
    path = str(tmp_path / "zone")
    spark.sql("SELECT 1 AS a, 1 AS b").coalesce(1).write.parquet(path)
    spark.sql("SELECT 'x' AS a, 2L AS b").coalesce(1).write.mode("append").parquet(path)
    contract = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.LongType())])
    assert rows_of(schema_drift(spark, path, contract)) == [
        ("a", "int", "int | string", "clash", 2, 0, 2, 2),
        ("b", "bigint", "bigint", "same", 2, 0, 2, 2),
    ]


def test_drift_of_a_dataset_without_rows(spark, tmp_path):
    path = str(tmp_path / "zone")
    spark.sql("SELECT 1 AS a, 'x' AS b").filter("a > 1").coalesce(1).write.parquet(path)
    contract = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("gone", T.DateType())])
    files = len(list((tmp_path / "zone").glob("*.parquet")))
    assert rows_of(schema_drift(spark, path, contract)) == [
        ("a", "int", "int", "same", files, files, 0, 0),
        ("b", None, "string", "added", files, files, 0, 0),
        ("gone", "date", None, "removed", files, files, 0, 0),
    ]


def test_drift_of_folder_columns(spark, tmp_path):
    path = str(tmp_path / "zone")
    rows = spark.sql("SELECT 1 AS a, 7 AS d UNION ALL SELECT 2, NULL")
    rows.coalesce(1).write.partitionBy("d").parquet(path)
    contract = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("d", T.IntegerType())])
    assert rows_of(schema_drift(spark, path, contract)) == [
        ("a", "int", "int", "same", 2, 0, 2, 2),
        ("d", "int", "int", "same", 2, 1, 2, 1),
    ]
