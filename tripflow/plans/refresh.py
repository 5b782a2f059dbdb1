"""Silver and gold kept up with bronze by rebuilding only the folders that new files touch.

What every file of bronze holds is remembered as its folders (days, months or
years of pickup). Files that are new, changed or gone since the last refresh name
the folders to rebuild: from footers where the extremes of the pickup time fall
into one folder, from that column alone otherwise. Those folders are built anew
from the files that hold trips of them, and replace the old ones.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from datetime import date

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow.observed import observed
from tripflow.plans.zones import build_gold, build_silver
from tripflow.schemas import PICKUP, RAW_TRIPS, REPORT_MONTH, REPORT_YEAR, SILVER_TRIPS, ZONE_SWAP
from tripflow.sources.files import children, exists, put_in_place, remove
from tripflow.sources.footers import data_files, read_footers
from tripflow.sources.landing import Listing, _filesystem
from tripflow.sources.scratch import stored
from tripflow.sources.zones import DAY, contract_schema, folder_of, read_zone, write_partitioned

# Send the helper below to tasks as code: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STATE = "file string, length bigint, modified bigint, folder date"
_KEY = ["file", "length", "modified"]
# Files named one by one to a scan; of more, the scan lists the whole dataset and skips by their statistics.
NAMED = 100_000


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: the silver folders rebuilt, and the files that were new, changed or gone."""

    folders: list[date]
    files: int


def refresh_zones(
    spark: SparkSession,
    bronze: str,
    silver: str,
    gold: str,
    state: str,
    year: int = REPORT_YEAR,
    month: int = REPORT_MONTH,
    mapping: Mapping[int, int] | DataFrame = ZONE_SWAP,
    by: str = DAY,
) -> Refreshed:
    """Bring silver and gold, both stored in folders of ``by``, up to date with bronze.

    ``state`` is a dataset of this function's own. The result is what a full build
    would give; folders that no new, changed or vanished file touches keep their
    files. The state is written last: a refresh that dies is repeated as a whole, with
    the same result. One refresh at a time.
    """
    listing = data_files(spark, bronze)
    now = stored(listing.files.select("path", *_KEY), "refresh-files")
    known = spark.read.schema(_STATE).parquet(state) if exists(spark, state) else spark.createDataFrame([], _STATE)
    old = known.select(*_KEY).distinct()
    # Times may be unknown, so keys compare with nulls equal.
    new = stored(now.join(old, _same(now, old), "left_anti"), "refresh-new")
    gone = stored(known.join(now, _same(known, now), "left_anti"), "refresh-gone")
    arrived = new.count()
    if arrived:
        found = stored(_folders(spark, bronze, listing, new, by), "refresh-folders")
    else:
        found = spark.createDataFrame([], "file string, folder date")
    holds = known.join(now, _same(known, now), "left_semi").select("file", "folder").union(found)
    touched = found.select("folder").union(gone.select("folder")).filter("folder IS NOT NULL").distinct()
    # One row per folder.
    folders = sorted(row.folder for row in touched.collect())
    changed = arrived + gone.select("file").distinct().count()
    if folders:
        rows = _rows_of(spark, bronze, listing, now, holds, folders, by)
        _replace_folders(spark, build_silver(rows), silver, folders, by)
        reported = [f for f in folders if f == _folder_of_month(year, month, by, f)]
        if reported:
            kept = read_zone(spark, silver, schema=SILVER_TRIPS).filter(_within(reported, by))
            _replace_folders(spark, build_gold(kept, year, month, mapping), gold, reported, by)
    if changed:
        current = now.join(holds.withColumnRenamed("file", "of"), F.col("file") == F.col("of"), "left")
        staged = f"{state.rstrip('/')}.staged-{uuid.uuid4().hex}"
        current.select(*_KEY, "folder").write.parquet(staged)
        put_in_place(spark, staged, state)
    return Refreshed(folders, changed)


def _same(left: DataFrame, right: DataFrame) -> Column:
    return (
        (left["file"] == right["file"])
        & (left["length"] == right["length"])
        & left["modified"].eqNullSafe(right["modified"])
    )


def _folders(spark: SparkSession, bronze: str, listing: Listing, new: DataFrame, by: str) -> DataFrame:
    """``file, folder`` for every new file and each folder it holds trips of; a null folder for one without."""
    files = Listing(new, listing.count, listing.bytes, listing.longest)
    footers = read_footers(spark, bronze, files)
    contract_schema(footers, RAW_TRIPS, bronze)  # raises where a file cannot be used
    times = footers.filter(F.lower("column") == PICKUP.lower()).select(
        "path",
        "file",
        folder_of(by, F.col("low").try_cast("timestamp_ntz")).alias("first"),
        folder_of(by, F.col("high").try_cast("timestamp_ntz")).alias("last"),
        "non_null_rows",
    )
    one = F.coalesce(F.col("first") == F.col("last"), F.lit(False)) | (F.col("non_null_rows") == 0)
    single = times.filter(one).select("file", F.when(F.col("non_null_rows") > 0, F.col("first")).alias("folder"))
    tasks = max(spark.sparkContext.defaultParallelism, listing.count // 1000)
    days = (
        times.filter(~one)
        .select("path", "file")
        .repartition(tasks, "path")
        .mapInPandas(_days_of, "file string, day date")
        .select("file", folder_of(by, F.col("day").cast("timestamp_ntz")).alias("folder"))
        .distinct()
    )
    return single.union(days)


def _days_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct days of pickup in each file, a row group at a time."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    for batch in batches:
        for uri, name in zip(batch["path"], batch["file"]):
            filesystem, path = _filesystem(uri)
            days = set()
            with filesystem.open_input_file(path) as stream:
                file = pq.ParquetFile(stream)
                column = next(c for c in file.schema_arrow.names if c.lower() == PICKUP.lower())
                for group in range(file.metadata.num_row_groups):
                    times = file.read_row_group(group, columns=[column]).column(0)
                    days |= set(pc.unique(pc.floor_temporal(times, unit="day").cast("date32")).to_pylist())
            if days:
                yield pd.DataFrame({"file": name, "day": sorted(days, key=lambda d: (d is not None, d or date.min))})


def _rows_of(
    spark: SparkSession, bronze: str, listing: Listing, now: DataFrame, holds: DataFrame, folders: list[date], by: str
) -> DataFrame:
    """The raw trips of ``folders``, from the files that hold any."""
    wanted = holds.filter(F.col("folder").isin(folders)).select(F.col("file").alias("wanted")).distinct()
    files = stored(now.join(wanted, F.col("file") == F.col("wanted"), "left_semi"), "refresh-read")
    count = files.count()
    if not count:  # all files of these folders are gone
        return spark.createDataFrame([], RAW_TRIPS)
    schema = contract_schema(read_footers(spark, bronze, Listing(files, count, listing.bytes, 0)), RAW_TRIPS, bronze)
    if count > NAMED:
        rows = read_zone(spark, bronze, recurse=True, schema=schema)
    else:
        rows = spark.read.schema(schema).parquet(*[r.path for r in files.select("path").collect()])
    return rows.filter(_within(folders, by))


def _within(folders: list[date], by: str) -> Column:
    """Trips of ``folders``: by their own folder, and by bounds that reach the scan."""
    first = F.lit(folders[0]).cast("timestamp_ntz")
    after = folder_of(by, F.lit(folders[-1]).cast("timestamp_ntz"), following=True).cast("timestamp_ntz")
    return (F.col(PICKUP) >= first) & (F.col(PICKUP) < after) & folder_of(by).isin(folders)


def _folder_of_month(year: int, month: int, by: str, folder: date) -> date | None:
    """``folder`` if it may hold trips of the month."""
    same_year = folder.year == year
    if by == DAY or by == "pickup_month":
        return folder if same_year and folder.month == month else None
    return folder if same_year else None


def _replace_folders(spark: SparkSession, rows: DataFrame, path: str, folders: list[date], by: str) -> None:
    """Write the folders anew; those that have no rows any more go."""
    seen = Observation()
    named = rows.withColumn(by, folder_of(by)).observe(seen, F.collect_set(by).alias("written"))
    write_partitioned(named, path, by)
    written = {f"{by}={day}" for day in observed(seen, written=[])["written"]}
    there = set(children(spark, path))
    for folder in folders:
        name = f"{by}={folder}"
        if name in there and name not in written:
            remove(spark, f"{path.rstrip('/')}/{name}")
