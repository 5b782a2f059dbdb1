"""Parquet datasets: the bronze, silver and gold zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.schemas import PICKUP
from tripflow.sources.footers import column_types, least_type, read_footers

DAY = "pickup_date"
MONTH = "pickup_month"
YEAR = "pickup_year"

# Folder columns derived from the pickup time; a month or a year goes by its first day.
_FOLDERS = {
    DAY: F.to_date,
    MONTH: lambda ts: F.trunc(ts, "month"),
    YEAR: lambda ts: F.trunc(ts, "year"),
}


# Enough for years of days to seldom share a shuffle partition; adaptive
# execution merges those that stay small. Above 2000, Spark records only average
# sizes by default, and a hot folder would no longer stand out to be split.
SHUFFLE_PARTS = 2000


def read_zone(
    spark: SparkSession,
    path: str,
    recurse: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan a Parquet file or directory.

    ``recurse`` takes in every file below ``path`` however the folders are
    named, so ``key=value`` folders no longer make columns. A given ``schema``
    saves reading footers to infer one.
    """
    reader = spark.read.option("recursiveFileLookup", "true") if recurse else spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_contract(
    spark: SparkSession, path: str, contract: T.StructType, footers: DataFrame | None = None
) -> DataFrame:
    """Scan the columns of ``contract``, judged by the footers of all files; integers and floats as wide as it says.

    So files that store a zone as ``int`` and others as ``bigint`` read as one
    dataset. A column that any file lacks raises instead of reading as NULL, and so
    do types that no type holds together; other types stay as stored. ``footers``:
    those of ``read_footers``, if they are at hand.
    """
    footers = read_footers(spark, path) if footers is None else footers
    return read_zone(spark, path, schema=contract_schema(footers, contract, path))


def contract_schema(footers: DataFrame, contract: T.StructType, path: str = "the dataset") -> T.StructType:
    """The types to read the columns of ``contract`` in from all files of ``footers``; see ``read_contract``."""
    wanted = {f.name.lower(): f for f in contract.fields}
    every = footers.agg(F.count_distinct("path").alias("n")).scalar()
    # One row per column of the contract.
    rows = column_types(footers).filter(F.col("key").isin(list(wanted))).withColumn("every", every).collect()
    found = {r.key: r.types for r in rows if r.files == r.every}
    if rows and len(found) < len(wanted):
        raise ValueError(f"{path}: {_lacking(footers, {k: f.name for k, f in wanted.items()})}")
    if not found:
        raise ValueError(f"{path} lacks {', '.join(contract.names)}")
    fields, clashes = [], []
    for key, f in wanted.items():
        stored, type_of = least_type(found[key]), f.dataType.simpleString()
        if least_type([*found[key], type_of]) == type_of:
            stored = type_of
        if stored is None:
            clashes.append(f"{f.name} is {' and '.join(found[key])}")
        else:
            fields.append(T.StructField(f.name, T.DataType.fromDDL(stored)))
    if clashes:
        raise ValueError(f"{path}: files hold types that do not merge: {'; '.join(clashes)}")
    return T.StructType(fields)


def _lacking(footers: DataFrame, names: dict[str, str]) -> str:
    """Which columns, by their lower-case keys, how many files lack, with an example."""
    held = F.collect_set(F.lower("column")).alias("held")
    keys = F.array(*[F.lit(key) for key in names])
    lacking = footers.groupBy("file").agg(held).select("file", F.explode(F.array_except(keys, "held")).alias("key"))
    # One row per column.
    counted = lacking.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file")).orderBy("key")
    return "; ".join(f"{r.n} file(s) lack {names[r.key]}, such as {r.file}" for r in counted.collect())


def write_zone(df: DataFrame, path: str) -> None:
    """Replace the dataset at ``path``.

    The target is emptied before the first row is read, so ``path`` must not be
    among the inputs of ``df``; see ``require_distinct``.
    """
    df.write.mode("overwrite").parquet(path)


def require_distinct(*paths: str) -> None:
    """Raise unless no path equals or contains another."""
    stems = [same_spelling(p) for p in paths]
    for i, one in enumerate(stems):
        for other in stems[i + 1 :]:
            if one == other or one.startswith(other + "/") or other.startswith(one + "/"):
                raise ValueError(f"paths overlap: {one} and {other}")


def same_spelling(path: str) -> str:
    """One spelling per local path: 'file:///a/', 'file:/a' and '/a' are the same."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme == "file":
        path = "/" + rest.lstrip("/")
    return path.rstrip("/")


def folder_of(by: str, ts: Column | None = None, following: bool = False) -> Column:
    """The value of a folder column derived from the pickup time, or from ``ts``; or the one after it."""
    own = _FOLDERS[by](F.col(PICKUP) if ts is None else ts)
    if not following:
        return own
    return F.date_add(own, 1) if by == DAY else F.add_months(own, 1 if by == MONTH else 12)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: str = DAY,
    partitions: int = SHUFFLE_PARTS,
    replace_all: bool = False,
) -> None:
    """Write one folder per value of ``by``, replacing only the folders in ``df``.

    With ``replace_all`` folders that ``df`` has no rows for go as well.
    ``pickup_date`` and ``pickup_month`` are derived from the pickup time; any
    other column must exist. REBALANCE brings the rows of a folder together for
    few files, and adaptive execution splits what is too big for one task, so a
    day with a third of all trips becomes many files instead of one long task.
    Folders beyond ``partitions`` share shuffle partitions and come out in more,
    smaller files.
    """
    if by in _FOLDERS and by not in df.columns:
        df = df.withColumn(by, folder_of(by))
    (
        df.hint("rebalance", partitions, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def read_partitioned(
    spark: SparkSession,
    path: str,
    first: str | None = None,
    last: str | None = None,
    by: str = DAY,
) -> DataFrame:
    """Read trips stored by day or month, picked up from ``first`` to ``last`` inclusive.

    The dates ('2021-03-01') are compared with the folder names, so that other
    folders are not read, and with the pickup time itself.
    """
    if by not in _FOLDERS:
        raise ValueError(f"by must be one of {', '.join(_FOLDERS)}, not {by}")
    df = spark.read.parquet(path)
    if first is not None:
        start = F.lit(first).cast("date")
        df = df.filter((F.col(by) >= _FOLDERS[by](start)) & (F.col(PICKUP) >= start.cast("timestamp_ntz")))
    if last is not None:
        end = F.lit(last).cast("date")
        after = F.date_add(end, 1).cast("timestamp_ntz")
        df = df.filter((F.col(by) <= _FOLDERS[by](end)) & (F.col(PICKUP) < after))
    return df
