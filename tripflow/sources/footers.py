"""What Parquet footers say: columns, types, counts and extremes of every file.

Tasks read footers; rows are not touched. The result is a table, so questions about
all files of a dataset (which types do they hold, which columns are missing, what
days do they cover) are ordinary queries over it, however many files there are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.sources.landing import Listing, _filesystem, _spread, take_listing
from tripflow.sources.scratch import scratch_path

# Send the helpers below to tasks as code: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FOOTERS = (
    "path string, file string, length bigint, rows bigint, place int, column string, type string, "
    "non_null_rows bigint, low string, high string"
)

# For each type those that hold all its values and that Spark's Parquet scan reads
# it as, narrowest first.
_WIDER = {
    "tinyint": ("tinyint", "smallint", "int", "bigint", "double"),
    "smallint": ("smallint", "int", "bigint", "double"),
    "int": ("int", "bigint", "double"),
    "bigint": ("bigint",),
    "float": ("float", "double"),
    "double": ("double",),
    "date": ("date", "timestamp_ntz"),
    "timestamp_ntz": ("timestamp_ntz",),
}


def data_files(spark: SparkSession, path: str) -> Listing:
    """The files below ``path`` that a scan reads: no name on the way starts with ``_`` or ``.``."""
    listing = take_listing(spark, path)
    seen = listing.files.filter(~F.col("file").rlike(r"(^|/)[._]"))
    return Listing(seen, listing.count, listing.bytes, listing.longest)


def read_footers(spark: SparkSession, path: str, files: Listing | None = None) -> DataFrame:
    """A row per file and column below ``path``, stored; a file without columns gives one without a name.

    ``path``, ``file`` (relative), ``length``, ``rows``, ``place`` in the file,
    ``column``, ``type`` as Spark names it, ``non_null_rows``, and ``low`` and ``high``
    of a time column, as text. Where a footer lacks the number of nulls, the column is read for it, by the
    same task; extremes it lacks are null.
    """
    listing = files or data_files(spark, path)
    found = _spread(listing, listing.files, None, "path").mapInPandas(_footers, _FOOTERS)
    stored = scratch_path(spark, "footers")
    found.write.parquet(stored)
    return spark.read.schema(_FOOTERS).parquet(stored)


def column_types(footers: DataFrame) -> DataFrame:
    """``key`` (lower case), ``column``, ``types`` (those the files hold it in, sorted), ``place`` and ``files``.

    Of spellings that differ in case only, the first in order is named; of places in
    files that differ in order, the last.
    """
    named = footers.filter("column IS NOT NULL")
    return named.groupBy(F.lower("column").alias("key")).agg(
        F.min("column").alias("column"),
        F.sort_array(F.collect_set("type")).alias("types"),
        F.max("place").alias("place"),
        F.count_distinct("path").alias("files"),
    )


def least_type(types: Iterable[str]) -> str | None:
    """The least type that holds all values of ``types`` and that a scan can read them all as; None if there is none."""
    wanted = sorted(set(types))
    if len(wanted) == 1:
        return wanted[0]
    if all(t in _WIDER for t in wanted):
        return next((t for t in _WIDER[wanted[0]] if all(t in _WIDER[other] for other in wanted)), None)
    decimals = [_decimal(t) for t in wanted]
    if all(decimals):
        scale = max(s for _, s in decimals)
        precision = max(p - s for p, s in decimals) + scale
        if precision <= 38:
            return f"decimal({precision},{scale})"
    return None


def merged_schema(footers: DataFrame) -> T.StructType:
    """One schema for all files: every column, each in its least type. Raises where there is none."""
    fields, clashes = [], []
    # One row per column.
    for row in column_types(footers).orderBy("place", "key").collect():
        found = least_type(row.types)
        if found is None:
            clashes.append(f"{row.column} is {' and '.join(row.types)}")
        else:
            fields.append(T.StructField(row.column, T.DataType.fromDDL(found)))
    if clashes:
        raise ValueError(f"files hold types that do not merge: {'; '.join(clashes)}")
    return T.StructType(fields)


def folder_columns(spark: SparkSession, path: str) -> T.StructType:
    """The columns that ``key=value`` folders make, as Spark reads them; no footer is opened."""
    other = T.StructType([T.StructField("no such column", T.StringType())])
    return T.StructType(spark.read.schema(other).parquet(path).schema.fields[1:])


def _decimal(name: str) -> tuple[int, int] | None:
    kind = T.DataType.fromDDL(name)
    return (kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else None


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import json

    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    names = [field.split()[0] for field in _FOOTERS.split(", ")]
    for batch in batches:
        found = []
        for uri, name, length in zip(batch["path"], batch["file"], batch["length"]):
            filesystem, path = _filesystem(uri)
            with filesystem.open_input_file(path) as stream:
                file = pq.ParquetFile(stream)
                meta, schema = file.metadata, file.schema_arrow
                # Files of Spark say what they meant, such as tinyint or char.
                written = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                told = T.StructType.fromJson(json.loads(written)) if written else None
                own = {f.name: f.dataType.simpleString() for f in told.fields} if told else {}
                if not len(schema):
                    found.append((uri, name, length, meta.num_rows, None, None, None, None, None, None))
                for place, field in enumerate(schema):
                    kind = own.get(field.name) or from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString()
                    nulls, low, high = _statistics(file, field.name, kind.startswith(("timestamp", "date")))
                    values = meta.num_rows - nulls
                    found.append((uri, name, length, meta.num_rows, place, field.name, kind, values, low, high))
        frame = pd.DataFrame(found, columns=names).astype(object)
        yield frame.where(frame.notna(), None)


def _statistics(file, column: str, times: bool) -> tuple[int, str | None, str | None]:
    """Nulls of a column, and the extremes of a column of times."""
    meta = file.metadata
    places = [i for i in range(meta.num_columns) if meta.schema.column(i).path == column]
    nulls, lows, highs, complete = 0, [], [], True
    for group in range(meta.num_row_groups):
        stats = meta.row_group(group).column(places[0]).statistics if places else None
        if stats is None or not stats.has_null_count:
            table = file.read_row_group(group, columns=[column])
            nulls += table.column(0).null_count
        else:
            nulls += stats.null_count
        if times and stats is not None and stats.has_min_max:
            lows.append(stats.min)
            highs.append(stats.max)
        elif stats is None or stats.null_count != meta.row_group(group).num_rows:
            complete = False
    if not (times and complete and lows):
        return nulls, None, None
    return nulls, str(min(lows)), str(max(highs))
