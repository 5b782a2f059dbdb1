"""Datasets as tables of the Spark catalog."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripflow.sources.files import children, remove
from tripflow.sources.footers import folder_columns, merged_schema, read_footers
from tripflow.sources.zones import same_spelling

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by name."""
    return spark.table(name)


def register_zone(
    spark: SparkSession,
    path: str,
    database: str,
    table: str,
    prefix: str = "",
    schema: T.StructType | None = None,
) -> str:
    """Make the Parquet dataset at ``path`` an external table; return its name.

    The schema is merged from the footers of all files, each column in the least
    type that holds every file's values: files with ``int`` and with ``bigint``
    make a table of ``bigint``. Types that do not merge raise, naming them. A given
    ``schema``, known to fit every file, saves reading footers. On a later call new columns and changed
    types are applied; columns that no file has any more stay in the table and
    are only logged. Rows are never moved: the table points at ``path``, also
    when it pointed elsewhere before.
    """
    name = f"`{database}`.`{prefix}{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    folders = folder_columns(spark, path)
    merged = merged_schema(read_footers(spark, path)) if schema is None else schema
    if not merged.fields:
        raise ValueError(f"no Parquet file with columns below {path}")
    taken = {f.name.lower() for f in folders.fields}
    merged = T.StructType([f for f in merged.fields if f.name.lower() not in taken] + folders.fields)
    if not spark.catalog.tableExists(name):
        _create(spark, name, path, merged, folders)
        return name
    known = spark.catalog.getTable(name)
    if known.tableType != "EXTERNAL":
        raise ValueError(f"{name} exists and is not an external table")
    before = {f.name.lower(): f for f in spark.table(name).schema.fields}
    after = {f.name.lower(): f for f in merged.fields}
    gone = [f.name for key, f in before.items() if key not in after]
    added = [f for key, f in after.items() if key not in before]
    changed = [f.name for key, f in after.items() if key in before and before[key].dataType != f.dataType]
    if gone:
        log.warning("%s: no file has column(s) %s any more", name, ", ".join(gone))
    moved = same_spelling(_location(spark, name)) != same_spelling(path)
    if changed or moved:
        log.info("%s: at %s, new type for %s", name, path, ", ".join(changed) or "no column")
        spark.sql(f"DROP TABLE {name}")
        _create(spark, name, path, merged, folders)
        added = [before[column.lower()] for column in gone]
    if added:
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    _refresh(spark, name)
    return name


def replace_table(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    database: str,
    table: str,
    keep: int = 1,
) -> str:
    """Replace the rows of an external table by those of ``df``, which may read the table; return its name.

    They are written to a folder of their own below ``root``, and when all are there
    the table is pointed at it, in one step of the catalog. Whoever asks by name sees
    all old rows or all new ones, and a write that dies half way changes nothing. Of
    earlier folders ``keep`` stay, for queries that are still reading them; folders that
    a dead write has left go, so one replacement at a time. A table whose columns change
    is made anew, which takes the catalog two steps.
    """
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    root = root.rstrip("/")
    known = spark.catalog.tableExists(name)
    if known and spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} exists and is not an external table")
    current = _location(spark, name) if known else None
    if current is not None and not same_spelling(current).startswith(same_spelling(root) + "/"):
        raise ValueError(f"{name} lies at {current}, not below {root}")
    versions = [n for n in children(spark, root) if n.startswith("version=")]
    number = max([int(n.removeprefix("version=")) for n in versions], default=0) + 1
    place = f"{root}/version={number:09d}"
    df.write.parquet(place)
    if known and _plain(spark.table(name).schema) == _plain(df.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_escaped(place)}'")
        spark.catalog.refreshTable(name)
    else:
        if known:
            spark.sql(f"DROP TABLE {name}")
        _create(spark, name, place, _plain(df.schema), T.StructType([]))
    held = current.rstrip("/").rpartition("/")[2] if current else None
    older = [n for n in versions if n != held]
    # The one just replaced is the first of those to keep; unnamed ones never were the table's.
    stay = ([held] if held and keep else []) + sorted(older, reverse=True)[: max(0, keep - 1)]
    for version in versions:
        if version not in stay:
            remove(spark, f"{root}/{version}")
    return name


def _plain(schema: T.StructType) -> T.StructType:
    """Names and types only: what is nullable says the scan, not the table."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _escaped(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _create(spark: SparkSession, name: str, path: str, schema: T.StructType, folders: T.StructType) -> None:
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(_quoted(f.name) for f in folders.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet {f'PARTITIONED BY ({by})' if by else ''} LOCATION '{_escaped(path)}'"
    )
    _refresh(spark, name)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _location(spark: SparkSession, name: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return details.filter("col_name = 'Location'").first().data_type


def _refresh(spark: SparkSession, name: str) -> None:
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        # Folders that are gone leave the table, new ones enter it.
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
