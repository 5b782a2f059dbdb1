"""Schema drift of a Parquet dataset against its contract, from footers alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.sources.footers import column_types, data_files, folder_columns, least_type, read_footers

_LABELS = ("key", "column", "contract_type", "actual_type", "change")


def column_presence(spark: SparkSession, path: str, footers: DataFrame | None = None) -> DataFrame:
    """Per file and column of the dataset: rows, and rows with a value.

    A file written before a column existed shows no value for it. Footers are read,
    rows are not.
    """
    footers = read_footers(spark, path) if footers is None else footers
    names = column_types(footers).select("key", "column")
    return _presence(footers, names).select("path", "rows", "column", "non_null_rows").withColumnRenamed("path", "file")


def _presence(footers: DataFrame, names: DataFrame) -> DataFrame:
    """``path, file, rows, key, column, non_null_rows``: every file with every name, which it may lack."""
    files = footers.groupBy("path", "file").agg(F.max("rows").alias("rows"))
    # One row per column of the dataset, repeated for every file.
    every = names.agg(F.collect_list(F.struct("key", "column")).alias("names")).scalar()
    found = footers.select(F.col("path").alias("in_path"), F.lower("column").alias("in_key"), "non_null_rows")
    cells = files.select("path", "file", "rows", F.inline(every))
    return cells.join(
        found, (F.col("path") == F.col("in_path")) & (F.col("key") == F.col("in_key")), "left"
    ).select("path", "file", "rows", "key", "column", F.coalesce("non_null_rows", F.lit(0)).alias("non_null_rows"))


def schema_drift(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """One row per column of the contract or the files, labelled by its change.

    ``same``, ``added`` (files only), ``removed`` (contract only), ``type_changed``,
    or ``clash`` where files hold types that no type holds together: ``actual_type``
    then names them all, otherwise the least type that holds every file's values.
    With the number of files, of those that hold no value for the column, and of
    rows with and without. A dataset without rows, or without files, has its rows, too.
    """
    listing = data_files(spark, path)
    footers = read_footers(spark, path, listing)
    expected = {f.name.lower(): f for f in contract.fields}
    # One row per column.
    actual = {r.key: (r.column, least_type(r.types), r.types) for r in column_types(footers).collect()}
    folders = {f.name.lower(): f for f in folder_columns(spark, path).fields}
    actual |= {key: (f.name, f.dataType.simpleString(), []) for key, f in folders.items()}
    labels = []
    for key in [*expected, *[k for k in actual if k not in expected]]:
        old = expected[key].dataType.simpleString() if key in expected else None
        name = expected[key].name if key in expected else actual[key][0]
        new = None
        if key not in actual:
            change = "removed"
        else:
            _, new, types = actual[key]
            if new is None:
                new, change = " | ".join(types), "clash"
            else:
                change = "added" if old is None else "same" if old == new else "type_changed"
        labels.append((key, name, old, new, change))
    cells = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(_LABELS, label)]) for label in labels]
    labelled = spark.range(1).select(F.inline(F.array(*cells)))
    present = _presence(footers, labelled)
    if folders:
        # A folder gives its files a value unless it is the one for null.
        null = F.expr("file LIKE concat('%/', column, '=__HIVE_DEFAULT_PARTITION__/%')") | F.expr(
            "file LIKE concat(column, '=__HIVE_DEFAULT_PARTITION__/%')"
        )
        values = F.when(F.col("key").isin(list(folders)), F.when(null, 0).otherwise(F.col("rows")))
        present = present.withColumn("non_null_rows", F.coalesce(values, "non_null_rows"))
    counts = present.groupBy("key").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("non_null_rows") == 0).alias("files_without_values"),
        F.sum("rows").alias("rows"),
        F.sum("non_null_rows").alias("non_null_rows"),
    )
    numbers = ("files", "files_without_values", "rows", "non_null_rows")
    return labelled.join(counts, "key", "left").select(
        "column", "contract_type", "actual_type", "change", *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers]
    )
