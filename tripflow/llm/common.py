"""What several operators need: stored intermediate tables, free names, text defaults."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.scratch import scratch_path

# A word: a run of anything but ASCII white space. Java's and DuckDB's regular
# expressions read it alike.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: what follows survives the loss of any executor without
    repeating what came before, and Spark knows the table's size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a table from ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` is called so."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in parts whose values of ``column`` hold up to ``most`` bytes together, or one row.

    Spark cuts batches by rows. Parts share the memory of their batch, so what is made of them
    in Python is bounded by their bytes, however long the values of a batch are. Memory of batches
    that are done goes back to the system: a worker lives on for other tasks.
    """
    for batch in batches:
        pa.default_memory_pool().release_unused()
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        reached = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(sizes):
            before = reached[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(reached, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
