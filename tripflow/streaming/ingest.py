"""Files that arrived since the last run, and only those."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripflow.schemas import RAW_TRIPS
from tripflow.sources.zones import require_distinct

NEVER_TOO_OLD = "36500d"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = RAW_TRIPS,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_bytes_per_batch: int | None = None,
) -> None:
    """Append the rows of new Parquet files below ``source`` to ``target``; then stop.

    ``checkpoint`` remembers the files already read, and ``target`` the batches
    already written, so a run that dies half way repeats nothing and loses
    nothing. ``transform`` may be any row-level operator, such as
    ``build_silver``. ``max_bytes_per_batch`` cuts a large backlog into several
    batches. All three paths must be on storage the executors share.

    Files count as new however old they are. So the list of files seen only
    grows; the driver holds it, some 100 bytes per file.
    """
    require_distinct(source, target, checkpoint)
    # Spark's default would skip files a week older than the newest one seen:
    # backfills and copies that keep their times.
    reader = spark.readStream.schema(schema).option("maxFileAge", NEVER_TOO_OLD)
    if max_bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_batch))
    arriving = reader.parquet(source)
    rows = arriving if transform is None else transform(arriving)
    (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
