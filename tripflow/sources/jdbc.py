"""Relational sink and source over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

CONNECTIONS = 16
BATCH_ROWS = 10_000


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    connections: int = CONNECTIONS,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write ``df`` to a table, over at most ``connections`` connections.

    Appending the same data twice doubles it: load each batch once, or use
    ``mode="overwrite"``, which empties the table and keeps its definition,
    grants and indexes. Each task commits its own transaction, so keep
    speculative execution off for this write. ``df`` should be a plain scan:
    the limit on connections also limits the tasks that compute it.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode}")
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(BATCH_ROWS),
        "numPartitions": str(connections),
        **(properties or {}),
    }
    if mode == "overwrite":
        options["truncate"] = "true"
    df.write.format("jdbc").options(**options).mode(mode).save()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    predicates: Sequence[str] | None = None,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    num_partitions: int = CONNECTIONS,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a table in parallel; its schema comes from the database.

    ``read_jdbc(…).createOrReplaceTempView(name)`` makes it a table for SQL.

    Either ``predicates``, one task each, which must cover the table without
    overlap (``time_slices`` makes such a list), or ``partition_column`` with
    bounds that only shape the split: rows outside them are still read. One of
    the two is required, as a scan without would run as a single task. Split by
    time rather than by zone, where a hot zone would land in one task.
    """
    options = {"preferTimestampNTZ": "true", **(properties or {})}
    if (predicates is None) == (partition_column is None):
        raise ValueError("give predicates or partition_column")
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    if lower is None or upper is None:
        raise ValueError("partition_column needs lower and upper")
    options |= {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(num_partitions),
    }
    return spark.read.format("jdbc").options(**options).load()


def time_slices(column: str, start: datetime, end: datetime, step: timedelta) -> list[str]:
    """Predicates that cut a table into time ranges.

    The first also takes NULL and everything earlier, the last everything later,
    so the slices together are the whole table.
    """
    if step <= timedelta(0) or end <= start:
        raise ValueError("need start < end and a positive step")
    cuts = []
    at = start
    while at < end:
        cuts.append(at.isoformat(sep=" "))
        at += step
    first = f"{column} < '{cuts[0]}' OR {column} IS NULL"
    middle = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(cuts, cuts[1:])]
    return [first, *middle, f"{column} >= '{cuts[-1]}'"]
