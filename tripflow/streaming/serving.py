"""Loading the serving table with what is new in gold, each row once.

Gold is read as a stream of files. Every micro-batch has a name of its own, the
stream's id and the batch's number, and holds the same files whenever it is
repeated. A sink keeps a ledger of these names: a batch is staged aside, where a
repeated attempt replaces what a failed one has left, and then published together
with its entry in the ledger, in one step. So a batch that was published is
skipped, and one that was not leaves nothing behind but its staging.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators import conform_serving
from tripflow.schemas import GOLD_TRIPS, PICKUP, SERVING_TRIPS
from tripflow.sources.files import children, exists, move, remove
from tripflow.sources.jdbc import CONNECTIONS, load_jdbc
from tripflow.sources.zones import require_distinct
from tripflow.streaming.ingest import NEVER_TOO_OLD


class ServingSink(Protocol):
    def is_loaded(self, batch: str) -> bool:
        """Whether the ledger holds the batch."""

    def stage(self, rows: DataFrame, batch: str) -> None:
        """Put the rows aside, instead of any that an earlier attempt has left."""

    def publish(self, batch: str, days: Sequence[date]) -> None:
        """Take the staged rows in, in place of those of ``days``, and enter the batch: all or nothing."""


def load_new_rows(
    spark: SparkSession,
    gold: str,
    checkpoint: str,
    sink: ServingSink,
    schema: T.StructType = GOLD_TRIPS,
    replace_days: bool = False,
    max_bytes_per_batch: int | None = None,
) -> None:
    """Load the rows of gold files that are new since the last run; then stop.

    ``replace_days`` is for a gold stored by day, where a changed day is written
    anew as a whole: days of new files then replace the same days in the serving
    table, instead of adding to them. All new files are one batch then, as a day must
    not be divided; otherwise ``max_bytes_per_batch`` may cut a backlog.

    The checkpoint must be kept as long as the table: a new one knows no files and has
    another id, so it would load all of gold again.
    """
    require_distinct(gold, checkpoint)
    if replace_days and max_bytes_per_batch is not None:
        raise ValueError("days are replaced as a whole: no max_bytes_per_batch with replace_days")
    reader = spark.readStream.schema(schema).option("maxFileAge", NEVER_TOO_OLD).option("recursiveFileLookup", "true")
    if max_bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_batch))
    if replace_days:
        # A file of a repeated batch may be gone because its day was written anew; the
        # new file of that day comes with the next batch and replaces it.
        reader = reader.option("ignoreMissingFiles", "true")

    def once(rows: DataFrame, number: int) -> None:
        stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = f"{stream}-{number}"
        if sink.is_loaded(batch):
            return
        sink.stage(conform_serving(rows), batch)
        sink.publish(batch, _days(rows) if replace_days else [])

    (
        reader.parquet(gold)
        .writeStream.foreachBatch(once)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _days(rows: DataFrame) -> list[date]:
    """The days that ``rows`` hold; one row per day comes to the driver."""
    day = F.to_date(PICKUP).alias("day")
    return [r.day for r in rows.select(day).filter("day IS NOT NULL").distinct().orderBy("day").collect()]


class FolderSink:
    """A serving dataset in a shared folder: one folder per batch, which is also its entry in the ledger."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _place(self, batch: str) -> str:
        return f"{self.root}/load={batch}"

    def is_loaded(self, batch: str) -> bool:
        return exists(self.spark, self._place(batch))

    def stage(self, rows: DataFrame, batch: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/_staged/{batch}")

    def publish(self, batch: str, days: Sequence[date]) -> None:
        if days:
            raise ValueError("folders per batch cannot replace days")
        move(self.spark, f"{self.root}/_staged/{batch}", self._place(batch))

    def batches(self) -> list[str]:
        return [name.removeprefix("load=") for name in children(self.spark, self.root) if name.startswith("load=")]

    def read(self) -> DataFrame:
        return self.spark.read.schema(SERVING_TRIPS).parquet(self.root).select(*SERVING_TRIPS.names)


class JdbcSink:
    """A relational serving table with its ledger and its staging tables beside it.

    ``<table>_loads`` holds the names of loaded batches and must exist: ``CREATE TABLE
    <table>_loads (batch VARCHAR(200) PRIMARY KEY)``. Rows are staged by all tasks
    into a table of the batch, and one transaction on the database itself moves them
    over, removes the days they replace and enters the batch. The key makes a second
    publication of the same batch fail, also where two runs race.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        table: str,
        connections: int = CONNECTIONS,
        properties: Mapping[str, str] | None = None,
        connect: Callable[[], Any] | None = None,
    ):
        self.url, self.table, self.connections = url, table, connections
        self.properties = dict(properties or {})
        self.connect = connect or (lambda: _connection(spark, url, self.properties))

    def _staging(self, batch: str) -> str:
        # Short enough for any database's limit on names.
        return f"{self.table}_staged_{hashlib.md5(batch.encode()).hexdigest()[:12]}"

    def is_loaded(self, batch: str) -> bool:
        connection = self.connect()
        try:
            asked = connection.prepareStatement(f"SELECT 1 FROM {self.table}_loads WHERE batch = ?")
            asked.setString(1, batch)
            return asked.executeQuery().next()
        finally:
            connection.close()

    def stage(self, rows: DataFrame, batch: str) -> None:
        load_jdbc(rows, self.url, self._staging(batch), "overwrite", self.connections, self.properties)

    def publish(self, batch: str, days: Sequence[date]) -> None:
        columns = ", ".join(f'"{c}"' for c in SERVING_TRIPS.names)
        connection = self.connect()
        try:
            connection.setAutoCommit(False)
            try:
                entry = connection.prepareStatement(f"INSERT INTO {self.table}_loads (batch) VALUES (?)")
                entry.setString(1, batch)
                entry.executeUpdate()
                change = connection.createStatement()
                for first, after in _spans(days):
                    change.executeUpdate(
                        f"DELETE FROM {self.table} WHERE \"{PICKUP}\" >= TIMESTAMP '{first} 00:00:00' "
                        f"AND \"{PICKUP}\" < TIMESTAMP '{after} 00:00:00'"
                    )
                change.executeUpdate(
                    f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {self._staging(batch)}"
                )
                connection.commit()
            except BaseException:
                connection.rollback()
                raise
            connection.setAutoCommit(True)
            connection.createStatement().executeUpdate(f"DROP TABLE {self._staging(batch)}")
        finally:
            connection.close()


def _spans(days: Sequence[date]) -> list[tuple[date, date]]:
    """Days in a row as one span each: its first day, and the day after its last."""
    spans: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if spans and spans[-1][1] == day:
            spans[-1] = (spans[-1][0], day + timedelta(days=1))
        else:
            spans.append((day, day + timedelta(days=1)))
    return spans


def _connection(spark: SparkSession, url: str, properties: Mapping[str, str]):
    settings = spark._jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, value)
    if "driver" in properties:
        registry = spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry
        registry.register(properties["driver"])
    return spark._jvm.java.sql.DriverManager.getConnection(url, settings)
