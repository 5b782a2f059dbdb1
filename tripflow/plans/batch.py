"""One batch from raw files to the serving table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tripflow.plans.checked import Limits, write_checked_silver
from tripflow.plans.refresh import refresh_zones
from tripflow.plans.zones import build_gold, build_silver, load_serving
from tripflow.schemas import RAW_TRIPS, REPORT_MONTH, REPORT_YEAR, SILVER_TRIPS, ZONE_SWAP
from tripflow.sources.catalog import register_zone
from tripflow.sources.files import exists
from tripflow.sources.footers import merged_schema, read_footers
from tripflow.sources.landing import land_files, require_match, verify_copy
from tripflow.sources.zones import read_contract, read_zone, require_distinct, write_partitioned, write_zone
from tripflow.streaming.serving import JdbcSink, load_new_rows


@dataclass(frozen=True)
class BatchConfig:
    """Where a batch reads and writes, and which month it reports.

    Without ``source`` the raw files are already in ``bronze``; without
    ``database`` no tables are registered, without ``jdbc_url`` nothing is
    loaded. ``silver_by_day`` stores silver in a folder per day, which costs a
    shuffle when writing and lets later months read only their own days.

    ``quarantine`` keeps the trips that cleaning rejects, written by the same pass
    as silver, and ``limits`` say how many may be before the batch stops.

    ``state`` makes the batch incremental: only files that are not landed yet are
    copied, and only the days that new, changed or vanished files touch are rebuilt
    in silver and gold, both stored by day. ``load_checkpoint`` then loads only what
    changed, each row once, whatever fails; see ``JdbcSink`` for the ledger it needs.
    """

    bronze: str
    silver: str
    gold: str
    source: str | None = None
    year: int = REPORT_YEAR
    month: int = REPORT_MONTH
    mapping: Mapping[int, int] = field(default_factory=lambda: dict(ZONE_SWAP))
    silver_by_day: bool = False
    database: str | None = None
    table_prefix: str = ""
    jdbc_url: str | None = None
    serving_table: str | None = None
    load_mode: str = "append"
    jdbc_properties: Mapping[str, str] = field(default_factory=dict)
    quarantine: str | None = None
    limits: Limits = Limits()
    state: str | None = None
    load_checkpoint: str | None = None


def run_pipeline(spark: SparkSession, config: BatchConfig) -> None:
    """Land, clean, enrich, register and load; the first failure ends the batch.

    Each stage reads what the one before wrote, so a batch can be repeated from
    the start. Bronze gathers what was landed, earlier files stay; silver and gold
    are replaced, or their touched days; an appending load appends, a load with a
    checkpoint adds each row once.
    """
    if (config.jdbc_url is None) != (config.serving_table is None):
        raise ValueError("give jdbc_url and serving_table together, or neither")
    if config.load_checkpoint is not None and (config.state is None or config.jdbc_url is None):
        raise ValueError("load_checkpoint needs state and jdbc_url: a gold that is replaced is all new")
    if config.state is not None and config.quarantine is not None:
        raise ValueError("a quarantine is kept by full batches, not with state")
    own = (config.source, config.bronze, config.silver, config.gold, config.quarantine, config.state)
    require_distinct(*[p for p in (*own, config.load_checkpoint) if p])

    if config.source is not None:
        which = {} if config.state is None else {"only_new": True}
        manifest = land_files(spark, config.source, config.bronze, **which)
        require_match(verify_copy(spark, config.source, config.bronze, manifest=manifest))

    footers = None
    if config.state is not None:
        refresh_zones(
            spark,
            config.bronze,
            config.silver,
            config.gold,
            config.state,
            config.year,
            config.month,
            config.mapping,
        )
    else:
        footers = read_footers(spark, config.bronze)
        _build(spark, config, read_contract(spark, config.bronze, RAW_TRIPS, footers))

    if config.database is not None:
        # What this library has written needs no look at its footers.
        schemas = {"bronze": footers and merged_schema(footers), "silver": SILVER_TRIPS, "gold": SILVER_TRIPS}
        for name, schema in schemas.items():
            path = getattr(config, name)
            if name == "bronze" or exists(spark, path):
                register_zone(spark, path, config.database, name, config.table_prefix, schema)

    if config.load_checkpoint is not None:
        sink = JdbcSink(spark, config.jdbc_url, config.serving_table, properties=config.jdbc_properties)
        load_new_rows(spark, config.gold, config.load_checkpoint, sink, replace_days=True)
    elif config.jdbc_url is not None:
        load_serving(
            spark,
            config.gold,
            config.jdbc_url,
            config.serving_table,
            config.load_mode,
            properties=config.jdbc_properties,
        )


def _build(spark: SparkSession, config: BatchConfig, raw: DataFrame) -> None:
    """Silver and gold as a whole."""
    if config.quarantine is not None:
        write_checked_silver(spark, raw, config.silver, config.quarantine, config.limits, config.silver_by_day)
    elif config.silver_by_day:
        write_partitioned(build_silver(raw), config.silver, replace_all=True)
    else:
        write_zone(build_silver(raw), config.silver)
    stored = read_zone(spark, config.silver, schema=SILVER_TRIPS)
    gold = build_gold(stored, config.year, config.month, config.mapping)
    write_zone(gold.select(*SILVER_TRIPS.names), config.gold)
