"""Scans, sinks, the catalog, JDBC and the landing zone."""

from tripflow.sources.catalog import read_table, register_zone, replace_table
from tripflow.sources.footers import merged_schema, read_footers
from tripflow.sources.jdbc import load_jdbc, read_jdbc, time_slices
from tripflow.sources.landing import (
    LandingError,
    by_dataset,
    file_blocks,
    file_checksums,
    hash_trees,
    land_files,
    list_files,
    repair_copy,
    require_match,
    verify_copy,
)
from tripflow.sources.zones import (
    read_contract,
    read_partitioned,
    read_zone,
    require_distinct,
    write_partitioned,
    write_zone,
)

__all__ = [
    "LandingError",
    "by_dataset",
    "file_blocks",
    "file_checksums",
    "hash_trees",
    "land_files",
    "list_files",
    "load_jdbc",
    "merged_schema",
    "read_contract",
    "read_footers",
    "read_jdbc",
    "read_partitioned",
    "read_table",
    "read_zone",
    "register_zone",
    "repair_copy",
    "replace_table",
    "require_distinct",
    "require_match",
    "time_slices",
    "verify_copy",
    "write_partitioned",
    "write_zone",
]
