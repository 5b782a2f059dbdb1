"""Arrived files known by their content: one that was sent before adds nothing, whatever its name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.files import exists, put_in_place
from tripflow.sources.footers import data_files
from tripflow.sources.landing import BLOCK_BYTES, Listing, copy_files, digest_blocks, hash_trees
from tripflow.sources.scratch import stored
from tripflow.sources.zones import require_distinct

_SEEN = "file string, length bigint, modified bigint, content string"


def gather_new_content(
    spark: SparkSession,
    source: str,
    gathered: str,
    manifest: str,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Copy the files below ``source`` whose content is new to ``gathered``; returns them: ``content, length, file``.

    ``gathered`` names a file by its content, the root of its hash tree, so it holds every
    content once. ``manifest`` remembers all files that were ever looked at, with their
    content: a file that it holds under its name, length and time is not read again; of
    the others, those whose content it holds, under any name, are left out, and of
    several with the same content one is taken. ``ingest_new_files`` reads ``gathered``.

    The copies come first and the manifest last, so a run that dies is repeated
    with the same result. One run at a time.
    """
    require_distinct(source, gathered, manifest)
    listing = data_files(spark, source)
    seen = spark.read.schema(_SEEN).parquet(manifest) if exists(spark, manifest) else spark.createDataFrame([], _SEEN)
    given = listing.files
    same = (
        (given["file"] == seen["file"])
        & (given["length"] == seen["length"])
        & given["modified"].eqNullSafe(seen["modified"])
    )
    unknown = Listing(given.join(seen, same, "left_anti"), listing.count, listing.bytes, listing.longest)
    trees = hash_trees(digest_blocks(unknown, block_bytes)).select(
        F.col("file").alias("digested"), F.concat("root", F.lit("-"), F.col("length").cast("string")).alias("content")
    )
    digested = stored(
        unknown.files.join(trees, F.col("file") == F.col("digested")).drop("digested"), "digested"
    )
    before = seen.select(F.col("content").alias("had")).distinct()
    # Of many files with one content the first by name is taken.
    chosen = stored(
        digested.join(before, F.col("content") == F.col("had"), "left_anti")
        .groupBy("content")
        .agg(F.min("file").alias("sent"), *[F.min_by(c, "file").alias(c) for c in ("path", "length", "modified")])
        .withColumn("file", F.concat("content", F.lit(".parquet"))),
        "new-content",
    )
    picked = Listing(chosen.select("path", "file", "length", "modified"), listing.count, listing.bytes, listing.longest)
    copy_files(spark, picked, gathered, block_bytes=block_bytes)
    staged = f"{manifest.rstrip('/')}.staged-{uuid.uuid4().hex}"
    seen.unionByName(digested.drop("path")).write.parquet(staged)
    put_in_place(spark, staged, manifest)
    return chosen.select("content", "length", F.col("sent").alias("file"))
