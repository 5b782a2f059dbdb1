"""Landing raw files as they are, and proving that the copy is the source.

Files are opaque here. Spreading and comparing are Spark jobs; small helpers
inside tasks list folders and stream bytes, so no file is ever held whole. A folder
is listed once per call, and what a copy digests it keeps in a manifest, so that a
later check reads the landed side only.
Every file counts, whatever its name or length: Spark's own file listing would
pass over empty files and names that start with ``_`` or ``.``.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import sys
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.scratch import scratch_path

# Send the helpers below to tasks as code: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A file is digested in blocks of this size, by different tasks.
BLOCK_BYTES = 128 * 1024 * 1024
# About what one task reads, unless told otherwise.
TASK_BYTES = 1024 * 1024 * 1024
_READ_BYTES = 8 * 1024 * 1024
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
_LISTED = "path string, file string, length bigint, modified bigint"
_BLOCKS = f"{_LISTED}, start bigint, size bigint"
_MANIFEST = "file string, length bigint, start bigint, size bigint, md5 string, block_bytes bigint"
# Folders that one task lists, where a level has many.
FOLDERS = 100


class LandingError(RuntimeError):
    """The landed copy differs from its source."""


@dataclass(frozen=True)
class Listing:
    """Every file below a root, listed once and stored, with what is known from listing it."""

    files: DataFrame  # path, file, length, modified (nanoseconds, null where the store has no times)
    count: int
    bytes: int
    longest: int


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path``, ``file`` (relative to ``root``), ``length`` and ``modified`` of every file below ``root``.

    Listed here and now, each folder once, and stored: see ``take_listing``.
    """
    return take_listing(spark, root).files


def take_listing(spark: SparkSession, root: str) -> Listing:
    """List ``root`` level by level; a root that is itself a file gives that one under its plain name.

    The folders of a level are dealt over all tasks anew, so one deep or wide
    folder at the top does not keep one task busy. Each level is written to the
    shared folder by the job that lists it, which also counts what it found: the
    driver never sees the names.
    """
    stored = scratch_path(spark, "listing")
    levels: list[str] = []
    totals = Counter()
    longest = 0
    folders, step = spark.createDataFrame([(_normal(root), "")], "path string, file string"), _list_root
    while True:
        seen = Observation()
        found = folders.mapInPandas(step, _LISTED).observe(
            seen,
            F.count("length").alias("files"),
            F.count_if(F.col("length").isNull()).alias("folders"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
            F.coalesce(F.max("length"), F.lit(0)).alias("longest"),
        )
        levels.append(f"{stored}/{len(levels)}")
        found.write.parquet(levels[-1])
        counts = seen.get
        totals.update(files=counts["files"], bytes=counts["bytes"])
        longest = max(longest, counts["longest"])
        if not counts["folders"]:
            break
        below = spark.read.schema(_LISTED).parquet(levels[-1]).filter("length IS NULL").select("path", "file")
        # A row is a folder to list, so the number of tasks is stated.
        tasks = min(counts["folders"], max(spark.sparkContext.defaultParallelism, counts["folders"] // FOLDERS))
        folders, step = below.repartition(tasks, "path"), _list_folders
    files = spark.read.schema(_LISTED).parquet(*levels).filter("length IS NOT NULL")
    return Listing(files, totals["files"], totals["bytes"], longest)


def file_checksums(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """``file`` (relative to ``root``), ``length`` and whole-file ``md5`` of each file.

    MD5 runs through a file from end to end, so one file is one task's work,
    streamed in constant memory.
    """
    listing = take_listing(spark, root)
    files = _spread(listing, listing.files, tasks, "path")
    return files.mapInPandas(_digest_files, f"{_LISTED}, md5 string").select("file", "length", "md5")


def file_blocks(
    spark: SparkSession,
    root: str,
    block_bytes: int = BLOCK_BYTES,
    tasks: int | None = None,
) -> DataFrame:
    """MD5 per block of ``block_bytes``: ``file``, ``length``, ``start``, ``md5``.

    Blocks of one large file are read by different tasks, so checking it scales
    with the cluster. An empty file is one empty block. ``tasks``: how many read
    side by side; by default as many as the bytes ask for.
    """
    return digest_blocks(take_listing(spark, root), block_bytes, tasks)


def digest_blocks(listing: Listing, block_bytes: int = BLOCK_BYTES, tasks: int | None = None) -> DataFrame:
    """``file_blocks`` of the files of a listing."""
    blocks = _spread(listing, _blocks(listing.files, block_bytes), tasks, "path", "start")
    return blocks.mapInPandas(_digest_blocks, f"{_BLOCKS}, md5 string").select("file", "length", "start", "md5")


def verify_copy(
    spark: SparkSession,
    source: str,
    landed: str,
    block_bytes: int = BLOCK_BYTES,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """One row per file: ``match``, ``mismatch``, ``missing`` or ``extra``.

    Both copies are read and digested, block by block; with a ``manifest`` from
    ``land_files`` only the landed one is, in the blocks of the manifest.
    """
    if manifest is None:
        given = file_blocks(spark, source, block_bytes)
    else:
        given = manifest
        block_bytes = _block_bytes(manifest) or block_bytes
    left = given.select("file", "start", F.col("length").alias("source_length"), F.col("md5").alias("source_md5"))
    right = file_blocks(spark, landed, block_bytes).select(
        "file", "start", F.col("length").alias("landed_length"), F.col("md5").alias("landed_md5")
    )
    same = F.col("source_length").eqNullSafe(F.col("landed_length")) & (F.col("bad_blocks") == 0)
    return (
        left.join(right, ["file", "start"], "full")
        .groupBy("file")
        .agg(
            F.max("source_length").alias("source_length"),
            F.max("landed_length").alias("landed_length"),
            F.count_if(~F.col("source_md5").eqNullSafe(F.col("landed_md5"))).alias("bad_blocks"),
        )
        .select(
            "file",
            "source_length",
            "landed_length",
            F.when(F.col("landed_length").isNull(), "missing")
            .when(F.col("source_length").isNull(), "extra")
            .when(same, "match")
            .otherwise("mismatch")
            .alias("status"),
        )
    )


def by_dataset(verified: DataFrame) -> DataFrame:
    """Rows of ``verify_copy`` by what stands at the top of the root: a single file, or a folder as one dataset.

    ``file`` is its name; ``status`` is that of all its files, ``mismatch`` where they differ in it.
    """
    return (
        verified.groupBy(F.substring_index("file", "/", 1).alias("file"))
        .agg(
            F.sum("source_length").alias("source_length"),
            F.sum("landed_length").alias("landed_length"),
            F.count(F.lit(1)).alias("files"),
            F.min("status").alias("status"),
            (F.min("status") != F.max("status")).alias("mixed"),
        )
        .withColumn("status", F.when(F.col("mixed"), "mismatch").otherwise(F.col("status")))
        .drop("mixed")
    )


def hash_trees(manifest: DataFrame) -> DataFrame:
    """``file``, ``length``, ``blocks`` and ``root``: one digest over the digests of each file's blocks.

    Equal roots, taken in blocks of one size, are equal files; where they differ, the blocks of
    the manifest tell which part does. Only 32 characters per block come together for a file.
    """
    leaves = F.sort_array(F.collect_list(F.struct("start", "md5")))
    return manifest.groupBy("file").agg(
        F.max("length").alias("length"),
        F.count(F.lit(1)).alias("blocks"),
        F.md5(F.concat_ws("", F.transform(leaves, lambda leaf: leaf["md5"]))).alias("root"),
    )


def require_match(verified: DataFrame, allow_extra: bool = True) -> None:
    """Raise ``LandingError`` if a file is missing or differs; with counts, and some names.

    A landed file that the source does not have (any more) is no failure: earlier
    landings stay. ``allow_extra=False`` refuses those, too.
    """
    fine = ["match", "extra"] if allow_extra else ["match"]
    bad = verified.filter(~F.col("status").isin(fine))
    by_status = bad.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("example"))
    found = by_status.orderBy("status").collect()  # one row per status
    if found:
        raise LandingError("; ".join(f"{row.n} {row.status}, such as {row.example}" for row in found))


def land_files(
    spark: SparkSession,
    source: str,
    landed: str,
    tasks: int | None = None,
    block_bytes: int = BLOCK_BYTES,
    only_new: bool = False,
) -> DataFrame:
    """Copy every file below ``source``, byte for byte, to the same place below ``landed``.

    With ``only_new`` files stay out that are landed already: with the same length,
    and changed no later than their landing.

    Returns the manifest, stored: ``file, length, start, size, md5, block_bytes``
    of every block, digested while it was copied. Tasks copy files side by side, and
    where the target lets several tasks write into one file, its blocks, too; other
    targets get a file from one task. A file appears under its name only when
    complete, so a lost executor leaves no half file and its retry starts over.
    """
    listing = take_listing(spark, source)
    if only_new:
        listing = _not_landed(spark, listing, landed)
    return copy_files(spark, listing, landed, tasks, block_bytes)


def copy_files(
    spark: SparkSession, listing: Listing, landed: str, tasks: int | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Copy the files of a listing: ``path`` to ``file`` below ``landed``; see ``land_files``."""
    stored = scratch_path(spark, "manifest")
    name = uuid.uuid4().hex
    in_blocks = _takes_blocks(landed)
    work = _blocks(listing.files, block_bytes) if in_blocks else _blocks(listing.files, None)
    split = in_blocks and listing.longest > block_bytes
    try:
        _spread(listing, work, tasks, "path", "start").mapInPandas(
            _copier(landed, name, block_bytes), _MANIFEST
        ).write.parquet(stored)
    except BaseException:
        if split:
            _finish(listing, landed, name, block_bytes, complete=False)
        raise
    if split:
        _finish(listing, landed, name, block_bytes)
    return spark.read.schema(_MANIFEST).parquet(stored)


def _not_landed(spark: SparkSession, listing: Listing, landed: str) -> Listing:
    try:
        there = take_listing(spark, landed).files
    except Exception as none:
        if "FileNotFoundError" not in str(none):
            raise
        return listing
    have = there.select("file", F.col("length").alias("have"), F.col("modified").alias("since"))
    same = (F.col("length") == F.col("have")) & (F.col("modified") <= F.col("since"))
    new = listing.files.join(have, "file", "left").filter(~F.coalesce(same, F.lit(False)))
    return Listing(new.select(*listing.files.columns), listing.count, listing.bytes, listing.longest)


def repair_copy(spark: SparkSession, source: str, landed: str, manifest: DataFrame) -> DataFrame:
    """Copy again what the landed side has lost or holds wrongly; returns the manifest rows of that, stored.

    The landed side is read and compared with the manifest. Of a file that still has
    its length only the blocks that differ are copied, into their place; others are
    copied whole. A source that changed since the manifest was made raises.
    """
    block_bytes = _block_bytes(manifest) or BLOCK_BYTES
    have = file_blocks(spark, landed, block_bytes).select(
        "file", "start", F.col("length").alias("landed_length"), F.col("md5").alias("landed_md5")
    )
    found = manifest.join(have, ["file", "start"], "left")
    whole = found.filter(~F.col("length").eqNullSafe(F.col("landed_length"))).select("file").distinct()
    bad = found.filter(~F.col("md5").eqNullSafe(F.col("landed_md5"))).join(
        whole.withColumn("whole", F.lit(True)), "file", "left"
    )
    stored, done = scratch_path(spark, "bad-blocks"), scratch_path(spark, "repaired")
    bad.select(*_names(_MANIFEST), F.coalesce("whole", F.lit(not _takes_blocks(landed))).alias("whole")).write.parquet(stored)
    bad = spark.read.parquet(stored)
    paths = F.concat(F.lit(_normal(source) + "/"), "file").alias("path")
    # Files that lost their length are written anew, under their name when complete.
    unknown = F.lit(None).cast("bigint").alias("modified")
    files = bad.filter("whole").select(paths, "file", "length", unknown).distinct()
    blocks = bad.filter("NOT whole").select(paths, "file", "length", unknown, "start", "size")
    again = _blocks(files, None).repartition(max(1, spark.sparkContext.defaultParallelism), "path")
    copied = again.mapInPandas(_copier(landed, uuid.uuid4().hex, block_bytes), _MANIFEST)
    patched = blocks.repartition(max(1, spark.sparkContext.defaultParallelism), "path", "start").mapInPandas(
        _patcher(landed, block_bytes), _MANIFEST
    )
    copied.unionByName(patched).write.parquet(done)
    repaired = spark.read.schema(_MANIFEST).parquet(done)
    changed = repaired.join(manifest, ["file", "start"]).filter(repaired["md5"] != manifest["md5"])
    example = changed.select("file").first()
    if example is not None:
        raise LandingError(f"the source is no longer that of the manifest, such as {example.file}")
    return repaired


def _normal(root: str) -> str:
    """One spelling of an absolute path or URI, without doubled or trailing slashes."""
    if not (root.startswith("/") or re.match(_SCHEME, root)):
        raise ValueError(f"need an absolute path or a URI, not {root}")
    scheme = re.match(_SCHEME, root)
    start = scheme.group() if scheme else ""
    return start + posixpath.normpath("/" + root[len(start) :].lstrip("/"))


def _block_bytes(manifest: DataFrame) -> int | None:
    """The size of blocks, the same in every row; None where there is no row."""
    row = manifest.select("block_bytes").first()
    return row and row.block_bytes


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _blocks(files: DataFrame, block_bytes: int | None) -> DataFrame:
    """A row per block of each file, with ``start`` and ``size``; the whole file as one without ``block_bytes``."""
    if block_bytes is None:
        start, size = F.lit(0).cast("bigint").alias("start"), F.col("length").alias("size")
        return files.select("path", "file", "length", "modified", start, size)
    last = F.greatest(F.col("length") - 1, F.lit(0))
    starts = F.sequence(F.lit(0).cast("bigint"), last, F.lit(block_bytes).cast("bigint"))
    return files.withColumn("start", F.explode(starts)).withColumn(
        "size", F.least(F.lit(block_bytes).cast("bigint"), F.col("length") - F.col("start"))
    )


def _spread(listing: Listing, work: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Rows of a few bytes that stand for much reading, dealt over enough tasks.

    The number is stated, as adaptive execution would merge such rows into one.
    """
    if tasks is None:
        tasks = max(work.sparkSession.sparkContext.defaultParallelism, -(-listing.bytes // TASK_BYTES))
        if listing.longest <= BLOCK_BYTES:
            tasks = max(1, min(tasks, listing.count))
    return work.repartition(tasks, *keys)


def _finish(listing: Listing, landed: str, name: str, block_bytes: int, complete: bool = True) -> None:
    """Give files that were written in blocks their names, or remove what there is of them."""
    files = listing.files.filter(F.col("length") > block_bytes)
    tasks = max(1, min(listing.count, files.sparkSession.sparkContext.defaultParallelism))
    files.repartition(tasks, "path").mapInPandas(_namer(landed, name, complete), "file string").write.format(
        "noop"
    ).mode("overwrite").save()


def _children(uri: str, name: str) -> list[tuple[str, str, int | None, int | None]]:
    """URI, relative name, length and time of what lies in a folder; folders have no length."""
    from pyarrow import fs

    filesystem, path = _filesystem(uri)
    found = filesystem.get_file_info(fs.FileSelector(path))
    return [
        (
            f"{uri.rstrip('/')}/{info.base_name}",
            f"{name}/{info.base_name}" if name else info.base_name,
            None if info.type == fs.FileType.Directory else info.size,
            info.mtime_ns,
        )
        for info in found
    ]


def _listed(rows: list[tuple[str, str, int | None, int | None]]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_names(_LISTED))
    return frame.astype({"path": object, "file": object, "length": "Int64", "modified": "Int64"})


def _list_root(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        for uri in batch["path"]:
            filesystem, path = _filesystem(uri)
            root = filesystem.get_file_info(path)
            if root.type == fs.FileType.NotFound:
                raise FileNotFoundError(uri)
            if root.type == fs.FileType.Directory:
                yield _listed(_children(uri, ""))
            else:
                yield _listed([(uri, root.base_name, root.size, root.mtime_ns)])


def _list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What lies in the folders, a folder at a time; not what lies below."""
    for batch in batches:
        for uri, name in zip(batch["path"], batch["file"]):
            yield _listed(_children(uri, name))


def _filesystem(uri: str):
    """File system and path of a URI, inside a task."""
    from pyarrow import fs

    if re.match(r"^(file:|/)", uri):
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:", "", uri).lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def _md5(uri: str, start: int = 0, size: int | None = None) -> str:
    filesystem, path = _filesystem(uri)
    digest = hashlib.md5()
    with filesystem.open_input_file(path) as stream:
        stream.seek(start)
        left = stream.size() - start if size is None else size
        while left > 0:
            piece = stream.read(min(_READ_BYTES, left))
            if not piece:
                raise OSError(f"{uri} is shorter than listed")
            digest.update(piece)
            left -= len(piece)
    return digest.hexdigest()


def _digest_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(md5=[_md5(path) for path in batch["path"]])


def _digest_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = [_md5(*block) for block in zip(batch["path"], batch["start"], batch["size"])]
        yield batch.assign(md5=digests)


def _takes_blocks(root: str) -> bool:
    """Whether several tasks can write into one file below ``root``: a local or mounted folder."""
    return bool(re.match(r"^(file:|/)", root))


def _copier(landed: str, name: str = "", block_bytes: int = BLOCK_BYTES):
    """Copies the blocks it is given, a whole file or a part of one; a row per block of ``block_bytes``."""

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, file, length, _, start, size in zip(*[batch[c] for c in _names(_BLOCKS)]):
                target = f"{_normal(landed)}/{file}"
                if size == length:
                    digests = _copy_file(uri, target, block_bytes)
                else:
                    digests = [_write_at(uri, _hidden(target, name), start, size)]
                yield _manifest_rows(file, length, start, size, digests, block_bytes)

    return copy


def _patcher(landed: str, block_bytes: int):
    """Writes single blocks into files that are there already."""

    def patch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, file, length, _, start, size in zip(*[batch[c] for c in _names(_BLOCKS)]):
                digest = _write_at(uri, f"{_normal(landed)}/{file}", start, size)
                yield _manifest_rows(file, length, start, size, [digest], block_bytes)

    return patch


def _namer(landed: str, name: str, complete: bool):
    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, length in zip(batch["file"], batch["length"]):
                target = f"{_normal(landed)}/{file}"
                filesystem, hidden = _filesystem(_hidden(target, name))
                _, path = _filesystem(target)
                info = filesystem.get_file_info(hidden)
                if not complete:
                    if info.is_file:
                        filesystem.delete_file(hidden)
                elif info.is_file:
                    if info.size != length:
                        raise OSError(f"{target} came out with {info.size} bytes instead of {length}")
                    filesystem.move(hidden, path)
                elif filesystem.get_file_info(path).size != length:  # else an earlier attempt has named it
                    raise OSError(f"{target} is not there")
            yield batch[["file"]]

    return finish


def _manifest_rows(
    file: str, length: int, start: int, size: int, digests: list[str], block_bytes: int
) -> pd.DataFrame:
    starts = list(range(start, start + max(size, 1), block_bytes))
    return pd.DataFrame(
        {
            "file": file,
            "length": length,
            "start": starts,
            "size": [min(block_bytes, start + size - at) for at in starts],
            "md5": digests,
            "block_bytes": block_bytes,
        }
    )


def _hidden(target: str, name: str) -> str:
    """Where a file is written until it is complete."""
    folder, base = posixpath.split(target)
    return f"{folder}/.{base}.{name or uuid.uuid4().hex}"


def _write_at(source: str, target: str, start: int, size: int) -> str:
    """Copy a block to its place in ``target``, which other tasks may be writing to; its MD5."""
    import os

    reading, from_path = _filesystem(source)
    writing, to_path = _filesystem(target)
    writing.create_dir(posixpath.dirname(to_path), recursive=True)
    digest = hashlib.md5()
    out = os.open(to_path, os.O_CREAT | os.O_WRONLY, 0o644)
    try:
        with reading.open_input_file(from_path) as stream:
            stream.seek(start)
            at, end = start, start + size
            while at < end:
                piece = memoryview(stream.read(min(_READ_BYTES, end - at)))
                if not piece:
                    raise OSError(f"{source} is shorter than listed")
                digest.update(piece)
                while piece:
                    written = os.pwrite(out, piece, at)
                    at, piece = at + written, piece[written:]
    finally:
        os.close(out)
    return digest.hexdigest()


def _copy_file(source: str, target: str, block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Copy a whole file; the MD5 of each of its blocks."""
    reading, from_path = _filesystem(source)
    hidden = _hidden(target, "")
    writing, part = _filesystem(hidden)
    _, to_path = _filesystem(target)
    writing.create_dir(posixpath.dirname(to_path), recursive=True)
    digests, digest, held = [], hashlib.md5(), 0
    try:
        with reading.open_input_file(from_path) as stream, writing.open_output_stream(part) as out:
            while piece := stream.read(min(_READ_BYTES, block_bytes - held)):
                out.write(piece)
                digest.update(piece)
                held += len(piece)
                if held == block_bytes:
                    digests.append(digest.hexdigest())
                    digest, held = hashlib.md5(), 0
        writing.move(part, to_path)
    except BaseException:
        if writing.get_file_info(part).is_file:
            writing.delete_file(part)
        raise
    return digests + [digest.hexdigest()] if held or not digests else digests
