"""Folders as a whole: asking for, moving and removing them on whatever storage holds them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, where = _at(spark, path)
    return filesystem.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and all below it; nothing happens where there is none."""
    filesystem, where = _at(spark, path)
    filesystem.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another name, one that is free, on the same file system.

    One step of the file system, so others see the folder under the old name or
    under the new one; on stores that only imitate folders it is many steps.
    """
    filesystem, where = _at(spark, source)
    _, to = _at(spark, target)
    filesystem.mkdirs(to.getParent())
    if filesystem.exists(to) or not filesystem.rename(where, to):
        raise OSError(f"could not move {source} to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none where there is no folder."""
    filesystem, where = _at(spark, path)
    if not filesystem.exists(where):
        return []
    return sorted(status.getPath().getName() for status in filesystem.listStatus(where))


def put_in_place(spark: SparkSession, staged: str, target: str) -> None:
    """Replace the folder ``target`` by ``staged``, written beside it.

    The old one steps aside first and goes last, so what a crash leaves is either
    the old folder or the new one, under its name or under ``target`` with ``.old``.
    """
    old = f"{target.rstrip('/')}.old"
    if exists(spark, target):
        remove(spark, old)
        move(spark, target, old)
    move(spark, staged, target)
    remove(spark, old)
