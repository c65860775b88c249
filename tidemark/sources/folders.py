"""Folders of a file system as Hadoop sees them (HDFS, object stores, local)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    modified_ms: int


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly in a folder; nothing where there is no such folder."""
    files, target = _open(spark, path)
    if not files.exists(target):
        return []
    return [Entry(s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(target)]


def written_at(spark: SparkSession, path: str) -> int | None:
    """When a Spark write to the folder was finished, in milliseconds; None if it was not."""
    return next((e.modified_ms for e in entries(spark, path) if e.name == "_SUCCESS"), None)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _open(spark, path)
    files.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another place in the same file system; the folders above it are made."""
    files, at = _open(spark, source)
    _, to = _open(spark, target)
    files.mkdirs(to.getParent())
    if not files.rename(at, to):
        raise OSError(f"cannot move {source} to {target}")
