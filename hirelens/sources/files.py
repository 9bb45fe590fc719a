"""Folders in whatever store Spark reads: what they hold, and removing them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def signature(spark: SparkSession, *folders: str) -> tuple[tuple[str, int, int], ...]:
    """(path, length, time of change) of every file below the folders: cheap, and other when a file is rewritten."""
    found = []
    for folder in folders:
        store, path = _path(spark, folder)
        if store.exists(path):
            files = store.listFiles(path, True)
            while files.hasNext():
                f = files.next()
                found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder and all below it; a missing one is fine."""
    store, path = _path(spark, folder)
    store.delete(path, True)
