"""Directory listings through the session's Hadoop file system (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def matching_dirs(spark: SparkSession, pattern: str) -> list[str]:
    """Directories that match a glob, sorted. One listing call, no data is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(status.getPath().toString() for status in found if status.isDirectory())


def matching_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files that match a glob, sorted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(status.getPath().toString() for status in found if status.isFile())


def remove_dir(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def move_dir(spark: SparkSession, source: str, target: str) -> None:
    """Put a directory in the place of another, or where none is."""
    path, place = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (source, target))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(place, True)
    files.mkdirs(place.getParent())
    if not files.rename(path, place):
        raise OSError(f"cannot move {source} to {target}")
