"""Cut lineage by writing a table to the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# shuffle files of a query go when it ends
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}  # application id -> temporary folder, local sessions only


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, as in tests, may go without it and gets a temporary folder:
    on a cluster a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can read")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tallyspark-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage", compression: str = "snappy") -> DataFrame:
    """Write ``df`` once as Parquet and return a frame that reads it.

    Use it where a result is read several times. Unlike a cache it survives lost
    executors, and later readers still get column pruning and filter pushdown. The shuffle files
    of the write go when it ends, since nobody reads them again; else they would stay on the
    executors' disks until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("errorifexists").option("compression", compression).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
