"""Output tables: ``<name>/run_date=YYYY-MM-DD/*.parquet``, one partition per run.

A run is published as a whole: its tables are written beside the store, the record of an earlier
run of that date is withdrawn, the tables move to their places, and a new record is written
last, in ``commits/run_date=YYYY-MM-DD``. Readers take the newest run that has a record, so a run
that failed, at any point, is not seen. A store without records is read by its partitions.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import matching_dirs, matching_files, move_dir, remove_dir

log = logging.getLogger(__name__)

# where the records of published runs are
COMMITS = "commits"

# tables that are stored in the order of their keys
SORT_KEYS = {
    "spend_by_source_date": ("source", "usage_date"),
    "spend_by_attribution": ("source", "attribution_kind", "attribution_key", "usage_date"),
}


def partition_path(output_dir: str, name: str, run_date: date) -> str:
    return f"{output_dir.rstrip('/')}/{name}/run_date={run_date.isoformat()}"


def write_output(
    df: DataFrame,
    output_dir: str,
    name: str,
    run_date: date,
    sort_keys: Sequence[str] | None = None,
) -> int:
    """Replace one partition of one table; the number of rows, counted while writing.

    The partition directory is overwritten as such, so a run with no rows replaces an
    earlier one too. Files are as many as the plan has partitions (adaptive execution
    merges small ones); nothing is forced through one task.
    """
    counted = Observation()
    keys = SORT_KEYS.get(name, ()) if sort_keys is None else sort_keys
    rows = df.orderBy(*keys) if keys else df
    path = partition_path(output_dir, name, run_date)
    rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    log.info("wrote %s (%d rows)", path, counted.get["rows"])
    return counted.get["rows"]


class Run:
    """The tables of one run, written apart until ``publish`` puts all of them in place."""

    def __init__(self, spark: SparkSession, output_dir: str, run_date: date):
        self.spark, self.output_dir, self.run_date = spark, output_dir.rstrip("/"), run_date
        self.staging = f"{self.output_dir}/staging/{uuid.uuid4().hex}"
        self.rows: dict[str, int] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write one table; what was written, read back."""
        self.rows[name] = write_output(df, self.staging, name, self.run_date)
        return self.spark.read.schema(df.schema).parquet(partition_path(self.staging, name, self.run_date))

    def publish(self) -> dict[str, int]:
        """Make this the store's run of its date; row counts by table."""
        record = partition_path(self.output_dir, COMMITS, self.run_date)
        remove_dir(self.spark, record)
        for name in self.rows:
            move_dir(self.spark, *(partition_path(d, name, self.run_date) for d in (self.staging, self.output_dir)))
        tables = self.spark.createDataFrame(list(self.rows.items()), "output_table string, record_count long")
        tables.coalesce(1).write.mode("overwrite").parquet(record)
        remove_dir(self.spark, self.staging)
        return self.rows


def run_dates(spark: SparkSession, output_dir: str, name: str) -> list[str]:
    """Partitions of a table, oldest first, from a directory listing."""
    dirs = matching_dirs(spark, f"{output_dir.rstrip('/')}/{name}/run_date=*")
    return [d.rsplit("run_date=", 1)[1] for d in dirs]


def published_dates(spark: SparkSession, output_dir: str) -> list[str]:
    """Dates of the runs that were published as a whole, oldest first."""
    marks = matching_files(spark, f"{output_dir.rstrip('/')}/{COMMITS}/run_date=*/_SUCCESS")
    return [m.rsplit("run_date=", 1)[1].split("/")[0] for m in marks]


def published_tables(spark: SparkSession, output_dir: str, run_date: str) -> DataFrame:
    """(output_table, record_count) of a published run."""
    schema = "output_table string, record_count long"
    return spark.read.schema(schema).parquet(f"{output_dir.rstrip('/')}/{COMMITS}/run_date={run_date}")


def store_run_date(spark: SparkSession, output_dir: str, name: str = "spend_by_source_date") -> str | None:
    """The newest run: of the store if it has records of runs, else of one table. None when there is none."""
    found = published_dates(spark, output_dir)
    if not found and not matching_dirs(spark, f"{output_dir.rstrip('/')}/{COMMITS}"):
        found = run_dates(spark, output_dir, name)
    return found[-1] if found else None


def read_latest(
    spark: SparkSession, output_dir: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """A table of the newest run; one that the run has not is an empty frame."""
    newest = store_run_date(spark, output_dir, name)
    if newest is None or not _has_table(spark, output_dir, newest, name):
        return spark.createDataFrame([], schema or T.StructType([]))
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{output_dir.rstrip('/')}/{name}/run_date={newest}")


def _has_table(spark: SparkSession, output_dir: str, run_date: str, name: str) -> bool:
    if run_date not in published_dates(spark, output_dir):
        return True  # told by the table's own partitions
    return not published_tables(spark, output_dir, run_date).filter(F.col("output_table") == name).isEmpty()


def read_all(spark: SparkSession, output_dir: str, name: str) -> DataFrame:
    """Every partition of a table, with ``run_date`` as a partition column."""
    return spark.read.parquet(f"{output_dir.rstrip('/')}/{name}")


def write_outputs(outputs: Mapping[str, DataFrame], output_dir: str, run_date: date) -> dict[str, int]:
    """Write every table and publish them as one run; row counts by name."""
    if not outputs:
        return {}
    run = Run(next(iter(outputs.values())).sparkSession, output_dir, run_date)
    for name, df in outputs.items():
        run.write(name, df)
    return run.publish()
