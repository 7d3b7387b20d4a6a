"""The append-only raw store: ``<source>/<table>/ingested_date=YYYY-MM-DD/*.parquet``."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import COUNTED_TABLES
from ..functions.calendar import iso_moment
from ..schema import DATE_COLUMNS, RECORD_COLUMNS, STORED_RECORD, TIMESTAMP_COLUMNS
from .files import matching_dirs

# a day's rows are dealt in so many parts, since a batch may have one day only
DAY_SLICES = 64

_WITH_PARTITION = T.StructType([*STORED_RECORD.fields, T.StructField("ingested_date", T.DateType(), True)])


def _table_dirs(
    spark: SparkSession,
    raw_dir: str,
    tables: Iterable[tuple[str, str]] | None,
    sources: Iterable[str] | None,
) -> list[str]:
    root = raw_dir.rstrip("/")
    if tables is not None:
        patterns = [f"{root}/{s}/{t}" for s, t in tables]
    else:
        patterns = [f"{root}/{s}/*" for s in (["*"] if sources is None else sources)]
    return [d for p in patterns for d in matching_dirs(spark, p)]


def _table_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of one ``<source>/<table>`` directory, with its source as a literal."""
    source = path.rstrip("/").split("/")[-2]
    return spark.read.schema(_WITH_PARTITION).parquet(path).withColumn("source", F.lit(source))


def read_raw_store(
    spark: SparkSession,
    raw_dir: str,
    *,
    tables: Iterable[tuple[str, str]] | None = None,
    sources: Iterable[str] | None = None,
    since: date | None = None,
    until: date | None = None,
    ingested_since: date | None = None,
    keep_ingested_date: bool = False,
) -> DataFrame:
    """All records of the store as one frame, with dates and timestamps parsed.

    ``source`` is a literal of each directory, as :func:`write_records` ensures, so a filter on
    it is settled while the query is planned: directories of other sources are not in the plan.
    A filter on ``resource_type`` reaches the Parquet statistics.

    Files are read under one fixed schema, since independent writers give an all-null
    column different physical types; Spark widens those while it reads. Text that is no
    date becomes null.

    ``tables`` (pairs of source and table), ``sources`` and ``ingested_since`` choose
    directories, so the files of the rest are not even opened. ``since``/``until`` bound ``usage_date``, both included;
    the store keeps dates as text, where Parquet statistics can skip row groups, so the text is
    bounded too: from below by ``since`` in ISO form, from above by the end of the year of
    ``until``. No date is lost whose month or day has one digit.
    """
    dirs = _table_dirs(spark, raw_dir, tables, sources)
    if not dirs:
        raise FileNotFoundError(f"no <source>/<table> directory under {raw_dir}")
    rows = reduce(DataFrame.unionByName, [_table_rows(spark, d) for d in dirs])
    if ingested_since is not None:
        rows = rows.filter(F.col("ingested_date") >= F.lit(ingested_since))
    if since is not None:
        rows = rows.filter(F.col("usage_date") >= since.isoformat())
    if until is not None:
        rows = rows.filter(F.col("usage_date") < f"{until.year + 1:04d}")
    rows = rows.withColumns(
        {c: F.try_to_date(c) for c in DATE_COLUMNS} | {c: F.try_to_timestamp(F.col(c)) for c in TIMESTAMP_COLUMNS}
    )
    if since is not None:
        rows = rows.filter(F.col("usage_date") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("usage_date") <= F.lit(until))
    return rows if keep_ingested_date else rows.drop("ingested_date")


def _stored(column: str, kind: T.DataType) -> Column:
    """A record column in its stored form."""
    value = F.col(column)
    if column == "raw_metadata" and not isinstance(kind, T.StringType):
        return F.to_json(value)
    if isinstance(kind, T.TimestampType):
        return iso_moment(value)
    return value.cast(STORED_RECORD[column].dataType)


def to_stored(records: DataFrame) -> DataFrame:
    """Records in stored form: the fixed columns, ISO text, JSON text. Unknown columns are an error."""
    unknown = set(records.columns) - set(RECORD_COLUMNS)
    if unknown:
        raise ValueError(f"not usage record columns: {sorted(unknown)}")
    kinds = {f.name: f.dataType for f in records.schema.fields}
    return records.select(
        *[
            (_stored(c, kinds[c]) if c in kinds else F.lit(None).cast(STORED_RECORD[c].dataType)).alias(c)
            for c in RECORD_COLUMNS
        ]
    )


def write_records(
    records: DataFrame,
    *,
    source: str,
    table: str,
    output_dir: str,
    ingested_date: date | None = None,
) -> str | None:
    """Append a batch to its partition; the written directory, or None for an empty batch.

    A record of another source than its directory fails the write, so that readers may
    choose sources by directory. Files are sorted by ``usage_date``, so that row groups
    cover few days; before that rows are dealt into partitions of bounded size, so that no task
    sorts more than such a one, however much of a batch it has read.
    """
    day = ingested_date or date.today()
    counted = Observation()
    own = F.when(F.col("source") == source, F.col("source")).otherwise(
        F.raise_error(F.concat(F.lit(f"a record in {source}/{table} has the source "), F.coalesce("source", F.lit("null"))))
    )
    target = f"{output_dir.rstrip('/')}/{source}/{table}"
    (
        to_stored(records)
        .withColumn("source", own)
        .withColumn("ingested_date", F.lit(day))
        .withColumn("__slice", F.pmod(F.xxhash64("resource_id"), F.lit(DAY_SLICES)))
        .hint("rebalance", "usage_date", "__slice")
        .drop("__slice")
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .sortWithinPartitions("ingested_date", "usage_date")
        .write.mode("append")
        .partitionBy("ingested_date")
        .parquet(target)
    )
    return f"{target}/ingested_date={day.isoformat()}" if counted.get["rows"] else None


def table_counts(records: DataFrame) -> DataFrame:
    """Records per counted raw table, zero included. Reads two columns of the store."""
    wanted = records.sparkSession.createDataFrame(COUNTED_TABLES, "source string, table string, resource_type string")
    counted = records.groupBy("source", "resource_type").agg(F.count(F.lit(1)).alias("n"))
    # one row per (source, resource_type) on either side
    return wanted.join(counted, ["source", "resource_type"], "left").select(
        "source", "table", F.coalesce("n", F.lit(0)).alias("record_count")
    )


def source_counts(records: DataFrame) -> DataFrame:
    """Records per source."""
    return records.groupBy("source").agg(F.count(F.lit(1)).alias("record_count"))
