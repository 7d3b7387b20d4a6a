"""Landed provider payloads: JSON or Parquet dumps under ``<landing>/<source>/<table>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schema
from ..fixed_values import AWS, DATABRICKS, SNOWFLAKE
from .files import matching_dirs

# schema of the payload rows of each raw table; "clusters" is a lookup for job runs
PAYLOAD_SCHEMAS: dict[tuple[str, str], T.StructType] = {
    (AWS, "cost_and_usage"): schema.COST_AND_USAGE_PAYLOAD,
    (AWS, "cost_forecast"): schema.COST_FORECAST_PAYLOAD,
    (AWS, "service_dimension_values"): schema.DIMENSION_PAYLOAD,
    (SNOWFLAKE, "query_history"): schema.QUERY_HISTORY_ROW,
    (SNOWFLAKE, "warehouse_metering_history"): schema.METERING_ROW,
    (DATABRICKS, "job_runs"): schema.JOB_RUN_PAYLOAD,
    (DATABRICKS, "clusters"): schema.CLUSTER_ROW,
    (DATABRICKS, "cluster_events"): schema.CLUSTER_EVENTS_PAYLOAD,
}


def payload_path(landing_dir: str, source: str, table: str) -> str:
    return f"{landing_dir.rstrip('/')}/{source}/{table}"


def read_payloads(
    spark: SparkSession, landing_dir: str, source: str, table: str, file_format: str = "json"
) -> DataFrame:
    """Payload rows of one table; no rows when nothing was landed. No schema inference."""
    kind = PAYLOAD_SCHEMAS[source, table]
    path = payload_path(landing_dir, source, table)
    if not matching_dirs(spark, path):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).format(file_format).load(path)
