"""The collection job: landed payloads of all providers to the raw store."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from ..fixed_values import AWS, DATABRICKS, SNOWFLAKE
from ..operators import normalize as n
from ..sources.payloads import PAYLOAD_SCHEMAS, read_payloads
from ..sources.raw_store import write_records

DIMENSION_LOOKBACK_DAYS = 14

TableKey = tuple[str, str]
Payloads = Mapping[TableKey, DataFrame]


def _dimension_values(payloads: Payloads, now: datetime) -> DataFrame:
    end = now.date()
    start = end - timedelta(days=DIMENSION_LOOKBACK_DAYS)
    return n.normalize_dimension_values(payloads[AWS, "service_dimension_values"], now, start, end)


# how the records of each raw table come out of the payloads
NORMALIZERS: dict[TableKey, Callable[[Payloads, datetime], DataFrame]] = {
    (AWS, "cost_and_usage"): lambda p, now: n.normalize_cost_and_usage(p[AWS, "cost_and_usage"], now),
    (AWS, "cost_forecast"): lambda p, now: n.normalize_cost_forecast(p[AWS, "cost_forecast"], now, now.date()),
    (AWS, "service_dimension_values"): _dimension_values,
    (SNOWFLAKE, "query_history"): lambda p, now: n.normalize_query_history(p[SNOWFLAKE, "query_history"], now),
    (SNOWFLAKE, "warehouse_metering_history"): lambda p, now: n.normalize_warehouse_metering(
        p[SNOWFLAKE, "warehouse_metering_history"], now
    ),
    (DATABRICKS, "job_runs"): lambda p, now: n.normalize_job_runs(
        p[DATABRICKS, "job_runs"], p[DATABRICKS, "clusters"], now
    ),
    (DATABRICKS, "cluster_events"): lambda p, now: n.normalize_cluster_events(p[DATABRICKS, "cluster_events"], now),
}


def normalize_all(payloads: Payloads, now: datetime) -> dict[TableKey, DataFrame]:
    """Usage records by (source, table)."""
    return {key: normalizer(payloads, now) for key, normalizer in NORMALIZERS.items()}


def collect(
    spark: SparkSession, landing_dir: str, raw_dir: str, now: datetime, file_format: str = "json"
) -> dict[TableKey, str | None]:
    """Normalize everything that was landed and append it; written directories by table."""
    payloads = {key: read_payloads(spark, landing_dir, *key, file_format) for key in PAYLOAD_SCHEMAS}
    return {
        (source, table): write_records(
            records, source=source, table=table, output_dir=raw_dir, ingested_date=now.date()
        )
        for (source, table), records in normalize_all(payloads, now).items()
    }
