"""Schemas: usage records at rest, suggestion rows, and the landed provider payloads."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D = T.StringType(), T.DoubleType()


def _row(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# A usage record as stored: dates are ISO text, money and quantities are doubles,
# provider-specific details are JSON text. Every column may be null.
STORED_RECORD = _row(
    ("source", _S),
    ("resource_type", _S),
    ("resource_id", _S),
    ("account_identifier", _S),
    ("usage_date", _S),
    ("period_start", _S),
    ("period_end", _S),
    ("service", _S),
    ("cost_usd", _D),
    ("cost_basis", _S),
    ("usage_quantity", _D),
    ("usage_unit", _S),
    ("raw_metadata", _S),
    ("ingested_at", _S),
)
RECORD_COLUMNS = STORED_RECORD.fieldNames()
DATE_COLUMNS = ("usage_date",)
TIMESTAMP_COLUMNS = ("period_start", "period_end", "ingested_at")

SUGGESTION = T.StructType(
    [
        T.StructField("rule_id", _S, False),
        T.StructField("source", _S, False),
        T.StructField("attribution_key", _S, True),
        T.StructField("resource_ids_sample", _S, True),
        T.StructField("evidence", _S, False),
        T.StructField("suggestion", _S, False),
        T.StructField("estimated_impact", _S, False),
        T.StructField("quantified", _S, False),
    ]
)

# --- landed payloads (one JSON/Parquet row per API response or result row) ---------
_AMOUNT = _row(("Amount", _S), ("Unit", _S))
_PERIOD = _row(("Start", _S), ("End", _S))
_METRICS = _row(("UnblendedCost", _AMOUNT), ("UsageQuantity", _AMOUNT))

COST_AND_USAGE_PAYLOAD = _row(
    (
        "ResultsByTime",
        T.ArrayType(
            _row(
                ("TimePeriod", _PERIOD),
                ("Groups", T.ArrayType(_row(("Keys", T.ArrayType(_S)), ("Metrics", _METRICS)))),
            )
        ),
    ),
)
COST_FORECAST_PAYLOAD = _row(
    ("Total", _AMOUNT),
    ("ForecastResultsByTime", T.ArrayType(_row(("TimePeriod", _PERIOD), ("MeanValue", _S)))),
)
DIMENSION_PAYLOAD = _row(
    ("DimensionValues", T.ArrayType(_row(("Value", _S), ("Attributes", T.MapType(_S, _S))))),
)
QUERY_HISTORY_ROW = _row(
    ("QUERY_ID", _S),
    ("QUERY_TEXT", _S),
    ("QUERY_TYPE", _S),
    ("DATABASE_NAME", _S),
    ("SCHEMA_NAME", _S),
    ("WAREHOUSE_NAME", _S),
    ("WAREHOUSE_SIZE", _S),
    ("EXECUTION_STATUS", _S),
    ("START_TIME", T.TimestampType()),
    ("END_TIME", T.TimestampType()),
    ("TOTAL_ELAPSED_TIME", _D),
    ("BYTES_SCANNED", _D),
    ("ROWS_PRODUCED", _D),
    ("CREDITS_USED_CLOUD_SERVICES", _D),
)
METERING_ROW = _row(
    ("WAREHOUSE_NAME", _S),
    ("START_TIME", T.TimestampType()),
    ("END_TIME", T.TimestampType()),
    ("CREDITS_USED", _D),
    ("CREDITS_USED_COMPUTE", _D),
    ("CREDITS_USED_CLOUD_SERVICES", _D),
)
_CLUSTER_SPEC = _row(("node_type_id", _S), ("num_workers", T.LongType()))
JOB_RUN_PAYLOAD = _row(
    ("run_id", T.LongType()),
    ("job_id", T.LongType()),
    ("run_name", _S),
    ("run_page_url", _S),
    ("start_time", T.LongType()),
    ("run_duration", T.LongType()),
    ("state", _row(("life_cycle_state", _S), ("result_state", _S), ("state_message", _S))),
    ("cluster_spec", _row(("new_cluster", _CLUSTER_SPEC))),
    ("tasks", T.ArrayType(_row(("new_cluster", _CLUSTER_SPEC)))),
    ("cluster_instance", _row(("cluster_id", _S))),
)
CLUSTER_ROW = _row(("cluster_id", _S), ("node_type_id", _S), ("num_workers", T.LongType()))
CLUSTER_EVENTS_PAYLOAD = _row(
    ("cluster_id", _S),
    (
        "events",
        T.ArrayType(_row(("timestamp", T.LongType()), ("type", _S), ("details", T.MapType(_S, _S)))),
    ),
)
