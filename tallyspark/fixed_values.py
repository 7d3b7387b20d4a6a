"""Fixed values.

Everything in this file is data that has to be exactly as it is for results to be
right: names, word lists, rates, thresholds and formats. Operators take these as
defaults of keyword parameters, so a deployment can pass its own.
"""

from __future__ import annotations

from decimal import Decimal

# --- sources, tables and resource types of the raw store -------------------------
AWS = "aws"
SNOWFLAKE = "snowflake"
DATABRICKS = "databricks"
SOURCES = (AWS, SNOWFLAKE, DATABRICKS)
SOURCE_LABELS = {AWS: "AWS", SNOWFLAKE: "Snowflake", DATABRICKS: "Databricks"}

# (source, table directory, resource_type of its rows)
RAW_TABLES = (
    (AWS, "cost_and_usage", "cost_explorer_daily_service"),
    (AWS, "cost_forecast", "cost_forecast"),
    (AWS, "service_dimension_values", "service_dimension_value"),
    (SNOWFLAKE, "query_history", "query"),
    (SNOWFLAKE, "warehouse_metering_history", "warehouse_metering_hour"),
    (DATABRICKS, "job_runs", "job_run"),
    (DATABRICKS, "cluster_events", "cluster_event"),
)
# tables whose rows are counted for the store overview (cluster events are not)
COUNTED_TABLES = tuple(t for t in RAW_TABLES if t[1] != "cluster_events")
# table that stands for its source in per-source counts
HEADLINE_TABLES = {AWS: "cost_and_usage", SNOWFLAKE: "query_history", DATABRICKS: "job_runs"}
# tables listed in the provenance report
PROVENANCE_TABLES = (
    (AWS, "cost_and_usage", "daily billed cost and usage per service"),
    (AWS, "cost_forecast", "the provider's own month-end forecast"),
    (SNOWFLAKE, "query_history", "one row per executed query"),
    (SNOWFLAKE, "warehouse_metering_history", "credits used per warehouse and hour"),
    (DATABRICKS, "job_runs", "one row per job run"),
)

# --- cost bases --------------------------------------------------------------------
BILLED = "billed"
FORECAST = "forecast"
ESTIMATED = "estimated_list_price"
ACTUAL_COST_BASES = (BILLED, ESTIMATED)

# --- metadata keys lifted into columns ----------------------------------------------
METADATA_TEXT_KEYS = (
    "query_type",
    "execution_status",
    "query_text_preview",
    "node_type_id",
    "cluster_source",
    "life_cycle_state",
    "result_state",
)
METADATA_NUMBER_KEYS = ("bytes_scanned",)

# --- text limits ----------------------------------------------------------------------
QUERY_PREVIEW_CHARS = 500
EVIDENCE_PREVIEW_CHARS = 160
OPTION_LABEL_CHARS = 60
HEADLINE_ID_CHARS = 18
CHART_LABEL_CHARS = 22
UNKNOWN_SERVICE = "UNKNOWN"

# --- query-text patterns ----------------------------------------------------------------
# statements that a web console issues by itself; case-sensitive prefixes
CONSOLE_PREFIXES = (
    "SELECT CURRENT_USER",
    "SELECT is_database_role_in_session",
    "SELECT SYSTEM$",
    "CALL SYSTEM$",
    "USE SECONDARY ROLES",
    "SHOW ",
    "DESCRIBE ",
    "PUT ",
    "GET ",
    "LIST ",
    "REMOVE ",
)
SAMPLE_CATALOG = "SNOWFLAKE_SAMPLE_DATA"

# --- thresholds ------------------------------------------------------------------------------
Z_THRESHOLD = 3.0
MIN_BASELINE_ROWS = 5
ZERO_SPREAD = 1e-12
MIN_REPEATS = 3
MIN_FLAT_DAYS = 7
MIN_TREND_DAYS = 2
HIGH_CONFIDENCE_DAYS = 7
MEDIUM_CONFIDENCE_DAYS = 3
SAMPLE_IDS = 3
TOP_ATTRIBUTION = 8
TOP_ANOMALIES = 12
OPTION_LIMIT = 200
SOURCE_LOOKBACK_DAYS = 7
SOURCE_ROW_LIMIT = 1000

# --- list prices (USD per hour) --------------------------------------------------------------
INSTANCE_HOURLY_USD = {
    "i3.xlarge": Decimal("0.312"),
    "i3.2xlarge": Decimal("0.624"),
    "m5.large": Decimal("0.096"),
    "m5.xlarge": Decimal("0.192"),
    "m5.2xlarge": Decimal("0.384"),
    "m4.large": Decimal("0.10"),
    "r5.xlarge": Decimal("0.252"),
    "c5.xlarge": Decimal("0.17"),
    "Standard_DS3_v2": Decimal("0.229"),
    "Standard_DS4_v2": Decimal("0.458"),
}
FALLBACK_HOURLY_USD = Decimal("0.20")
DBU_HOURLY_USD = Decimal("0.15")
