"""tallyspark: cloud usage and cost analytics as plain PySpark DataFrame operators."""

from .functions.text import metadata_field
from .operators.anomalies import detect_anomalies
from .operators.enrich import enrich_events
from .operators.forecast import (
    daily_cost_actuals,
    month_end_forecast,
    native_unit_forecast,
    reconcile_with_aws_native_forecast,
)
from .operators.rollups import spend_by_attribution, spend_by_source_date
from .operators.rules import run_all_rules
from .plans.pipeline import build_outputs, run
from .sources.outputs import read_latest, write_outputs
from .sources.raw_store import read_raw_store, write_records

__all__ = [
    "build_outputs",
    "daily_cost_actuals",
    "detect_anomalies",
    "enrich_events",
    "metadata_field",
    "month_end_forecast",
    "native_unit_forecast",
    "read_latest",
    "read_raw_store",
    "reconcile_with_aws_native_forecast",
    "run",
    "run_all_rules",
    "spend_by_attribution",
    "spend_by_source_date",
    "write_outputs",
    "write_records",
]
