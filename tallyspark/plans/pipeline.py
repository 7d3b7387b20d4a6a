"""The batch job: raw store to output tables."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import AWS, SNOWFLAKE, SOURCES
from ..operators.anomalies import daily_cost_anomalies, query_duration_anomalies, snowflake_queries
from ..operators.enrich import enrich_events
from ..operators.forecast import (
    month_end_forecast,
    native_unit_forecast,
    reconcile_with_aws_native_forecast,
)
from ..operators.newest import newest_records
from ..operators.rollups import attribution_rollup, daily_totals, source_date_rollup
from ..operators.rules import run_all_rules
from ..sources.materialize import materialize
from ..sources.outputs import Run
from ..sources.raw_store import read_raw_store

log = logging.getLogger(__name__)

QUERY_ANOMALIES = "anomalies_snowflake_query_duration"
SUGGESTIONS = "optimization_suggestions"


def totals_as_events(totals: DataFrame) -> DataFrame:
    """Daily totals in the shape the forecasts read: sums stand for their records.

    ``has_cost`` is a key of the totals, so records with and without a cost stay apart.
    """
    return totals.select("source", "usage_date", "cost_basis", "cost_usd", "usage_unit", "usage_quantity")


def build_outputs(
    spark: SparkSession,
    events: DataFrame,
    as_of: date,
    *,
    by_source: Mapping[str, DataFrame] | None = None,
    rules_on_records: bool = True,
) -> dict[str, DataFrame]:
    """Every output table from enriched events.

    The events are read once for the daily totals, which go to the checkpoint folder;
    both rollups, the cost anomalies and the dollar and unit forecasts come from that
    small table. Query anomalies and rules read the records they are about, from
    ``by_source`` where it has the events of that source. A caller that runs the rules on
    a written table instead turns ``rules_on_records`` off.
    """
    parts = by_source or {}
    totals = materialize(daily_totals(events), "daily-totals")
    by_attribution = materialize(attribution_rollup(totals), "spend-by-attribution")
    sums = totals_as_events(totals)
    forecast_by_source = month_end_forecast(sums, as_of)
    outputs = {
        "spend_by_source_date": source_date_rollup(totals),
        "spend_by_attribution": by_attribution,
        QUERY_ANOMALIES: query_duration_anomalies(snowflake_queries(parts.get(SNOWFLAKE, events))),
        "anomalies_daily_cost_by_attribution": daily_cost_anomalies(by_attribution),
        "forecast_by_source": forecast_by_source,
        "forecast_combined": month_end_forecast(sums, as_of, group_cols=[]),
        "forecast_native_units": native_unit_forecast(sums, as_of),
    }
    aws_row = forecast_by_source.filter(F.col("source") == AWS)
    if not aws_row.isEmpty():  # reads the staged totals only
        outputs["forecast_aws_reconciled"] = reconcile_with_aws_native_forecast(aws_row, parts.get(AWS, events))
    if rules_on_records:
        outputs[SUGGESTIONS] = run_all_rules(spark, events, by_source=parts)
    return outputs


def stored_events(
    spark: SparkSession, raw_dir: str, *, sources: Iterable[str] | None = None, newest_only: bool = False
) -> DataFrame:
    """Enriched records of the store; with ``newest_only``, those of the newest collection."""
    records = read_raw_store(spark, raw_dir, sources=sources)
    return enrich_events(newest_records(records) if newest_only else records)


def events_by_source(spark: SparkSession, raw_dir: str, *, newest_only: bool = False) -> dict[str, DataFrame]:
    """Enriched events of each source that has a directory."""
    found = {}
    for source in SOURCES:
        try:
            found[source] = stored_events(spark, raw_dir, sources=[source], newest_only=newest_only)
        except FileNotFoundError:
            log.info("no records of %s", source)
    return found


def run(
    raw_dir: str,
    output_dir: str,
    as_of: date | None = None,
    spark: SparkSession | None = None,
    *,
    newest_only: bool = False,
) -> dict[str, int]:
    """Read, enrich, build and write; row counts of the written tables by name.

    Works in the given session, else in the one that is running or can be started.
    The query anomaly table is written first. It holds every query row with its metadata
    as columns, so the rules on query text read it back in place of the raw JSON. All tables
    are published together when the last is written. With ``newest_only``, a record that
    several collections have counts once, as the newest has it.
    """
    spark = spark or SparkSession.builder.getOrCreate()
    as_of = as_of or date.today()
    events = stored_events(spark, raw_dir, newest_only=newest_only)
    parts = events_by_source(spark, raw_dir, newest_only=newest_only)
    outputs = build_outputs(spark, events, as_of, by_source=parts, rules_on_records=False)
    run = Run(spark, output_dir, as_of)
    queries = run.write(QUERY_ANOMALIES, outputs.pop(QUERY_ANOMALIES))
    outputs[SUGGESTIONS] = run_all_rules(spark, events, queries=queries, by_source=parts)
    for name, df in outputs.items():
        run.write(name, df)
    return run.publish()


def main() -> None:
    """Command line: RAW_DIR OUTPUT_DIR [--as-of DAY] [--newest-only]."""
    parser = argparse.ArgumentParser(description="raw usage records to spend, anomaly, forecast and suggestion tables")
    parser.add_argument("raw_dir")
    parser.add_argument("output_dir")
    parser.add_argument("--as-of", type=date.fromisoformat, default=None)
    parser.add_argument("--newest-only", action="store_true", help="count a record that was collected again once")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("usage-cost-analytics").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        for name, rows in run(args.raw_dir, args.output_dir, args.as_of, spark, newest_only=args.newest_only).items():
            log.info("%s: %d rows", name, rows)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
