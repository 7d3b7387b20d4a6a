"""Landed provider payloads to usage records.

All functions are narrow (projections and explodes) apart from the cluster lookup, so
they run in one pass over payloads of any volume. ``now`` stands for the time of
collection and is passed in, so that runs can be repeated. Days are UTC days under any
session time zone.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    AWS,
    BILLED,
    DATABRICKS,
    FORECAST,
    INSTANCE_HOURLY_USD,
    QUERY_PREVIEW_CHARS,
    SNOWFLAKE,
    SOURCE_LOOKBACK_DAYS,
    UNKNOWN_SERVICE,
)
from ..functions.calendar import as_day, iso_moment, moment_of_epoch_ms, month_start, utc_day, utc_midnight
from ..schema import RECORD_COLUMNS, STORED_RECORD
from .groups import lookup_join
from .pricing import estimate_cost, hours_of_ms

# in frames, dates and timestamps have their own types
_FRAME_TYPES = {f.name: f.dataType.simpleString() for f in STORED_RECORD} | {
    "usage_date": "date",
    "period_start": "timestamp",
    "period_end": "timestamp",
    "ingested_at": "timestamp",
}


def _records(df: DataFrame, now: datetime, *, source: str, resource_type: str, **columns: Column) -> DataFrame:
    """The canonical columns in order; those not given are null."""
    given = {"source": F.lit(source), "resource_type": F.lit(resource_type), "ingested_at": F.lit(now), **columns}
    return df.select(
        *[given.get(c, F.lit(None)).cast(_FRAME_TYPES[c]).alias(c) for c in RECORD_COLUMNS]
    )


def _json(**fields: Column) -> Column:
    """JSON object that keeps keys whose value is null."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})


def _joined_id(*parts: Column) -> Column:
    return F.concat_ws("::", *parts)


# --- billing API --------------------------------------------------------------------------


def normalize_cost_and_usage(payloads: DataFrame, now: datetime) -> DataFrame:
    """One record per day and service of ``ResultsByTime[].Groups[]``."""
    groups = payloads.select(F.explode("ResultsByTime").alias("result")).select(
        F.col("result.TimePeriod").alias("period"), F.explode("result.Groups").alias("group")
    )
    day = F.try_to_date("period.Start")
    service = F.coalesce(F.get("group.Keys", F.lit(0)), F.lit(UNKNOWN_SERVICE))
    cost, usage = F.col("group.Metrics.UnblendedCost"), F.col("group.Metrics.UsageQuantity")
    return _records(
        groups,
        now,
        source=AWS,
        resource_type="cost_explorer_daily_service",
        resource_id=_joined_id(day.cast("string"), service),
        usage_date=day,
        service=service,
        cost_usd=cost["Amount"].try_cast("double"),
        cost_basis=F.lit(BILLED),
        usage_quantity=usage["Amount"].try_cast("double"),
        usage_unit=usage["Unit"],
        raw_metadata=_json(time_period=F.col("period"), metrics=F.col("group.Metrics")),
    )


def forecast_window(today: date | Column) -> tuple[Column, Column]:
    """Tomorrow up to the first of next month, or of the month after if tomorrow is that day."""
    day = as_day(today)
    tomorrow = F.date_add(day, 1)
    next_month = F.add_months(month_start(day), 1)
    return tomorrow, F.when(tomorrow >= next_month, F.add_months(next_month, 1)).otherwise(next_month)


def normalize_cost_forecast(payloads: DataFrame, now: datetime, today: date | Column) -> DataFrame:
    """One record per forecast, dated tomorrow."""
    start, end = forecast_window(today)
    return _records(
        payloads,
        now,
        source=AWS,
        resource_type="cost_forecast",
        resource_id=_joined_id(start.cast("string"), end.cast("string")),
        usage_date=start,
        period_start=utc_midnight(start),
        period_end=utc_midnight(end),
        cost_usd=F.col("Total.Amount").try_cast("double"),
        cost_basis=F.lit(FORECAST),
        usage_unit=F.col("Total.Unit"),
        raw_metadata=_json(forecast_results_by_time=F.col("ForecastResultsByTime")),
    )


def normalize_dimension_values(payloads: DataFrame, now: datetime, start: date, end: date) -> DataFrame:
    """One record per service that was active in the window."""
    entries = payloads.select(F.explode("DimensionValues").alias("entry"))
    service = F.coalesce("entry.Value", F.lit(UNKNOWN_SERVICE))
    return _records(
        entries,
        now,
        source=AWS,
        resource_type="service_dimension_value",
        resource_id=_joined_id(F.lit(start.isoformat()), F.lit(end.isoformat()), service),
        usage_date=F.lit(start),
        service=service,
        raw_metadata=_json(attributes=F.col("entry.Attributes")),
    )


# --- warehouse history ----------------------------------------------------------------------


def recent_rows(
    rows: DataFrame,
    now: datetime,
    *,
    time_col: str = "START_TIME",
    lookback_days: int = SOURCE_LOOKBACK_DAYS,
    row_limit: int | None = None,
    tie_break: str | None = None,
) -> DataFrame:
    """Rows of the last days; with ``row_limit``, the newest so many of them, newest first."""
    window = rows.filter(F.col(time_col) >= F.lit(now) - F.expr(f"INTERVAL {int(lookback_days)} DAYS"))
    if row_limit is None:
        return window
    order = [F.col(time_col).desc()] + ([F.col(tie_break)] if tie_break else [])
    return window.orderBy(*order).limit(row_limit)


def normalize_query_history(rows: DataFrame, now: datetime) -> DataFrame:
    """One record per query; its warehouse is both account and service."""
    started = F.col("START_TIME").cast("timestamp")

    def number(name: str) -> Column:
        return F.col(name).cast("double")

    return _records(
        rows,
        now,
        source=SNOWFLAKE,
        resource_type="query",
        resource_id=F.col("QUERY_ID"),
        account_identifier=F.col("WAREHOUSE_NAME"),
        usage_date=utc_day(F.coalesce(started, F.lit(now))),
        period_start=started,
        period_end=F.col("END_TIME"),
        service=F.col("WAREHOUSE_NAME"),
        usage_quantity=F.col("TOTAL_ELAPSED_TIME"),
        usage_unit=F.lit("milliseconds"),
        raw_metadata=_json(
            query_type=F.col("QUERY_TYPE"),
            execution_status=F.col("EXECUTION_STATUS"),
            database_name=F.col("DATABASE_NAME"),
            schema_name=F.col("SCHEMA_NAME"),
            warehouse_size=F.col("WAREHOUSE_SIZE"),
            bytes_scanned=number("BYTES_SCANNED"),
            rows_produced=number("ROWS_PRODUCED"),
            credits_used_cloud_services=number("CREDITS_USED_CLOUD_SERVICES"),
            query_text_preview=F.substring(F.coalesce("QUERY_TEXT", F.lit("")), 1, QUERY_PREVIEW_CHARS),
            # only where the preview is not all of it
            query_text=F.when(F.length("QUERY_TEXT") > QUERY_PREVIEW_CHARS, F.col("QUERY_TEXT")),
        ),
    )


def normalize_warehouse_metering(rows: DataFrame, now: datetime) -> DataFrame:
    """One record per warehouse and hour of credit use."""
    started = F.col("START_TIME").cast("timestamp")
    return _records(
        rows,
        now,
        source=SNOWFLAKE,
        resource_type="warehouse_metering_hour",
        resource_id=_joined_id(F.coalesce("WAREHOUSE_NAME", F.lit("None")), F.coalesce(iso_moment(started), F.lit("unknown"))),
        account_identifier=F.col("WAREHOUSE_NAME"),
        usage_date=utc_day(F.coalesce(started, F.lit(now))),
        period_start=started,
        period_end=F.col("END_TIME"),
        service=F.col("WAREHOUSE_NAME"),
        usage_quantity=F.col("CREDITS_USED"),
        usage_unit=F.lit("credits"),
        raw_metadata=_json(
            credits_used_compute=F.col("CREDITS_USED_COMPUTE").cast("double"),
            credits_used_cloud_services=F.col("CREDITS_USED_CLOUD_SERVICES").cast("double"),
        ),
    )


# --- job runs -----------------------------------------------------------------------------------


def resolve_clusters(runs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Adds node_type_id, num_workers, cluster_source and cluster_id to job runs.

    First match: the run's own new cluster, the first task that has one, the existing
    cluster it names (looked up in ``clusters``), none.
    """
    own = F.col("cluster_spec.new_cluster")
    task = F.get(F.filter("tasks", lambda t: t["new_cluster"].isNotNull()), F.lit(0))["new_cluster"]
    found = F.coalesce(own, task)
    named = F.when(found.isNull(), F.nullif("cluster_instance.cluster_id", F.lit("")))
    prepared = runs.withColumns({"__own": own, "__found": found, "cluster_id": named})
    known = clusters.groupBy("cluster_id").agg(F.max(F.struct("node_type_id", "num_workers")).alias("__looked_up"))
    joined = lookup_join(prepared, known, "cluster_id")
    spec = F.when(F.col("__found").isNotNull(), F.col("__found")).otherwise(F.col("__looked_up"))
    return (
        joined.withColumn("__spec", spec)
        .withColumns(
            {
                "node_type_id": F.col("__spec.node_type_id"),
                "num_workers": F.col("__spec.num_workers"),
                "cluster_source": F.when(F.col("__own").isNotNull(), "job_new_cluster")
                .when(F.col("__found").isNotNull(), "task_new_cluster")
                .when(F.col("__looked_up").isNotNull(), "existing_cluster_lookup")
                .when(F.col("cluster_id").isNotNull(), "cluster_lookup_failed")
                .otherwise("no_cluster_info_available"),
            }
        )
        .drop("__own", "__found", "__looked_up", "__spec")
    )


def normalize_job_runs(
    runs: DataFrame, clusters: DataFrame, now: datetime, *, prices: Mapping[str, Decimal] = INSTANCE_HOURLY_USD
) -> DataFrame:
    """One record per job run, with a list-price estimate where the node type is known."""
    resolved = resolve_clusters(runs, clusters)
    run_ms = F.coalesce("run_duration", F.lit(0))
    started = F.coalesce(moment_of_epoch_ms(F.col("start_time")), F.lit(now))
    ended = F.when(run_ms != 0, F.timestamp_millis(F.unix_millis(started) + run_ms))
    cost, basis, note = estimate_cost(F.col("node_type_id"), F.col("num_workers"), run_ms, prices=prices)
    return _records(
        resolved,
        now,
        source=DATABRICKS,
        resource_type="job_run",
        resource_id=F.col("run_id"),
        account_identifier=F.coalesce(F.nullif("job_id", F.lit(0)).cast("string"), F.lit("")),
        usage_date=utc_day(started),
        period_start=started,
        period_end=ended,
        service=F.col("run_name"),
        cost_usd=cost,
        cost_basis=basis,
        usage_quantity=hours_of_ms(run_ms),
        usage_unit=F.lit("cluster_hours"),
        raw_metadata=_json(
            job_id=F.col("job_id"),
            life_cycle_state=F.col("state.life_cycle_state"),
            result_state=F.col("state.result_state"),
            state_message=F.col("state.state_message"),
            node_type_id=F.col("node_type_id"),
            num_workers=F.col("num_workers"),
            cluster_source=F.col("cluster_source"),
            cluster_id=F.col("cluster_id"),
            pricing_note=note,
            run_page_url=F.col("run_page_url"),
        ),
    )


def distinct_cluster_ids(job_runs: DataFrame) -> DataFrame:
    """Ids of existing clusters that job-run records name, sorted."""
    cluster = F.get_json_object("raw_metadata", "$.cluster_id")
    return job_runs.select(cluster.alias("cluster_id")).filter("cluster_id <> ''").distinct().orderBy("cluster_id")


def normalize_cluster_events(payloads: DataFrame, now: datetime) -> DataFrame:
    """One record per cluster lifecycle event."""
    events = payloads.select("cluster_id", F.explode("events").alias("event"))
    moment = F.coalesce(moment_of_epoch_ms(F.col("event.timestamp")), F.lit(now))
    return _records(
        events,
        now,
        source=DATABRICKS,
        resource_type="cluster_event",
        resource_id=_joined_id(F.col("cluster_id"), F.coalesce(F.col("event.timestamp").cast("string"), F.lit("None"))),
        account_identifier=F.col("cluster_id"),
        usage_date=utc_day(moment),
        period_start=moment,
        raw_metadata=_json(type=F.col("event.type"), details=F.coalesce(F.col("event.details"), F.create_map())),
    )
