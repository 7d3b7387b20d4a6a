"""Queries behind dashboards: slices, totals, top lists, pivots, filter options."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    AWS,
    CHART_LABEL_CHARS,
    HEADLINE_ID_CHARS,
    HEADLINE_TABLES,
    OPTION_LABEL_CHARS,
    OPTION_LIMIT,
    PROVENANCE_TABLES,
    SNOWFLAKE,
    SOURCE_LABELS,
    SOURCES,
    TOP_ATTRIBUTION,
)
from ..functions.text import clip, finite, format_ms, format_z, title_words
from .anomalies import headline_anomaly, top_by_score
from .forecast import forecast_series

# --- arguments -----------------------------------------------------------------------------


def checked_source(source: str | None, known: Sequence[str] = SOURCES) -> str | None:
    if source is not None and source not in known:
        raise ValueError(f"unknown source {source!r}, expected one of {sorted(known)}")
    return source


def checked_day(value: date | str | None, name: str) -> date | None:
    if value is None or isinstance(value, date):
        return value
    try:
        return date.fromisoformat(value)
    except ValueError as error:
        raise ValueError(f"{name} must be an ISO date (YYYY-MM-DD)") from error


def spend_slice(
    spend: DataFrame,
    *,
    source: str | None = None,
    attribution_kind: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Part of a spend table. Both dates are included. An unknown kind gives no rows, an
    unknown source or a start after the end is an error."""
    first, last = checked_day(start, "start"), checked_day(end, "end")
    if first and last and first > last:
        raise ValueError("start must not be after end")
    if checked_source(source) is not None:
        spend = spend.filter(F.col("source") == source)
    if attribution_kind is not None and "attribution_kind" in spend.columns:
        spend = spend.filter(F.col("attribution_kind") == attribution_kind)
    if first:
        spend = spend.filter(F.col("usage_date") >= F.lit(first))
    if last:
        spend = spend.filter(F.col("usage_date") <= F.lit(last))
    return spend


# --- spend -------------------------------------------------------------------------------------


def spend_totals(by_source_date: DataFrame) -> DataFrame:
    """Cost, records and days per source. No cost at all counts as 0 here."""
    return by_source_date.groupBy("source").agg(
        F.coalesce(F.sum("cost_usd_total").cast("double"), F.lit(0.0)).alias("total_cost_usd"),
        F.sum("record_count").alias("total_records"),
        F.countDistinct("usage_date").alias("days_observed"),
    )


def spend_report(by_source_date: DataFrame, by_attribution: DataFrame, **where) -> dict[str, DataFrame]:
    """Both spend tables and the totals, for the same filter."""
    days = spend_slice(by_source_date, **{k: v for k, v in where.items() if k != "attribution_kind"})
    return {
        "by_source_date": days,
        "by_attribution": spend_slice(by_attribution, **where),
        "totals_by_source": spend_totals(days),
    }


def top_attribution(by_attribution: DataFrame, limit: int = TOP_ATTRIBUTION) -> DataFrame:
    """The largest keys: by cost if any key has a positive cost, else by quantity.

    The unit is the one seen last. The input is a rollup, small next to the records; it is
    read once for the totals and once for the flag.
    """
    unit_seen = F.when(F.col("usage_unit").isNotNull(), F.struct("usage_date", "usage_unit"))
    totals = by_attribution.groupBy("source", "attribution_key").agg(
        F.sum(F.coalesce("cost_usd_total", F.lit(0))).alias("cost"),
        F.sum(F.coalesce("usage_quantity_total", F.lit(0))).alias("quantity"),
        F.coalesce(F.max(unit_seen)["usage_unit"], F.lit("")).alias("unit"),
    )
    flag = totals.agg(F.coalesce(F.max("cost") > 0, F.lit(False)).alias("uses_cost"))  # one row
    ranked = totals.crossJoin(F.broadcast(flag)).withColumn(
        "value", F.when(F.col("uses_cost"), F.col("cost").cast("double")).otherwise(F.col("quantity").cast("double"))
    )
    return (
        ranked.withColumn("label", clip(F.col("attribution_key"), CHART_LABEL_CHARS, "…"))
        .orderBy(F.col("value").desc(), "source", "attribution_key")
        .limit(limit)
    )


def activity_pivot(by_source_date: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Record counts, one row per date and one column per source, 0 where there are none."""
    return (
        by_source_date.groupBy("usage_date")
        .pivot("source", list(sources))
        .agg(F.sum("record_count"))
        .na.fill(0, list(sources))
        .orderBy("usage_date")
    )


# --- filter options --------------------------------------------------------------------------------


def date_range(by_source_date: DataFrame) -> DataFrame:
    return by_source_date.agg(F.min("usage_date").alias("date_min"), F.max("usage_date").alias("date_max"))


def attribution_kinds(by_attribution: DataFrame) -> DataFrame:
    """Kinds that occur, with their display names."""
    kind = F.col("attribution_kind")
    kinds = by_attribution.filter(kind.isNotNull()).select("attribution_kind").distinct()
    return kinds.select(kind.alias("value"), title_words(kind).alias("label")).orderBy("value")


def attribution_options(by_attribution: DataFrame, queries: DataFrame) -> DataFrame:
    """Distinct (source, kind, key) with a label: the query text where the key is a query id.

    Only queries whose id is a key are looked at for labels; of several, the newest counts.
    """
    options = by_attribution.select("source", "attribution_kind", "attribution_key").distinct()
    keys = options.select(F.col("attribution_key").alias("resource_id")).distinct()
    text = F.col("query_text_preview")
    labels = (
        queries.filter(text.isNotNull() & (text != ""))
        .select("resource_id", "usage_date", "query_text_preview")
        .join(keys, "resource_id", "left_semi")
        .groupBy(F.col("resource_id").alias("attribution_key"))
        .agg(F.max(F.struct("usage_date", "query_text_preview"))["query_text_preview"].alias("__text"))
    )
    return options.join(labels, "attribution_key", "left").select(
        "source",
        "attribution_kind",
        "attribution_key",
        F.coalesce(clip(F.col("__text"), OPTION_LABEL_CHARS), F.col("attribution_key")).alias("label"),
    )


def dedupe_options(options: DataFrame) -> DataFrame:
    """One option per (source, key): the first kind in text order."""
    first = F.min(F.struct("attribution_kind", "label"))
    return options.groupBy("source", "attribution_key").agg(first.alias("__first")).select(
        "source",
        F.col("__first.attribution_kind").alias("attribution_kind"),
        "attribution_key",
        F.col("__first.label").alias("label"),
    )


def first_options(options: DataFrame, limit: int = OPTION_LIMIT) -> DataFrame:
    """The options a select box shows."""
    return dedupe_options(options).orderBy("source", "attribution_key").limit(limit)


def headline_counts(counts: DataFrame) -> DataFrame:
    """Records per source, counted on the table that stands for it, with display names."""
    spark = counts.sparkSession
    rows = [(s, SOURCE_LABELS[s], HEADLINE_TABLES[s]) for s in SOURCES]
    shown = spark.createDataFrame(rows, "source string, label string, table string")
    return shown.join(counts, ["source", "table"], "left").select(
        "source", "label", F.coalesce("record_count", F.lit(0)).alias("record_count")
    )


def filter_options(
    by_source_date: DataFrame, by_attribution: DataFrame, queries: DataFrame, counts: DataFrame
) -> dict[str, DataFrame]:
    return {
        "sources": headline_counts(counts),
        "date_range": date_range(by_source_date),
        "attribution_kinds": attribution_kinds(by_attribution),
        "attribution_options": attribution_options(by_attribution, queries),
    }


# --- anomalies and suggestions ---------------------------------------------------------------------------


def anomaly_counters(*scored: DataFrame) -> DataFrame:
    """Anomalies and scored rows over all given tables."""
    parts = [
        s.select("anomaly", "status").agg(
            F.count_if("anomaly").alias("anomaly_count"),
            F.count_if(F.col("status").isin("normal", "anomaly")).alias("scored_count"),
        )
        for s in scored
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.agg(F.sum("anomaly_count").alias("anomaly_count"), F.sum("scored_count").alias("scored_count"))


def anomaly_report(
    cost_anomalies: DataFrame, query_anomalies: DataFrame, source: str | None = None
) -> dict[str, DataFrame]:
    """Both anomaly tables for one source or all, the query table by falling score."""
    if checked_source(source) is not None:
        cost_anomalies = cost_anomalies.filter(F.col("source") == source)
        if source != SNOWFLAKE:
            query_anomalies = query_anomalies.filter(F.lit(False))
    return {
        "cost_anomalies": cost_anomalies,
        "query_anomalies": query_anomalies.orderBy(F.col("z_score").desc_nulls_last(), "resource_id"),
        "top_query_anomalies": top_by_score(query_anomalies),
        "counters": anomaly_counters(cost_anomalies, query_anomalies),
    }


def suggestion_counters(suggestions: DataFrame) -> DataFrame:
    return suggestions.agg(
        F.count(F.lit(1)).alias("total_count"), F.count_if(F.col("quantified") == "yes").alias("quantified_count")
    )


def suggestion_report(suggestions: DataFrame, source: str | None = None) -> dict[str, DataFrame]:
    if checked_source(source) is not None:
        suggestions = suggestions.filter(F.col("source") == source)
    return {"suggestions": suggestions, "counters": suggestion_counters(suggestions)}


def forecast_report(outputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The forecast tables as a page shows them."""
    report = {
        "by_source": outputs["forecast_by_source"],
        "combined": outputs["forecast_combined"].limit(1),
        "native_units": outputs["forecast_native_units"],
    }
    if "forecast_aws_reconciled" in outputs:
        report["aws_reconciled"] = outputs["forecast_aws_reconciled"].limit(1)
    return report


# --- overview ----------------------------------------------------------------------------------------------


def headline_card(query_anomalies: DataFrame) -> DataFrame:
    """The highest anomaly as display texts."""
    top = headline_anomaly(query_anomalies)
    key = F.coalesce("attribution_key", F.lit("warehouse")) if "attribution_key" in top.columns else F.col("account_identifier")
    return top.select(
        F.lit(SOURCE_LABELS[SNOWFLAKE]).alias("source_label"),
        key.alias("warehouse_label"),
        F.concat(F.substring("resource_id", 1, HEADLINE_ID_CHARS), F.lit("...")).alias("query_label"),
        F.coalesce("query_type", F.lit("query")).alias("query_type"),
        format_ms(F.col("usage_quantity")).alias("duration_label"),
        format_z(F.col("z_score")).alias("metric_value"),
        finite(F.col("z_score")).alias("z_score"),
    )


def total_records(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("record_count").alias("total_records"))


def overview(
    counts: DataFrame, query_anomalies: DataFrame, forecast_by_source: DataFrame, run_date: str | None = None
) -> dict[str, DataFrame]:
    """The parts of the first page; ``run_date`` is that of the run whose tables are given."""
    store = total_records(counts).withColumn("run_date", F.lit(run_date).cast("string"))
    return {
        "sources": headline_counts(counts),
        "headline_anomaly": headline_card(query_anomalies),
        "forecast_preview": forecast_series(forecast_by_source.filter(F.col("source") == AWS)),
        "total_records": total_records(counts),
        "store": store,
    }


def provenance(counts: DataFrame) -> DataFrame:
    """Record counts of the listed raw tables with a description."""
    spark = counts.sparkSession
    listed = spark.createDataFrame(PROVENANCE_TABLES, "source string, table string, description string")
    return listed.join(counts, ["source", "table"], "left").select(
        F.concat_ws("/", "source", "table").alias("table"),
        "source",
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
        "description",
    )
