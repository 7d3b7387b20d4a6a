"""Query registry: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import fixed_values as fv
from tallyspark.functions import text as fmt
from tallyspark.operators import anomalies as an
from tallyspark.operators import forecast as fc
from tallyspark.operators import normalize as nz
from tallyspark.operators import reports as rp
from tallyspark.operators import rollups as ro
from tallyspark.operators import rules as ru
from tallyspark.operators.enrich import enrich_events
from tallyspark.operators.newest import newest_records
from tallyspark.operators.pricing import estimate_cost, hours_of_ms
from tallyspark.plans import pipeline
from tallyspark.plans.collect import normalize_all
from tallyspark.plans.quick_look import repeated_texts
from tallyspark.sources import outputs as out
from tallyspark.sources import raw_store as rs
from tallyspark.sources.materialize import materialize, new_path

from . import views as v
from .portable import portable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCORES = list(an.SCORE_COLUMNS)
RECORD = ["source", "resource_type", "resource_id", "account_identifier", "usage_date", "period_start", "period_end"]
RECORD += ["service", "cost_usd", "cost_basis", "usage_quantity", "usage_unit"]


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def _labelled(parts: dict[str, DataFrame], name: str = "part") -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn(name, F.lit(k)) for k, df in parts.items()])


def _record_and_metadata(records: DataFrame, keys: tuple[str, ...], numbers: tuple[str, ...] = ()) -> DataFrame:
    parsed = records.withColumn("__m", fmt.metadata_struct((*keys, *numbers)))
    return parsed.select(
        *RECORD, *[F.col(f"__m.{k}").alias(k) for k in keys], *[F.col(f"__m.{k}").cast("double").alias(k) for k in numbers]
    )


# --- rollups and enrichment -------------------------------------------------------------------


@query
def spend_by_source_date(spark, sf):
    return ro.spend_by_source_date(v.usage_events(spark, sf))


@query
def spend_by_attribution(spark, sf):
    return ro.spend_by_attribution(v.usage_events(spark, sf))


@query
def spend_actual_only(spark, sf):
    return ro.spend_by_source_date(v.usage_events(spark, sf), actual_only=True)


@query
def enrich_metadata(spark, sf):
    return v.usage_events(spark, sf).select(
        "resource_type",
        "resource_id",
        "ingested_at",
        "attribution_key",
        "attribution_kind",
        *fv.METADATA_TEXT_KEYS,
        *fv.METADATA_NUMBER_KEYS,
    )


@query
def metadata_json(spark, sf):
    """JSON text decoded to a variant and read by path, unusable text as an empty object."""
    records = v.query_records(spark, sf)
    broken = F.when(F.col("resource_id").cast("long") % 50 == 0, F.lit("{not json")).otherwise(F.col("raw_metadata"))
    decoded = records.select("resource_id", broken.alias("raw_metadata")).withColumn("m", fmt.json_or_empty())
    return decoded.select(
        "resource_id",
        F.try_variant_get("m", "$.query_type", "string").alias("query_type"),
        F.try_variant_get("m", "$.bytes_scanned", "double").alias("bytes_scanned"),
        (F.to_json("m") == "{}").alias("is_empty"),
    )


@query
def row_counts_by_source(spark, sf):
    return rs.source_counts(v.usage_records(spark, sf))


@query
def table_counts(spark, sf):
    return rs.table_counts(v.usage_records(spark, sf))


# --- anomalies -------------------------------------------------------------------------------------


def _query_scores(spark, sf, **options):
    return an.query_duration_anomalies(v.query_events(spark, sf), **options)


def _cost_scores(spark, sf):
    spend = ro.spend_by_attribution(v.usage_events(spark, sf))
    # squares of 18 digits fit a decimal without loss
    return an.daily_cost_anomalies(materialize(spend.withColumn("cost_usd_total", F.col("cost_usd_total").cast(v.MONEY))))


@query
def anomaly_query_duration(spark, sf):
    return _query_scores(spark, sf).select("resource_id", "account_identifier", "usage_date", "usage_quantity", *SCORES)


@query
def anomaly_flat_double(spark, sf):
    """Equal doubles with one value barely above them in some groups, counted by outcome."""
    scored = an.detect_anomalies(v.flat_doubles(spark, sf), group_cols=["grp"], value_col="val")
    return scored.groupBy("grp", "val", "status", (F.col("z_score") == float("inf")).alias("infinite")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def anomaly_extreme_double(spark, sf):
    """Doubles beside a value up to 10^12 times as large, and values that are not finite; scores to nine digits."""
    scored = an.detect_anomalies(v.extreme_doubles(spark, sf), group_cols=["grp"], value_col="val")
    digits = lambda c: F.format_string("%.9e", F.col(c))
    return scored.groupBy(
        "grp",
        "status",
        "group_n_other",
        F.when((F.col("val") >= 1000) & (F.col("status") != "no_value"), digits("val")).alias("far"),
        F.when(F.col("anomaly"), digits("baseline_mean")).alias("mean"),
        F.when(F.col("anomaly"), digits("baseline_stddev")).alias("stddev"),
        F.when(F.col("anomaly"), digits("z_score")).alias("z"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def anomaly_query_duration_window(spark, sf):
    scored = _query_scores(spark, sf, form="window")
    return scored.select("resource_id", "account_identifier", "usage_date", "usage_quantity", *SCORES)


@query
def anomaly_query_duration_shuffled(spark, sf):
    """The same through the plan for statistics too large to broadcast."""
    scored = _query_scores(spark, sf, broadcast_bytes=0, hot_parts=20)
    return scored.select("resource_id", "account_identifier", "usage_date", "usage_quantity", *SCORES)


@query
def anomaly_daily_cost(spark, sf):
    return _cost_scores(spark, sf).select(
        "source", "attribution_kind", "attribution_key", "usage_date", "cost_usd_total", *SCORES
    )


@query
def anomaly_null_and_flat(spark, sf):
    """Groups with missing values, without spread, and with one value off a flat line."""
    scored = an.detect_anomalies(v.flat_charges(spark, sf), group_cols=["service"], value_col="cost_usd", min_group_size=3)
    return scored.select("resource_id", "service", "cost_usd", *SCORES)


@query
def anomaly_status_counts(spark, sf):
    return an.status_counts(_query_scores(spark, sf))


@query
def anomaly_counts(spark, sf):
    return rp.anomaly_counters(_query_scores(spark, sf), _cost_scores(spark, sf))


@query
def headline_anomaly(spark, sf):
    return an.headline_anomaly(_query_scores(spark, sf)).select("resource_id", "account_identifier", "z_score")


@query
def anomaly_top12(spark, sf):
    return an.top_by_score(_query_scores(spark, sf)).select("resource_id", "usage_date", "z_score", "status")


@query
def anomaly_report(spark, sf):
    """Counters of the anomaly page for each source filter."""
    cost, queries = materialize(_cost_scores(spark, sf)), materialize(_query_scores(spark, sf))
    return _labelled(
        {s or "all": rp.anomaly_report(cost, queries, s)["counters"] for s in (None, *fv.SOURCES)}, "source_filter"
    )


@query
def notebook_loo_condensed(spark, sf):
    return an.condensed_query_anomalies(v.query_events(spark, sf))


@query
def what_if_score(spark, sf):
    """Each query's baseline against twice its duration."""
    scored = _query_scores(spark, sf)
    return an.what_if_score(scored, F.col("usage_quantity") * 2).select(
        "resource_id", "what_if_value", "what_if_z", "what_if_flagged"
    )


# --- forecasts -----------------------------------------------------------------------------------------


def _by_service(spark, sf):
    """Cloud cost with each service as a source of its own."""
    return v.cost_records(spark, sf).withColumn("source", F.col("service"))


@query
def daily_cost_actuals(spark, sf):
    return fc.daily_cost_actuals(v.usage_events(spark, sf))


@query
def cumulative_cost(spark, sf):
    return fc.cumulative_cost(fc.daily_cost_actuals(v.usage_events(spark, sf)))


@query
def cumulative_cost_ties(spark, sf):
    """All sources in one group: rows of one date share one running total."""
    return fc.cumulative_cost(fc.daily_cost_actuals(v.usage_events(spark, sf)), [])


@query
def forecast_by_source(spark, sf):
    return fc.month_end_forecast(v.usage_events(spark, sf), v.COST_AS_OF)


@query
def forecast_by_group(spark, sf):
    return fc.month_end_forecast(_by_service(spark, sf), v.COST_AS_OF)


@query
def forecast_combined(spark, sf):
    return fc.month_end_forecast(v.usage_events(spark, sf), v.COST_AS_OF, group_cols=[])


@query
def forecast_native_units(spark, sf):
    events = v.usage_events(spark, sf)
    return _labelled(
        {d.isoformat(): fc.native_unit_forecast(events, d) for d in (v.UNIT_AS_OF, v.COST_AS_OF)}, "as_of"
    )


@query
def forecast_reconciled(spark, sf):
    events = v.usage_events(spark, sf)
    aws = fc.month_end_forecast(events, v.COST_AS_OF).filter(F.col("source") == fv.AWS)
    return fc.reconcile_with_aws_native_forecast(aws, events)


@query
def forecast_series(spark, sf):
    forecast = fc.month_end_forecast(_by_service(spark, sf), v.COST_AS_OF)
    return fc.forecast_series(forecast).select("source", "day", "cumulative_cost_usd", "observed")


@query
def forecast_method_compare(spark, sf):
    records = _by_service(spark, sf)
    month = fc.daily_cost_actuals(records).filter(F.col("usage_date").between(F.lit(date(1998, 5, 1)), F.lit(v.COST_AS_OF)))
    return fc.forecast_method_series(fc.month_end_forecast(records, v.COST_AS_OF), fc.cumulative_cost(month))


@query
def forecast_report(spark, sf):
    """Row counts of the forecast page's parts."""
    events = materialize(pipeline.totals_as_events(ro.daily_totals(v.usage_events(spark, sf))))
    report = rp.forecast_report(
        {
            "forecast_by_source": fc.month_end_forecast(events, v.COST_AS_OF),
            "forecast_combined": fc.month_end_forecast(events, v.COST_AS_OF, group_cols=[]),
            "forecast_native_units": fc.native_unit_forecast(events, v.COST_AS_OF),
        }
    )
    return _labelled({k: df.agg(F.count(F.lit(1)).alias("n")) for k, df in report.items()})


@query
def notebook_aws_run_rate(spark, sf):
    return fc.billed_run_rate(v.usage_events(spark, sf), v.COST_AS_OF)


# --- rules ------------------------------------------------------------------------------------------------


@query
def rule_repeated_query(spark, sf):
    return ru.repeated_query_facts(v.query_events(spark, sf))


@query
def rule_unfiltered_scan(spark, sf):
    return ru.unfiltered_scan_facts(v.query_events(spark, sf))


@query
def rule_flat_cost(spark, sf):
    return ru.flat_cost_facts(v.flat_charges(spark, sf)).withColumn("cost_avg", F.round("cost_avg", 4)).drop("cost_stddev")


@query
def rule_cost_visibility_gap(spark, sf):
    return ru.cost_gap_facts(v.usage_events(spark, sf))


@query
def all_suggestions(spark, sf):
    events = v.usage_events(spark, sf).unionByName(enrich_events(v.flat_charges(spark, sf)))
    return ru.run_all_rules(spark, events).select("rule_id", "source", "attribution_key", "resource_ids_sample", "quantified")


@query
def suggestion_report(spark, sf):
    events = v.usage_events(spark, sf).unionByName(enrich_events(v.flat_charges(spark, sf)))
    found = materialize(ru.run_all_rules(spark, events))
    return _labelled(
        {s or "all": rp.suggestion_report(found, s)["counters"] for s in (None, *fv.SOURCES)}, "source_filter"
    )


@query
def notebook_repeated_texts(spark, sf):
    return repeated_texts(v.query_events(spark, sf))


# --- normalizers ----------------------------------------------------------------------------------------------


@query
def normalize_billing(spark, sf):
    records = nz.normalize_cost_and_usage(v.billing_payloads(spark, sf), v.NOW)
    return records.select(
        *RECORD,
        F.get_json_object("raw_metadata", "$.time_period.End").alias("metadata_end"),
        F.get_json_object("raw_metadata", "$.metrics.UnblendedCost.Amount").cast("double").alias("metadata_amount"),
    )


@query
def normalize_forecast(spark, sf):
    """One forecast as of an ordinary day and as of the last of a month."""
    payloads = v.forecast_payloads(spark, sf)
    return _labelled(
        {d.isoformat(): nz.normalize_cost_forecast(payloads, v.NOW, d).select(*RECORD) for d in (v.COST_AS_OF, date(1998, 5, 31))},
        "today",
    )


@query
def normalize_dimensions(spark, sf):
    return nz.normalize_dimension_values(v.dimension_payloads(spark, sf), v.NOW, *v.WINDOW).select(*RECORD)


@query
def normalize_query_history(spark, sf):
    records = nz.normalize_query_history(v.query_history_rows(spark, sf), v.NOW)
    keys = ("query_type", "execution_status", "database_name", "schema_name", "warehouse_size", "query_text_preview")
    return _record_and_metadata(records, keys, ("bytes_scanned", "rows_produced"))


@query
def recent_query_history(spark, sf):
    """The source-side window: newest rows of the last days, limited."""
    recent = nz.recent_rows(v.query_history_rows(spark, sf), v.NOW, row_limit=fv.SOURCE_ROW_LIMIT, tie_break="QUERY_ID")
    return recent.select("QUERY_ID", "WAREHOUSE_NAME", "START_TIME")


@query
def recent_query_history_all(spark, sf):
    """The same window with all its rows."""
    return nz.recent_rows(v.query_history_rows(spark, sf), v.NOW).select("QUERY_ID", "WAREHOUSE_NAME", "START_TIME")


@query
def normalize_metering(spark, sf):
    records = nz.normalize_warehouse_metering(v.metering_rows(spark, sf), v.NOW)
    return records.select(*RECORD, F.get_json_object("raw_metadata", "$.credits_used_compute").cast("double").alias("credits_used_compute"))


@query
def normalize_job_runs(spark, sf):
    records = nz.normalize_job_runs(v.job_run_payloads(spark, sf), v.cluster_dump(spark, sf), v.NOW)
    keys = ("job_id", "result_state", "node_type_id", "num_workers", "cluster_source", "cluster_id")
    return _record_and_metadata(records, keys)


@query
def normalize_cluster_events(spark, sf):
    records = nz.normalize_cluster_events(v.cluster_event_payloads(spark, sf), v.NOW)
    return records.select(
        *RECORD,
        F.get_json_object("raw_metadata", "$.type").alias("type"),
        F.get_json_object("raw_metadata", "$.details.k").alias("k"),
    )


@query
def cluster_resolution(spark, sf):
    return nz.resolve_clusters(v.job_run_payloads(spark, sf), v.cluster_dump(spark, sf)).select(
        "run_id", "node_type_id", "num_workers", "cluster_source", "cluster_id"
    )


@query
def distinct_clusters(spark, sf):
    return nz.distinct_cluster_ids(
        nz.normalize_job_runs(v.job_run_payloads(spark, sf), v.cluster_dump(spark, sf), v.NOW)
    )


@query
def job_cost_estimate(spark, sf):
    cost, basis, _ = estimate_cost(F.col("node_type"), F.col("workers"), F.col("run_ms"))
    return v.job_rows(spark, sf).select(
        "run_id", cost.alias("cost_usd"), basis.alias("cost_basis"), hours_of_ms(F.col("run_ms")).alias("hours")
    )


def _payloads(spark, sf):
    return {
        (fv.AWS, "cost_and_usage"): v.billing_payloads(spark, sf),
        (fv.AWS, "cost_forecast"): v.forecast_payloads(spark, sf),
        (fv.AWS, "service_dimension_values"): v.dimension_payloads(spark, sf),
        (fv.SNOWFLAKE, "query_history"): v.query_history_rows(spark, sf),
        (fv.SNOWFLAKE, "warehouse_metering_history"): v.metering_rows(spark, sf),
        (fv.DATABRICKS, "job_runs"): v.job_run_payloads(spark, sf),
        (fv.DATABRICKS, "clusters"): v.cluster_dump(spark, sf),
        (fv.DATABRICKS, "cluster_events"): v.cluster_event_payloads(spark, sf),
    }


@query
def normalize_batch(spark, sf):
    """All payloads at once, summed up per raw table."""
    tables = normalize_all(_payloads(spark, sf), v.NOW)
    return _labelled(
        {
            f"{source}/{name}": df.agg(
                F.count(F.lit(1)).alias("n"),
                F.count("cost_usd").alias("with_cost"),
                F.sum(F.col("cost_usd").cast(v.MONEY)).alias("cost_usd"),
                F.sum(F.col("usage_quantity").cast(v.MONEY)).alias("usage_quantity"),
            )
            for (source, name), df in tables.items()
        },
        "raw_table",
    )


# --- reports -----------------------------------------------------------------------------------------------------


@query
def spend_slice(spark, sf):
    spend = ro.spend_by_attribution(v.usage_events(spark, sf))
    return rp.spend_slice(spend, source=fv.AWS, attribution_kind="service", start="1997-01-01", end=date(1997, 6, 30))


@query
def spend_totals(spark, sf):
    return rp.spend_totals(ro.spend_by_source_date(v.usage_events(spark, sf)))


@query
def spend_report(spark, sf):
    """Totals of the spend page for one half-year."""
    events = v.usage_events(spark, sf)
    report = rp.spend_report(
        ro.spend_by_source_date(events), ro.spend_by_attribution(events), start="1997-01-01", end="1997-06-30"
    )
    return report["totals_by_source"]


@query
def top_attribution(spark, sf):
    return rp.top_attribution(ro.spend_by_attribution(v.usage_events(spark, sf)))


@query
def top_attribution_by_quantity(spark, sf):
    spend = rp.spend_slice(ro.spend_by_attribution(v.usage_events(spark, sf)), source=fv.SNOWFLAKE)
    return rp.top_attribution(spend, limit=3)


@query
def activity_pivot(spark, sf):
    return rp.activity_pivot(ro.spend_by_source_date(v.usage_events(spark, sf)))


def _option_inputs(spark, sf):
    """Events in which every hundredth query has no warehouse and is its own key."""
    events = v.usage_events(spark, sf)
    no_account = (F.col("resource_type") == "query") & (F.col("resource_id").cast("long") % 100 == 0)
    loose = events.withColumn("attribution_key", F.when(no_account, F.col("resource_id")).otherwise(F.col("attribution_key")))
    return loose, an.snowflake_queries(events)


@query
def filter_options(spark, sf):
    events, queries = _option_inputs(spark, sf)
    return rp.attribution_options(ro.spend_by_attribution(events), queries)


@query
def options_deduped(spark, sf):
    events, queries = _option_inputs(spark, sf)
    return rp.dedupe_options(rp.attribution_options(ro.spend_by_attribution(events), queries))


@query
def options_first_200(spark, sf):
    events, queries = _option_inputs(spark, sf)
    return rp.first_options(rp.attribution_options(ro.spend_by_attribution(events), queries))


@query
def attribution_kinds(spark, sf):
    return rp.attribution_kinds(ro.spend_by_attribution(v.usage_events(spark, sf)))


@query
def date_range(spark, sf):
    return rp.date_range(ro.spend_by_source_date(v.usage_events(spark, sf)))


@query
def overview_headline(spark, sf):
    return rp.headline_card(_query_scores(spark, sf))


@query
def overview_sources(spark, sf):
    return rp.headline_counts(rs.table_counts(v.usage_records(spark, sf)))


@query
def overview_forecast(spark, sf):
    parts = rp.overview(
        rs.table_counts(v.usage_records(spark, sf)),
        _query_scores(spark, sf),
        fc.month_end_forecast(v.usage_events(spark, sf), v.COST_AS_OF),
    )
    series = parts["forecast_preview"]
    return series.crossJoin(F.broadcast(parts["total_records"])).select(
        "day", "cumulative_cost_usd", "observed", "total_records"
    )


@query
def provenance(spark, sf):
    return rp.provenance(rs.table_counts(v.usage_records(spark, sf))).drop("description")


@query
def display_formats(spark, sf):
    """Costs and scores of charges as display texts."""
    charges = v.flat_charges(spark, sf).select("resource_id", "cost_usd")
    small = F.col("cost_usd").cast("double") / F.lit(1000003.0)
    return charges.select(
        "resource_id",
        fmt.format_usd(F.col("cost_usd")).alias("usd"),
        fmt.format_usd(small).alias("small_usd"),
        fmt.format_count(F.col("cost_usd"), 3).alias("number"),
    )


# --- stores ------------------------------------------------------------------------------------------------------------


@query
def newest_collection(spark, sf):
    """A store with overlapping collections: each record once, as the newest has it."""
    records = newest_records(rs.read_raw_store(spark, v.twice_landed_store(spark, sf), keep_ingested_date=True))
    return records.groupBy("source", "resource_type", "usage_date", "ingested_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("cost_usd").cast(v.MONEY)).alias("cost_usd"),
        F.sum(F.col("usage_quantity").cast(v.MONEY)).alias("usage_quantity"),
        F.max("ingested_at").alias("ingested_at"),
    )


@query
def raw_store_roundtrip(spark, sf):
    """Records of all tables written to a raw store and read back, summed up per day."""
    raw = new_path(spark, "raw-store")
    v.land(spark, sf, raw)
    back = rs.read_raw_store(spark, raw)
    return back.groupBy("source", "resource_type", "usage_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("cost_usd").cast(v.MONEY)).alias("cost_usd"),
        F.sum(F.col("usage_quantity").cast(v.MONEY)).alias("usage_quantity"),
        F.min("period_start").alias("first_start"),
        F.max("ingested_at").alias("ingested_at"),
        F.count(F.get_json_object("raw_metadata", "$.query_type")).alias("with_query_type"),
    )


@query
def latest_partition(spark, sf):
    """Two runs of one table; only the newer is read."""
    root = new_path(spark, "outputs")
    spend = ro.spend_by_source_date(v.usage_events(spark, sf))
    out.write_output(spend, root, "spend_by_source_date", date(2024, 1, 30))
    out.write_output(spend.filter(F.col("source") == fv.SNOWFLAKE), root, "spend_by_source_date", date(2024, 1, 31))
    newest = out.store_run_date(spark, root)
    return out.read_latest(spark, root, "spend_by_source_date").withColumn("run_date", F.lit(newest))


@query
def outputs_written(spark, sf):
    """The whole job over a written raw store; rows of every output table of the published run, and its record."""
    root = new_path(spark, "outputs")
    written = pipeline.run(v.landed_store(spark, sf), root, v.COST_AS_OF, spark)
    tables = {name: out.read_latest(spark, root, name).agg(F.count(F.lit(1)).alias("n")) for name in written}
    newest = out.store_run_date(spark, root)
    return _labelled(tables, "output_table").join(out.published_tables(spark, root, newest), "output_table").withColumn("run_date", F.lit(newest))
