from datetime import date

from tallyspark.functions.text import metadata_field
from tallyspark.operators import rollups as ro
from tallyspark.operators.enrich import enrich_events

RECORD = "source string, resource_type string, resource_id string, account_identifier string, usage_date date, service string, cost_usd double, cost_basis string, usage_quantity double, usage_unit string, raw_metadata string"
DAY = date(2026, 8, 1)


def events(spark):
    rows = [
        ("aws", "cost_explorer_daily_service", "a", None, DAY, "S3", 1.0, "billed", 2.0, "GB", None),
        ("aws", "cost_forecast", "f", None, DAY, None, 9.0, "forecast", None, "USD", "{}"),
        ("snowflake", "query", "q1", "WH", DAY, "WH", None, None, 5.0, "milliseconds", '{"query_type": "SELECT", "bytes_scanned": 12.5}'),
        ("snowflake", "query", "q2", "WH", DAY, "WH", None, None, None, "milliseconds", "{broken"),
        ("snowflake", "warehouse_metering_hour", "m", "WH", DAY, "WH", None, None, 1.5, "credits", '{"bytes_scanned": "many"}'),
        ("databricks", "cluster_event", "c", "cl", DAY, None, None, None, None, None, '{"type": "START"}'),
        ("gcp", "x", "only", None, DAY, None, None, None, None, None, None),
    ]
    return enrich_events(spark.createDataFrame(rows, RECORD))


def test_attribution_and_metadata(spark):
    rows = {r.resource_id: r for r in events(spark).collect()}
    assert len(rows) == 7
    assert (rows["a"].attribution_key, rows["a"].attribution_kind) == ("S3", "service")
    assert (rows["f"].attribution_key, rows["f"].attribution_kind) == ("f", "service")
    assert (rows["q1"].attribution_key, rows["q1"].attribution_kind) == ("WH", "query")
    assert rows["m"].attribution_kind == "warehouse" and rows["c"].attribution_kind == "job"
    assert (rows["only"].attribution_key, rows["only"].attribution_kind) == ("only", "other")
    assert (rows["q1"].query_type, rows["q1"].bytes_scanned) == ("SELECT", 12.5)
    assert rows["q2"].query_type is None and rows["m"].bytes_scanned is None


def test_single_field(spark):
    df = events(spark)
    got = df.select("resource_id", metadata_field(df, "bytes_scanned", as_double=True).alias("b")).collect()
    assert {r.resource_id: r.b for r in got if r.b is not None} == {"q1": 12.5}


def test_by_source_and_date(spark):
    rows = {r.source: r for r in ro.spend_by_source_date(events(spark)).collect()}
    assert (rows["aws"].cost_usd_total, rows["aws"].record_count, rows["aws"].records_with_cost) == (10.0, 2, 2)
    assert rows["aws"].cost_bases_present == ["billed", "forecast"]
    assert rows["snowflake"].cost_usd_total is None and rows["snowflake"].records_with_cost == 0
    assert rows["snowflake"].cost_bases_present == []
    assert {r.source: r.cost_usd_total for r in ro.spend_by_source_date(events(spark), actual_only=True).collect()}["aws"] == 1.0


def test_by_attribution_matches_the_shared_pre_aggregate(spark):
    rows = {(r.attribution_kind, r.attribution_key): r for r in ro.spend_by_attribution(events(spark)).collect()}
    assert (rows["query", "WH"].usage_quantity_total, rows["query", "WH"].record_count) == (5.0, 2)
    assert rows["warehouse", "WH"].usage_unit == "credits"
    totals = ro.daily_totals(events(spark))
    again = {r.source: (r.cost_usd_total, r.record_count) for r in ro.source_date_rollup(totals).collect()}
    assert again == {r.source: (r.cost_usd_total, r.record_count) for r in ro.spend_by_source_date(events(spark)).collect()}


def test_metadata_is_not_read_when_not_needed(spark, tmp_path):
    path = str(tmp_path / "records")
    events(spark).select("source", "resource_type", "resource_id", "account_identifier", "usage_date", "service", "cost_usd", "cost_basis", "usage_quantity", "usage_unit", "raw_metadata").write.parquet(path)
    plan = ro.spend_by_attribution(enrich_events(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    assert "raw_metadata" not in plan and "from_json" not in plan
