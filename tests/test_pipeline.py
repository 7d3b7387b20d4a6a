"""Whole jobs: collection from payload files, the output tables, the stream, the notebook."""

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.enrich import enrich_events
from tallyspark.plans import collect, pipeline, quick_look
from tallyspark.sources import outputs as out
from tallyspark.sources.raw_store import read_raw_store
from tallyspark.streaming.landing import start_collection

NOW = datetime(2026, 8, 12, 12, tzinfo=timezone.utc)


def land(root, source, table, rows, name="part"):
    folder = root / source / table
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in rows))


def query(i, ms, text="SELECT a FROM t", **more):
    return {"QUERY_ID": f"q{i:03d}", "WAREHOUSE_NAME": "WH", "QUERY_TYPE": "SELECT", "QUERY_TEXT": text, "START_TIME": "2026-08-12T08:00:00Z", "TOTAL_ELAPSED_TIME": ms} | more


@pytest.fixture()
def landing(tmp_path):
    root = tmp_path / "landing"
    days = [date(2026, 7, 30) + timedelta(days=i) for i in range(13)]
    cost = lambda a: {"UnblendedCost": {"Amount": a, "Unit": "USD"}, "UsageQuantity": {"Amount": "1", "Unit": "GB"}}
    land(root, "aws", "cost_and_usage", [{"ResultsByTime": [{"TimePeriod": {"Start": str(d), "End": str(d + timedelta(days=1))}, "Groups": [{"Keys": ["S3"], "Metrics": cost("0.0000046448")}]} for d in days]}])
    land(root, "aws", "cost_forecast", [{"Total": {"Amount": "0.0000510928", "Unit": "USD"}, "ForecastResultsByTime": []}])
    land(root, "snowflake", "query_history", [query(i, 200.0 + i) for i in range(12)] + [query(99, 11899.0), query(100, 5.0, "SELECT * FROM SNOWFLAKE_SAMPLE_DATA.A.B")])
    land(root, "snowflake", "warehouse_metering_history", [{"WAREHOUSE_NAME": "WH", "START_TIME": "2026-08-12T08:00:00Z", "CREDITS_USED": 0.222666}])
    land(root, "databricks", "job_runs", [{"run_id": 1, "job_id": 7, "run_name": "etl", "start_time": 1786522000000, "run_duration": 90000, "state": {"result_state": "SUCCESS"}}])
    return root


def test_collect_then_run(spark, landing, tmp_path):
    raw, processed = str(tmp_path / "raw"), str(tmp_path / "processed")
    written = collect.collect(spark, str(landing), raw, NOW)
    assert {k[1] for k, v in written.items() if v is None} == {"service_dimension_values", "cluster_events"}
    counts = pipeline.run(raw, processed, date(2026, 8, 12), spark)
    assert counts == {
        "anomalies_snowflake_query_duration": 14,
        "spend_by_source_date": 16,
        "spend_by_attribution": 17,
        "anomalies_daily_cost_by_attribution": 17,
        "forecast_by_source": 1,
        "forecast_combined": 1,
        "forecast_native_units": 3,
        "forecast_aws_reconciled": 1,
        "optimization_suggestions": 4,
    }
    latest = lambda name: out.read_latest(spark, processed, name)
    assert [r.resource_id for r in latest("anomalies_snowflake_query_duration").filter("anomaly").collect()] == ["q099"]
    own = latest("forecast_aws_reconciled").first()
    assert own.days_observed == 11 and own.run_rate_month_end_projection == pytest.approx(0.0001439888)
    assert own.aws_native_forecast_usd == pytest.approx(5.10928e-5)
    rules = {r.rule_id: r for r in latest("optimization_suggestions").collect()}
    assert set(rules) == {"repeated_identical_query", "unfiltered_table_scan", "idle_flat_cost_resource", "databricks_cost_visibility_gap"}
    assert out.store_run_date(spark, processed) == "2026-08-12"
    assert latest("spend_by_attribution").columns == ["source", "attribution_kind", "attribution_key", "usage_date", "cost_usd_total", "cost_bases_present", "usage_quantity_total", "usage_unit", "record_count"]


def test_outputs_from_totals_equal_outputs_from_records(spark, landing, tmp_path):
    """The shared pre-aggregate must not change any result."""
    from tallyspark.operators import forecast as fc
    from tallyspark.operators import rollups as ro

    collect.collect(spark, str(landing), str(tmp_path / "raw"), NOW)
    events = enrich_events(read_raw_store(spark, str(tmp_path / "raw")))
    outputs = pipeline.build_outputs(spark, events, date(2026, 8, 12))
    direct = {
        "spend_by_source_date": ro.spend_by_source_date(events),
        "spend_by_attribution": ro.spend_by_attribution(events),
        "forecast_by_source": fc.month_end_forecast(events, date(2026, 8, 12)),
        "forecast_native_units": fc.native_unit_forecast(events, date(2026, 8, 12)),
    }
    for name, df in direct.items():
        shown = lambda d: sorted(str([round(x, 12) if isinstance(x, float) else x for x in r]) for r in d.select(*df.columns).collect())
        assert shown(outputs[name]) == shown(df), name
    # the records are read for: totals (once), query scores (final pass), never per rollup
    plan = outputs["spend_by_source_date"]._jdf.queryExecution().executedPlan().toString()
    assert "daily-totals" in plan and "cost_and_usage" not in plan


def test_no_aws_cost_means_no_reconciled_table(spark, landing, tmp_path):
    collect.collect(spark, str(landing), str(tmp_path / "raw"), NOW)
    events = enrich_events(read_raw_store(spark, str(tmp_path / "raw"))).filter(F.col("source") != "aws")
    assert "forecast_aws_reconciled" not in pipeline.build_outputs(spark, events, date(2026, 8, 12))


def test_quick_look(spark, landing, tmp_path):
    collect.collect(spark, str(landing), str(tmp_path / "raw"), NOW)
    results = quick_look.run(spark, str(tmp_path / "raw"), str(tmp_path / "out"), date(2026, 8, 12))
    assert [r.resource_id for r in spark.read.parquet(str(tmp_path / "out" / "anomalies_snowflake_query_duration")).collect()] == ["q099"]
    assert results["forecast_aws"].first().days_observed == 11
    assert [r.run_count for r in results["optimization_suggestions_repeated_query"].collect()] == [13]


def test_stream_collects_each_file_once(spark, landing, tmp_path):
    raw, marks = str(tmp_path / "raw"), str(tmp_path / "marks")

    def collect_new(source, table):
        stream = start_collection(spark, str(landing), raw, marks, source, table, NOW)
        stream.awaitTermination(120)
        assert stream.exception() is None

    collect_new("snowflake", "query_history")
    assert read_raw_store(spark, raw).count() == 14
    collect_new("snowflake", "query_history")
    assert read_raw_store(spark, raw).count() == 14
    land(landing, "snowflake", "query_history", [query(200, 1.0)], name="later")
    collect_new("snowflake", "query_history")
    collect_new("databricks", "job_runs")
    rows = read_raw_store(spark, raw)
    assert rows.count() == 16 and rows.filter("resource_id = 'q200'").count() == 1


@pytest.mark.parametrize("fails_at", ["write", "move", "record"])
def test_a_run_that_fails_is_not_seen(spark, tmp_path, monkeypatch, fails_at):
    root = str(tmp_path / "processed")
    tables = lambda n: {name: spark.range(n).withColumn("table", F.lit(name)) for name in "abc"}
    seen = lambda: {name: out.read_latest(spark, root, name).count() for name in "abcd"}
    assert out.write_outputs(tables(1), root, date(2026, 8, 10)) == {"a": 1, "b": 1, "c": 1}
    out.write_outputs(tables(2), root, date(2026, 8, 11))
    assert seen() == {"a": 2, "b": 2, "c": 2, "d": 0}

    def broken(real, which):
        calls = []

        def call(*args):
            calls.append(args)
            if len(calls) == which:
                raise OSError("lost")
            return real(*args)

        return call

    with monkeypatch.context() as m:
        if fails_at == "write":
            m.setattr(out, "write_output", broken(out.write_output, 2))
        elif fails_at == "move":
            m.setattr(out, "move_dir", broken(out.move_dir, 2))
        else:
            m.setattr(spark, "createDataFrame", broken(spark.createDataFrame, 1))
        with pytest.raises(OSError):
            out.write_outputs(tables(3) | {"d": spark.range(4)}, root, date(2026, 8, 11))
    # a run of the same date that fails on the way takes the earlier one with it, as a whole
    whole = 2 if fails_at == "write" else 1
    assert seen() == {"a": whole, "b": whole, "c": whole, "d": 0}
    assert out.store_run_date(spark, root) == ("2026-08-11" if fails_at == "write" else "2026-08-10")
    out.write_outputs(tables(3) | {"d": spark.range(4)}, root, date(2026, 8, 11))
    assert seen() == {"a": 3, "b": 3, "c": 3, "d": 4}
    tables_of = out.published_tables(spark, root, "2026-08-11").collect()
    assert {r["output_table"]: r["record_count"] for r in tables_of} == {"a": 3, "b": 3, "c": 3, "d": 4}
