from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import text as fmt
from tallyspark.operators import reports as rp

DAY = [date(2026, 8, d) for d in range(1, 32)]
ATTRIBUTION = "source string, attribution_kind string, attribution_key string, usage_date date, cost_usd_total double, usage_quantity_total double, usage_unit string, record_count bigint"


def by_attribution(spark, cost=1.0):
    rows = [
        ("aws", "service", "S3", DAY[0], cost, 5.0, "GB", 1),
        ("aws", "service", "S3", DAY[1], None, 5.0, None, 1),
        ("snowflake", "query", "WH", DAY[0], None, 90.0, "milliseconds", 3),
        ("snowflake", "warehouse", "WH", DAY[2], None, 2.0, "credits", 1),
        ("databricks", "job", "j" * 30, DAY[3], None, None, None, 1),
    ]
    return spark.createDataFrame(rows, ATTRIBUTION)


def by_date(spark):
    rows = [("aws", DAY[0], 1.0, 2), ("aws", DAY[1], None, 1), ("snowflake", DAY[0], None, 4)]
    return spark.createDataFrame(rows, "source string, usage_date date, cost_usd_total double, record_count bigint")


def test_slices(spark):
    spend = by_attribution(spark)
    assert rp.spend_slice(spend, start="2026-08-01", end="2026-08-01").count() == 2
    assert rp.spend_slice(spend, source="aws", start=DAY[1]).count() == 1
    assert rp.spend_slice(spend, attribution_kind="nothing").count() == 0
    assert rp.spend_slice(spend, start="2030-01-01").count() == 0
    for wrong in ({"source": "gcp"}, {"start": "August"}, {"start": DAY[1], "end": DAY[0]}):
        with pytest.raises(ValueError):
            rp.spend_slice(spend, **wrong)


def test_totals_count_missing_cost_as_zero(spark):
    rows = {r.source: r for r in rp.spend_report(by_date(spark), by_attribution(spark))["totals_by_source"].collect()}
    assert (rows["aws"].total_cost_usd, rows["aws"].total_records, rows["aws"].days_observed) == (1.0, 3, 2)
    assert (rows["snowflake"].total_cost_usd, rows["snowflake"].days_observed) == (0.0, 1)


def test_top_attribution_by_cost_or_quantity(spark):
    top = rp.top_attribution(by_attribution(spark)).collect()
    assert (top[0].attribution_key, top[0].value, top[0].unit) == ("S3", 1.0, "GB") and top[0].uses_cost
    top = rp.top_attribution(by_attribution(spark, cost=0.0), limit=2).collect()
    assert [(r.attribution_key, r.value) for r in top] == [("WH", 92.0), ("S3", 10.0)]
    assert top[0].unit == "credits" and not top[0].uses_cost
    label = {r.source: r.label for r in rp.top_attribution(by_attribution(spark)).collect()}["databricks"]
    assert label == "j" * 22 + "…"


def test_activity_pivot(spark):
    rows = [tuple(r) for r in rp.activity_pivot(by_date(spark)).collect()]
    assert rows == [(DAY[0], 2, 4, 0), (DAY[1], 1, 0, 0)]


def test_options(spark):
    queries = spark.createDataFrame(
        [("S3", DAY[0], "old text"), ("S3", DAY[1], "t" * 70), ("other", DAY[1], "x"), ("WH", DAY[0], "")],
        "resource_id string, usage_date date, query_text_preview string",
    )
    options = rp.attribution_options(by_attribution(spark), queries)
    labels = {(r.attribution_kind, r.attribution_key): r.label for r in options.collect()}
    assert len(labels) == 4 and labels["service", "S3"] == "t" * 60 + "..." and labels["query", "WH"] == "WH"
    deduped = {(r.source, r.attribution_key): r.attribution_kind for r in rp.dedupe_options(options).collect()}
    assert deduped["snowflake", "WH"] == "query" and len(deduped) == 3
    assert rp.dedupe_options(options.limit(0)).count() == 0
    assert [tuple(r) for r in rp.attribution_kinds(by_attribution(spark)).collect()][-1] == ("warehouse", "Warehouse")
    assert tuple(rp.date_range(by_date(spark)).first()) == (DAY[0], DAY[1])


def test_anomaly_and_suggestion_reports(spark):
    scored = spark.createDataFrame(
        [("aws", "a", 5.0, "anomaly", True), ("aws", "b", None, "no_value", False), ("snowflake", "c", 1.0, "normal", False)],
        "source string, resource_id string, z_score double, status string, anomaly boolean",
    )
    queries = scored.filter("source = 'snowflake'")
    counters = {s: tuple(rp.anomaly_report(scored, queries, s)["counters"].first()) for s in (None, "aws", "snowflake")}
    assert counters == {None: (1, 3), "aws": (1, 1), "snowflake": (0, 2)}
    found = spark.createDataFrame([("aws", "yes"), ("aws", "no"), ("databricks", "no")], "source string, quantified string")
    assert tuple(rp.suggestion_report(found, "aws")["counters"].first()) == (2, 1)
    assert tuple(rp.suggestion_report(found)["counters"].first()) == (3, 1)


def test_provenance_and_overview_counts(spark):
    counts = spark.createDataFrame([("aws", "cost_and_usage", 29), ("snowflake", "query_history", 167)], "source string, table string, record_count bigint")
    assert {r.table: r.record_count for r in rp.provenance(counts).collect()}["aws/cost_and_usage"] == 29
    assert {r.source: r.record_count for r in rp.headline_counts(counts).collect()} == {"aws": 29, "snowflake": 167, "databricks": 0}


@pytest.mark.parametrize(
    "value, text",
    [(0.0000046448, "$0.0000046448"), (0.0001439888, "$0.0001439888"), (0.0, "$0.00"), (None, "—"), (float("nan"), "—"), (1234.5, "$1,234.50"), (-0.25, "$-0.25")],
)
def test_money_text(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(fmt.format_usd(F.col("v"))).first()[0] == text


def test_other_texts(spark):
    df = spark.createDataFrame([(20.896044071432563, 6.902632205, "2026-08-12", "no date")], "z double, n double, d string, x string")
    row = df.select(fmt.format_z(F.col("z")), fmt.format_count(F.col("n"), 3), fmt.format_day(F.col("d")), fmt.format_day(F.col("x")), fmt.format_ms(F.col("z"))).first()
    assert tuple(row) == ("z=20.90", "6.903", "Aug 12, 2026", "no date", "21 ms")
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "v double").select(fmt.finite(F.col("v"))).collect()
    assert [r[0] for r in nan] == [None, 1.0]
