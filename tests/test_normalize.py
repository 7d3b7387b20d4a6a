import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark import schema as sc
from tallyspark.functions.calendar import iso_moment
from tallyspark.operators import normalize as nz
from tallyspark.operators.groups import lookup_join
from tallyspark.operators.newest import newest_records
from tallyspark.operators.pricing import estimate_cost

NOW = datetime(2026, 8, 12, 12, tzinfo=timezone.utc)


def test_billing(spark):
    group = lambda keys, cost, usage: {"Keys": keys, "Metrics": {"UnblendedCost": cost, "UsageQuantity": usage}}
    payload = {
        "ResultsByTime": [
            {
                "TimePeriod": {"Start": "2026-08-01", "End": "2026-08-02"},
                "Groups": [
                    group(["S3"], {"Amount": "0.0000046448", "Unit": "USD"}, {"Amount": "2.5", "Unit": "GB"}),
                    group([], None, None),
                ],
            },
            {"TimePeriod": {"Start": "2026-08-02", "End": "2026-08-03"}, "Groups": []},
        ]
    }
    rows = nz.normalize_cost_and_usage(spark.createDataFrame([payload], sc.COST_AND_USAGE_PAYLOAD), NOW).collect()
    assert [r.resource_id for r in rows] == ["2026-08-01::S3", "2026-08-01::UNKNOWN"]
    assert (rows[0].cost_usd, rows[0].usage_quantity, rows[0].usage_unit) == (4.6448e-6, 2.5, "GB")
    assert rows[1].cost_usd is None and rows[1].cost_basis == "billed" and rows[1].usage_unit is None
    assert json.loads(rows[0].raw_metadata)["time_period"]["End"] == "2026-08-02"
    assert rows[0].usage_date == date(2026, 8, 1)


@pytest.mark.parametrize(
    "today, start, end",
    [
        (date(2026, 8, 12), date(2026, 8, 13), date(2026, 9, 1)),
        (date(2026, 8, 31), date(2026, 9, 1), date(2026, 10, 1)),
        (date(2026, 12, 31), date(2027, 1, 1), date(2027, 2, 1)),
        (date(2026, 12, 30), date(2026, 12, 31), date(2027, 1, 1)),
        (date(2028, 2, 28), date(2028, 2, 29), date(2028, 3, 1)),
    ],
)
def test_forecast_window(spark, today, start, end):
    payload = spark.createDataFrame([({"Amount": "1.5", "Unit": "USD"}, [])], sc.COST_FORECAST_PAYLOAD)
    row = nz.normalize_cost_forecast(payload, NOW, today).first()
    assert (row.usage_date, row.period_start.date(), row.period_end.date()) == (start, start, end)
    assert row.resource_id == f"{start}::{end}" and (row.cost_usd, row.cost_basis) == (1.5, "forecast")


def test_dimension_values(spark):
    payload = spark.createDataFrame([([("S3", {"a": "b"}), (None, None)],)], sc.DIMENSION_PAYLOAD)
    rows = nz.normalize_dimension_values(payload, NOW, date(2026, 7, 29), date(2026, 8, 12)).collect()
    assert [r.service for r in rows] == ["S3", "UNKNOWN"] and rows[0].cost_usd is None
    assert rows[0].resource_id == "2026-07-29::2026-08-12::S3"


def test_query_history(spark):
    row = {f.name: None for f in sc.QUERY_HISTORY_ROW} | {"QUERY_ID": "q", "WAREHOUSE_NAME": "WH", "QUERY_TEXT": "x" * 600, "TOTAL_ELAPSED_TIME": 7.0}
    dated = row | {"QUERY_ID": "d", "QUERY_TEXT": None, "START_TIME": datetime(2026, 8, 1, 23, 59)}
    rows = {r.resource_id: r for r in nz.normalize_query_history(spark.createDataFrame([row, dated], sc.QUERY_HISTORY_ROW), NOW).collect()}
    assert rows["q"].usage_date == date(2026, 8, 12) and rows["d"].usage_date == date(2026, 8, 1)
    assert (rows["q"].service, rows["q"].account_identifier, rows["q"].usage_unit) == ("WH", "WH", "milliseconds")
    assert rows["q"].cost_usd is None and rows["q"].cost_basis is None
    assert len(json.loads(rows["q"].raw_metadata)["query_text_preview"]) == 500
    assert json.loads(rows["q"].raw_metadata)["query_text"] == "x" * 600
    assert json.loads(rows["d"].raw_metadata)["query_text"] is None
    assert json.loads(rows["d"].raw_metadata)["query_text_preview"] == ""
    assert len(json.loads(rows["q"].raw_metadata)) == 10, "keys without a value are kept"


def test_recent_rows(spark):
    rows = [(str(d), datetime(2026, 8, d, 12)) for d in range(1, 13)]
    df = spark.createDataFrame(rows, "QUERY_ID string, START_TIME timestamp")
    assert nz.recent_rows(df, NOW, row_limit=None).count() == 8
    assert [r.QUERY_ID for r in nz.recent_rows(df, NOW, row_limit=2).collect()] == ["12", "11"]


def test_metering(spark):
    rows = [("WH", datetime(2026, 8, 1, 5), datetime(2026, 8, 1, 6), 0.5, 0.4, 0.1), (None, None, None, None, None, None)]
    got = nz.normalize_warehouse_metering(spark.createDataFrame(rows, sc.METERING_ROW), NOW).collect()
    assert [r.resource_id for r in got] == ["WH::2026-08-01T05:00:00+00:00", "None::unknown"]
    assert (got[0].usage_quantity, got[0].usage_unit) == (0.5, "credits") and got[1].usage_date == date(2026, 8, 12)


def run(run_id, own=None, tasks=None, cluster=None, ms=3_600_000, start=1_785_542_400_000, job=7):
    return (run_id, job, "etl", None, start, ms, ("TERMINATED", "SUCCESS", ""), (own,), tasks, (cluster,))


def test_job_runs(spark):
    runs = [
        run(1, own=("i3.xlarge", 1)),
        run(2, tasks=[(None,), (("m5.large", 3),)], ms=7_200_000),
        run(3, cluster="c1"),
        run(4, cluster="gone"),
        run(5),
        run(6, own=("odd.type", None), ms=7_200_000),
        run(7, own=("i3.xlarge", 1), ms=0, start=None, job=None),
        run(8, own=("", 1)),
        run(9, cluster=""),
    ]
    clusters = spark.createDataFrame([("c1", "c5.xlarge", 0), (None, "x", 1)], sc.CLUSTER_ROW)
    records = nz.normalize_job_runs(spark.createDataFrame(runs, sc.JOB_RUN_PAYLOAD), clusters, NOW)
    rows = {int(r.resource_id): r for r in records.collect()}
    meta = {k: json.loads(r.raw_metadata) for k, r in rows.items()}
    assert {k: m["cluster_source"] for k, m in meta.items()} == {
        1: "job_new_cluster",
        2: "task_new_cluster",
        3: "existing_cluster_lookup",
        4: "cluster_lookup_failed",
        5: "no_cluster_info_available",
        6: "job_new_cluster",
        7: "job_new_cluster",
        8: "job_new_cluster",
        9: "no_cluster_info_available",
    }
    assert {k: r.cost_usd for k, r in rows.items()} == {1: 0.924, 2: 1.968, 3: 0.32, 4: None, 5: None, 6: 0.70, 7: None, 8: None, 9: None}
    assert rows[1].cost_basis == "estimated_list_price" and rows[4].cost_basis is None
    assert rows[7].usage_date == date(2026, 8, 12) and rows[7].period_end is None and rows[7].account_identifier == ""
    assert rows[1].period_end - rows[1].period_start == datetime(2026, 1, 1, 1) - datetime(2026, 1, 1)
    assert (rows[2].usage_quantity, rows[2].usage_unit) == (2.0, "cluster_hours")
    assert "fallback" in meta[6]["pricing_note"] and "listed" in meta[1]["pricing_note"]
    assert [r.cluster_id for r in nz.distinct_cluster_ids(records).collect()] == ["c1", "gone"]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_lookup_join_plans_agree(spark, broadcast_bytes):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else (None if i % 2 else f"k{i}")) for i in range(90)], "i int, k string")
    table = spark.createDataFrame([("hot", 1), ("k0", 2), (None, 9)], "k string, v int")
    got = {r.i: r.v for r in lookup_join(rows, table, "k", broadcast_bytes=broadcast_bytes).collect()}
    assert got == {i: 1 if i % 3 else (2 if i == 0 else None) for i in range(90)}


def test_own_price_list(spark):
    df = spark.createDataFrame([("mine", 0, 3_600_000)], "n string, w bigint, ms bigint")
    cost = lambda prices: df.select(estimate_cost(df.n, df.w, df.ms, prices=prices)[0].alias("c")).first().c
    assert cost({"mine": Decimal("1.00")}) == Decimal("1.15") and cost({}) == Decimal("0.35")


def test_cluster_events(spark):
    payload = [("c1", [(1_785_542_400_000, "START", {"a": "b"}), (None, "X", None)])]
    rows = nz.normalize_cluster_events(spark.createDataFrame(payload, sc.CLUSTER_EVENTS_PAYLOAD), NOW).collect()
    assert [r.resource_id for r in rows] == ["c1::1785542400000", "c1::None"]
    assert rows[0].usage_date == date(2026, 8, 1) and rows[1].usage_date == date(2026, 8, 12)
    assert json.loads(rows[1].raw_metadata) == {"type": "X", "details": {}}
    assert rows[0].cost_usd is None


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_days_are_utc_days_in_every_session_zone(spark, zone):
    """Moments around a UTC midnight and in an hour that New York's clocks leave out."""
    before = spark.conf.get("spark.sql.session.timeZone")
    epoch = lambda *at: int(datetime(*at, tzinfo=timezone.utc).timestamp() * 1000)
    moments = [epoch(2026, 8, 1, 0, 30), epoch(2026, 8, 1, 23, 30), epoch(2026, 3, 8, 2, 30), epoch(2026, 3, 8, 7, 30), epoch(1969, 12, 31, 23, 59)]
    days = ["2026-08-01", "2026-08-01", "2026-03-08", "2026-03-08", "1969-12-31"]
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        at = spark.createDataFrame([(m,) for m in moments], "ms long").selectExpr("timestamp_millis(ms) AS at", "ms")
        history = at.selectExpr(*[f"{'at' if f.name == 'START_TIME' else f'CAST(NULL AS {f.dataType.simpleString()})'} AS {f.name}" for f in sc.QUERY_HISTORY_ROW])
        metering = at.selectExpr(*[f"{'at' if f.name == 'START_TIME' else f'CAST(NULL AS {f.dataType.simpleString()})'} AS {f.name}" for f in sc.METERING_ROW])
        runs = spark.createDataFrame([{"run_id": i, "start_time": m} for i, m in enumerate(moments)], sc.JOB_RUN_PAYLOAD)
        events = spark.createDataFrame([("c", [(m, "START", None)]) for m in moments], sc.CLUSTER_EVENTS_PAYLOAD)
        clusters = spark.createDataFrame([], sc.CLUSTER_ROW)
        for records in (
            nz.normalize_query_history(history, NOW),
            nz.normalize_warehouse_metering(metering, NOW),
            nz.normalize_job_runs(runs, clusters, NOW),
            nz.normalize_cluster_events(events, NOW),
        ):
            assert sorted(str(r.usage_date) for r in records.collect()) == sorted(days)
        late = nz.normalize_query_history(history.withColumn("START_TIME", F.lit(None).cast("timestamp")), NOW.replace(hour=23))
        assert {str(r.usage_date) for r in late.collect()} == {"2026-08-12"}
        ids = [r.resource_id for r in nz.normalize_warehouse_metering(metering, NOW).collect()]
        assert sorted(ids)[0] == "None::1969-12-31T23:59:00+00:00" and "None::2026-03-08T02:30:00+00:00" in ids
        forecast = spark.createDataFrame([({"Amount": "1", "Unit": "USD"}, [])], sc.COST_FORECAST_PAYLOAD)
        bounds = nz.normalize_cost_forecast(forecast, NOW, date(2026, 8, 12)).selectExpr("unix_millis(period_start)", "unix_millis(period_end)").first()
        assert tuple(bounds) == (epoch(2026, 8, 13), epoch(2026, 9, 1))
        exact = spark.sql("SELECT timestamp_micros(1785542400000007) AS t").select(iso_moment(F.col("t"))).first()[0]
        assert exact == "2026-08-01T00:00:00.000007+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("hot_parts", [1, 10, 1000])
def test_lookup_join_copies_rows_of_hot_keys_only(spark, hot_parts):
    keys = ["hot"] * 300 + [f"k{i}" for i in range(50)] + [None] * 40 + ["unknown"]
    rows = spark.createDataFrame(list(enumerate(keys)), "i int, k string").repartition(3)
    table = spark.createDataFrame([("hot", 1), (None, 9)] + [(f"k{i}", i) for i in range(40)], "k string, v int")
    joined = lookup_join(rows, table, "k", broadcast_bytes=0, hot_parts=hot_parts)
    want = {i: 1 if k == "hot" else int(k[1:]) if k and k[1:].isdigit() and int(k[1:]) < 40 else None for i, k in enumerate(keys)}
    assert {r.i: r.v for r in joined.collect()} == want and joined.count() == len(keys)
    empty = lookup_join(rows.limit(0), table, "k", broadcast_bytes=0)
    assert empty.count() == 0 and set(empty.columns) == {"i", "k", "v"}
    assert lookup_join(rows, table.limit(0), "k", broadcast_bytes=0).filter("v IS NULL").count() == len(keys)


def test_newest_records(spark):
    at = lambda d: datetime(2026, 8, d)
    rows = [
        ("aws", "t", "a", at(1), 1.0, "x"),
        ("aws", "t", "a", at(3), None, "y"),
        ("aws", "t", "a", at(2), 9.0, "z"),
        ("aws", "u", "a", None, 4.0, None),
        ("aws", "u", "b", at(1), 4.0, "p"),
        ("aws", "u", "b", at(1), 5.0, "o"),
        ("aws", "u", "b", at(1), 5.0, "o"),
        ("aws", "u", None, at(1), 5.0, "o"),
        ("aws", "u", None, at(1), 5.0, "o"),
        (None, None, "c", None, None, None),
    ]
    df = spark.createDataFrame(rows, "source string, resource_type string, resource_id string, ingested_at timestamp, cost_usd double, extra string")
    got = newest_records(df)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, df.coalesce(1).filter("cost_usd IS NULL OR cost_usd = 4.0 AND extra IS NULL OR cost_usd = 5.0").dropDuplicates().union(df.filter("resource_id IS NULL").limit(1)).collect()))
    assert newest_records(df.limit(0)).count() == 0
