import os
import time
from datetime import date, datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyspark.operators.enrich import enrich_events
from tallyspark.operators.forecast import billed_run_rate
from tallyspark.operators.rules import cost_gap_facts, query_text_stats
from tallyspark.schema import RECORD_COLUMNS
from tallyspark.sources import outputs as out
from tallyspark.sources import raw_store as rs
from tallyspark.sources.materialize import materialize, shared_folder

DAY = date(2026, 8, 12)
SAMPLE = {
    "source": "aws",
    "resource_type": "cost_explorer_daily_service",
    "resource_id": "2026-08-01::AmazonS3",
    "usage_date": date(2026, 8, 1),
    "service": "AmazonS3",
    "cost_usd": 0.01,
    "cost_basis": "billed",
    "usage_quantity": 3.0,
    "usage_unit": "GB-Month",
    "ingested_at": datetime(2026, 8, 12, 12, tzinfo=timezone.utc),
}
SCHEMA = "source string, resource_type string, resource_id string, usage_date date, service string, cost_usd double, cost_basis string, usage_quantity double, usage_unit string, ingested_at timestamp, raw_metadata struct<nested: struct<a: int>, decimal_like: double>"


def records(spark, count=1, **changes):
    row = SAMPLE | changes | {"raw_metadata": ((1,), 1.5)}
    names = [f.split()[0] for f in SCHEMA.split(", ")[:10]] + ["raw_metadata"]
    return spark.createDataFrame([tuple(row[n] for n in names)] * count, SCHEMA)


def write(df, root, source="aws", table="cost_and_usage", day=DAY):
    return rs.write_records(df, source=source, table=table, output_dir=str(root), ingested_date=day)


def test_empty_batch_writes_nothing(spark, tmp_path):
    assert write(records(spark).limit(0), tmp_path) is None
    assert not list(tmp_path.rglob("*.parquet"))


def test_batches_append_in_their_partition(spark, tmp_path):
    assert write(records(spark, 2), tmp_path).endswith("aws/cost_and_usage/ingested_date=2026-08-12")
    write(records(spark), tmp_path)
    write(records(spark, source="snowflake", resource_type="query"), tmp_path, "snowflake", "query_history", date(2026, 8, 13))
    assert os.listdir(tmp_path / "aws") == ["cost_and_usage"]
    store = rs.read_raw_store(spark, str(tmp_path))
    assert store.columns == RECORD_COLUMNS and store.count() == 4
    assert {(r.source, r.table): r.record_count for r in rs.table_counts(store).collect() if r.record_count} == {
        ("aws", "cost_and_usage"): 3,
        ("snowflake", "query_history"): 1,
    }
    assert rs.table_counts(store).count() == 6
    assert rs.read_raw_store(spark, str(tmp_path), tables=[("snowflake", "query_history")]).count() == 1
    kept = rs.read_raw_store(spark, str(tmp_path), ingested_since=date(2026, 8, 13), keep_ingested_date=True)
    assert [(r.source, r.ingested_date) for r in kept.collect()] == [("snowflake", date(2026, 8, 13))]


def test_record_round_trip(spark, tmp_path):
    write(records(spark), tmp_path)
    row = rs.read_raw_store(spark, str(tmp_path)).first()
    assert (row.usage_date, row.cost_usd, row.account_identifier) == (date(2026, 8, 1), 0.01, None)
    assert row.raw_metadata == '{"nested":{"a":1},"decimal_like":1.5}'
    assert row.ingested_at == datetime(2026, 8, 12, 12)
    stored = spark.read.parquet(str(tmp_path / "aws" / "cost_and_usage")).first()
    assert (stored.usage_date, stored.ingested_at) == ("2026-08-01", "2026-08-12T12:00:00+00:00")


def test_unknown_columns_and_missing_store(spark, tmp_path):
    with pytest.raises(ValueError):
        write(records(spark).withColumnRenamed("service", "servise"), tmp_path)
    with pytest.raises(FileNotFoundError):
        rs.read_raw_store(spark, str(tmp_path / "nowhere"))


def test_sources_are_chosen_by_directory_and_kept_apart(spark, tmp_path):
    write(records(spark), tmp_path)
    write(records(spark, source="snowflake"), tmp_path, "snowflake", "query_history")
    assert [r.source for r in rs.read_raw_store(spark, str(tmp_path), sources=["snowflake"]).collect()] == ["snowflake"]
    with pytest.raises(Exception, match="has the source snowflake"):
        write(records(spark, source="snowflake"), tmp_path)
    assert rs.read_raw_store(spark, str(tmp_path)).count() == 2


def test_files_of_different_physical_types(spark, tmp_path):
    """All-null columns come as null or int32 from other writers; text may be no date."""

    def put(table, cost, dates):
        folder = tmp_path / "aws" / table / "ingested_date=2026-08-12"
        folder.mkdir(parents=True)
        data = {c: pa.nulls(len(dates), pa.string()) for c in RECORD_COLUMNS}
        data |= {"source": pa.array(["aws"] * len(dates)), "cost_usd": cost, "usage_quantity": pa.nulls(len(dates)), "usage_date": pa.array(dates)}
        pq.write_table(pa.table(data), folder / f"{table}-1.parquet")

    put("t_null", pa.nulls(1), ["2026-08-01"])
    put("t_int", pa.array([None, 7], pa.int32()), ["2026-08-01", "not a date"])
    put("t_double", pa.array([0.5]), ["2026-08-02T10:00:00Z"])
    rows = rs.read_raw_store(spark, str(tmp_path)).collect()
    assert sorted((r.cost_usd, r.usage_date) for r in rows if r.cost_usd is not None and r.usage_date) == [(0.5, date(2026, 8, 2))]
    assert [r.usage_date for r in rows if r.cost_usd == 7.0] == [None] and len(rows) == 4
    assert spark.conf.get("spark.sql.parquet.enableVectorizedReader") == "true"


def test_date_bounds_are_exact_and_pushed(spark, tmp_path):
    for day in (1, 2, 3):
        write(records(spark, usage_date=date(2026, 8, day)), tmp_path)
    some = rs.read_raw_store(spark, str(tmp_path), since=date(2026, 8, 2), until=date(2026, 8, 2))
    assert [r.usage_date for r in some.collect()] == [date(2026, 8, 2)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(usage_date,2026-08-02)" in plan and "LessThan(usage_date,2027)" in plan


def test_output_partitions(spark, tmp_path):
    root = str(tmp_path)
    assert out.read_latest(spark, root, "t").count() == 0 and out.store_run_date(spark, root) is None
    df = spark.range(5).withColumnRenamed("id", "n")
    assert out.write_outputs({"t": df}, root, date(2026, 8, 11)) == {"t": 5}
    out.write_outputs({"t": df.limit(2)}, root, date(2026, 8, 12))
    assert out.run_dates(spark, root, "t") == ["2026-08-11", "2026-08-12"]
    assert out.read_latest(spark, root, "t").count() == 2
    out.write_outputs({"t": df.limit(0)}, root, date(2026, 8, 12))
    assert out.read_latest(spark, root, "t").count() == 0, "a rerun without rows replaces the partition"
    assert out.read_all(spark, root, "t").count() == 5


def test_materialized_table_lies_in_the_shared_folder(spark):
    df = materialize(spark.range(10).selectExpr("id", "id % 2 AS k"))
    assert df.filter("k = 1").count() == 5
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,1)]" in df.filter("k = 1")._jdf.queryExecution().executedPlan().toString()


def test_bounds_keep_dates_of_one_digit(spark, tmp_path):
    stored = ["2026-8-1", "2026-08-31", "2026-8-9", "2026-09-01", "2026-10-02", "2025-12-31", "2026-1-5"]
    rows = [{c: None for c in RECORD_COLUMNS} | {"source": "aws", "usage_date": d} for d in stored]
    folder = tmp_path / "aws" / "cost_and_usage" / "ingested_date=2026-08-12"
    folder.mkdir(parents=True)
    table = pa.Table.from_pylist(rows, pa.schema([(c, pa.string() if c not in ("cost_usd", "usage_quantity") else pa.float64()) for c in RECORD_COLUMNS]))
    pq.write_table(table, folder / "part.parquet")
    got = rs.read_raw_store(spark, str(tmp_path), since=date(2026, 8, 1), until=date(2026, 8, 31)).collect()
    assert sorted(r.usage_date.day for r in got) == [1, 9, 31]
    early = rs.read_raw_store(spark, str(tmp_path), since=date(2026, 1, 1), until=date(2026, 8, 1)).collect()
    assert sorted(r.usage_date for r in early) == [date(2026, 1, 5), date(2026, 8, 1)]


def scans(df):
    """Table directories that the optimized plan reads."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("parquet")


def test_a_filter_on_source_leaves_other_directories_out_of_the_plan(spark, tmp_path):
    for source, table in (("aws", "cost_and_usage"), ("aws", "cost_forecast"), ("snowflake", "query_history"), ("databricks", "job_runs")):
        write(records(spark, source=source, resource_type=table), tmp_path, source, table)
    store = rs.read_raw_store(spark, str(tmp_path))
    events = enrich_events(store)
    assert scans(store) == 4 and {r.source for r in store.collect()} == {"aws", "snowflake", "databricks"}
    assert scans(events.filter("source = 'databricks'")) == 1
    assert scans(cost_gap_facts(events)) == 1
    assert scans(query_text_stats(events)) <= 2
    assert scans(billed_run_rate(events, date(2026, 8, 12))) == 2
    assert scans(store.filter("source = 'elsewhere'")) == 0
    assert scans(store.filter("source IN ('aws', 'snowflake')").groupBy("source").count()) == 3


def test_rows_of_a_file_are_sorted_by_date(spark, tmp_path):
    days = [3, 1, 2]
    parts = [records(spark, usage_date=date(2026, 8, d)) for d in days]
    write(parts[0].union(parts[1]).union(parts[2]).coalesce(1), tmp_path)
    (stored,) = (tmp_path / "aws" / "cost_and_usage").rglob("*.parquet")
    assert pq.read_table(stored)["usage_date"].to_pylist() == ["2026-08-01", "2026-08-02", "2026-08-03"]


def test_a_batch_of_one_task_and_day_is_sorted_in_parts(spark, tmp_path):
    sizes = [f"spark.sql.adaptive.{x}" for x in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")]
    for size in sizes:
        spark.conf.set(size, "64k")
    try:
        day = records(spark).withColumn("resource_id", F.explode(F.sequence(F.lit(1), F.lit(20_000))))
        write(day.withColumn("service", F.sha2(F.col("resource_id").cast("string"), 256)).coalesce(1), tmp_path)
    finally:
        for size in sizes:
            spark.conf.unset(size)
    assert len(list(tmp_path.rglob("*.parquet"))) > 1
    assert rs.read_raw_store(spark, str(tmp_path)).select("resource_id").distinct().count() == 20_000


def test_shuffle_files_go_when_a_table_is_written(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def shuffle_bytes():
        dirs = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()]
        return sum(os.path.getsize(os.path.join(at, f)) for d in dirs for at, _, files in os.walk(d) for f in files if f.endswith(".data"))

    before = shuffle_bytes()
    rows = spark.range(200_000).withColumn("k", F.xxhash64("id")).repartition(4, "k")
    assert materialize(rows, "shuffled").count() == 200_000
    for _ in range(50):  # files go in the background
        if shuffle_bytes() < before + 100_000:
            break
        time.sleep(0.1)
    assert shuffle_bytes() < before + 100_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
