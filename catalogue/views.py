"""Adapter views: the test tables read as landed payloads and usage records.

- ``lineitem`` (joined to ``supplier`` and ``nation``) gives daily cloud cost per service;
- ``events`` gives warehouse query history, hourly metering and cluster events;
- ``orders`` gives job runs, ``customer`` the cluster dump they refer to.

The records are landed in a raw store, each table once per session and when a query first
reads it; from the store the queries read like any user of the library. Money and quantities are then cast to decimals, so sums are exact
and the comparison with another engine does not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import fixed_values as fv
from tallyspark.operators.enrich import enrich_events
from tallyspark.operators.normalize import normalize_query_history, normalize_warehouse_metering
from tallyspark.operators.pricing import estimate_cost, hours_of_ms
from tallyspark.sources.materialize import new_path
from tallyspark.sources.raw_store import read_raw_store, write_records
from tallyspark.schema import (
    CLUSTER_EVENTS_PAYLOAD,
    COST_AND_USAGE_PAYLOAD,
    COST_FORECAST_PAYLOAD,
    DIMENSION_PAYLOAD,
    JOB_RUN_PAYLOAD,
    RECORD_COLUMNS,
)

NOW = datetime(2024, 1, 31, 12, 0, 0, tzinfo=timezone.utc)
COST_AS_OF = date(1998, 5, 20)
UNIT_AS_OF = date(2024, 1, 20)
WINDOW = (date(1998, 5, 1), date(1998, 5, 15))
MONEY = "decimal(18,4)"


# a view is defined once per session and data set
view = lru_cache(maxsize=None)

# columns of the test tables that are used; a given schema saves a job per read
TABLES = {
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def hundredths(amount: Column) -> Column:
    """An amount with two decimals as a whole number of hundredths."""
    return F.round(amount * 100).cast("bigint")


def _in_units(total: Column, unit: str) -> Column:
    return (total.cast("decimal(18,0)") * F.lit(Decimal(unit))).cast(MONEY)


def _exact(records: DataFrame) -> DataFrame:
    return records.withColumns({c: F.col(c).cast(MONEY) for c in ("cost_usd", "usage_quantity")})


def _complete(df: DataFrame, **columns: Column) -> DataFrame:
    """Canonical columns from the given ones; the rest is null text."""
    given = {"ingested_at": F.lit(NOW), **columns}
    kinds = {"cost_usd": MONEY, "usage_quantity": MONEY, "usage_date": "date"} | {
        c: "timestamp" for c in ("period_start", "period_end", "ingested_at")
    }
    return df.select(*[given.get(c, F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in RECORD_COLUMNS])


# --- cloud cost from lineitem -------------------------------------------------------------


@view
def daily_service_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(service, usage_date, cost_usd, usage_quantity) of shipped items by supplier nation."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.to_date("l_shipdate").alias("usage_date"),
        (hundredths(F.col("l_extendedprice")) * (100 - hundredths(F.col("l_discount")))).alias("cost"),
        hundredths(F.col("l_quantity")).alias("quantity"),
    )
    suppliers, nations = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return (
        items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("service"), "usage_date")
        .agg(
            _in_units(F.sum("cost"), "0.0001").alias("cost_usd"),
            _in_units(F.sum("quantity"), "0.01").alias("usage_quantity"),
        )
    )


@view
def landing_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _complete(
        daily_service_cost(spark, sf_dir),
        source=F.lit(fv.AWS),
        resource_type=F.lit("cost_explorer_daily_service"),
        resource_id=F.concat(F.col("usage_date").cast("string"), F.lit("::"), "service"),
        usage_date=F.col("usage_date"),
        service=F.col("service"),
        cost_usd=F.col("cost_usd"),
        cost_basis=F.lit(fv.BILLED),
        usage_quantity=F.col("usage_quantity"),
        usage_unit=F.lit("items"),
    )


@view
def landing_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections of a provider forecast, the newer one twice the shipped value of the month."""
    month = table(spark, sf_dir, "lineitem").filter(
        F.to_date("l_shipdate").between(F.lit("1998-05-01").cast("date"), F.lit(COST_AS_OF))
    )
    total = month.agg(_in_units(F.sum(hundredths(F.col("l_extendedprice"))), "0.01").alias("total"))
    collections = total.select("total", F.explode(F.array(F.lit(1), F.lit(2))).alias("age"))
    return _complete(
        collections,
        source=F.lit(fv.AWS),
        resource_type=F.lit("cost_forecast"),
        resource_id=F.lit("1998-05-21::1998-06-01"),
        usage_date=F.lit("1998-05-21"),
        period_start=F.lit("1998-05-21").cast("date"),
        period_end=F.lit("1998-06-01").cast("date"),
        cost_usd=F.col("total") * F.col("age"),
        cost_basis=F.lit(fv.FORECAST),
        usage_unit=F.lit("USD"),
        ingested_at=F.when(F.col("age") == 2, F.lit(NOW)).otherwise(F.lit(NOW) - F.expr("INTERVAL 1 DAY")),
    )


@view
def flat_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charges per shipped item of a supplier.

    Every third supplier charges a fixed fee, some with a surcharge on single items;
    items with line number 7 have no cost.
    """
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    key = F.col("l_suppkey")
    fee = (key % 40 + 1) * F.lit(0.25).cast("decimal(6,2)")
    surcharge = F.when((key % 6 == 0) & ((F.col("l_orderkey") + F.col("l_linenumber")) % 499 == 0), F.lit(1)).otherwise(0)
    cost = F.when(key % 3 == 0, fee + surcharge).otherwise(F.col("l_extendedprice").cast("decimal(12,2)"))
    return _complete(
        items.join(suppliers, key == F.col("s_suppkey")),
        source=F.lit(fv.AWS),
        resource_type=F.lit("cost_explorer_daily_service"),
        resource_id=F.concat("l_orderkey", F.lit("-"), "l_linenumber"),
        usage_date=F.to_date("l_shipdate"),
        service=F.concat(F.lit("SVC_"), key),
        cost_usd=F.when(F.col("l_linenumber") != 7, cost),
        cost_basis=F.lit(fv.BILLED),
    )


# --- warehouse queries from events ------------------------------------------------------------


@view
def query_history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as a query-history dump has them."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    # long texts with one beginning, which name their table, and some a filter, after the preview
    long = F.concat(F.lit("SELECT "), F.repeat(F.lit("some_column, "), 50), F.lit("a FROM SNOWFLAKE_SAMPLE_DATA.T"), k)
    text = (
        F.when(k % 16 == 0, long)
        .when(k % 16 == 8, F.concat(long, F.lit(" WHERE x = "), F.col("event_id") % 3))
        .when(k % 4 == 0, F.concat(F.lit("SELECT * FROM SNOWFLAKE_SAMPLE_DATA.T"), k))
        .when(k % 4 == 1, F.concat(F.lit("SELECT a FROM SNOWFLAKE_SAMPLE_DATA.T"), k, F.lit(" where x = 1")))
        .when(k % 4 == 2, F.lit("SHOW TABLES"))
        .otherwise(F.lit("SELECT CURRENT_USER() FROM dual"))
    )
    started = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").cast("string").alias("QUERY_ID"),
        text.alias("QUERY_TEXT"),
        F.when(k % 4 == 2, "SHOW").otherwise("SELECT").alias("QUERY_TYPE"),
        F.lit("LAKE").alias("DATABASE_NAME"),
        F.lit("PUBLIC").alias("SCHEMA_NAME"),
        F.concat(F.lit("WH_"), F.upper("event_type")).alias("WAREHOUSE_NAME"),
        F.lit("X-Small").alias("WAREHOUSE_SIZE"),
        F.when(F.col("event_id") % 10 == 0, "FAIL").otherwise("SUCCESS").alias("EXECUTION_STATUS"),
        started.alias("START_TIME"),
        (started + F.expr("INTERVAL 1 SECOND") * (F.col("event_id") % 60)).alias("END_TIME"),
        F.col("value").alias("TOTAL_ELAPSED_TIME"),
        F.when(k % 5 != 0, (F.col("event_id") % 1000) * 1024).cast("double").alias("BYTES_SCANNED"),
        (F.col("event_id") % 100).cast("double").alias("ROWS_PRODUCED"),
        F.lit(None).cast("double").alias("CREDITS_USED_CLOUD_SERVICES"),
    )


@view
def extreme_doubles(spark: SparkSession, sf: str) -> DataFrame:
    """Event values near 1 in groups of their own spread, with one event in each far above them, and odd ones.

    The far value is 10^4, 10^6 and so on up to 10^12; every 1,000th event is not a number or is infinite.
    """
    events = table(spark, sf, "events")
    key, grp = F.col("event_id"), F.pmod(F.col("event_id"), F.lit(5)).cast("int")
    near = 1 + (key % 97) * 0.001
    far = F.element_at(F.array(*[F.lit(10.0**e) for e in (4, 6, 8, 10, 12)]), grp + 1)
    odd = F.when(key % 2000 == 0, float("nan")).otherwise(float("inf"))
    value = F.when(key < 5, far).when(key % 1000 == 0, odd).otherwise(near)
    return events.select(key, grp.alias("grp"), value.alias("val"))


@view
def flat_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grp, val): events by user group; its value is the same in all but the first event of odd groups."""
    grp = F.pmod(F.col("event_id"), F.lit(4)).cast("int")
    level = F.element_at(F.array(*[F.lit(x) for x in (0.1, 123.45, 12345.67, 7654321.09)]), grp + 1)
    one_off = (grp % 2 == 1) & (F.col("event_id") < 4)
    return table(spark, sf_dir, "events").select(
        grp.alias("grp"), F.when(one_off, level * F.lit(1.0000001)).otherwise(level).alias("val")
    )


@view
def metering_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits per warehouse and hour: one hundredth of the milliseconds."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    credits = _in_units(F.sum(hundredths(F.col("value"))), "0.0001")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.concat(F.lit("WH_"), F.upper("event_type")).alias("WAREHOUSE_NAME"), hour.alias("START_TIME"))
        .agg(credits.alias("CREDITS_USED"))
        .withColumn("END_TIME", F.col("START_TIME") + F.expr("INTERVAL 1 HOUR"))
        .withColumn("CREDITS_USED_COMPUTE", F.col("CREDITS_USED"))
        .withColumn("CREDITS_USED_CLOUD_SERVICES", F.lit(None).cast("double"))
    )


@view
def landing_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact(normalize_query_history(query_history_rows(spark, sf_dir), NOW))


@view
def landing_metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact(normalize_warehouse_metering(metering_rows(spark, sf_dir), NOW))


@view
def cluster_event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lifecycle events per user event; some of the second have no time."""
    k = F.get_json_object("props", "$.k").cast("int")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    details = F.create_map(F.lit("k"), k.cast("string"))
    kind = CLUSTER_EVENTS_PAYLOAD["events"].dataType
    started = F.struct(ms.alias("timestamp"), F.lit("STARTING").alias("type"), details.alias("details"))
    running = F.struct(
        F.when(k % 7 != 0, ms + 1000).alias("timestamp"),
        F.lit("RUNNING").alias("type"),
        F.lit(None).cast("map<string,string>").alias("details"),
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("c-"), "user_id").alias("cluster_id"), F.array(started, running).cast(kind).alias("events")
    )


# --- job runs from orders ------------------------------------------------------------------------


def _node_type(priority: Column) -> Column:
    return (
        F.when(priority == "1", "i3.xlarge")
        .when(priority == "2", "m5.large")
        .when(priority == "3", "r5.xlarge")
        .when(priority == "4", "x9.custom")
    )


@view
def job_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, run_id, run_name, started, run_ms, workers, node_type, state)."""
    order = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("job_id"),
        order.alias("run_id"),
        F.concat(F.lit("job_"), F.col("o_custkey") % 40).alias("run_name"),
        F.col("o_orderdate").cast("timestamp").alias("started"),
        ((order % 7200) * 1000).alias("run_ms"),
        (order % 8).alias("workers"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.col("o_orderstatus").alias("state"),
    ).withColumn("node_type", _node_type(F.col("priority")))


@view
def landing_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = job_rows(spark, sf_dir)
    cost, basis, _ = estimate_cost(F.col("node_type"), F.col("workers"), F.col("run_ms"))
    ended = F.when(F.col("run_ms") > 0, F.timestamp_millis(F.unix_millis("started") + F.col("run_ms")))
    metadata = F.to_json(
        F.struct(
            F.col("state").alias("result_state"),
            F.lit("TERMINATED").alias("life_cycle_state"),
            F.col("node_type").alias("node_type_id"),
            F.when(F.col("node_type").isNotNull(), "job_new_cluster")
            .otherwise("no_cluster_info_available")
            .alias("cluster_source"),
        )
    )
    return _complete(
        runs,
        source=F.lit(fv.DATABRICKS),
        resource_type=F.lit("job_run"),
        resource_id=F.col("run_id"),
        account_identifier=F.col("job_id"),
        usage_date=F.to_date("started"),
        period_start=F.col("started"),
        period_end=ended,
        service=F.col("run_name"),
        cost_usd=cost,
        cost_basis=basis,
        usage_quantity=hours_of_ms(F.col("run_ms")),
        usage_unit=F.lit("cluster_hours"),
        raw_metadata=metadata,
    )


@view
def job_run_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job runs as the jobs API lists them; where the cluster is described depends on the priority."""
    runs = job_rows(spark, sf_dir)
    kinds = {f.name: f.dataType for f in JOB_RUN_PAYLOAD}
    cluster = F.struct(F.col("node_type").alias("node_type_id"), F.col("workers").alias("num_workers"))
    priority = F.col("priority")
    none = F.lit(None)
    values = {
        "run_id": F.col("run_id"),
        "job_id": F.col("job_id"),
        "run_name": F.col("run_name"),
        "run_page_url": none,
        "start_time": F.when(F.col("run_id") % 11 != 0, F.unix_millis("started")),
        "run_duration": F.nullif(F.col("run_ms"), F.lit(0)),
        "state": F.struct(F.lit("TERMINATED"), F.col("state"), F.lit("")),
        "cluster_spec": F.struct(F.when(priority.isin("1", "2"), cluster)),
        "tasks": F.array(F.struct(none.cast(kinds["tasks"].elementType["new_cluster"].dataType)), F.struct(F.when(priority == "3", cluster))),
        "cluster_instance": F.when(priority == "4", F.struct(F.concat(F.lit("c-"), F.col("job_id")))),
    }
    return runs.select(*[values[c].cast(kind).alias(c) for c, kind in kinds.items()])


@view
def cluster_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing clusters, one per customer; every fifth is gone."""
    return table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 5 != 0).select(
        F.concat(F.lit("c-"), "c_custkey").alias("cluster_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "c5.xlarge").otherwise("m4.large").alias("node_type_id"),
        (F.col("c_nationkey") % 8).cast("long").alias("num_workers"),
    )


# --- billing payloads --------------------------------------------------------------------------------


@view
def billing_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per day with a group per service, as many as there are nations.

    Services that start with U come without a name.
    """
    kind = COST_AND_USAGE_PAYLOAD["ResultsByTime"].dataType
    service = F.col("service")
    group = F.struct(
        F.when(service.startswith("U"), F.array().cast("array<string>")).otherwise(F.array(service)),
        F.struct(
            F.struct(F.col("cost_usd").cast("string"), F.lit("USD")),
            F.when(service != "FRANCE", F.struct(F.col("usage_quantity").cast("string"), F.lit("items"))),
        ),
    )
    days = daily_service_cost(spark, sf_dir).groupBy("usage_date").agg(F.collect_list(group).alias("groups"))
    period = F.struct(F.col("usage_date").cast("string"), F.date_add("usage_date", 1).cast("string"))
    return days.select(F.array(F.struct(period, F.col("groups"))).cast(kind).alias("ResultsByTime"))


@view
def forecast_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {f.name: f.dataType for f in COST_FORECAST_PAYLOAD}
    total = table(spark, sf_dir, "lineitem").agg(
        _in_units(F.sum(hundredths(F.col("l_extendedprice"))), "0.01").alias("t")
    )
    return total.select(
        F.struct(F.col("t").cast("string"), F.lit("USD")).cast(kinds["Total"]).alias("Total"),
        F.array().cast(kinds["ForecastResultsByTime"]).alias("ForecastResultsByTime"),
    )


@view
def dimension_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Services with cost in the window, at most one per nation."""
    kind = DIMENSION_PAYLOAD["DimensionValues"].dataType
    active = daily_service_cost(spark, sf_dir).filter(F.col("usage_date").between(*[F.lit(d) for d in WINDOW]))
    entry = F.struct(F.when(~F.col("service").startswith("U"), F.col("service")), F.lit(None).cast("map<string,string>"))
    return active.select("service").distinct().agg(F.collect_list(entry).cast(kind).alias("DimensionValues"))


# --- everything together ------------------------------------------------------------------------------


LANDING = {
    (fv.AWS, "cost_and_usage"): landing_cost,
    (fv.AWS, "cost_forecast"): landing_forecast,
    (fv.SNOWFLAKE, "query_history"): landing_queries,
    (fv.SNOWFLAKE, "warehouse_metering_history"): landing_metering,
    (fv.DATABRICKS, "job_runs"): landing_jobs,
}


def land(spark: SparkSession, sf_dir: str, raw_dir: str, tables: Iterable[tuple[str, str]] = tuple(LANDING)) -> None:
    """Write the records of the tables, all of them unless named, to a raw store."""
    for source, name in tables:
        write_records(
            LANDING[source, name](spark, sf_dir), source=source, table=name, output_dir=raw_dir, ingested_date=NOW.date()
        )


@view
def _landed_root(spark: SparkSession, sf_dir: str) -> str:
    return new_path(spark, "landed")


@view
def landed_table(spark: SparkSession, sf_dir: str, source: str, name: str) -> str:
    """The raw store with at least this table, which is written once per session."""
    land(spark, sf_dir, _landed_root(spark, sf_dir), [(source, name)])
    return _landed_root(spark, sf_dir)


def landed_store(spark: SparkSession, sf_dir: str) -> str:
    """The raw store made from the test tables, each written once per session."""
    for source, name in LANDING:
        landed_table(spark, sf_dir, source, name)
    return _landed_root(spark, sf_dir)


@view
def twice_landed_store(spark: SparkSession, sf_dir: str) -> str:
    """The records, and a day later those of some days and runs again, with twice the cost."""
    raw_dir = new_path(spark, "landed-twice")
    later = NOW + timedelta(days=1)
    for (source, name), records in LANDING.items():
        first = records(spark, sf_dir)
        again = first.filter(F.day("usage_date") <= 10).withColumns(
            {"cost_usd": (F.col("cost_usd") * 2).cast(MONEY), "ingested_at": F.lit(later)}
        )
        for batch, at in ((first, NOW), (again, later)):
            write_records(batch, source=source, table=name, output_dir=raw_dir, ingested_date=at.date())
    return raw_dir


@view
def usage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact(read_raw_store(spark, landed_store(spark, sf_dir)))


@view
def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_events(usage_records(spark, sf_dir))


def _one_table(spark: SparkSession, sf_dir: str, source: str, name: str) -> DataFrame:
    return _exact(read_raw_store(spark, landed_table(spark, sf_dir, source, name), tables=[(source, name)]))


@view
def query_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_table(spark, sf_dir, fv.SNOWFLAKE, "query_history")


@view
def query_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_events(query_records(spark, sf_dir))


@view
def cost_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_table(spark, sf_dir, fv.AWS, "cost_and_usage")
