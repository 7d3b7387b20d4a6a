"""Three analyses for a notebook: query anomalies, billed run rate, repeated queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import MIN_REPEATS
from ..functions.text import text_identity, with_query_text
from ..operators.anomalies import condensed_query_anomalies, snowflake_queries
from ..operators.enrich import enrich_events
from ..operators.forecast import billed_run_rate
from ..sources.raw_store import read_raw_store


def repeated_texts(queries: DataFrame, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """Whole query texts by warehouse with run count and total time; console statements included."""
    selects = with_query_text(queries).filter((F.col("query_type") == "SELECT") & F.col("query_text").contains("FROM"))
    identity = text_identity(F.col("query_text"))
    return (
        selects.select("account_identifier", "usage_quantity", *[c.alias(name) for name, c in identity.items()])
        .groupBy("account_identifier", *identity)
        .agg(F.count(F.lit(1)).alias("run_count"), F.sum("usage_quantity").alias("total_ms"))
        .filter(F.col("run_count") >= min_repeats)
        .drop("text_digest")
    )


def quick_look(events: DataFrame, as_of: date) -> dict[str, DataFrame]:
    queries = snowflake_queries(events)
    return {
        "anomalies_snowflake_query_duration": condensed_query_anomalies(queries),
        "forecast_aws": billed_run_rate(events, as_of),
        "optimization_suggestions_repeated_query": repeated_texts(queries),
    }


def run(spark: SparkSession, raw_dir: str, output_dir: str, as_of: date | None = None) -> dict[str, DataFrame]:
    """The three analyses over a raw store, each written as one Parquet table."""
    results = quick_look(enrich_events(read_raw_store(spark, raw_dir)), as_of or date.today())
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/{name}")
    return results
