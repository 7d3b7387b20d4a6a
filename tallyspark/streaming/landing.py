"""Collect newly landed payload files only.

The collection job of ``plans.collect`` as a file stream: each run takes the payload
files that came since the last one (the checkpoint remembers them), normalizes them with
the same functions and appends them to the raw store through Spark's file sink, which
stores a retried batch once. All tables but job runs are projections of their own rows;
job runs look their clusters up in the static dump.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..fixed_values import DATABRICKS
from ..plans.collect import NORMALIZERS
from ..sources.payloads import PAYLOAD_SCHEMAS, payload_path, read_payloads
from ..sources.raw_store import to_stored


def start_collection(
    spark: SparkSession,
    landing_dir: str,
    raw_dir: str,
    checkpoint_dir: str,
    source: str,
    table: str,
    now: datetime,
    *,
    file_format: str = "json",
) -> StreamingQuery:
    """Start the stream of one table; it ends by itself when all landed files are done.

    The sink keeps a log of its files and readers go by that log, so a table is collected
    either by this stream or by the batch job, not by both.
    """
    rows = (
        spark.readStream.schema(PAYLOAD_SCHEMAS[source, table])
        .format(file_format)
        .load(payload_path(landing_dir, source, table))
    )
    payloads = {(source, table): rows}
    if (source, table) == (DATABRICKS, "job_runs"):
        payloads[DATABRICKS, "clusters"] = read_payloads(spark, landing_dir, DATABRICKS, "clusters", file_format)
    records = to_stored(NORMALIZERS[source, table](payloads, now))
    return (
        records.withColumn("ingested_date", F.lit(now.date()))
        .writeStream.format("parquet")
        .partitionBy("ingested_date")
        .option("path", f"{raw_dir.rstrip('/')}/{source}/{table}")
        .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{source}-{table}")
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )
