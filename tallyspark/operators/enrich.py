"""Usage records with attribution and metadata columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import AWS, DATABRICKS, METADATA_NUMBER_KEYS, METADATA_TEXT_KEYS, SNOWFLAKE
from ..functions.text import metadata_struct


def attribution_key() -> Column:
    """Who is charged: the service, else the account, else the resource itself."""
    return F.coalesce("service", "account_identifier", "resource_id")


def attribution_kind() -> Column:
    source, kind = F.col("source"), F.col("resource_type")
    return (
        F.when(source == AWS, "service")
        .when((source == SNOWFLAKE) & (kind == "query"), "query")
        .when((source == SNOWFLAKE) & (kind == "warehouse_metering_hour"), "warehouse")
        .when(source == DATABRICKS, "job")
        .otherwise("other")
    )


def enrich_events(df: DataFrame) -> DataFrame:
    """One row per record, with its attribution, metadata and ``query_text`` columns.

    ``query_text`` is the whole text of a query; records that have only its beginning give
    that. The JSON text is parsed once per row however many keys are used, and not at all
    when a query uses none of them.
    """
    keys = [*METADATA_TEXT_KEYS, *METADATA_NUMBER_KEYS]
    fields = {k: F.col(f"__metadata.{k}") for k in METADATA_TEXT_KEYS}
    fields |= {k: F.col(f"__metadata.{k}").try_cast("double") for k in METADATA_NUMBER_KEYS}
    # inside an array the parse has one mention, and is not repeated for the second choice
    texts = F.array(metadata_struct(["query_text", "query_text_preview"]))
    whole = F.transform(texts, lambda text: F.coalesce(text["query_text"], text["query_text_preview"]))
    fields["query_text"] = F.col("__texts")[0]
    return (
        df.withColumns({"__metadata": metadata_struct(keys), "__texts": whole})
        .withColumns({"attribution_key": attribution_key(), "attribution_kind": attribution_kind(), **fields})
        .drop("__metadata", "__texts")
    )
