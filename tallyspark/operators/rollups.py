"""Daily spend rollups.

All rollups come from one pre-aggregate, :func:`daily_totals`, whose size depends on
the number of keys and days and not on the number of records. A job that needs several
of them computes it once (see ``plans.pipeline``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import ACTUAL_COST_BASES

KEYS = ("source", "attribution_kind", "attribution_key", "usage_date")
_SPLIT = ("cost_basis", "usage_unit", "has_cost")


def daily_totals(events: DataFrame) -> DataFrame:
    """Sums and counts per attribution key, day, cost basis, unit and "has a cost".

    Only counts and sums: a hash aggregation that combines before the shuffle, so a key
    with a third of all records costs one row per map task.
    """
    return (
        events.withColumn("has_cost", F.col("cost_usd").isNotNull())
        .groupBy(*KEYS, *_SPLIT)
        .agg(
            F.sum("cost_usd").alias("cost_usd"),
            F.sum("usage_quantity").alias("usage_quantity"),
            F.count("usage_quantity").alias("quantity_rows"),
            F.count(F.lit(1)).alias("record_count"),
        )
    )


def source_date_rollup(totals: DataFrame) -> DataFrame:
    """Spend per source and day from :func:`daily_totals`."""
    return totals.groupBy("source", "usage_date").agg(
        F.sum("cost_usd").alias("cost_usd_total"),
        F.sum("record_count").alias("record_count"),
        F.sum(F.when(F.col("has_cost"), F.col("record_count")).otherwise(0)).alias("records_with_cost"),
        F.sort_array(F.collect_set("cost_basis")).alias("cost_bases_present"),
    )


def attribution_rollup(totals: DataFrame) -> DataFrame:
    """Spend per attribution key and day from :func:`daily_totals`.

    Where one group has several units, the first in text order stands for it.
    """
    return totals.groupBy(*KEYS).agg(
        F.sum("cost_usd").alias("cost_usd_total"),
        F.sort_array(F.collect_set("cost_basis")).alias("cost_bases_present"),
        F.sum("usage_quantity").alias("usage_quantity_total"),
        F.min("usage_unit").alias("usage_unit"),
        F.sum("record_count").alias("record_count"),
    )


def spend_by_source_date(events: DataFrame, *, actual_only: bool = False) -> DataFrame:
    """Cost, record count, costed record count and cost bases per source and day.

    Provider forecasts are records too and are summed with the rest, unless
    ``actual_only`` leaves them out.
    """
    if actual_only:
        events = _actual(events)
    slim = events.select(
        "source",
        "usage_date",
        "cost_usd",
        "cost_basis",
        F.col("cost_usd").isNotNull().alias("has_cost"),
    )
    totals = slim.groupBy("source", "usage_date", "cost_basis", "has_cost").agg(
        F.sum("cost_usd").alias("cost_usd"), F.count(F.lit(1)).alias("record_count")
    )
    return source_date_rollup(totals)


def spend_by_attribution(events: DataFrame, *, actual_only: bool = False) -> DataFrame:
    """Cost, quantity, unit, record count and cost bases per attribution key and day."""
    return attribution_rollup(daily_totals(_actual(events) if actual_only else events))


def _actual(events: DataFrame) -> DataFrame:
    basis = F.col("cost_basis")
    return events.filter(basis.isNull() | basis.isin(*ACTUAL_COST_BASES))
