"""List-price estimate of a job run."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import DBU_HOURLY_USD, ESTIMATED, FALLBACK_HOURLY_USD, INSTANCE_HOURLY_USD

_MS_PER_HOUR = 3_600_000
_RATE = "decimal(9,4)"


def hours_of_ms(ms: Column, decimals: int = 4) -> Column:
    """Milliseconds as hours, rounded half up from an exact decimal quotient."""
    return F.round(ms.cast("decimal(18,0)") / F.lit(Decimal(_MS_PER_HOUR)), decimals)


def listed_rate(node_type: Column, prices: Mapping[str, Decimal]) -> Column:
    """Hourly price of a node type, null when it is not listed.

    The price list is a literal of the plan: no join, no shuffle.
    """
    if not prices:
        return F.lit(None).cast(_RATE)
    pairs = chain.from_iterable((F.lit(k), F.lit(v).cast(_RATE)) for k, v in prices.items())
    return F.try_element_at(F.create_map(*pairs), node_type)


def estimate_cost(
    node_type: Column,
    num_workers: Column,
    run_ms: Column,
    *,
    prices: Mapping[str, Decimal] = INSTANCE_HOURLY_USD,
    fallback: Decimal = FALLBACK_HOURLY_USD,
    dbu_rate: Decimal = DBU_HOURLY_USD,
) -> tuple[Column, Column, Column]:
    """(cost in USD, cost basis, note) of a run.

    Workers and one driver are charged at the node's hourly rate plus the platform's, for
    the time of the run. The product is exact decimal arithmetic, rounded half up to four
    places at the end. Runs without time or without a node type have no cost.
    """
    ran = F.coalesce(run_ms, F.lit(0)) > 0
    known = F.coalesce(node_type, F.lit("")) != ""
    listed = listed_rate(node_type, prices)
    rate = F.coalesce(listed, F.lit(fallback).cast(_RATE))
    nodes = F.coalesce(num_workers, F.lit(0)) + 1
    per_hour = (rate + F.lit(dbu_rate).cast(_RATE)) * nodes.cast("decimal(9,0)")
    exact = per_hour.cast("decimal(18,4)") * run_ms.cast("decimal(14,0)") / F.lit(Decimal(_MS_PER_HOUR))
    cost = F.when(ran & known, F.round(exact, 4))
    basis = F.when(ran & known, F.lit(ESTIMATED))
    note = (
        F.when(~ran, F.lit("no run time recorded"))
        .when(~known, F.lit("node type not known (serverless compute or a removed cluster)"))
        .otherwise(
            F.concat(
                F.lit("estimate: "),
                nodes.cast("string"),
                F.format_string(" node(s) x %.3f h x ($", run_ms.cast("double") / _MS_PER_HOUR),
                rate.cast("string"),
                F.when(listed.isNull(), F.concat(F.lit(" fallback rate for "), node_type)).otherwise(F.lit(" listed")),
                F.lit(f" + ${dbu_rate} platform rate)"),
            )
        )
    )
    return cost, basis, note
