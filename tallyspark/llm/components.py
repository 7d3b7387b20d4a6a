"""Connected components of a table of links, round by round on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import materialize


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link to another node; root is the least node reachable.

    Links become stars around the least node: each round moves a link's smaller end to that
    node's least neighbour, then ties all smaller neighbours of a node to the least of them.
    A node may be the smaller end of any number of links; as the larger end it should have a
    bounded number, as links to the least member of a group have. The driver sees two
    numbers a round. Rows with a null end and links of a node to itself say nothing.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    pairs, before = _staged(links.filter(F.col(a) != F.col(b)).select(high.alias("high"), low.alias("low")).distinct())
    while True:
        parent = materialize(pairs.groupBy("high").agg(F.min("low").alias("parent")), "parents")
        parent = parent.withColumnRenamed("high", "node")
        lifted = pairs.join(parent, pairs["low"] == parent["node"], "left").select(
            "high", F.coalesce("parent", "low").alias("low")
        )
        least = F.min("low").over(Window.partitionBy("high"))
        tied = lifted.withColumn("least", least).select(
            F.explode(
                F.array(
                    F.struct(F.col("high"), F.col("least").alias("low")),
                    F.struct(F.col("low").alias("high"), F.col("least").alias("low")),
                )
            ).alias("pair")
        )
        pairs, now = _staged(tied.select("pair.*").filter("high != low").distinct())
        if now == before:
            roots = pairs.select("low").distinct()
            return pairs.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
                roots.select(F.col("low").alias("node"), F.col("low").alias("root"))
            )
        before = now


def _staged(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    state = Observation()
    total = F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
    staged = materialize(pairs.observe(state, F.count("*").alias("rows"), total.alias("sum")), "links")
    return staged, (state.get["rows"], state.get["sum"])
