"""Joining group statistics back to rows, and bounded samples per group.

Both must hold when one group has a large share of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..sources.materialize import materialize

# a statistics table up to this many bytes is broadcast
BROADCAST_BYTES = 32 << 20
# a group with more than 1/HOT_PARTS of all rows is hot, so there are fewer than HOT_PARTS
HOT_PARTS = 1000
ROW_OVERHEAD = 64

GROUP_ROWS = "__group_rows"
_KEY = "__group_key_"


def _renamed(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stats.withColumnsRenamed({k: f"{_KEY}{i}" for i, k in enumerate(keys)})


def _same_group(rows: DataFrame, renamed: DataFrame, keys: Sequence[str]):
    """Null keys form a group of their own, as in ``groupBy``."""
    test = F.lit(True)
    for i, k in enumerate(keys):
        test = test & rows[k].eqNullSafe(renamed[f"{_KEY}{i}"])
    return test


def attach_group_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_parts: int = HOT_PARTS,
) -> DataFrame:
    """Every row with the columns of its group's row in ``stats``.

    ``stats`` has one row per group and a ``__group_rows`` column, and is small next to
    ``rows``; it is computed once, and its size measured on the way. If it is small
    enough it is broadcast and ``rows`` is not shuffled at all. Otherwise hot groups,
    which are fewer than ``hot_parts``, are broadcast, and only the rows of the other
    groups are shuffled: no group among them has more than 1/``hot_parts`` of all rows.
    """
    size = Observation()
    key_bytes = sum((F.coalesce(F.length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(0))
    payload = ROW_OVERHEAD + 16 * len(stats.columns)
    stats = materialize(
        stats.observe(
            size,
            F.coalesce(F.sum(key_bytes.cast("long") + payload), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum(GROUP_ROWS), F.lit(0)).alias("rows"),
        ),
        "group-stats",
    )
    total_bytes, total_rows = size.get["bytes"], size.get["rows"]

    def joined(left: DataFrame, right: DataFrame, broadcast: bool) -> DataFrame:
        renamed = _renamed(right, keys)
        side = F.broadcast(renamed) if broadcast else renamed
        added = [c for c in stats.columns if c not in keys and c != GROUP_ROWS]
        return left.join(side, _same_group(left, renamed, keys)).select(*[left[c] for c in left.columns], *added)

    if total_bytes <= broadcast_bytes:
        return joined(rows, stats, broadcast=True)
    hot = stats.filter(F.col(GROUP_ROWS) * hot_parts > total_rows)
    hot_keys = _renamed(hot.select(*keys), keys)
    cold_rows = rows.join(F.broadcast(hot_keys), _same_group(rows, hot_keys, keys), "left_anti")
    return joined(rows, hot, broadcast=True).unionByName(joined(cold_rows, stats, broadcast=False))


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_parts: int = HOT_PARTS,
    slices: int = 64,
) -> DataFrame:
    """``rows`` left-joined to ``table``, which has one row per ``key``; null keys match nothing.

    The table is written once and measured on the way: broadcast when small, else joined by
    shuffle. Then rows are counted by key; keys with more than 1/``hot_parts`` of the rows, so
    fewer than ``hot_parts`` of them, are split in ``slices``, and only their rows of the table
    are copied. Rows with a null key are not shuffled. Keys of a stream cannot be counted
    ahead, so there every key is split.
    """
    size = Observation()
    width = F.coalesce(F.length(F.to_json(F.struct("*"))), F.lit(0)).cast("long") + ROW_OVERHEAD
    table = materialize(
        table.filter(F.col(key).isNotNull()).observe(size, F.coalesce(F.sum(width), F.lit(0)).alias("bytes")),
        "lookup",
    )
    if size.get["bytes"] <= broadcast_bytes:
        return rows.join(F.broadcast(table), key, "left")
    slice_of_row = F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), F.lit(slices)).cast("int")
    each_slice = F.sequence(F.lit(0), F.lit(slices - 1))
    if rows.isStreaming:
        copies = table.withColumn("__slice", F.explode(each_slice))
        return rows.withColumn("__slice", slice_of_row).join(copies, [key, "__slice"], "left").drop("__slice")
    hot = F.broadcast(_hot_keys(rows, key, hot_parts).withColumn("__hot", F.lit(True)))
    is_hot = F.col("__hot").isNotNull()
    named = rows.filter(F.col(key).isNotNull()).join(hot, key, "left")
    copies = table.join(hot, key, "left").withColumn(
        "__slice", F.explode(F.when(is_hot, each_slice).otherwise(F.array(F.lit(0))))
    )
    found = named.withColumn("__slice", F.when(is_hot, slice_of_row).otherwise(0)).join(
        copies.drop("__hot"), [key, "__slice"], "left"
    )
    unnamed = rows.filter(F.col(key).isNull())
    return found.drop("__slice", "__hot").unionByName(unnamed, allowMissingColumns=True)


def _hot_keys(rows: DataFrame, key: str, hot_parts: int) -> DataFrame:
    """Keys, other than null, with more than 1/``hot_parts`` of the rows that have one."""
    total = Observation()
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(GROUP_ROWS))
    counts = materialize(counts.observe(total, F.coalesce(F.sum(GROUP_ROWS), F.lit(0)).alias("rows")), "key-counts")
    return counts.filter(F.col(GROUP_ROWS) * hot_parts > total.get["rows"]).select(key)


def smallest_per_group(
    rows: DataFrame, keys: Sequence[str], value: str, count: int, name: str, slices: int = 64
) -> DataFrame:
    """The ``count`` smallest distinct values of each group, as a sorted array.

    Each task keeps only the leading values of its own rows before the shuffle (a ranking
    filter that Spark pushes below the exchange), and the rows of one group go to up to
    ``slices`` tasks, so no task and no array ever holds a whole group.
    """
    known = rows.select(*keys, value).filter(F.col(value).isNotNull())
    order = Window.partitionBy(*keys, "__slice").orderBy(value)
    leading = (
        known.withColumn("__slice", F.spark_partition_id() % slices)
        .withColumn("__rank", F.dense_rank().over(order))
        .filter(F.col("__rank") <= count)
    )
    return leading.groupBy(*keys).agg(
        F.slice(F.array_sort(F.collect_set(value)), 1, count).alias(name)
    )
