"""Exact top-k search by inner product, pruned by segment statistics.

Vectors are cut into segments, coarse and then fine. From the means and deviations of two
vectors' segments follows a lower bound of their distance, and with the lengths an upper
bound of their product: a segment adds no more than its size times the product of the means
plus the product of the deviations. The statistics are computed once for each vector.

Queries and candidates are dealt into blocks, and each pair of blocks is one group. The first
block of candidates is searched alone and gives each query a bar, its k-th best score there.
In the other blocks a pair of query and candidate whose bound is below the query's bar is
dropped, coarse to fine; exact products decide among the rest, and raise the bar.

Vectors whose products doubles may not hold exactly are compared apart: products in doubles
with a bound of their error leave the pairs that can be among the best, for which Python's
integers decide. One such vector costs no more than its own pairs.

Only vectors of equal length are compared. Rows with a null id, a null vector, or a null or
non-finite component, also when scaled, take no part; a row that is repeated as a whole counts
once. Scores beyond a long are ranked and given as the nearest long. Columns other than id and
vector are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

QUERY_BLOCK = 4096
ROW_BLOCK = 32768
# blocks of candidates at least, so that few rows are spread as well
LEAST_BLOCKS = 32
TILE = 2048
LEVELS = (4, 16)
# queries that are taken together, and the share of surviving pairs below which they are multiplied one by one
TOGETHER = 512
SPARSE = 1 / 16
_EXACT = 1 << 53
_LONG = float(1 << 63)


def finite(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, odd), F.lit(False))


def _floor(x: Column) -> Column:
    """The floor as a double; from 2^53 on doubles are whole numbers, of which some exceed a long."""
    return F.when(F.abs(x) < float(_EXACT), F.floor(x).cast("double")).otherwise(x)


def segment_statistics(x: np.ndarray) -> np.ndarray:
    """Per vector, for each level, numbers whose products bound the products of the vectors from above."""
    columns = []
    for segments in _segments(x.shape[1]):
        for part in np.array_split(x, segments, axis=1):
            mean = part.mean(axis=1)
            columns += [mean * np.sqrt(part.shape[1]), np.sqrt(np.square(part - mean[:, None]).sum(axis=1))]
    return np.stack(columns, axis=1) if columns else np.zeros((len(x), 0))


def _segments(length: int) -> list[int]:
    return [min(n, length) for n in LEVELS] if length else []


def _levels(statistics: np.ndarray, length: int) -> list[np.ndarray]:
    ends = np.cumsum([2 * n for n in _segments(length)])
    return np.split(statistics, ends[:-1], axis=1) if len(ends) else []


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row, ties to the smaller id; ids is one row or a row each."""
    ids = np.broadcast_to(ids, scores.shape)
    if scores.shape[1] > 4 * k:
        # everything at or above the k-th score, which ties can make more than k
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
        width = int((scores >= cut).sum(axis=1).max())
        if width < scores.shape[1]:
            order = np.argpartition(-scores, width - 1, axis=1)[:, :width]
            scores, ids = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _best_of_large(query: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k best rows of one query, whatever the size of the components."""
    with np.errstate(all="ignore"):
        near = rows @ query
        error = (np.abs(rows) @ np.abs(query)) * (4 * (len(query) + 1) * np.finfo(float).eps)
        unknown = ~(np.isfinite(near) & np.isfinite(error))
        low = np.where(unknown, -_LONG, np.clip(near - error, -_LONG, _LONG))
        high = np.where(unknown, _LONG, np.clip(near + error, -_LONG, _LONG))
    if len(ids) > k:
        kept = np.flatnonzero(high >= np.partition(low, len(low) - k)[len(low) - k])
        ids, rows, low, high = ids[kept], rows[kept], low[kept], high[kept]
    most, least = (1 << 63) - 1, -(1 << 63)
    scores = np.where(low >= _LONG, most, least)
    own = [int(v) for v in query.tolist()]
    for j in np.flatnonzero((low < _LONG) & (high > -_LONG)):
        scores[j] = max(least, min(most, sum(map(int.__mul__, own, map(int, rows[j].tolist())))))
    order = np.lexsort((ids, ~scores))[:k]  # ~x is -x - 1, without overflow
    return [(int(scores[j]), int(ids[j])) for j in order]


def _search_small(
    query_ids: np.ndarray, queries: np.ndarray, query_stats: np.ndarray, bars: np.ndarray,
    row_ids: np.ndarray, rows: np.ndarray, row_stats: np.ndarray, k: int, tile: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(position of the query, scores, ids, surviving pairs); all products are exact in doubles."""
    length = rows.shape[1]
    norms = np.sqrt(np.square(rows).sum(axis=1))
    order = np.lexsort((row_ids, -norms))  # long vectors first: they raise the bar early
    row_ids, rows, norms = row_ids[order], rows[order], norms[order]
    row_levels = _levels(row_stats[order], length)
    for first in range(0, len(queries), TOGETHER):
        part = slice(first, first + TOGETHER)
        own, own_ids, own_levels = queries[part], query_ids[part], _levels(query_stats[part], length)
        own_norms = np.sqrt(np.square(own).sum(axis=1))
        scores = np.full((len(own), k), -np.inf)
        ids = np.full((len(own), k), np.iinfo(np.int64).max)
        survivors = np.zeros(len(own), np.int64)
        for start in range(0, len(rows), tile):
            live = np.arange(start, min(start + tile, len(rows)))
            bar = np.maximum(scores[:, -1], bars[part])[:, None]
            passed = own_ids[:, None] != row_ids[live][None, :]
            for q, r in zip(own_levels, row_levels):
                # far above the rounding of the sums, far below a whole number's share of the norms
                slack = 1e-12 * own_norms[:, None] * norms[live][None, :]
                passed &= q @ r[live].T + slack >= bar
                some = passed.any(axis=0)
                live, passed = live[some], passed[:, some]
            if not len(live):
                continue
            survivors += passed.sum(axis=1)
            if passed.mean() < SPARSE:
                product = np.full(passed.shape, -np.inf)
                i, j = np.nonzero(passed)
                product[i, j] = np.einsum("ij,ij->i", own[i], rows[live[j]])
            else:
                product = np.where(passed, own @ rows[live].T, -np.inf)
            best = _best(product, row_ids[live], k)
            scores, ids = _best(np.hstack([scores, best[0]]), np.hstack([ids, best[1]]), k)
        for i in range(len(own)):
            there = np.isfinite(scores[i])
            yield first + i, scores[i][there], ids[i][there], int(survivors[i])


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, query_stats: np.ndarray, bars: np.ndarray,
    row_ids: np.ndarray, rows: np.ndarray, row_stats: np.ndarray, k: int, tile: int = TILE,
) -> Iterator[tuple[int, list[tuple[int, int]], int]]:
    """(query id, (score, vec id) of its k best rows, surviving pairs) of each query, other than rows of its id.

    The vectors hold whole numbers. Rows that score below a query's bar may be left out.
    """
    limit = math.sqrt(_EXACT / max(1, rows.shape[1]))
    is_large = lambda x: np.abs(x).max(axis=1, initial=0) >= limit
    large_query, large_row = is_large(queries), is_large(rows)
    small_query, small_row = np.flatnonzero(~large_query), np.flatnonzero(~large_row)
    for n, scores, ids, survivors in _search_small(
        query_ids[small_query], queries[small_query], query_stats[small_query], bars[small_query],
        row_ids[small_row], rows[small_row], row_stats[small_row], k, tile,
    ):
        i = small_query[n]
        found = [(int(s), int(v)) for s, v in zip(scores, ids)]
        if large_row.any():
            others = large_row & (row_ids != query_ids[i])
            found += _best_of_large(queries[i], row_ids[others], rows[others], k)
            survivors += int(others.sum())
        yield int(query_ids[i]), sorted(found, key=lambda x: (-x[0], x[1]))[:k], survivors
    for i in np.flatnonzero(large_query):
        others = row_ids != query_ids[i]
        yield int(query_ids[i]), _best_of_large(queries[i], row_ids[others], rows[others], k), int(others.sum())


def nearest(
    vectors: DataFrame,
    *,
    k: int = 5,
    scale: int = 256,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
    row_block: int = ROW_BLOCK,
    survivors: bool = False,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query.

    Components are scaled and rounded down to whole numbers. Queries are the rows whose id
    is divisible by ``every``; candidates are all rows. With ``survivors``, each row also has
    ``n_survivors``, the candidates of its query that the bounds did not rule out.
    """
    values = F.transform(F.col(vector_col), lambda x: _floor(x.cast("double") * scale))
    known = (
        vectors.filter(F.col(id_col).isNotNull() & finite(F.col(vector_col)))
        .select(F.col(id_col).cast("long").alias("vec_id"), values.alias("v"))
        .filter(finite(F.col("v")))
        .dropDuplicates(["vec_id", "v"])
    )
    known = materialize(known.select("vec_id", "v", _statistics("v").alias("stats"), F.size("v").alias("length")), "vectors")
    query = F.col("vec_id") % every == 0
    total = known.agg(F.count("*").alias("rows"), F.count_if(query).alias("queries")).first()
    query_blocks = max(1, -(-total["queries"] // query_block))
    row_blocks = max(LEAST_BLOCKS, -(-total["rows"] // row_block))
    dealt = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda first, n: F.explode(F.sequence(F.lit(first), F.lit(n - 1)))
    keys = ["length", "query_block", "row_block"]
    asked = known.filter(query).select(*[F.col(c).alias(c) for c in known.columns], dealt(query_blocks, 1).alias("query_block"))
    rows = known.withColumn("row_block", dealt(row_blocks, 2)).withColumn("query_block", each(0, query_blocks))

    def search(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(rows):
            stack = lambda v: np.stack([np.asarray(x, float) for x in v])
            bars = asked["bar"].astype(float).fillna(-np.inf).to_numpy()
            own = (asked["vec_id"].to_numpy(), stack(asked["v"]), stack(asked["stats"]), bars)
            for query_id, best, passed in search_block(
                *own, rows["vec_id"].to_numpy(), stack(rows["v"]), stack(rows["stats"]), k
            ):
                # the count goes with the first row, which may be of the count alone
                found += [(query_id, v, s, passed if n == 0 else 0) for n, (s, v) in enumerate(best or [(None, None)])]
        names = ("query_id", "vec_id", "score", "passed")
        # nullable integers: a long beside a null would go by way of a double
        return pd.DataFrame({name: pd.array([row[n] for row in found], dtype="Int64") for n, name in enumerate(names)})

    def searched(asked: DataFrame, rows: DataFrame) -> DataFrame:
        return (
            asked.groupBy(*keys)
            .cogroup(rows.groupBy(*keys))
            .applyInPandas(search, "query_id long, vec_id long, score long, passed long")
        )

    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    first = searched(
        asked.withColumns({"row_block": F.lit(0), "bar": F.lit(None).cast("double")}), rows.filter("row_block = 0")
    )
    first = materialize(first, "first-block")
    bars = first.filter("vec_id IS NOT NULL").withColumn("rank", ranked).filter(F.col("rank") == k)
    bars = bars.select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bar"))
    others = searched(
        asked.join(bars, "vec_id", "left").withColumn("row_block", each(1, row_blocks)), rows.filter("row_block > 0")
    )
    found = first.unionByName(others)
    if survivors:
        found = materialize(found, "found")
    best = found.filter("vec_id IS NOT NULL").withColumn("rank", ranked).filter(F.col("rank") <= k)
    best = best.select("query_id", "rank", "vec_id", "score")
    if not survivors:
        return best
    return best.join(found.groupBy("query_id").agg(F.sum("passed").alias("n_survivors")), "query_id")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(v: pd.Series) -> pd.Series:
    lengths = v.map(len).to_numpy()
    result = np.empty(len(v), object)
    with np.errstate(all="ignore"):  # those of very large components are not used
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            for i, row in zip(at, segment_statistics(np.stack([np.asarray(x, float) for x in v.iloc[at]]))):
                result[i] = row
    return pd.Series(result)
