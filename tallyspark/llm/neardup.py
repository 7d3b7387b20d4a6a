"""Near-duplicate vectors by cosine, within cells of a spherical k-means.

Rows with the same label and vector are one point before anything is compared. Centres are
fitted on a bounded sample of directions; every point belongs to the cell of its nearest
centre and also visits each cell with a smaller number whose border is within ``boundary``
of it, so a link across cells is looked for once, in the smaller of the two. The default
boundary is sin(acos(threshold)), and finds every link of any data; a smaller one misses links.
A point also stays out of a cell that borders nearer than that on another cell: who is within
reach of a cell is within ``boundary`` of each of its borders.

Points of a cell are compared as blocked products. A cell with more than ``block`` points is
dealt into blocks, and each pair of blocks is a group of its own. Groups return the number
of links of each point and a forest of its links, never the pairs.

Vectors that are null, zero, or hold a null or non-finite component, and rows whose label is
null, link with nothing and stay as rows of their own, also under a null id. Only vectors of
equal length are compared. Columns other than id, vector and label are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components
from .topk import finite

THRESHOLD = 0.98
# what rounding may add to a distance from a border
MARGIN = 1e-7
# borders of a cell with this many of a point's nearest cells are looked at
BORDERS = 16
CELL = 2048
BLOCK = 4096
MAX_CELLS = 4096
# the centres are fitted on at most this many vectors of each length
SAMPLE = 20_000
ROUNDS = 8


def unit(vectors: np.ndarray) -> np.ndarray:
    """Directions; scaled first, so that no square is lost or infinite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.square(vectors).sum(axis=1, keepdims=True))


def fit_centres(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means on unit vectors, from points spread over the sample."""
    centres = sample[np.unique(np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int))].copy()
    for _ in range(rounds):
        nearest = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-300)[:, None], centres)
    return centres


def boundary_of(threshold: float) -> float:
    """How far from a border a point may lie that links across it."""
    return math.sqrt(1 - min(threshold, 1) ** 2) if threshold > 0 else 1.0


def cells_of(points: np.ndarray, centres: np.ndarray, boundary: float) -> list[list[int]]:
    """For each unit vector its own cell, then the smaller cells whose border is near."""
    scores = points @ centres.T
    home = np.argmax(scores, axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    near = np.take_along_axis(scores, home[:, None], 1) - scores <= boundary * apart[home] + MARGIN
    near &= np.arange(len(centres))[None, :] < home[:, None]
    row, cell = np.nonzero(near)
    few = min(BORDERS, len(centres))
    for other in np.argpartition(-scores, few - 1, axis=1)[:, :few].T:
        there = scores[row, other[row]] - scores[row, cell] <= boundary * apart[cell, other[row]] + MARGIN
        row, cell = row[there], cell[there]
    found = [[int(h)] for h in home]
    for i, c in zip(row.tolist(), cell.tolist()):
        found[i].append(c)
    return found


def compare(ids: np.ndarray, points: np.ndarray, weights: np.ndarray, home: np.ndarray, side: np.ndarray, threshold: float):
    """(links, root): for each point how many rows it links to here, and the least id linked.

    Two visitors of a cell are not compared here. ``side`` is 0 or 1 in a pair of different
    blocks, and then only points of different sides are compared.
    """
    links, roots = np.zeros(len(ids), np.int64), np.arange(len(ids))
    mixed = bool(side.any()) and not bool(side.all())
    at_home, visitors = np.flatnonzero(home), np.flatnonzero(~home)
    for start in range(0, len(at_home), 512):
        part = at_home[start : start + 512]
        close = points[part] @ points.T >= threshold
        close &= (side[part, None] != side[None, :]) if mixed else ids[part, None] != ids[None, :]
        links[part] += close @ weights
        links[visitors] += weights[part] @ close[:, visitors]
        for i in np.flatnonzero(close.any(axis=1)):
            group = np.append(np.flatnonzero(close[i]), part[i])
            tops = _tops(roots, group)
            roots[tops] = tops[np.argmin(ids[tops])]
    return links, ids[_tops(roots, np.arange(len(ids)))]


def _tops(roots: np.ndarray, of: np.ndarray) -> np.ndarray:
    top = roots[of]
    while (above := roots[top]).tolist() != top.tolist():
        top = above
    roots[of] = top
    return top


def near_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = THRESHOLD,
    boundary: float | None = None,
    cell: int = CELL,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the least id
    reachable, itself included, and one row of each component is ``kept``.
    """
    reach = boundary_of(threshold) if boundary is None else boundary
    spark = vectors.sparkSession
    doubles = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    able = finite(F.col(vector_col)) & F.exists(F.col(vector_col), lambda x: x != 0) & F.col(label_col).isNotNull()
    rows = materialize(
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(label_col).cast("string").alias("label"),
            F.when(able, doubles).alias("v"),
            F.when(able, F.xxhash64(doubles)).alias("hash"),
        ),
        "vectors",
    )
    # equal vectors of a label are one point, known by the least id of its rows
    points = materialize(
        rows.filter("v is not null and vec_id is not null")
        .groupBy("label", "hash", "v")
        .agg(F.min("vec_id").alias("point"), F.count("*").alias("weight"))
        .withColumn("length", F.size("v")),
        "points",
    )
    sizes = points.groupBy("length").agg(F.count("*").alias("all")).collect()  # one row per vector length
    labels = points.groupBy("length", "label").count().groupBy("length").agg(F.max("count").alias("most"))
    most = {r["length"]: r["most"] for r in labels.collect()}
    sample = lambda n: points.filter(F.col("length") == n).select("v").orderBy(F.xxhash64("point")).limit(SAMPLE)
    centres = spark.sparkContext.broadcast(
        {
            r["length"]: fit_centres(
                unit(np.array([x["v"] for x in sample(r["length"]).collect()])),
                min(MAX_CELLS, -(-most[r["length"]] // cell)),
            )
            for r in sizes
        }
    )

    @F.pandas_udf("array<int>")
    def cells(v: pd.Series) -> pd.Series:
        out: list = [None] * len(v)
        lengths = np.array([len(x) for x in v])
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            for part in np.array_split(at, -(-len(at) // 1024)):
                found = cells_of(unit(np.stack([v.iloc[i] for i in part])), centres.value[int(n)], reach)
                for i, c in zip(part, found):
                    out[i] = c
        return pd.Series(out)

    placed = points.withColumn("cells", cells("v"))
    members = materialize(
        placed.select("point", "weight", "label", "length", "v", F.posexplode("cells").alias("visit", "cell")).withColumn(
            "home", F.col("visit") == 0
        ),
        "members",
    )
    where = ["length", "label", "cell"]
    counts = materialize(members.groupBy(*where).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "cells")
    own = F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        members.join(counts, where)
        .withColumn("own", own)
        .withColumn("other", other)
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .withColumn("side", (F.col("own") != F.col("low")).cast("int"))
    )

    def group(found: pd.DataFrame) -> pd.DataFrame:
        links, roots = compare(
            found["point"].to_numpy(),
            unit(np.stack(found["v"].to_list())),
            found["weight"].to_numpy(),
            found["home"].to_numpy(),
            found["side"].to_numpy(),
            threshold,
        )
        linked = links > 0
        return pd.DataFrame({"point": found["point"][linked], "links": links[linked], "root": roots[linked]})

    forest = materialize(
        dealt.select("point", "weight", "v", "home", "side", *where, "low", "high")
        .groupBy(*where, "low", "high")
        .applyInPandas(group, "point long, links long, root long"),
        "forest",
    )
    roots = materialize(connected_components(forest, "point", "root"), "roots")
    links = forest.groupBy("point").agg(F.sum("links").alias("links"))
    groups = materialize(
        points.join(links, "point", "left")
        .join(roots, points["point"] == roots["node"], "left")
        .select(
            "label",
            "hash",
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "point").alias("component_id"),
        ),
        "groups",
    )
    g = groups.select(*[F.col(c).alias(f"group_{c}") for c in ("label", "hash", "v")], "n_links", "component_id")
    same = [rows[c] == g[f"group_{c}"] for c in ("label", "hash", "v")]
    return (
        rows.join(g, [*same, rows["vec_id"].isNotNull()], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
