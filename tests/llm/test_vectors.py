import math

import numpy as np
import pytest

from tallyspark.llm import neardup, topk
from tallyspark.llm.common import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    rows = [(i, base[i % 40] + rng.normal(size=8) * 0.03 * (i // 40), i % 3) for i in range(200)]
    rows = [(i, v.astype(float).tolist(), label) for i, v, label in rows]
    rows += [(200, None, 1), (250, [float("nan")] * 8, 1), (300, [0.0] * 8, 1), (350, [None] * 8, 1), (400, rows[7][1], None)]
    rows += [(450, rows[7][1], rows[7][2]), (7, *rows[7][1:]), (None, rows[3][1], 0), (500, [1.0, 2.0], 1), (550, [1e200] * 8, 1)]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, rank int, score int")


def usable(r):
    v = r["embedding"]
    return r["vec_id"] is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_top_k_equals_brute_force(spark):
    frame = vectors(spark)
    rows = {(r["vec_id"], tuple(math.floor(256 * x) for x in r["embedding"])) for r in frame.collect() if usable(r)}
    want = set()
    for i, q in [r for r in rows if r[0] % 50 == 0]:
        exact = [(sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i and len(v) == len(q)]
        scored = sorted((-max(-(2**63), min(2**63 - 1, s)), j) for s, j in exact)[:5]
        want |= {(i, n, j, -s) for n, (s, j) in enumerate(scored, 1)}
    got = topk.nearest(frame, query_block=2, row_block=50).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want
    assert topk.nearest(frame.limit(0)).count() == 0


@pytest.mark.parametrize("cell, block", [(2048, 4096), (8, 5)])
def test_near_duplicates_equal_brute_force(spark, cell, block):
    frame = vectors(spark)
    rows = frame.collect()
    able = [usable(r) and r["label"] is not None and any(r["embedding"]) for r in rows]
    unit = [neardup.unit(np.array([r["embedding"]], float))[0] if a else None for r, a in zip(rows, able)]
    near = lambda i, j: (
        i != j and able[i] and able[j] and rows[i]["label"] == rows[j]["label"] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98
    )
    links = [[j for j in range(len(rows)) if near(i, j)] for i in range(len(rows))]
    least = [r["vec_id"] for r in rows]
    for _ in rows:
        least = [min([least[i], *(least[j] for j in links[i])]) if links[i] else least[i] for i in range(len(rows))]
    want = sorted((str(r["vec_id"]), len(n), str(c)) for r, n, c in zip(rows, links, least))
    got = neardup.near_duplicates(frame, boundary=0.2, cell=cell, block=block).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got) == want
    assert neardup.near_duplicates(frame.limit(0)).count() == 0


def test_no_link_is_lost_across_borders(spark):
    rng = np.random.default_rng(3)
    spread = np.zeros((2, 64))
    spread[:, 1:3] = np.eye(2)
    rows = np.eye(64)[0] + 0.15 * rng.normal(size=(5000, 2)) @ spread  # one label, variation in two directions
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    unit = neardup.unit(rows)
    close = unit @ unit.T >= neardup.THRESHOLD
    centres = neardup.fit_centres(unit, 3)
    assert any(len(c) > 1 for c in neardup.cells_of(unit, centres, neardup.boundary_of(neardup.THRESHOLD)))
    got = {r["vec_id"]: r["n_links"] for r in neardup.near_duplicates(frame).collect()}
    assert [got[i] for i in range(len(rows))] == (close.sum(axis=1) - 1).tolist()


@pytest.mark.parametrize("threshold", [0.98, 0.9, 0.5])
def test_cells_meet_all_links(threshold):
    rng = np.random.default_rng(4)
    for rank in (2, 4, 12):
        points = neardup.unit(rng.normal(size=(800, rank)) @ rng.normal(size=(rank, 12)) + rng.normal(size=12))
        cells = neardup.cells_of(points, neardup.fit_centres(points, 25), neardup.boundary_of(threshold))
        for i, j in np.argwhere(points @ points.T >= threshold):
            assert cells[i][0] in cells[j] or cells[j][0] in cells[i]


def brute_force(rows, k=5, every=50):
    """{(query, rank, id, score)} over (id, whole numbers) with Python's integers."""
    want = set()
    for i, q in [r for r in rows if r[0] % every == 0]:
        exact = [(sum(int(a) * int(b) for a, b in zip(q, v)), j) for j, v in rows if j != i]
        scored = sorted((-max(-(2**63), min(2**63 - 1, s)), j) for s, j in exact)[:k]
        want |= {(i, n, j, -s) for n, (s, j) in enumerate(scored, 1)}
    return want


def test_bounds_rule_out_candidates_and_lose_none(spark):
    """Vectors in groups with means of their own: most candidates fall by segment statistics."""
    rng = np.random.default_rng(3)
    centres = np.repeat(rng.normal(size=(12, 16)) * 4, 4, axis=1)
    vectors = [(i, (centres[i % 12] + rng.normal(size=64) * 0.2).tolist()) for i in range(3000)]
    found = topk.nearest(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), survivors=True).collect()
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors]
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == brute_force(rows)
    assert sum({r["query_id"]: r["n_survivors"] for r in found}.values()) < 0.5 * 60 * 3000


def test_large_components_do_not_change_the_way_of_the_others(spark):
    """Rows and queries beyond exact doubles, beyond a long, and so large that products overflow."""
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=6).tolist()) for i in range(400)]
    large = [(400, [1e200] * 6), (401, [1e200] * 6), (402, [-1e199] + [0.0] * 5), (450, [3e7] * 6), (403, [3e7 + 0.25] * 6), (404, [1e15, -1e15] * 3), (405, [1e306] + [0.0] * 5)]
    found = topk.nearest(spark.createDataFrame(vectors + large, "vec_id long, embedding array<double>"), row_block=40).collect()
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors + large if math.isfinite(256 * max(v))]
    assert len(rows) == 406 and {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == brute_force(rows)


def test_a_large_row_costs_its_own_pairs_only():
    """Every pair that is not the large row's goes by doubles."""
    rng = np.random.default_rng(5)
    rows = np.floor(rng.normal(size=(20_000, 64)) * 256)
    rows[7] = 1e200
    stats = np.nan_to_num(topk.segment_statistics(rows))
    ids = np.arange(len(rows))
    calls = []
    plain = topk._best_of_large
    topk._best_of_large = lambda q, i, r, k: calls.append(len(i)) or plain(q, i, r, k)
    try:
        found = list(topk.search_block(ids[100:150], rows[100:150], stats[100:150], np.full(50, -np.inf), ids, rows, stats, 5))
    finally:
        topk._best_of_large = plain
    assert calls == [1] * 50 and len(found) == 50
    plus = [q for q, best, _ in found if best[0] == (2**63 - 1, 7)]
    assert plus == [q for q in range(100, 150) if rows[q].sum() > 0]
