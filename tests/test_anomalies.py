import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import anomalies as an
from tallyspark.operators.groups import smallest_per_group


def frame(spark, groups):
    rows = [(g, float(v) if v is not None else None, i) for g, values in groups.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "grp string, val double, i int")


def scores(df, **options):
    return an.detect_anomalies(df, group_cols=["grp"], value_col="val", **options).collect()


@pytest.mark.parametrize("form", ["aggregate", "window"])
def test_single_outlier(spark, form):
    rows = scores(frame(spark, {"g1": [98, 101, 99, 102, 100, 1000]}), min_group_size=3, form=form)
    flagged = [r for r in rows if r.anomaly]
    assert [r.val for r in flagged] == [1000.0] and flagged[0].z_score > 3


def test_small_group_has_no_baseline(spark):
    rows = scores(frame(spark, {"g1": [1, 2, 1000]}))
    assert {r.status for r in rows} == {"insufficient_baseline"}
    assert all(r.z_score is None for r in rows)


def test_flat_group_is_normal_and_one_off_value_is_infinite(spark):
    rows = scores(frame(spark, {"flat": [5.0] * 8, "off": [5.0] * 7 + [5.5]}), min_group_size=3)
    flat = [r for r in rows if r.grp == "flat"]
    assert all(r.status == "normal" and r.z_score == 0.0 for r in flat)
    off = [r for r in rows if r.grp == "off" and r.val == 5.5]
    assert off[0].anomaly and math.isinf(off[0].z_score)


def test_null_values_and_single_rows(spark):
    rows = scores(frame(spark, {"g": [1, 2, 3, None], "one": [7], None: [1, 1]}), min_group_size=2)
    by = {(r.grp, r.val): r for r in rows}
    missing = by["g", None]
    assert missing.status == "no_value" and missing.anomaly is False
    assert missing.group_n_other is None and missing.baseline_mean is None and missing.z_score is None
    assert by["g", 1.0].group_n_other == 2
    assert by["one", 7.0].baseline_mean is None and by["one", 7.0].group_n_other == 0
    assert len([r for r in rows if r.grp is None]) == 2


def test_published_scores(spark):
    """Baselines known from the field: x, mean, stddev and score."""
    known = [(11899.0, 260.617021, 556.965851, 20.896044), (1993.0, 167.929204, 159.047481, 11.475006)]
    base = spark.createDataFrame(known, "x double, baseline_mean double, baseline_stddev double, want double")
    for row in an.what_if_score(base, F.col("x")).collect():
        assert row.what_if_z == pytest.approx(row.want, abs=1e-5) and row.what_if_flagged
    flat = spark.createDataFrame([(1.0, 1.0, 0.0), (float("nan"), 1.0, 1.0)], "x double, baseline_mean double, baseline_stddev double")
    assert [r.what_if_z for r in an.what_if_score(flat, F.col("x")).collect()] == [None, None]


@pytest.mark.parametrize("options", [{"form": "window"}, {}, {"broadcast_bytes": 0, "hot_parts": 3}, {"broadcast_bytes": 0, "hot_parts": 10**6}])
def test_all_plans_agree_with_brute_force_under_skew(spark, options):
    """One group holds most rows, keys and values may be null; decimals make sums exact."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        group = "hot" if i % 3 else rng.choice(["a", "b", None, "c"])
        value = None if i % 17 == 0 else Decimal(rng.randrange(1, 9999)) / 100
        rows.append((group, rng.choice(["x", "y"]) if group != "hot" else "x", value, i))
    df = spark.createDataFrame(rows, "grp string, sub string, val decimal(10,2), i int")
    got = {r.i: r for r in an.detect_anomalies(df, group_cols=["grp", "sub"], value_col="val", **options).collect()}
    assert len(got) == len(rows)
    for group, sub, value, i in rows:
        others = [float(v) for g, s, v, j in rows if (g, s) == (group, sub) and j != i and v is not None]
        if value is None:
            assert got[i].status == "no_value"
            continue
        assert got[i].group_n_other == len(others)
        mean = sum(others) / len(others)
        stddev = math.sqrt(max(sum(o * o for o in others) / len(others) - mean * mean, 0))
        assert got[i].baseline_mean == pytest.approx(mean)
        assert got[i].baseline_stddev == pytest.approx(stddev, abs=1e-6)
        if len(others) >= 5:
            assert got[i].z_score == pytest.approx((float(value) - mean) / stddev, rel=1e-6)


def test_small_statistics_leave_rows_where_they_are(spark):
    df = frame(spark, {"g": range(20), "h": range(20)})
    plan = an.detect_anomalies(df, group_cols=["grp"], value_col="val")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_smallest_per_group_is_bounded_and_exact(spark):
    rows = [("hot", f"id{i % 40:03d}") for i in range(2000)] + [("few", "b"), ("few", "a"), ("few", "a"), (None, "z"), ("few", None)]
    df = spark.createDataFrame(rows, "k string, id string").repartition(4)
    sampled = smallest_per_group(df, ["k"], "id", 3, "ids")
    assert {r.k: r.ids for r in sampled.collect()} == {"hot": ["id000", "id001", "id002"], "few": ["a", "b"], None: ["z"]}
    plan = sampled._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_reports_of_scores(spark):
    df = frame(spark, {"g": [98, 101, 99, 102, 100, 1000, 97]}).withColumn("resource_id", F.concat(F.lit("r"), "i"))
    scored = an.detect_anomalies(df, group_cols=["grp"], value_col="val")
    assert an.headline_anomaly(scored).first().val == 1000.0
    assert [r.val for r in an.top_by_score(scored, 2).collect()] == [1000.0, 102.0]
    assert {r.status: r.n for r in an.status_counts(scored).collect()} == {"anomaly": 1, "normal": 6}


@pytest.mark.parametrize("form", ["aggregate", "window"])
@pytest.mark.parametrize("level", [0.1, 123.45, 12345.67, 7654321.09, 5e-6])
def test_others_without_spread_in_doubles(spark, form, level):
    """Thousands of equal doubles and one slightly above: an infinite score, and only for that one."""
    above = level * 1.001 if level < 1e-3 else level * 1.0000001
    df = spark.createDataFrame([("g", level)] * 4000 + [("g", above)], "grp string, val double").repartition(64)
    rows = scores(df, form=form)
    top = [r for r in rows if r.val == above]
    assert len(top) == 1 and math.isinf(top[0].z_score) and top[0].anomaly
    assert top[0].baseline_mean == level and top[0].baseline_stddev == 0.0
    assert all(r.status == "normal" for r in rows if r.val == level)


def test_scores_in_doubles_against_direct_sums(spark):
    rng = random.Random(5)
    values = [1e6 + rng.gauss(0, 1e-2) for _ in range(300)] + [1e6 + 1.0]
    got = {r.val: r for r in scores(frame(spark, {"g": values}).repartition(7))}
    for i in (0, 17, 300):
        others = [v - 1e6 for j, v in enumerate(values) if j != i]
        mean = math.fsum(others) / len(others)
        stddev = math.sqrt(math.fsum((v - mean) ** 2 for v in others) / len(others))
        assert got[values[i]].z_score == pytest.approx((values[i] - 1e6 - mean) / stddev, rel=1e-5)
    pairs = scores(frame(spark, {"g": [1.0, 1.0, 3.0, 3.0, 9.0]}), min_group_size=3)
    assert [r.baseline_stddev for r in pairs if r.val == 9.0] == [pytest.approx(1.0)]


def direct(values, at):
    """Mean and population deviation of the others, by plain sums around their mean."""
    others = [v for i, v in enumerate(values) if i != at and v is not None and math.isfinite(v)]
    mean = math.fsum(others) / len(others)
    return mean, math.sqrt(math.fsum((v - mean) ** 2 for v in others) / len(others))


@pytest.mark.parametrize("far", [1e6, 1e9, 1e15, -1e9, 1.5])
@pytest.mark.parametrize("options", [{}, {"form": "window"}, {"broadcast_bytes": 0, "hot_parts": 2}])
def test_baselines_beside_an_extreme_value(spark, far, options):
    near = [1.0 + 0.01 * k * (-1) ** k for k in range(9)]
    groups = {"one": [*near, far], "twice": [*near, far, far], "both": [*near, far, -far], "flat": [2.5] * 8 + [far], "none": near}
    rows = [(g, i, x) for g, values in groups.items() for i, x in enumerate(values)]
    scored = an.detect_anomalies(spark.createDataFrame(rows, "grp string, i int, val double"), group_cols=["grp"], value_col="val", **options)
    for r in scored.collect():
        mean, stddev = direct(groups[r["grp"]], r["i"])
        assert r["baseline_mean"] == pytest.approx(mean, rel=1e-9, abs=1e-12 * abs(far))
        assert r["baseline_stddev"] == pytest.approx(stddev, rel=1e-9)


@pytest.mark.parametrize("form", ["aggregate", "window"])
def test_values_that_are_not_finite_are_no_values(spark, form):
    values = [1.0, 1.1, 0.9, 1.0, 1.05, 0.95, 1.0, float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([("g", i, x) for i, x in enumerate(values)], "grp string, i int, val double")
    scored = {r["i"]: r for r in an.detect_anomalies(rows, group_cols=["grp"], value_col="val", form=form).collect()}
    assert all(scored[i]["status"] == "no_value" and scored[i]["z_score"] is None for i in range(7, 11))
    for i in range(7):
        assert scored[i]["status"] == "normal" and scored[i]["group_n_other"] == 6
        assert scored[i]["baseline_stddev"] == pytest.approx(direct(values, i)[1], rel=1e-9)
