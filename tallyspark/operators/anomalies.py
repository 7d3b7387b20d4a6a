"""Leave-one-out z-scores: each value against all others of its group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import (
    MIN_BASELINE_ROWS,
    SNOWFLAKE,
    TOP_ANOMALIES,
    Z_THRESHOLD,
    ZERO_SPREAD,
)
from ..sources.materialize import materialize
from .groups import BROADCAST_BYTES, GROUP_ROWS, HOT_PARTS, attach_group_stats

SCORE_COLUMNS = ("group_n_other", "baseline_mean", "baseline_stddev", "z_score", "status", "anomaly")
# of a decimal value column, and of any other
_EXACT_STATS = ("__n", "__total", "__squares")
_FLOAT_STATS = ("__n", "__mean", "__variance", "__low", "__high", "__marks")
# the moments of a group without its highest or its lowest values
_REST_STATS = ("__n_below", "__mean_below", "__variance_below", "__n_above", "__mean_above", "__variance_above")
# an extreme value with all but this share of its group's variance hides the spread of the others
_HIDDEN = 1e-3
_MARK_BITS = (1 << 28) - 1


def _is_decimal(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.DecimalType)


def _mark(number: Column) -> Column:
    """A hash per value, of few enough bits that a long holds the sum over 2^35 rows."""
    return F.xxhash64(number).bitwiseAND(F.lit(_MARK_BITS))


def _number(value: Column) -> Column:
    """The value as a double; null where it is not finite."""
    number = value.cast("double") + F.lit(0.0)  # one zero, not two
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def _group_measures(value: Column, exact: bool) -> dict[str, Column]:
    """Measures that describe a group for this purpose, and combine before the shuffle.

    For a decimal column of up to 18 digits, count, sum and sum of squares are exact. Doubles
    would lose a small spread in such sums, so they have central moments; the extremes and a
    sum of hashes tell, but for a collision, whether the others of an extreme value are all equal.
    """
    if exact:
        return dict(zip(_EXACT_STATS, [F.count(value), F.sum(value), F.sum(value * value)]))
    number = _number(value)
    marks = F.sum(F.when(number.isNotNull(), _mark(number)))
    return dict(
        zip(_FLOAT_STATS, [F.count(number), F.avg(number), F.var_pop(number), F.min(number), F.max(number), marks])
    )


def _rest_measures(value: Column) -> dict[str, Column]:
    """Moments of what is below the group's highest, and above its lowest value."""
    number = _number(value)
    below, above = F.when(number < F.col("__high"), number), F.when(number > F.col("__low"), number)
    return dict(zip(_REST_STATS, [f(part) for part in (below, above) for f in (F.count, F.avg, F.var_pop)]))


def _hides_others(n: Column, mean: Column, variance: Column, low: Column, high: Column) -> Column:
    """Whether one of the extremes has nearly all of the variance."""
    far = F.greatest(high - mean, mean - low)
    return (n > 1) & (high > low) & (far * far * n / (n - 1) >= variance * n * (1 - _HIDDEN))


def _exact_baseline(df: DataFrame, value: Column, columns: list[str]) -> DataFrame:
    others = F.when(value.isNotNull(), F.col("__n") - 1)
    mean = (F.col("__total") - value).cast("double") / others
    squares, kind = F.col("__squares"), df.schema["__squares"].dataType
    if isinstance(kind, T.DecimalType):  # one digit less, which the subtraction needs to stay exact
        squares = squares.cast(T.DecimalType(min(kind.precision, 37), kind.scale))
    mean_square = (squares - value * value).cast("double") / others
    has_others = others > 0
    based = df.select(
        *columns,
        others.alias("group_n_other"),
        F.when(has_others, mean).alias("baseline_mean"),
        F.when(has_others, mean_square).alias("__mean_square"),
    )
    mean = F.col("baseline_mean")
    stddev = F.when(mean.isNotNull(), F.sqrt(F.greatest(F.col("__mean_square") - mean * mean, F.lit(0.0))))
    return based.select(*columns, "group_n_other", "baseline_mean", stddev.alias("baseline_stddev"))


def _float_baseline(df: DataFrame, value: Column, columns: list[str]) -> DataFrame:
    """Moments of the others from those of the group.

    Others that are all equal have their own value as mean and no spread, without rounding.
    The only highest (or lowest) value of a group that has nearly all of its variance is not taken
    out of moments that it dominates: the others have moments of their own.
    """
    number, n = _number(value), F.col("__n")
    others = F.when(number.isNotNull(), n - 1)
    away, total = number - F.col("__mean"), F.col("__variance") * n
    left = total - away * away * n / others
    # an extreme value's others can only all be equal at the other extreme
    level = F.when(number == F.col("__high"), F.col("__low")).when(number == F.col("__low"), F.col("__high"))
    same = (F.col("__marks") - _mark(number) == others * _mark(level)) & (left <= total * _HIDDEN)
    highest = (number == F.col("__high")) & (F.col("__n_below") == others)
    lowest = (number == F.col("__low")) & (F.col("__n_above") == others)
    mean = F.when(highest, F.col("__mean_below")).when(lowest, F.col("__mean_above")).otherwise(F.col("__mean") - away / others)
    spread = F.greatest(left, total * 1e-16) / others
    spread = F.when(highest, F.col("__variance_below")).when(lowest, F.col("__variance_above")).otherwise(spread)
    based = df.select(
        *columns,
        others.alias("group_n_other"),
        F.when(others > 0, F.coalesce(same, F.lit(False))).alias("__same"),
        level.alias("__level"),
        mean.alias("__others_mean"),
        F.sqrt(spread).alias("__others_stddev"),
    )
    return based.select(
        *columns,
        "group_n_other",
        F.when(F.col("__same"), F.col("__level")).when(~F.col("__same"), F.col("__others_mean")).alias("baseline_mean"),
        F.when(F.col("__same"), F.lit(0.0)).when(~F.col("__same"), F.col("__others_stddev")).alias("baseline_stddev"),
    )


def _scored(df: DataFrame, value: Column, exact: bool, z_threshold: float, min_group_size: int) -> DataFrame:
    """Score columns from the group measures next to each row. One projection per level."""
    columns = [c for c in df.columns if c not in _EXACT_STATS + _FLOAT_STATS + _REST_STATS]
    spread = (_exact_baseline if exact else _float_baseline)(df, value, columns)
    mean, stddev = F.col("baseline_mean"), F.col("baseline_stddev")
    number = value.cast("double") if exact else _number(value)
    z = F.when(
        F.col("group_n_other") >= min_group_size,
        F.when(stddev > ZERO_SPREAD, (number - mean) / stddev)
        .when(number > mean, F.lit(float("inf")))
        .otherwise(F.lit(0.0)),
    )
    status = (
        F.when(number.isNull(), "no_value")
        .when(F.col("z_score").isNull(), "insufficient_baseline")
        .when(F.col("z_score") > z_threshold, "anomaly")
        .otherwise("normal")
    )
    return spread.withColumn("z_score", z).withColumn("status", status).withColumn(
        "anomaly", F.col("status") == "anomaly"
    )


def _with_rest(
    df: DataFrame, stats: DataFrame, keys: list[str], value: Column, broadcast_bytes: int, hot_parts: int
) -> DataFrame:
    """``stats`` with the moments of the rest, in groups where an extreme value hides it."""
    stats = materialize(stats, "group-moments")
    hidden = stats.filter(_hides_others(*[F.col(c) for c in _FLOAT_STATS[:5]]))
    bounds = hidden.select(*keys, "__low", "__high", GROUP_ROWS)  # rows of other groups fall out of the join
    rows = attach_group_stats(df, bounds, keys, broadcast_bytes=broadcast_bytes, hot_parts=hot_parts)
    rest = rows.groupBy(*keys).agg(*[m.alias(n) for n, m in _rest_measures(value).items()])
    named = rest.withColumnsRenamed({k: f"__rest_{i}" for i, k in enumerate(keys)})
    test = F.lit(True)
    for i, k in enumerate(keys):
        test = test & stats[k].eqNullSafe(named[f"__rest_{i}"])
    return stats.join(named, test, "left").select(*stats.columns, *_REST_STATS)


def detect_anomalies(
    df: DataFrame,
    *,
    group_cols: Sequence[str],
    value_col: str,
    z_threshold: float = Z_THRESHOLD,
    min_group_size: int = MIN_BASELINE_ROWS,
    row_id_col: str | None = None,
    form: str = "aggregate",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_parts: int = HOT_PARTS,
) -> DataFrame:
    """``df`` with its leave-one-out score columns; one output row per input row.

    A row is an anomaly when it lies more than ``z_threshold`` standard deviations above
    the mean of the others in its group (upper side only). With fewer than
    ``min_group_size`` others there is no score. Others without any spread give infinity
    above their mean and 0 otherwise. A null value, NaN or an infinite value is ``no_value``
    and counts for nobody.

    ``form="aggregate"`` reads ``df`` twice (key and value columns first) but never
    shuffles its wide rows when the statistics are small, and holds under any skew. For
    doubles, groups with an extreme value that hides the spread of the others are measured
    once more, without it.
    ``form="window"`` reads once and shuffles all of it, each group to one task; for small
    inputs and as an independent check. ``row_id_col`` is accepted for compatibility;
    every column is kept anyway.
    """
    keys, value, exact = list(group_cols), F.col(value_col), _is_decimal(df, value_col)
    if form == "window":
        group = Window.partitionBy(*keys)
        with_stats = df.select("*", *[m.over(group).alias(n) for n, m in _group_measures(value, exact).items()])
        if not exact:
            with_stats = with_stats.select("*", *[m.over(group).alias(n) for n, m in _rest_measures(value).items()])
    elif form == "aggregate":
        measures = [m.alias(n) for n, m in _group_measures(value, exact).items()]
        stats = df.groupBy(*keys).agg(*measures, F.count(F.lit(1)).alias(GROUP_ROWS))
        if not exact:
            stats = _with_rest(df.select(*keys, value_col), stats, keys, value, broadcast_bytes, hot_parts)
        with_stats = attach_group_stats(df, stats, keys, broadcast_bytes=broadcast_bytes, hot_parts=hot_parts)
    else:
        raise ValueError("form must be 'aggregate' or 'window'")
    return _scored(with_stats, value, exact, z_threshold, min_group_size)


def snowflake_queries(events: DataFrame) -> DataFrame:
    return events.filter((F.col("source") == SNOWFLAKE) & (F.col("resource_type") == "query"))


def query_duration_anomalies(queries: DataFrame, **options) -> DataFrame:
    """Each query's duration against the others on its warehouse and day."""
    return detect_anomalies(
        queries, group_cols=["account_identifier", "usage_date"], value_col="usage_quantity", **options
    )


def daily_cost_anomalies(by_attribution: DataFrame, **options) -> DataFrame:
    """Each day's cost of a key against its other days."""
    return detect_anomalies(
        by_attribution, group_cols=["source", "attribution_key"], value_col="cost_usd_total", **options
    )


def condensed_query_anomalies(
    queries: DataFrame, *, z_threshold: float = Z_THRESHOLD, min_group_size: int = MIN_BASELINE_ROWS
) -> DataFrame:
    """Only the anomalies, in six columns. Others without spread count as z = 0 here."""
    scored = query_duration_anomalies(queries, z_threshold=z_threshold, min_group_size=min_group_size)
    return scored.filter(F.col("anomaly") & (F.col("baseline_stddev") > ZERO_SPREAD)).select(
        "resource_id", "account_identifier", "usage_date", "usage_quantity", "z_score", "query_text_preview"
    )


def status_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def headline_anomaly(scored: DataFrame) -> DataFrame:
    """The highest score among the anomalies."""
    return scored.filter("anomaly").orderBy(F.col("z_score").desc(), F.col("resource_id")).limit(1)


def top_by_score(scored: DataFrame, limit: int = TOP_ANOMALIES) -> DataFrame:
    """Highest scores first, rows without a score last."""
    return scored.orderBy(F.col("z_score").desc_nulls_last(), F.col("resource_id")).limit(limit)


def what_if_score(baselines: DataFrame, value: Column, *, flag_at: float = Z_THRESHOLD) -> DataFrame:
    """Score of a hypothetical value against stored baselines, flagged on either side.

    Null where the baseline has no spread or something is not finite.
    """
    mean, stddev = F.col("baseline_mean"), F.col("baseline_stddev")
    number = value.cast("double")
    usable = stddev != 0
    for part in (number, mean, stddev):
        usable = usable & part.isNotNull() & ~F.isnan(part) & (F.abs(part) != float("inf"))
    z = F.when(usable, (number - mean) / stddev)
    return baselines.withColumn("what_if_value", number).withColumn("what_if_z", z).withColumn(
        "what_if_flagged", F.abs(F.col("what_if_z")) >= flag_at
    )
