"""Rolling and seasonal features of a positioned panel (`series_id, idx, n, claim_count`).

All windows share the partitioning by series, so a chain of these functions shuffles once.  A series
is bounded by its calendar; no window spans series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from panelwright.functions.columns import ratio


def by_series() -> WindowSpec:
    return W.partitionBy("series_id")


def in_order() -> WindowSpec:
    return by_series().orderBy("idx")


def _y(value: str) -> Column:
    """Counts are never negative."""
    return F.greatest(F.col(value), F.lit(0.0))


def rolling_psi(panel: DataFrame, window: int = 12, value: str = "claim_count") -> DataFrame:
    """Coefficient of variation of the previous `window` points; 0 where there are fewer."""
    w = in_order().rowsBetween(-window, -1)
    y = _y(value)
    cv = F.coalesce(F.when(F.avg(y).over(w) > 0, ratio(F.stddev_pop(y).over(w), F.avg(y).over(w))), F.lit(0.0))
    return panel.withColumn("psi", F.when(F.col("idx") >= window, cv).otherwise(0.0))


def rolling_amplitude(panel: DataFrame, window: int = 12, value: str = "claim_count") -> DataFrame:
    """Population deviation of the previous `window` points; 0 where there are fewer."""
    w = in_order().rowsBetween(-window, -1)
    return panel.withColumn(
        "amplitude", F.when(F.col("idx") >= window, F.stddev_pop(_y(value)).over(w)).otherwise(0.0)
    )


def value_range(panel: DataFrame, value: str = "claim_count") -> DataFrame:
    """Largest minus smallest value per series."""
    y = _y(value)
    return panel.groupBy("series_id").agg((F.max(y) - F.min(y)).alias("range"))


def difference_flags(
    panel: DataFrame, threshold: float = 2.0, window: int = 12, value: str = "claim_count"
) -> DataFrame:
    """1 where a step exceeds `threshold` deviations of the previous `window` steps.

    A step equal to the limit does not count, whatever the rounding of the deviation.
    """
    y = _y(value)
    step = F.coalesce(y - F.lag(y).over(in_order()), F.lit(0.0))
    spread = F.stddev_pop("_step").over(in_order().rowsBetween(-window, -1))
    hit = (F.col("idx") >= window) & (spread > 0) & (F.abs("_step") > threshold * spread + 1e-9)
    return (
        panel.withColumn("_step", step)
        .withColumn("changepoint", F.coalesce(hit, F.lit(False)).cast("int"))
        .drop("_step")
    )


def centred_changepoints(
    panel: DataFrame, window: int = 6, recent: int | None = None, value: str = "claim_count"
) -> DataFrame:
    """Per series, the positions where the centred mean moves more than its 75th percentile move.

    `has_recent` tells whether one lies in the last `recent` positions (default: the window), and
    `recent_share` how many of those positions are changepoints.
    """
    left = window // 2
    last = window if recent is None else recent
    w = in_order().rowsBetween(-left, window - left - 1)
    mean = F.when(F.count(value).over(w) == window, F.avg(value).over(w))
    move = F.round(F.abs(F.col("_mean") - F.lag("_mean").over(in_order())), 9)  # equal moves stay equal
    cut = F.round(F.percentile("_move", 0.75).over(by_series()), 9)
    hit = (F.col("n") >= 2 * window) & (F.col("_move") > F.col("_cut"))
    is_recent = hit & (F.col("idx") >= F.col("n") - last)
    return (
        panel.withColumn("_mean", mean)
        .withColumn("_move", move)
        .withColumn("_cut", cut)
        .groupBy("series_id")
        .agg(
            F.sort_array(F.collect_list(F.when(hit, F.col("idx")))).alias("changepoints"),
            F.coalesce(F.max(is_recent.cast("int")), F.lit(0)).cast("boolean").alias("has_recent"),
            (F.count_if(is_recent) / last).alias("recent_share"),
        )
    )


def peaks(vectors: DataFrame, min_prominence: float = 1.0, values: str = "ys") -> DataFrame:
    """Local maxima with position, prominence and width at half prominence, one row per peak.

    Input has one row per series with its ordered values.  A flat top counts once, at its middle.
    Prominence is the drop to the higher of the two lowest points reached before the series rises
    above the peak; width is measured by linear interpolation at half that drop.
    """
    clipped = vectors.select("series_id", F.expr(f"transform({values}, v -> greatest(v, 0D))").alias("y"))
    tops = clipped.select(
        "series_id",
        "y",
        F.explode(
            F.expr(
                """
                filter(
                  transform(
                    filter(sequence(0, size(y) - 1), i -> i > 0 AND i < size(y) - 1 AND y[i - 1] < y[i]),
                    i -> named_struct('i', i, 'j', array_min(filter(sequence(i, size(y) - 1), k -> y[k] <> y[i])))),
                  t -> t.j IS NOT NULL AND y[t.j] < y[t.i])
                """
            )
        ).alias("t"),
    ).select("series_id", "y", F.expr("(t.i + t.j - 1) div 2").cast("int").alias("idx"))
    bases = (
        tops.withColumn("h", F.expr("y[idx]"))
        .withColumn("lo", F.expr("coalesce(array_max(filter(sequence(0, idx), k -> y[k] > h)), -1)"))
        .withColumn("hi", F.expr("coalesce(array_min(filter(sequence(idx, size(y) - 1), k -> y[k] > h)), size(y))"))
        .withColumn("left_min", F.expr("array_min(slice(y, lo + 2, idx - lo))"))
        .withColumn("right_min", F.expr("array_min(slice(y, idx + 1, hi - idx))"))
        .withColumn("prominence", F.expr("h - greatest(left_min, right_min)"))
        .where(F.col("prominence") >= min_prominence)
    )
    # the base on each side is the position of its lowest point nearest to the peak
    sides = (
        bases.withColumn("level", F.expr("h - prominence * 0.5D"))
        .withColumn("lb", F.expr("array_max(filter(sequence(lo + 1, idx), k -> y[k] = left_min))"))
        .withColumn("rb", F.expr("array_min(filter(sequence(idx, hi - 1), k -> y[k] = right_min))"))
        .withColumn("l", F.expr("coalesce(array_max(filter(sequence(lb, idx), k -> y[k] <= level)), lb)"))
        .withColumn("r", F.expr("coalesce(array_min(filter(sequence(idx, rb), k -> y[k] <= level)), rb)"))
        .withColumn("left_x", F.expr("if(y[l] < level, l + (level - y[l]) / (y[l + 1] - y[l]), cast(l AS double))"))
        .withColumn("right_x", F.expr("if(y[r] < level, r - (level - y[r]) / (y[r - 1] - y[r]), cast(r AS double))"))
    )
    return sides.select(
        "series_id", "idx", F.col("h").alias("height"), "prominence", (F.col("right_x") - F.col("left_x")).alias("width")
    )


def recent_alert(panel: DataFrame, recent: int = 4, base: int = 12, value: str = "claim_count") -> DataFrame:
    """Alert when the mean of the last points exceeds mean + sample deviation of those before."""
    from_end = F.col("n") - F.col("idx")
    y = _y(value)
    in_recent, in_base = from_end <= recent, (from_end > recent) & (from_end <= recent + base)
    enough = F.col("n") >= recent + base
    out = panel.groupBy("series_id", "n").agg(
        F.avg(F.when(in_recent & enough, y)).alias("recent"),
        F.avg(F.when(in_base & enough, y)).alias("baseline"),
        F.stddev_samp(F.when(in_base & enough, y)).alias("sigma"),
    )
    gap = F.col("recent") - F.col("baseline")
    return out.select(
        "series_id",
        F.coalesce(F.col("recent") > F.col("baseline") + F.col("sigma"), F.lit(False)).alias("alert"),
        F.coalesce(ratio(gap, F.col("sigma")), F.lit(0.0)).alias("score"),
        "recent",
        "baseline",
        "sigma",
    )


def seasonal_means(panel: DataFrame, period: int = 12, value: str = "claim_count", anchor: int = 0) -> DataFrame:
    """Mean per series and position in the cycle; `anchor` is the idx that has position 0."""
    position = F.pmod(F.col("idx") - anchor, F.lit(period)).alias("position")
    return panel.groupBy("series_id", position).agg(
        F.avg(value).alias("season_mean"), F.count(F.lit(1)).alias("n_cycles")
    )


def seasonal_index(panel: DataFrame, period: int = 12, value: str = "claim_count") -> DataFrame:
    """Seasonal means over their own mean; 1 for a series whose means are not positive."""
    means = seasonal_means(panel, period, value)
    overall = F.avg("season_mean").over(by_series())
    return means.withColumn(
        "seasonal_factor", F.when(overall > 0, ratio(F.col("season_mean"), overall)).otherwise(1.0)
    )


def value_gaps(panel: DataFrame, date_col: str, max_days: int = 10) -> DataFrame:
    """Rows that follow the previous observation of their series by more than `max_days`."""
    before = F.lag(date_col).over(by_series().orderBy(date_col))
    return panel.withColumn("gap_days", F.datediff(date_col, before)).where(F.col("gap_days") > max_days)


def recent_motion(panel: DataFrame, points: int = 6, value: str = "claim_count") -> DataFrame:
    """First and second differences inside the last `points` positions, with the linear slope."""
    y = F.col(value)
    tail = panel.withColumn("_pos", F.col("idx") - (F.col("n") - points))
    one, two = F.lag(y, 1).over(in_order()), F.lag(y, 2).over(in_order())
    moved = tail.withColumn("_v", y - one).withColumn("_a", y - 2 * one + two)
    return moved.where(F.col("_pos") >= 0).groupBy("series_id").agg(
        F.avg(F.when(F.col("_pos") >= 1, F.col("_v"))).alias("mean_velocity"),
        F.stddev_pop(F.when(F.col("_pos") >= 1, F.col("_v"))).alias("sd_velocity"),
        F.avg(F.when(F.col("_pos") >= 2, F.col("_a"))).alias("mean_acceleration"),
        F.avg(F.when((F.col("_pos") >= 2) & (F.col("_a") > 0), F.col("_a"))).alias("mean_rising"),
        F.regr_slope(y, F.col("_pos").cast("double")).alias("slope"),
    )


def rolling_range_mean(panel: DataFrame, window: int = 12, value: str = "claim_count") -> DataFrame:
    """Mean over all full windows of largest minus smallest value."""
    w = in_order().rowsBetween(0, window - 1)
    spread = F.max(value).over(w) - F.min(value).over(w)
    return (
        panel.withColumn("_range", F.when(F.col("idx") <= F.col("n") - window, spread))
        .groupBy("series_id")
        .agg(F.avg("_range").alias("mean_range"))
    )
