"""Structural changes: CUSUM, two-sample t, stable regions and penalised segmentation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.operators.features import by_series, in_order

T_CRITICAL_1PCT_DF18 = 2.878440472738608  # two-sided 1 % point of Student's t, 18 degrees


def cusum(panel: DataFrame, threshold: float = 3.0, drift: float = 0.5, value: str = "claim_count") -> DataFrame:
    """Upper and lower CUSUM of the standardised series and a flag beyond `threshold`.

    The recursion max(0, s + z - drift) equals the running sum minus its running minimum, which is
    two stacked windows.  A constant series is never flagged, nor is a sum equal to the threshold.
    """
    y = F.col(value)
    z = F.try_divide(y - F.avg(y).over(by_series()), F.stddev_pop(y).over(by_series()))
    started = F.col("idx") > 0
    running = in_order().rowsBetween(W.unboundedPreceding, 0)
    df = panel.withColumn("_z", F.coalesce(z, F.lit(0.0)))
    for name, sign in (("_up", 1), ("_down", -1)):
        df = df.withColumn(name, F.sum(F.when(started, sign * F.col("_z") - drift).otherwise(0.0)).over(running))
    return (
        df.withColumn("cusum_pos", F.col("_up") - F.min("_up").over(running))
        .withColumn("cusum_neg", F.col("_down") - F.min("_down").over(running))
        .withColumn("changepoint", F.greatest("cusum_pos", "cusum_neg") > threshold + 1e-9)
        .drop("_z", "_up", "_down")
    )


def t_test_flags(panel: DataFrame, window: int = 10, value: str = "claim_count") -> DataFrame:
    """Flag positions whose `window` points before and after differ in mean at the 1 % level.

    With no variance on either side, any difference of the means counts.
    """
    before, after = in_order().rowsBetween(-window, -1), in_order().rowsBetween(0, window - 1)
    diff = F.avg(value).over(before) - F.avg(value).over(after)
    pooled = (F.var_samp(value).over(before) + F.var_samp(value).over(after)) / 2
    se = F.sqrt(pooled * 2 / window)
    inside = (F.col("n") >= 2 * window) & (F.col("idx") >= window) & (F.col("idx") < F.col("n") - window)
    t = F.try_divide(F.abs("_diff"), F.col("_se"))
    critical = T_CRITICAL_1PCT_DF18
    hit = F.when(F.col("_se") == 0, F.col("_diff") != 0).otherwise(t > critical)
    return (
        panel.withColumn("_diff", diff)
        .withColumn("_se", se)
        .withColumn("changepoint", inside & F.coalesce(hit, F.lit(False)))
        .drop("_diff", "_se")
    )


def stable_regions(flags: DataFrame, margin: int = 5) -> DataFrame:
    """Half-open index ranges [begin, end) at least `margin` away from every changepoint.

    `flags` is a positioned panel with a boolean `changepoint`.  A series without changepoints is
    one region.
    """
    marks = flags.groupBy("series_id", "n").agg(
        F.sort_array(F.collect_list(F.when(F.col("changepoint"), F.col("idx")))).alias("cps")
    )
    head = F.expr(f"named_struct('begin', 0, 'end', cps[0] - {margin})")
    tail = F.expr(f"named_struct('begin', element_at(cps, -1) + {margin}, 'end', n)")
    between = F.expr(
        f"transform(filter(sequence(0, size(cps) - 1), i -> i > 0),"
        f" i -> named_struct('begin', cps[i - 1] + {margin}, 'end', cps[i] - {margin}))"
    )
    regions = F.when(
        F.size("cps") == 0, F.array(F.struct(F.lit(0).alias("begin"), F.col("n").alias("end")))
    ).otherwise(F.filter(F.concat(F.array(head), between, F.array(tail)), lambda r: r["end"] > r["begin"]))
    return marks.select("series_id", "n", F.explode(regions).alias("r")).select(
        "series_id", F.col("r.begin").alias("begin"), F.col("r.end").alias("end")
    )


def stable_rows(flags: DataFrame, margin: int = 5) -> DataFrame:
    """The rows of a flagged panel that lie in a stable region, by distance to the nearest flags.

    Same rows as joining `stable_regions`, but as two windows on the same partitioning.
    """
    mark = F.when(F.col("changepoint"), F.col("idx"))
    last = F.max(mark).over(in_order().rowsBetween(W.unboundedPreceding, 0))
    following = F.min(mark).over(in_order().rowsBetween(1, W.unboundedFollowing))
    after_last = last.isNull() | (F.col("idx") >= last + margin)
    before_next = following.isNull() | (F.col("idx") < following - margin)
    return flags.withColumn("_ok", after_last & before_next).where("_ok").drop("_ok")


def _segment_costs(y: np.ndarray) -> np.ndarray:
    """Kernel cost of every segment [s, t) for a batch of equally long series: (rows, n+1, n+1)."""
    rows, n = y.shape
    gaps = (y[:, :, None] - y[:, None, :]) ** 2
    upper = np.triu_indices(n, 1)
    typical = np.median(gaps[:, upper[0], upper[1]], axis=1)
    scale = np.where(typical > 0, 1.0 / np.where(typical > 0, typical, 1.0), 1.0)
    kernel = np.exp(-np.clip(gaps * scale[:, None, None], 1e-2, 1e2))
    kernel[:, np.arange(n), np.arange(n)] = 1.0
    sums = np.zeros((rows, n + 1, n + 1))
    sums[:, 1:, 1:] = kernel.cumsum(1).cumsum(2)
    diagonal = sums[:, np.arange(n + 1), np.arange(n + 1)]
    block = diagonal[:, None, :] - sums - sums.transpose(0, 2, 1) + diagonal[:, :, None]
    length = np.arange(n + 1)[None, :] - np.arange(n + 1)[:, None]
    return length - block / np.where(length == 0, 1, length)


def segment_ends(y: np.ndarray, penalty: np.ndarray, min_size: int) -> list[list[int]]:
    """Ends of the segments with the least total cost + penalty per segment, for each row of y."""
    rows, n = y.shape
    cost = _segment_costs(y)
    best = np.full((rows, n + 1), np.inf)
    best[:, 0] = 0.0
    cut = np.zeros((rows, n + 1), dtype=int)
    for t in range(min_size, n + 1):
        total = best[:, : t - min_size + 1] + cost[:, : t - min_size + 1, t] + penalty[:, None]
        cut[:, t] = total.argmin(1)
        best[:, t] = np.take_along_axis(total, cut[:, t][:, None], 1)[:, 0]
    ends = []
    for r in range(rows):
        t, row = n, []
        while t > 0:
            row.append(t)
            t = cut[r, t]
        ends.append(row[::-1])
    return ends


def _by_length(ys: pd.Series, fn, chunk: int = 256) -> pd.Series:
    """Apply a batch function to groups of equally long rows."""
    out = pd.Series([None] * len(ys), dtype=object)
    lengths = ys.map(len)
    for n, where in lengths.groupby(lengths).groups.items():
        for at in range(0, len(where), chunk):
            ids = where[at : at + chunk]
            for i, value in zip(ids, fn(np.stack([np.asarray(ys[i], dtype=float) for i in ids]))):
                out[i] = value
    return out


def penalised_segments(vectors: DataFrame, rule: str = "log_variance", min_size: int = 3, values: str = "ys") -> DataFrame:
    """Add `segment_ends`: the optimal segmentation of each series under a Gaussian kernel cost.

    `rule` sets the penalty: `log_variance` is ln(n) * variance, `log_deviation` is
    ln(n) * (deviation + 1e-6), and a number is taken as it is.  Rows are independent, so Arrow
    batches of any composition give the same result.
    """

    def penalties(y: np.ndarray) -> np.ndarray:
        if rule == "log_variance":
            return np.log(y.shape[1]) * y.var(1)
        if rule == "log_deviation":
            return np.log(y.shape[1]) * (y.std(1) + 1e-6)
        return np.full(len(y), float(rule))

    def ends(y: np.ndarray) -> list[list[int]]:
        if y.shape[1] < 2 * min_size:
            return [[y.shape[1]]] * len(y)
        return segment_ends(y, penalties(y), min_size)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def segment(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ys in batches:
            yield _by_length(ys.reset_index(drop=True), ends)

    # declared so that filters are not pushed below it, which would segment twice
    return vectors.withColumn("segment_ends", segment.asNondeterministic()(values))


def recent_change_share(segments: DataFrame, recent: int = 6, values: str = "ys") -> DataFrame:
    """`cp_prob`: ends in the last `recent` positions (the final end included) per inner changepoint.

    A series of one segment has 0.
    """
    ends = F.col("segment_ends")
    late = F.size(F.filter(ends, lambda e: e >= F.size(values) - recent))
    return segments.withColumn(
        "cp_prob", F.when(F.size(ends) > 1, late / (F.size(ends) - 1)).otherwise(F.lit(0.0))
    )


def listed_changepoints(segments: DataFrame, most: int = 5, min_length: int = 10, values: str = "ys") -> DataFrame:
    """The first `most` changepoints as the last index of each segment but the final one."""
    n = F.size(values)
    inner = F.transform(F.slice(F.col("segment_ends"), 1, F.greatest(F.size("segment_ends") - 1, F.lit(0))), lambda e: e - 1)
    kept = F.filter(inner, lambda i: (i > 0) & (i < n - 1))
    return segments.withColumn(
        "changepoints", F.when(n >= min_length, F.slice(kept, 1, most)).otherwise(F.array().cast("array<int>"))
    )
