"""Quality guards per series, from one pass over a positioned panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.config import GuardRules, SparseRule
from panelwright.functions import labels
from panelwright.functions.columns import ratio


def guard_statistics(panel: DataFrame, rules: GuardRules = GuardRules(), date_col: str | None = None) -> DataFrame:
    """Everything the guards look at, one row per series.

    Needs the hash by series only: the seasonal means are a window inside it, the rest one grouped
    aggregate.  Values of one series are gathered for the outlier count; their number is bounded by
    the calendar.
    """
    y = F.col("claim_count")
    recent = F.col("idx") >= F.col("n") - rules.window
    season = F.avg(y).over(W.partitionBy("series_id", F.pmod("idx", F.lit(rules.period))))
    df = panel.withColumn("_season", F.when(F.col("idx") < rules.period, season))
    gap = F.lit(0)
    if date_col is not None:
        before = F.lag(date_col).over(W.partitionBy("series_id").orderBy("idx"))
        df = df.withColumn("_gap", F.datediff(date_col, before))
        gap = F.coalesce(F.max("_gap"), F.lit(0))
    return df.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y.isNull()).alias("n_null"),
        F.count_if(y == 0).alias("n_zero"),
        F.avg(y).alias("mean"),
        F.stddev_pop(y).alias("std"),
        F.var_pop(y).alias("variance"),
        F.avg(F.when(recent, y)).alias("recent_mean"),
        F.var_pop(F.when(recent, y)).alias("recent_var"),
        F.avg(F.when(~recent, y)).alias("past_mean"),
        F.var_pop(F.when(~recent, y)).alias("past_var"),
        F.var_pop("_season").alias("season_var"),
        F.percentile(y, [0.25, 0.75]).alias("quartiles"),
        F.collect_list(y).alias("ys"),
        gap.alias("max_gap_days"),
    )


def guard_table(
    panel: DataFrame,
    rules: GuardRules = GuardRules(),
    date_col: str | None = None,
    outliers: str = "iqr",
) -> DataFrame:
    """Flags, their measures and the comma-joined recommendations per series.

    With too little data for a check its flag is false and its measure null (drift) or 0 (season).
    Limits are compared at 9 decimals, so that summation order cannot flip a flag.
    `outliers` is `iqr` (fences) or `zscore`.
    """
    s = guard_statistics(panel, rules, date_col)
    n = F.col("n")
    long_enough = n > rules.window
    mean_shift = F.coalesce(
        ratio(F.abs(F.col("recent_mean") - F.col("past_mean")), F.sqrt("past_var")), F.lit(0.0)
    )
    var_shift = F.coalesce(ratio(F.abs(F.col("recent_var") - F.col("past_var")), F.col("past_var")), F.lit(0.0))
    if outliers == "iqr":
        iqr = F.col("quartiles")[1] - F.col("quartiles")[0]
        low = F.col("quartiles")[0] - rules.outlier_factor * iqr
        high = F.col("quartiles")[1] + rules.outlier_factor * iqr
    elif outliers == "zscore":
        low = F.col("mean") - rules.outlier_factor * F.col("std")
        high = F.col("mean") + rules.outlier_factor * F.col("std")
    else:
        raise ValueError(f"unknown outlier method: {outliers}")
    n_out = F.size(F.filter("ys", lambda v: (v < low) | (v > high)))
    seasonal = F.least(F.lit(1.0), F.coalesce(ratio(F.col("season_var"), F.col("variance")), F.lit(0.0)))
    out = s.select(
        "series_id",
        (F.col("n_zero") / n >= rules.zero_ratio).alias("is_sparse"),
        (F.col("n_zero") / n).alias("zero_ratio"),
        (long_enough & ((F.round(mean_shift, 9) > rules.sigma) | (F.round(var_shift, 9) > rules.variance_ratio))).alias("has_drift"),
        F.when(long_enough, mean_shift).alias("mean_shift_sigma"),
        (
            (F.col("n_null") == 0) & (n >= rules.expected_length) & (F.col("max_gap_days") <= rules.gap_days)
        ).alias("is_complete"),
        (n_out > 0).alias("has_outliers"),
        (n_out / n).alias("outlier_ratio"),
        F.when(n >= 2 * rules.period, seasonal).otherwise(0.0).alias("seasonality_strength"),
    ).withColumn("has_seasonality", F.round("seasonality_strength", 9) >= rules.strength)
    advice = F.array_compact(
        F.array(
            F.when(F.col("is_sparse"), "USE_NAIVE_MODEL"),
            F.when(F.col("has_drift"), "APPLY_SEASONAL_RECALIBRATION"),
            F.when(~F.col("is_complete"), "SKIP_RECONCILE"),
            F.when(F.col("outlier_ratio") > rules.outlier_share, "PREPROCESS_OUTLIERS"),
            F.when(~F.col("has_seasonality"), "USE_SIMPLE_MODEL"),
        )
    )
    return out.withColumn("recommendations", F.array_join(advice, ","))


def outlier_positions(panel: DataFrame, method: str = "iqr", threshold: float = 3.0) -> DataFrame:
    """The rows outside the fences of their own series (a bounded window per series)."""
    whole = W.partitionBy("series_id")
    y = F.col("claim_count")
    if method == "iqr":
        df = panel.withColumn("_q", F.percentile(y, [0.25, 0.75]).over(whole))
        iqr = F.col("_q")[1] - F.col("_q")[0]
        hit = (y < F.col("_q")[0] - threshold * iqr) | (y > F.col("_q")[1] + threshold * iqr)
        return df.where(hit).drop("_q")
    if method == "zscore":
        df = panel.withColumn("_m", F.avg(y).over(whole)).withColumn("_s", F.stddev_pop(y).over(whole))
        return df.where(F.abs(F.try_divide(y - F.col("_m"), F.col("_s"))) > threshold).drop("_m", "_s")
    raise ValueError(f"unknown outlier method: {method}")


def apply_guards(panel: DataFrame, guards: DataFrame) -> DataFrame:
    """Rows of series that are neither sparse nor incomplete."""
    bad = guards.where(F.col("is_sparse") | ~F.col("is_complete")).select("series_id")
    return panel.join(bad, "series_id", "left_anti")


def model_eligibility(history: DataFrame, rule: SparseRule = SparseRule()) -> DataFrame:
    """Whether a series is worth a model: `status` (ok or skipped), `reason` and the sparse texts."""
    y = F.col("claim_count")
    s = history.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.avg(y).alias("mean_claims"),
        F.stddev_pop(y).alias("std_claims"),
        (F.count_if(y != 0) / F.count(F.lit(1))).alias("nonzero_ratio"),
    )
    short = F.col("n_obs") < rule.min_obs
    sparse = labels.sparse_flag(F.col("mean_claims"), F.col("nonzero_ratio"), rule)
    text = labels.sparse_reason(F.col("mean_claims"), F.col("nonzero_ratio"), rule)
    reason = (
        F.when(short, F.concat(F.lit("insufficient_data (only "), F.col("n_obs"), F.lit(" months)")))
        .when(sparse, F.concat(F.lit("sparse_series ("), text, F.lit(")")))
        .when(F.col("std_claims") < rule.min_std, F.lit("zero_variance"))
    )
    return s.select(
        "series_id",
        F.when(reason.isNull(), "ok").otherwise("skipped").alias("status"),
        F.coalesce(reason, F.lit("")).alias("reason"),
        sparse.alias("sparse_flag"),
        F.when(sparse, text).otherwise("").alias("sparse_reason"),
        "n_obs",
        "mean_claims",
        "std_claims",
        "nonzero_ratio",
    )

