"""Forecast against actual: joins, metric tables, gates and diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.config import KpiGate
from panelwright.functions import accuracy
from panelwright.functions.columns import chi2_tail_df10, key_part, obs, pred, ratio
from panelwright.operators.features import by_series, in_order

SLOT = ["series_id", "year", "month"]


def compare_inner(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Slots present on both sides with error = actual - forecast and its size."""
    keep = [c for c in ("y_pred", "y_pred_lower", "y_pred_upper", "model") if c in forecast.columns]
    return (
        actual.select(*SLOT, *[c for c in ("idx", "n") if c in actual.columns], "claim_count")
        .join(forecast.select(*SLOT, *keep), SLOT)
        .withColumn("error", obs() - pred())
        .withColumn("abs_error", F.abs("error"))
    )


def compare_left(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Every actual slot; a missing forecast counts as 0 in the error.  pct_error is 0 where y = 0."""
    return (
        actual.select(*SLOT, "claim_count")
        .join(forecast.select(*SLOT, "y_pred"), SLOT, "left")
        .withColumn("error", obs() - F.coalesce(pred(), F.lit(0.0)))
        .withColumn("abs_error", F.abs("error"))
        .withColumn("pct_error", F.when(obs() > 0, F.col("error") / obs() * 100).otherwise(0.0))
    )


def compare_outer(actual: DataFrame, forecast: DataFrame, slot: str = "week") -> DataFrame:
    """Slots of either side (0 where absent), for series present on both sides."""
    keys = ["series_id", "year", slot]
    forecast_ids, actual_ids = forecast.select("series_id"), actual.select("series_id")
    a = actual.join(forecast_ids, "series_id", "left_semi").select(*keys, "claim_count")
    f = forecast.join(actual_ids, "series_id", "left_semi").select(*keys, "y_pred")
    return a.join(f, keys, "full").select(
        *keys, F.coalesce(obs(), F.lit(0.0)).alias("claim_count"), F.coalesce(pred(), F.lit(0.0)).alias("y_pred")
    )


def match_by_position(actual: DataFrame, arrays: DataFrame, slot: str = "week", values: str = "yhat") -> DataFrame:
    """Pair the slot number k of the actuals with element k of each series' forecast array."""
    steps = arrays.select("series_id", F.posexplode(values).alias("_p", "y_pred")).withColumn(slot, F.col("_p") + 1)
    return actual.join(steps.drop("_p"), ["series_id", slot])


def metrics_by(df: DataFrame, *by: str) -> DataFrame:
    """Percent metrics, MAE and RMSE per group (one map-side combined aggregate)."""
    return df.groupBy(*by).agg(*accuracy.bundle(obs(), pred()))


def fraction_metrics_by(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(*accuracy.fraction_bundle(obs(), pred()))


def naive_scale(train: DataFrame, period: int = 12) -> DataFrame:
    """Mean absolute seasonal step per series; the plain step where the series is not longer."""
    seasonal = F.abs(obs() - F.lag(obs(), period).over(in_order()))
    plain = F.abs(obs() - F.lag(obs(), 1).over(in_order()))
    return (
        train.withColumn("_step", F.when(F.col("n") > period, seasonal).otherwise(plain))
        .groupBy("series_id")
        .agg(F.avg("_step").alias("naive_mae"))
    )


def with_mase(metrics: DataFrame, scale: DataFrame) -> DataFrame:
    """Add `mase` = MAE over the naive scale of the training part; null where that is 0."""
    return metrics.join(scale, "series_id", "left").withColumn("mase", ratio(F.col("mae"), F.col("naive_mae"))).drop("naive_mae")


def evaluation(df: DataFrame, *by: str) -> DataFrame:
    """MAPE over y <> 0 in percent, MAE, RMSE, R2, points and totals per group.

    R2 uses the sums of y and y squared, so no second pass over the rows is needed.
    """
    n = F.count(F.lit(1))
    rss = F.sum((obs() - pred()) * (obs() - pred()))
    tss = F.greatest(F.var_pop(obs()) * n, F.lit(0.0))
    return df.groupBy(*by).agg(
        (accuracy.mape_nonzero(obs(), pred()) * 100).alias("mape"),
        accuracy.mae(obs(), pred()).alias("mae"),
        accuracy.rmse(obs(), pred()).alias("rmse"),
        (1 - ratio(rss, tss)).alias("r2"),
        n.alias("n_points"),
        F.sum(obs()).alias("total_actual"),
        F.sum(pred()).alias("total_predicted"),
        accuracy.total_bias(obs(), pred()).alias("bias"),
    )


def evaluation_documents(df: DataFrame, slot: str = "week") -> DataFrame:
    """Per series: key parts, ordered weeks, actuals and predictions, and the metrics as a struct."""
    scored = evaluation(df, "series_id").select("series_id", F.struct("mape", "mae", "rmse", "r2", "n_points").alias("metrics"))
    points = F.sort_array(F.collect_list(F.struct(slot, "claim_count", "y_pred")))
    nested = df.groupBy("series_id").agg(points.alias("z"))
    return nested.join(scored, "series_id").select(
        "series_id",
        *[key_part(F.col("series_id"), i).alias(c) for i, c in enumerate(("plant", "product_cat2", "mid_category"))],
        F.col(f"z.{slot}").alias("weeks_evaluated"),
        F.col("z.claim_count").alias("actual_values"),
        F.col("z.y_pred").alias("predicted_values"),
        "metrics",
    )


def monthly_totals(compare: DataFrame) -> DataFrame:
    """Run statistics of a comparison: rows, series, mean error and MAE per month."""
    return compare.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.countDistinct("series_id").alias("n_series"),
        F.avg("error").alias("mean_error"),
        F.avg("abs_error").alias("mae"),
    )


def overall_scores(compare: DataFrame) -> DataFrame:
    """MAE, RMSE, MAPE against y + 1, WMAPE over all rows and mean over-forecast, as one row."""
    return compare.agg(
        accuracy.mae(obs(), pred()).alias("mae"),
        accuracy.rmse(obs(), pred()).alias("rmse"),
        accuracy.mape_plus_one_pct(obs(), pred()).alias("mape"),
        (ratio(F.sum(F.abs(obs() - pred())), F.sum(obs())) * 100).alias("wmape"),
        F.avg(pred() - obs()).alias("bias"),
        F.count(F.lit(1)).alias("n_records"),
    )


def retrain_candidates(compare: DataFrame) -> DataFrame:
    """Rows that miss by twice the MAE, by 1.5 times the WMAPE, by half of the actual either way, or
    by more than 30 % on 10 or more."""
    kpi = overall_scores(compare).select(F.struct("mae", "wmape").alias("k")).scalar()
    over = pred() - obs()
    pct = F.abs(over) / (obs() + 1) * 100
    return compare.where(
        (F.abs(over) > kpi["mae"] * 2)
        | (pct > kpi["wmape"] * 1.5)
        | (over > obs() * 0.5)
        | (over < -obs() * 0.5)
        | ((obs() >= 10) & (pct > 30))
    ).withColumn("abs_pct_error", pct)


def kpi(compare: DataFrame, gate: KpiGate = KpiGate(), by: tuple[str, ...] = ()) -> DataFrame:
    """MAPE over y > 0, bias, MAE, RMSE, counts and whether both limits are met (null fails)."""
    return (
        compare.groupBy(*by)
        .agg(
            accuracy.mape_positive(obs(), pred()).alias("mape"),
            accuracy.mean_error_bias(obs(), pred()).alias("bias"),
            accuracy.mae(obs(), pred()).alias("mae"),
            accuracy.rmse(obs(), pred()).alias("rmse"),
            F.count(F.lit(1)).alias("n_records"),
            F.countDistinct("series_id").alias("n_series"),
        )
        .withColumn(
            "passed",
            F.coalesce((F.col("mape") < gate.mape) & (F.abs("bias") < gate.bias), F.lit(False)),
        )
    )


def mean_series_kpi(evaluated: DataFrame, gate: KpiGate = KpiGate()) -> DataFrame:
    """Means of the per-series MAPE (percent) and |bias| against the gate."""
    return evaluated.agg(
        F.avg("mape").alias("mean_mape"), F.avg(F.abs("bias")).alias("mean_abs_bias"), F.count(F.lit(1)).alias("n_series")
    ).withColumn(
        "passed",
        F.coalesce((F.col("mean_mape") / 100 < gate.mape) & (F.col("mean_abs_bias") < gate.bias), F.lit(False)),
    )


def year_metrics(compare: DataFrame) -> DataFrame:
    """MAPE, MASE (against the plain step), bias and RMSE per series with guarded denominators."""
    step = F.abs(obs() - F.lag(obs()).over(in_order()))
    return (
        compare.withColumn("_step", step)
        .groupBy("series_id")
        .agg(
            accuracy.mape_guarded(obs(), pred()).alias("mape"),
            (accuracy.mae(obs(), pred()) / F.coalesce(F.nullif(F.avg("_step"), F.lit(0.0)), F.lit(1.0))).alias("mase"),
            accuracy.guarded_bias(obs(), pred()).alias("bias"),
            accuracy.rmse(obs(), pred()).alias("rmse"),
        )
    )


def poor_performers(metrics: DataFrame, mape: float = 0.20, bias: float = 0.05, mase: float = 1.5) -> DataFrame:
    """Series over any limit with a priority (0.4 MAPE, 0.3 |bias|, 0.3 MASE, each over its limit)."""
    m, b, s = F.col("mape"), F.abs(F.col("bias")), F.col("mase")
    over = F.coalesce(m > mape, F.lit(False)) | F.coalesce(b > bias, F.lit(False)) | F.coalesce(s > mase, F.lit(False))
    return metrics.where(over).withColumn("priority_score", m / mape * 0.4 + b / bias * 0.3 + s / mase * 0.3)


def reliability(compare: DataFrame) -> DataFrame:
    """Scores 0..100 for size of error, interval width, coverage and volatility, and their mix."""
    y = F.greatest(obs(), F.lit(0.0))
    stats = {
        "_mean": F.avg(y).over(by_series()),
        "_std": F.when(F.count(F.lit(1)).over(by_series()) > 1, F.stddev_pop(y).over(by_series())).otherwise(1.0),
        "_high": F.max(y).over(by_series()) * 1.5,
        "_low": F.greatest(F.lit(0.0), F.min(y).over(by_series()) * 0.5),
    }
    df = compare.withColumns(stats)
    bounded = {
        name: F.least(F.greatest(F.col(c), F.col("_low")), F.col("_high"))
        for name, c in (("_p", "y_pred"), ("_lo", "y_pred_lower"), ("_hi", "y_pred_upper"))
    }
    df = df.withColumns(bounded)
    g = df.groupBy("series_id").agg(
        F.max("_mean").alias("mean"),
        F.max("_std").alias("std"),
        F.stddev_pop(y).alias("std_y"),
        F.avg(F.abs(y - F.col("_p"))).alias("mae"),
        F.sqrt(F.avg((y - F.col("_p")) * (y - F.col("_p")))).alias("rmse"),
        F.sum((y - F.col("_p")) * (y - F.col("_p"))).alias("rss"),
        F.sum((y - F.col("_mean")) * (y - F.col("_mean"))).alias("tss"),
        F.avg(F.col("_hi") - F.col("_lo")).alias("width"),
        F.avg(((y >= F.col("_lo")) & (y <= F.col("_hi"))).cast("double")).alias("covered"),
        F.avg("_p").alias("p_mean"),
        F.stddev_pop("_p").alias("p_std"),
    )

    def capped(error: Column, scale: Column) -> Column:
        return F.greatest(F.lit(0.0), 100 * (1 - error / F.when(scale > 0, scale).otherwise(1.0)))

    width_ratio = F.col("width") / F.greatest(F.lit(1e-6), 2 * F.col("std"))
    log_width = F.log2(F.when(width_ratio > 0, width_ratio))
    swing = (F.col("p_std") / (F.col("p_mean") + 1e-10)) / (F.col("std_y") / (F.col("mean") + 1e-10) + 1e-10)
    out = g.select(
        "series_id",
        capped(F.col("mae"), F.col("mean") + F.col("std")).alias("mae_score"),
        capped(F.col("rmse"), F.col("mean") + 2 * F.col("std")).alias("rmse_score"),
        F.coalesce(100 * F.exp(-F.abs(log_width)), F.lit(0.0)).alias("width_score"),
        (100 * F.exp(-F.abs(F.lit(0.95) - F.col("covered")))).alias("interval_score"),
        F.when(F.col("tss") != 0, 1 - ratio(F.col("rss"), F.col("tss"))).otherwise(0.0).alias("r2"),
        (100 * F.exp(-F.abs(F.log2(swing + 1e-10)))).alias("volatility_score"),
    )
    return out.withColumn(
        "reliability_score",
        F.col("mae_score") * 0.25
        + F.col("rmse_score") * 0.25
        + F.col("width_score") * 0.2
        + F.col("interval_score") * 0.2
        + F.col("volatility_score") * 0.1,
    )


def residual_diagnostics(compare: DataFrame, lags: int = 10, min_rows: int = 10) -> DataFrame:
    """Ljung-Box over 10 lags, Jarque-Bera normality and the moments of the errors per series.

    Normality is tested by skewness and kurtosis instead of order statistics.
    """
    if lags != 10:
        raise ValueError("the tail probability is in closed form for 10 lags only")
    e = F.col("error")
    centred = compare.withColumn("_c", e - F.avg(e).over(by_series()))
    for k in range(1, lags + 1):
        centred = centred.withColumn(f"_p{k}", F.col("_c") * F.lag("_c", k).over(in_order()))
    n = F.col("n_residuals")
    g = centred.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_residuals"),
        F.sum(F.col("_c") * F.col("_c")).alias("ss"),
        *[F.sum(f"_p{k}").alias(f"s{k}") for k in range(1, lags + 1)],
        F.avg(e).alias("residual_mean"),
        F.stddev_samp(e).alias("residual_std"),
        F.skewness(e).alias("residual_skew"),
        F.kurtosis(e).alias("residual_kurtosis"),
    ).where(n >= min_rows)
    q = F.lit(0.0)
    for k in range(1, lags + 1):
        r = ratio(F.col(f"s{k}"), F.col("ss"))
        q = q + F.when(n > k, r * r / (n - k)).otherwise(0.0)
    q = F.when(F.col("ss") > 0, q * n * (n + 2))
    skew = F.nanvl("residual_skew", F.lit(None).cast("double"))
    kurt = F.nanvl("residual_kurtosis", F.lit(None).cast("double"))
    jb = n / 6 * (skew * skew + kurt * kurt / 4)
    return g.select(
        "series_id",
        "n_residuals",
        chi2_tail_df10(q).alias("ljungbox_pvalue"),
        (chi2_tail_df10(q) > 0.05).alias("ljungbox_pass"),
        F.exp(-jb / 2).alias("normality_pvalue"),
        (F.exp(-jb / 2) > 0.05).alias("normality_pass"),
        "residual_mean",
        "residual_std",
        skew.alias("residual_skew"),
        kurt.alias("residual_kurtosis"),
    )


def residual_pass_rates(diagnostics: DataFrame) -> DataFrame:
    """Share of series that pass each residual test."""
    rate = lambda c: F.avg(F.col(c).cast("double"))
    return diagnostics.agg(
        F.count(F.lit(1)).alias("n_series"),
        rate("ljungbox_pass").alias("ljungbox_pass_rate"),
        rate("normality_pass").alias("normality_pass_rate"),
        F.count_if(~F.col("ljungbox_pass")).alias("n_autocorrelated"),
    )


def failing_series(diagnostics: DataFrame) -> DataFrame:
    """Series that fail a residual test, and which: series_id, failed (`ljungbox`, `normality`), and the p-values."""
    failed = [F.when(~F.col(f"{test}_pass"), F.lit(test)) for test in ("ljungbox", "normality")]
    named = diagnostics.withColumn("failed", F.concat_ws(",", *failed)).where("failed <> ''")
    return named.select("series_id", "failed", "ljungbox_pvalue", "normality_pvalue")


def tuning_gain(tuned: DataFrame, original: DataFrame) -> DataFrame:
    """Tuned against original MASE per series with the improvement in percent."""
    before = original.select("series_id", F.col("mase").alias("original_mase"))
    gain = ratio(F.col("original_mase") - F.col("best_mase"), F.col("original_mase")) * 100
    return tuned.join(before, "series_id", "left").withColumn("improvement_pct", gain)


def clip_nonnegative(df: DataFrame, *cols: str) -> DataFrame:
    """Rows whose listed values are all at least 0."""
    for c in cols:
        df = df.where(F.col(c) >= 0)
    return df


