"""Corrections of a forecast against what happened, as functions on the comparison table.

The comparison has `series_id, year, month (or week), claim_count, y_pred, error, abs_error`; every
stage returns the same columns with the last three refreshed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.config import GuardRules, KpiGate, OrderGrid
from panelwright.functions import accuracy as acc
from panelwright.functions import calendar
from panelwright.functions.columns import floor_at, obs, pred, ratio
from panelwright.operators import accuracy, changepoints, features, forecast, guards, panel, ranking, seasonal_models



def refreshed(df: DataFrame, y_pred: Column) -> DataFrame:
    """Replace the prediction and recompute its errors."""
    return df.withColumn("y_pred", y_pred).withColumn("error", obs() - F.col("y_pred")).withColumn("abs_error", F.abs("error"))


def position_bias(compare: DataFrame, slot: str = "month", by: tuple[str, ...] = ("series_id",)) -> DataFrame:
    """Mean of actual - forecast per position in the year; `week_month` groups weeks to months."""
    position = calendar.week_to_month(F.col("week")) if slot == "week_month" else F.col(slot)
    return compare.groupBy(*by, position.alias("position")).agg(F.avg(obs() - pred()).alias("position_bias"))


def apply_position_bias(df: DataFrame, bias: DataFrame, slot: str = "month", by: tuple[str, ...] = ("series_id",)) -> DataFrame:
    """Add each position's mean error to the prediction; an unseen position adds nothing."""
    position = calendar.week_to_month(F.col("week")) if slot == "week_month" else F.col(slot)
    joined = df.withColumn("position", position).join(bias, [*by, "position"], "left")
    return refreshed(joined, pred() + F.coalesce("position_bias", F.lit(0.0))).drop("position", "position_bias")


def series_bias(compare: DataFrame, min_obs: int = 4) -> DataFrame:
    """Mean error per series and the correction it leads to (0 below `min_obs` rows)."""
    return (
        compare.groupBy("series_id")
        .agg(F.avg("error").alias("avg_bias"), F.count("claim_count").alias("n_obs"))
        .withColumn("bias_correction", F.when(F.col("n_obs") >= min_obs, F.col("avg_bias")).otherwise(0.0))
    )


def apply_series_bias(compare: DataFrame, min_obs: int = 4) -> DataFrame:
    """Shift each series by its mean error, never below 0; one window on the series."""
    n, mean = F.count(obs()).over(features.by_series()), F.avg("error").over(features.by_series())
    shift = F.when(n >= min_obs, mean).otherwise(0.0)
    return refreshed(compare.withColumn("_shift", shift), floor_at(pred() + F.col("_shift"), 0.0)).drop("_shift")


def improvement(before: DataFrame, after: DataFrame) -> DataFrame:
    """MAE before and after and the gain in percent, as one row."""
    b = before.agg(F.avg("abs_error").alias("m")).scalar()
    return after.agg(F.avg("abs_error").alias("after_mae")).select(
        b.alias("before_mae"), "after_mae", (ratio(b - F.col("after_mae"), b) * 100).alias("improvement_pct")
    )


def seasonal_factors(
    history: DataFrame, period: int = 12, cycles: int = 2, phase: str = "calendar", slot: str = "month"
) -> DataFrame:
    """Seasonal mean over overall mean from the last `cycles` cycles, per position.

    `phase="calendar"` counts positions from the start of the year (position 0 is the first slot),
    `phase="slice"` from the first point used.  Without one full cycle, or with a mean that is not
    positive, all factors are 1 (the series has no row here).
    """
    recent = history.where((F.col("idx") >= F.col("n") - period * cycles) & (F.col("n") >= period))
    start = F.greatest(F.col("n") - period * cycles, F.lit(0))
    position = (
        F.pmod(F.col(slot) - 1, F.lit(period)) if phase == "calendar" else F.pmod(F.col("idx") - start, F.lit(period))
    )
    means = recent.groupBy("series_id", position.alias("position")).agg(F.avg(obs()).alias("_m"))
    overall = F.avg("_m").over(features.by_series())
    return means.select("series_id", "position", F.when(overall > 0, ratio(F.col("_m"), overall)).otherwise(1.0).alias("factor"))


def apply_seasonal_factors(
    df: DataFrame, factors: DataFrame, period: int = 12, phase: str = "calendar", slot: str = "month"
) -> DataFrame:
    """Multiply the prediction by the factor of its position; `slice` counts the forecast steps."""
    first = F.min("idx").over(features.by_series())
    position = F.pmod(F.col(slot) - 1, F.lit(period)) if phase == "calendar" else F.pmod(F.col("idx") - first, F.lit(period))
    joined = df.withColumn("position", position).join(factors, ["series_id", "position"], "left")
    return refreshed(joined, pred() * F.coalesce("factor", F.lit(1.0))).drop("position", "factor")


def seasonal_component(history: DataFrame, period: int = 12) -> DataFrame:
    """Classical additive decomposition: seasonal component per series and calendar position.

    The trend is the centred moving average over one period (half weights at the ends for an even
    period); the component is the mean of value - trend per position, centred to sum to 0.
    """
    half = period // 2
    w = features.in_order().rowsBetween(-half, half)
    y = F.col("claim_count")
    full = F.count(y).over(w) == 2 * half + 1
    if period % 2 == 0:
        ends = (F.lag(y, half).over(features.in_order()) + F.lead(y, half).over(features.in_order())) / 2
        trend = (F.sum(y).over(w) - ends) / period
    else:
        trend = F.avg(y).over(w)
    detrended = history.withColumn("_d", F.when(full, y - trend))
    means = detrended.groupBy("series_id", F.pmod("idx", F.lit(period)).alias("position"), "n").agg(F.avg("_d").alias("_m"))
    centre = F.avg("_m").over(features.by_series())
    return means.select("series_id", "position", "n", (F.col("_m") - centre).alias("seasonal"))


def apply_seasonal_shift(
    compare: DataFrame, history: DataFrame, period: int = 12, cycles: int = 2, share: float = 0.5, mode: str = "cycle_mean"
) -> DataFrame:
    """Add half of the seasonal component to the predictions of series long enough and not constant.

    `cycle_mean` adds its mean over the last cycle (close to 0 by construction), `per_position` the
    value of the forecast's own position.
    """
    recent = history.where(F.col("idx") >= F.col("n") - period * cycles).withColumn("idx", F.col("idx") - (F.col("n") - period * cycles)).withColumn("n", F.lit(period * cycles))
    varied = (
        history.groupBy("series_id", "n")
        .agg(F.stddev_pop(F.when(F.col("idx") >= F.col("n") - period * cycles, obs())).alias("_s"))
        .where((F.col("n") >= period * cycles) & (F.col("_s") > 0))
        .select("series_id", F.col("n").alias("_hist_n"))
    )
    component = seasonal_component(recent.join(varied, "series_id", "left_semi"), period).drop("n")
    if mode == "cycle_mean":
        shift = component.groupBy("series_id").agg((F.avg("seasonal") * share).alias("_shift"))
        joined = compare.join(shift, "series_id", "left")
    elif mode == "per_position":
        shift = component.select("series_id", "position", (F.col("seasonal") * share).alias("_shift"))
        step = F.pmod(F.col("idx") - F.col("_hist_n"), F.lit(period))
        joined = (
            compare.join(varied, "series_id", "left")
            .withColumn("position", step)
            .join(shift, ["series_id", "position"], "left")
            .drop("position", "_hist_n")
        )
    else:
        raise ValueError(f"unknown mode: {mode}")
    shifted = F.when(F.col("_shift").isNotNull(), floor_at(pred() + F.col("_shift"), 0.0)).otherwise(pred())
    return refreshed(joined, shifted).drop("_shift")


def worst_series(compare: DataFrame, share: float = 0.1, min_obs: int = 26, least: int = 5, most: int = 10) -> DataFrame:
    """The series with the highest MAPE: a tenth of them, `least` if that is none, at most `most`.

    As `most` bounds the list, this is a top-k, not a sort of all series.
    """
    scored = (
        compare.groupBy("series_id")
        .agg(acc.mape_positive(obs(), pred()).alias("mape"), F.count(F.lit(1)).alias("n_obs"))
        .where(F.col("mape").isNotNull() & (F.col("n_obs") >= min_obs))
    )
    tenth = F.floor(F.count(F.lit(1)) * share)
    wanted = scored.agg(F.when(tenth < 1, F.lit(least)).otherwise(tenth).alias("k")).scalar()
    best = ranking.top(scored, most, [F.col("mape").desc(), F.col("series_id")], out="_k")
    return best.where(F.col("_k") <= wanted).drop("_k")


def reselect_worst(
    compare: DataFrame, history: DataFrame, grid: OrderGrid = OrderGrid(), min_obs: int = 6, min_history: int = 24, horizon: int = 6
) -> DataFrame:
    """Choose a new order for the worst series and put its forecast into the comparison."""
    worst = worst_series(compare, min_obs=min_obs).select("series_id")
    rows = history.where(F.col("n") >= min_history).join(worst, "series_id", "left_semi")
    chosen = seasonal_models.select_orders(panel.series_vectors(rows), forecast.unit_root(rows), grid)
    fresh = seasonal_models.forecast_rows(chosen, rows).select(*accuracy.SLOT, F.col("y_pred").alias("_new"))
    joined = compare.join(fresh, accuracy.SLOT, "left")
    return refreshed(joined, F.coalesce("_new", pred())).drop("_new")


def staged_correction(
    compare: DataFrame,
    history: DataFrame,
    gate: KpiGate = KpiGate(),
    stages: tuple[str, ...] = ("bias", "seasonal", "reselect"),
    min_obs: int = 4,
) -> tuple[DataFrame, list[dict]]:
    """Apply the stages in turn until the gate is met.

    Returns the corrected comparison and the KPI row after each step.  The comparison is written to
    the checkpoint folder before each gate, which reads one row, so no stage is computed twice.
    """
    apply = {
        "bias": lambda df: apply_series_bias(df, min_obs),
        "seasonal": lambda df: apply_seasonal_shift(df, history),
        "reselect": lambda df: reselect_worst(df, history),
    }
    current = ranking.checkpointed(compare)
    trail = [{"stage": "start", **accuracy.kpi(current, gate).first().asDict()}]
    for stage in stages:
        if trail[-1]["passed"]:
            break
        current = ranking.checkpointed(apply[stage](current))
        trail.append({"stage": stage, **accuracy.kpi(current, gate).first().asDict()})
    return current, trail


def staged_columns(
    compare: DataFrame, history: DataFrame, stages: tuple[str, ...] = ("bias", "seasonal", "reselect"), min_obs: int = 4
) -> DataFrame:
    """The comparison with the prediction after every stage side by side: `y_start`, then `y_<stage>` each.

    Every stage works on the one before it.  The plan is one plan: nothing is written or read back in between.
    """
    out = compare.withColumn("y_start", pred())
    for stage in stages:
        if stage == "bias":
            out = apply_series_bias(out, min_obs)
        elif stage == "seasonal":
            out = apply_seasonal_shift(out, history)
        elif stage == "reselect":
            out = reselect_worst(out, history)
        else:
            raise ValueError(f"unknown stage: {stage}")
        out = out.withColumn(f"y_{stage}", pred())
    return out


def stage_trail(staged: DataFrame, stages: tuple[str, ...] = ("bias", "seasonal", "reselect"), gate: KpiGate = KpiGate()) -> DataFrame:
    """The KPI row of every stage of `staged_columns`, in one pass; `applied` says whether the job comes to the stage.

    The job goes on until a stage meets the gate, so all stages up to the first that does are applied, or all of them.
    """
    steps = [
        F.struct(F.lit(i).alias("step"), F.lit(stage).alias("stage"), F.col(f"y_{stage}").alias("y_pred"))
        for i, stage in enumerate(("start", *stages))
    ]
    rows = staged.select("series_id", "claim_count", F.explode(F.array(*steps)).alias("s")).select("series_id", "claim_count", "s.*")
    rated = accuracy.kpi(rows, gate, by=("step", "stage"))
    reached = rated.agg(F.coalesce(F.min(F.when(F.col("passed"), F.col("step"))), F.lit(len(stages)))).scalar()
    return rated.withColumn("applied", F.col("step") <= reached)


def conditional_correction(
    compare: DataFrame,
    history: DataFrame,
    kpi_mape: float = 0.20,
    bias_mape: float = 0.10,
    rules: GuardRules = GuardRules(),
    period: int = 12,
    phase: str = "slice",
) -> DataFrame:
    """Correct each series only where its own error calls for it.

    Series that are not sparse get the position bias when their guarded MAPE is above `bias_mape`,
    and then the seasonal factors when it was above `kpi_mape`.  Adds the flags and the original
    prediction.
    """
    before = compare.groupBy("series_id").agg(acc.mape_guarded(obs(), pred()).alias("_mape"))
    flags = (
        guards.guard_table(history, rules)
        .select("series_id", "is_sparse", "has_drift", "is_complete")
        .join(before, "series_id")
        .select(
            "series_id",
            "is_sparse",
            "has_drift",
            "is_complete",
            ((F.col("_mape") > bias_mape) & ~F.col("is_sparse")).alias("bias_adj_applied"),
            ((F.col("_mape") > kpi_mape) & ~F.col("is_sparse")).alias("seasonal_recal_applied"),
        )
    )
    df = compare.withColumn("y_pred_original", pred()).join(flags, "series_id")
    bias = F.avg(obs() - pred()).over(W.partitionBy("series_id", "month"))
    df = refreshed(df, F.when(F.col("bias_adj_applied"), pred() + bias).otherwise(pred()))
    factors = seasonal_factors(history, period, phase=phase)
    return refreshed(
        apply_seasonal_factors(df.withColumn("_kept", pred()), factors, period, phase),
        F.when(F.col("seasonal_recal_applied"), pred()).otherwise(F.col("_kept")),
    ).drop("_kept")


def correction_summary(corrected: DataFrame, history: DataFrame, period: int = 12) -> DataFrame:
    """Per series: metrics before and after, applied flags and the number of changepoints."""
    O = F.col("y_pred_original")
    m = corrected.groupBy("series_id").agg(
        acc.mape_guarded(obs(), O).alias("mape_original"),
        acc.mape_nonzero(obs(), pred()).alias("mape_adjusted"),
        acc.guarded_bias(obs(), O).alias("bias_original"),
        acc.total_bias(obs(), pred()).alias("bias_adjusted"),
        acc.rmse(obs(), pred()).alias("rmse"),
        acc.mae(obs(), pred()).alias("mae"),
        F.count(F.lit(1)).alias("n_points"),
        F.avg(obs() - O).alias("bias_intercept"),
        F.bool_or("bias_adj_applied").alias("bias_adj_applied"),
        F.bool_or("seasonal_recal_applied").alias("seasonal_recal_applied"),
    )
    changes = changepoints.t_test_flags(history).groupBy("series_id").agg(
        F.count_if("changepoint").alias("n_changepoints")
    )
    return accuracy.with_mase(m, accuracy.naive_scale(history, period)).join(changes, "series_id", "left").drop("mae")


def stable_correction(
    fitted: DataFrame, target: DataFrame, history: DataFrame, min_stable: int = 10, margin: int = 5, period: int = 12
) -> DataFrame:
    """Position bias learned on stable slots only, then seasonal factors.

    `fitted` is the comparison over the history span (with idx), `target` the one to correct.  A
    series with changepoints and at most `min_stable` stable slots gets no bias correction.
    """
    flags = changepoints.t_test_flags(history)
    marked = flags.groupBy("series_id").agg(F.bool_or("changepoint").alias("_changed"))
    stable = changepoints.stable_rows(flags, margin).select("series_id", "idx")
    enough = (
        stable.groupBy("series_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(marked, "series_id", "right")
        .where(~F.col("_changed") | (F.col("_n") > min_stable))
        .select("series_id")
    )
    usable = fitted.join(stable, ["series_id", "idx"], "left_semi").join(enough, "series_id", "left_semi")
    shifted = apply_position_bias(target, position_bias(usable))
    return apply_seasonal_factors(shifted, seasonal_factors(history, period), period)


def bias_intercepts(compare: DataFrame) -> DataFrame:
    return compare.groupBy("series_id").agg(F.avg(obs() - pred()).alias("bias_intercept"))
