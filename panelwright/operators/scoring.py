"""Early-warning scores from five factors per series.

All native factors come from one grouped aggregate over the history: windows and group-by share the
hash by series.  Only the changepoint part of the fifth factor runs in Python batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.config import FACTOR_WEIGHTS, FACTORS, RiskCuts, SparseRule
from panelwright.functions import calendar, labels
from panelwright.functions.columns import clip, ratio
from panelwright.operators import changepoints, features, ranking


def confidence_from_error(wmape: Column) -> Column:
    """1 at no error, 0 from 200 %; unknown or beyond 1000 is 0."""
    return F.when(wmape.isNull() | (wmape > 1000), F.lit(0.0)).otherwise(clip(1 - wmape / 200, 0.0, 1.0))


def interval_confidence(forecast: DataFrame, actual: DataFrame | None = None, nominal: float = 0.8) -> DataFrame:
    """Half compression of the interval (1 - width / level), half its coverage of the actuals.

    Without actuals, or where their number differs, the nominal coverage is assumed.
    """
    lo, hi = F.col("y_pred_lower"), F.col("y_pred_upper")
    df = forecast
    covered = F.lit(None).cast("double")
    if actual is not None:
        df = df.join(actual.select("series_id", "year", "month", "claim_count"), ["series_id", "year", "month"], "left")
        covered = F.when(
            F.count("claim_count") == F.count(F.lit(1)), F.avg(F.col("claim_count").between(lo, hi).cast("double"))
        )
    g = df.groupBy("series_id").agg(F.avg(hi - lo).alias("w"), F.avg((hi + lo) / 2).alias("m"), covered.alias("c"))
    compression = F.when(F.col("m") > 0, clip(1 - F.col("w") / F.col("m"), 0.0, 1.0)).otherwise(0.0)
    return g.select("series_id", clip(0.5 * compression + 0.5 * F.coalesce("c", F.lit(nominal)), 0.0, 1.0).alias("f2_conf"))


def history_factors(history: DataFrame, period: int = 12, recent: int = 6, by: tuple[str, ...] = ("series_id",)) -> DataFrame:
    """Mean of the last year, seasonality, amplitude and acceleration, one row per series.

    Seasonality is the mean over positions in the year of 1 - deviation / (mean + 0.01), at least 0,
    over complete cycles and positions that vary.  Amplitude is the mean range of all one-year
    windows over the mean, at most 1.  Acceleration is the mean rise of the last differences over
    the deviation of the last steps, at most 3, over 3.
    """
    y = F.col("claim_count")
    series = W.partitionBy(*by)
    order = series.orderBy("idx")
    position = W.partitionBy(*by, "_position")
    in_cycle = F.col("_in_cycle")
    year = order.rowsBetween(0, period - 1)
    one, two = F.lag(y, 1).over(order), F.lag(y, 2).over(order)
    pos = F.col("idx") - (F.col("n") - recent)
    # the windows of one ordering are added together, so each ordering sorts once
    df = (
        history.withColumns(
            {
                "_range": F.when(F.col("idx") <= F.col("n") - period, F.max(y).over(year) - F.min(y).over(year)),
                "_v": F.when(pos >= 1, y - one),
                "_a": F.when(pos >= 2, y - 2 * one + two),
            }
        )
        .withColumns(
            {
                "_position": F.pmod("idx", F.lit(period)),
                "_in_cycle": F.when(F.col("idx") < F.floor(F.col("n") / period) * period, y),
            }
        )
        .withColumns(
            {
                "_pm": F.avg(in_cycle).over(position),
                "_ps": F.stddev_pop(in_cycle).over(position),
                "_pc": F.count(in_cycle).over(position),
            }
        )
    )
    first_of_position = F.col("idx") < period
    steady = F.when(
        first_of_position & (F.col("_pc") >= 2) & (F.col("_ps") > 0),
        F.greatest(F.lit(0.0), 1 - F.col("_ps") / (F.col("_pm") + 0.01)),
    )
    g = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_hist"),
        F.avg(y).alias("mean_y"),
        (F.count_if(y != 0) / F.count(F.lit(1))).alias("nonzero_ratio"),
        F.avg(F.when(F.col("idx") >= F.col("n") - 12, y)).alias("mean_recent"),
        F.avg(steady).alias("_steady"),
        F.avg("_range").alias("_swing"),
        F.stddev_pop("_v").alias("_sv"),
        F.avg(F.when(F.col("_a") > 0, F.col("_a"))).alias("_up"),
    )
    long = F.col("n_hist") >= 2 * period
    rise = F.coalesce(clip(ratio(F.col("_up"), F.col("_sv")), 0.0, 3.0) / 3, F.lit(0.0))
    return g.select(
        *by,
        "n_hist",
        "mean_y",
        "nonzero_ratio",
        "mean_recent",
        F.when(long, F.coalesce("_steady", F.lit(0.0))).alias("f3_season"),
        F.when(long, F.when(F.col("mean_y") < 0.01, 0.0).otherwise(F.least(ratio(F.col("_swing"), F.col("mean_y")), F.lit(1.0)))).alias("f4_ampl"),
        F.when(F.col("n_hist") >= recent + 2, rise).alias("accel"),
    )


def growth_ratio(mean_forecast: Column, mean_recent: Column, n_hist: Column) -> Column:
    """Mean forecast over the mean of the last 12 points; null when short or near zero."""
    return F.when((n_hist >= 12) & (mean_recent >= 0.01), ratio(mean_forecast, mean_recent))


def five_factors(
    history: DataFrame,
    forecast: DataFrame,
    errors: DataFrame,
    change_share: DataFrame | None = None,
    rule: SparseRule = SparseRule(),
    min_history: int = 24,
    by: tuple[str, ...] = ("series_id",),
) -> DataFrame:
    """The five factors with the sparse flag and reason, for series with a forecast.

    `errors` has `wmape` per series.  `change_share` has `cp_prob`; without it the changepoint part
    of the fifth factor counts as 0.
    """
    ahead = forecast.groupBy(*by).agg(F.avg("y_pred").alias("_ahead"))
    df = history_factors(history, by=by).where(F.col("n_hist") >= min_history).join(ahead, list(by))
    df = df.join(errors.select(*by, "wmape"), list(by), "left")
    if change_share is not None:
        df = df.join(change_share.select(*by, "cp_prob"), list(by), "left")
    else:
        df = df.withColumn("cp_prob", F.lit(0.0))
    sparse = labels.sparse_flag(F.col("mean_y"), F.col("nonzero_ratio"), rule)
    return df.select(
        *by,
        growth_ratio(F.col("_ahead"), F.col("mean_recent"), F.col("n_hist")).alias("f1_ratio"),
        confidence_from_error(F.col("wmape")).alias("f2_conf"),
        "f3_season",
        "f4_ampl",
        (0.5 * F.col("accel") + 0.5 * F.coalesce("cp_prob", F.lit(0.0))).alias("f5_inflect"),
        sparse.alias("sparse_flag"),
        labels.sparse_reason(F.col("mean_y"), F.col("nonzero_ratio"), rule).alias("sparse_reason"),
        "mean_y",
        "nonzero_ratio",
    )


def move_share(history: DataFrame, recent: int = 6) -> DataFrame:
    """`cp_prob` per series: the share of the last positions at which the centred mean moves unusually far.

    A rule in plain windows in place of a segmentation; `change_share` has that.
    """
    return features.centred_changepoints(history, recent=recent).select("series_id", F.col("recent_share").alias("cp_prob"))


def change_share(vectors: DataFrame, recent: int = 6) -> DataFrame:
    """`cp_prob` per series from the penalised segmentation of its history."""
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = vectors.select("series_id", "ys").repartition(partitions, "series_id")
    return changepoints.recent_change_share(changepoints.penalised_segments(spread), recent).select("series_id", "cp_prob")


def normalised(factors: DataFrame, names: tuple[str, ...] = ("f1_ratio", "f3_season", "f4_ampl", "f5_inflect")) -> DataFrame:
    """Scale the named factors to [0, 1] by their range over the series that are not sparse."""
    usable = ~F.col("sparse_flag")
    spans = factors.agg(
        F.struct(
            *[
                F.struct(F.min(F.when(usable, F.col(c))).alias("lo"), F.max(F.when(usable, F.col(c))).alias("hi")).alias(c)
                for c in names
            ]
        ).alias("s")
    ).scalar()

    def scaled(c: str) -> Column:
        width = spans[c]["hi"] - spans[c]["lo"]
        return F.when(width < 1e-10, F.when(F.col(c).isNotNull(), F.lit(0.0))).otherwise(ratio(F.col(c) - spans[c]["lo"], width))

    return factors.withColumns({c: scaled(c) for c in names})


def weighted_score(weights: dict[str, float] = FACTOR_WEIGHTS) -> Column:
    """Weighted mean over the factors that are known, in [0, 1]; 0 for sparse series or none known."""
    total = sum((F.coalesce(F.col(c) * weights[c], F.lit(0.0)) for c in FACTORS), F.lit(0.0))
    known = sum((F.when(F.col(c).isNotNull(), weights[c]).otherwise(0.0) for c in FACTORS), F.lit(0.0))
    return F.when(F.col("sparse_flag"), 0.0).otherwise(F.coalesce(clip(ratio(total, known), 0.0, 1.0), F.lit(0.0)))


def scored(factors: DataFrame, weights: dict[str, float] = FACTOR_WEIGHTS, cuts: RiskCuts = RiskCuts(), normalize: str = "raw") -> DataFrame:
    """Add score, candidate and confidence flags, level and rationale to series that are not sparse.

    The score uses the raw factors (`raw`) or their min-max scaled values (`minmax`); flags, level
    and rationale always use the raw ones.
    """
    usable = factors.where(~F.col("sparse_flag"))
    if normalize == "minmax":
        points = normalised(usable).select("series_id", weighted_score(weights).alias("ews_score"))
        usable = usable.join(points, "series_id")
    elif normalize == "raw":
        usable = usable.withColumn("ews_score", weighted_score(weights))
    else:
        raise ValueError(f"unknown normalisation: {normalize}")
    return (
        usable.withColumn(
            "candidate",
            F.coalesce(
                (F.col("f3_season") >= cuts.candidate_season) & (F.col("f4_ampl") >= cuts.candidate_amplitude), F.lit(False)
            ),
        )
        .withColumn("low_confidence", F.col("f2_conf") < cuts.low_confidence)
        .withColumn("level", labels.risk_level(F.col("ews_score"), F.col("f2_conf"), cuts))
        .withColumn("rationale", labels.rationale())
    )


REPORT = ("rank", "series_id", "ews_score", "level", *FACTORS, "candidate", "rationale")


def report(factors: DataFrame, weights: dict[str, float] = FACTOR_WEIGHTS, normalize: str = "raw") -> DataFrame:
    """The ranked score table: highest score first, ties (at 9 decimals) by series id."""
    table = scored(factors, weights, normalize=normalize)
    return ranking.ranked(table, [-F.round("ews_score", 9)]).select(*REPORT)


def discriminating(scores: DataFrame, exclude_low_confidence: bool = True) -> DataFrame:
    """Re-rank by 0.4 score + 0.3 growth + 0.3 confidence."""
    df = scores.where(F.col("level") != "LOW_CONF") if exclude_low_confidence else scores
    mix = F.col("ews_score") * 0.4 + F.coalesce("f1_ratio", F.lit(0.0)) * 0.3 + F.col("f2_conf") * 0.3
    df = df.drop("rank").withColumn("mixed_score", mix)
    return ranking.ranked(df, [-F.round("mixed_score", 9)])


def filter_scores(
    scores: DataFrame, levels: list[str] | None = None, min_conf: float = 0.0, min_ratio: float = 0.0, min_score: float = 0.0, text: str = ""
) -> DataFrame:
    """Scores at given levels, above given minimums and with the text in their id (any case)."""
    df = scores.where(
        (F.col("f2_conf") >= min_conf) & (F.col("f1_ratio") >= min_ratio) & (F.col("ews_score") >= min_score)
    )
    if levels:
        df = df.where(F.col("level").isin(*levels))
    return df.where(F.lower("series_id").contains(text.lower())) if text else df


def risk_months(forecast: DataFrame) -> DataFrame:
    """Month with the highest prediction per series; the earliest on ties."""
    slot = calendar.slot_number(F.col("year"), F.col("month"), 12)
    top = F.max_by(F.struct("year", "month", "y_pred"), F.struct(F.col("y_pred"), -slot))
    return forecast.groupBy("series_id").agg(top.alias("t")).select(
        "series_id", calendar.month_label(F.col("t.year"), F.col("t.month")).alias("risk_month"), F.col("t.y_pred").alias("risk_value")
    )


def with_risk_months(scores: DataFrame, forecast: DataFrame) -> DataFrame:
    """Add the peak month and value; `N/A` and 0 without a forecast."""
    return scores.join(risk_months(forecast), "series_id", "left").withColumns(
        {"risk_month": F.coalesce("risk_month", F.lit("N/A")), "risk_value": F.coalesce("risk_value", F.lit(0.0))}
    )


def score_summary(scores: DataFrame) -> DataFrame:
    """Count and share per level."""
    by_level = scores.groupBy("level").agg(F.count(F.lit(1)).alias("n_series"), F.avg("ews_score").alias("mean_score"))
    total = by_level.agg(F.sum("n_series").alias("t")).scalar()
    return by_level.withColumn("pct", F.col("n_series") * 100.0 / total)


def factor_summary(factors: DataFrame) -> DataFrame:
    """Per factor: known share, mean, deviation, extremes, quartiles and how many reach 0.5."""
    packed = F.explode(
        F.array(*[F.struct(F.lit(c).alias("factor"), F.col(c).alias("v")) for c in FACTORS])
    ).alias("f")
    v = F.col("f.v")
    return factors.select(packed).groupBy(F.col("f.factor").alias("factor")).agg(
        F.count(F.lit(1)).alias("n_series"),
        (F.count(v) / F.count(F.lit(1))).alias("known_ratio"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        *[F.percentile(v, F.lit(q / 100)).alias(f"q{q}") for q in (25, 50, 75)],
        F.count_if(v >= 0.5).alias("n_high"),
    )


# --- score on a 0..100 scale -------------------------------------------------------------------


def score100(history: DataFrame, forecast: DataFrame, errors: DataFrame, weights: dict[str, float], same_month: str = "first", min_mean: float = 0.5) -> DataFrame:
    """Growth, volatility, same-month growth and acceleration (0..100 each), their weighted total,
    confidence 100 - error, and the expected peak month and count.

    `same_month="first"` compares with the first six points of the history, `"calendar"` with the
    history of the forecast's own months.
    """
    y, p = F.col("claim_count"), F.col("y_pred")
    first = F.when(F.col("idx") < 6, y)
    tail = F.col("idx") - (F.col("n") - 6)
    h = history.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_hist"),
        F.avg(y).alias("historical_mean"),
        F.stddev_pop(y).alias("historical_std"),
        F.max(y).alias("historical_max"),
        F.avg(first).alias("same_mean"),
        F.regr_slope(y, F.when(tail >= 0, tail.cast("double"))).alias("recent_slope"),
    )
    if same_month == "calendar":
        months = forecast.select("series_id", "month").distinct()
        same = history.join(months, ["series_id", "month"], "left_semi").groupBy("series_id").agg(F.avg(y).alias("same_mean"))
        h = h.drop("same_mean").join(same, "series_id", "left")
    h = h.where((F.col("n_hist") >= 12) & (F.col("historical_mean") >= min_mean))
    limit = F.col("historical_mean") + 2 * F.col("historical_std")
    f = (
        forecast.join(h, "series_id")
        .groupBy("series_id", *[c for c in h.columns if c != "series_id"])
        .agg(
            F.avg(p).alias("forecast_mean"),
            F.max(p).alias("forecast_max"),
            F.avg((p > limit).cast("double")).alias("exceed"),
            F.regr_slope(p, F.col("h").cast("double")).alias("forecast_slope"),
        )
    )

    def growth(new: Column, old: Column) -> Column:
        return F.when(old < 0.01, 0.0).otherwise(clip(ratio(new - old, old) * 100, 0.0, 100.0))

    hist, std = F.col("historical_mean"), F.col("historical_std")
    slope = F.col("recent_slope")
    parts = {
        "growth_score": growth(F.col("forecast_mean"), hist),
        "volatility_score": F.when((std < 0.01) | (hist < 0.01), 0.0).otherwise(clip(F.col("exceed") * 200, 0.0, 100.0)),
        "seasonality_score": F.coalesce(growth(F.col("forecast_mean"), F.col("same_mean")), F.lit(0.0)),
        "acceleration_score": F.when(F.abs(slope) < 0.001, 0.0).otherwise(
            clip(ratio(F.col("forecast_slope") - slope, F.abs(slope)) * 100, 0.0, 100.0)
        ),
    }
    total = sum((F.col(f"{name}_score") * w for name, w in weights.items()), F.lit(0.0))
    error = F.col("wmape")
    confidence = F.when(error.isNull() | (error > 1000), 0.0).otherwise(F.greatest(F.lit(0.0), 100 - error))
    peak = risk_months(forecast).select("series_id", F.col("risk_month").alias("expected_time"), F.round("risk_value", 2).alias("expected_count"))
    return (
        f.withColumns(parts)
        .withColumn("total_score", total)
        .join(errors.select("series_id", "wmape"), "series_id", "left")
        .join(peak, "series_id")
        .select(
            "series_id",
            "total_score",
            *parts,
            "forecast_mean",
            "historical_mean",
            "forecast_max",
            "historical_max",
            F.when(hist > 0, ratio(F.col("forecast_mean") - hist, hist) * 100).otherwise(0.0).alias("growth_rate_pct"),
            F.round(confidence, 1).alias("confidence"),
            "expected_time",
            "expected_count",
        )
    )


def score100_report(scores: DataFrame) -> DataFrame:
    return ranking.ranked(scores, [-F.round("total_score", 9)])


