"""Summary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions import calendar, labels
from panelwright.functions.columns import fixed_decimals, joined_text, ratio
from panelwright.operators import ranking


def month_detection(claims: DataFrame, date_col: str = "manufacturing_date") -> DataFrame:
    """Most frequent year and month of an upload, with its span, series and total, as one row.

    Rows are first counted per date and series, so the modes come from small counts.
    """
    daily = claims.groupBy(date_col, "plant", "product_cat2", "mid_category").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("claim_count").alias("claims")
    )
    facts = daily.agg(
        F.countDistinct("plant", "product_cat2", "mid_category").alias("n_series"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.sum("claims").alias("total_claims"),
    )

    def modal(part: Column) -> Column:
        counts = daily.groupBy(part.alias("v")).agg(F.sum("rows").alias("k"))
        return counts.agg(F.max_by("v", F.struct("k", -F.col("v")))).scalar()

    return facts.select(modal(F.year(date_col)).alias("year"), modal(F.month(date_col)).alias("month"), "*")


def kpi_summary(models: DataFrame) -> DataFrame:
    """Means and medians of the hold-out metrics and level counts, as one row.

    Checkpoints the metrics; the medians are exact and come from distributed counts.
    """
    names = ("wmape", "smape", "bias")
    table = ranking.checkpointed(models.select(*names, "mae", "wmape_level"))
    level = lambda name: F.count_if(F.col("wmape_level") == name).alias(f"wmape_{name.lower()}")
    medians = ranking.quantiles(table, {f"{m}_median": (m, 0.5) for m in names})
    facts = table.agg(
        F.count(F.lit(1)).alias("n_series"),
        *[F.avg(m).alias(f"{m}_mean") for m in names],
        F.avg("mae").alias("mae_mean"),
        *[level(n) for n in ("EXCELLENT", "GOOD", "FAIR", "POOR", "UNKNOWN")],
    )
    one = medians.select(F.struct("*").alias("m")).scalar()
    return facts.select("*", *[one[f"{m}_median"].alias(f"{m}_median") for m in names])


def share_of(df: DataFrame, column: str) -> DataFrame:
    """Rows and percent per value of a column (status, strategy, level, model type...)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def fallback_rate(forecast: DataFrame, fallback: tuple[str, ...] = ("naive_seasonal", "fallback_naive")) -> DataFrame:
    """Share of series whose most frequent model is a fallback, as one row."""
    counts = forecast.groupBy("series_id", "model").agg(F.count(F.lit(1)).alias("k"))
    primary = counts.groupBy("series_id").agg(F.min_by("model", F.struct(-F.col("k"), "model")).alias("model"))
    n = F.count_if(F.col("model").isin(*fallback))
    return primary.agg(F.count(F.lit(1)).alias("n_series"), n.alias("n_fallback"), (n * 100.0 / F.count(F.lit(1))).alias("fallback_pct"))


def metrics_by_model(metrics: DataFrame) -> DataFrame:
    """Mean metrics and series per model type."""
    return metrics.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_series"), *[F.avg(c).alias(c) for c in ("wmape", "smape", "bias", "mae", "rmse")]
    )


def classified(models: DataFrame, high: float = 0.7, low: float = 0.4) -> DataFrame:
    """Add the predictability class and whether the series is worth the focus (high and above the
    first quartile of the means).  Checkpoints the models for the quartile."""
    models = ranking.checkpointed(models)
    quarter = ranking.quantiles(models, {"q": ("mean", 0.25)}).scalar()
    return models.withColumn(
        "predictability_category", labels.predictability(F.col("predictability_score"), high, low)
    ).withColumn("focus_recommended", (F.col("predictability_category") == "high") & (F.col("mean") > quarter))


def class_shares(models: DataFrame) -> DataFrame:
    """Series, percent and mean score per predictability class."""
    return share_of(models, "predictability_category").join(
        models.groupBy("predictability_category").agg(F.avg("predictability_score").alias("mean_score")), "predictability_category"
    )


def flag_effects(models: DataFrame) -> DataFrame:
    """Mean score and series by each flag, from one pass."""
    flags = F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c).alias("v")) for c in ("is_sparse", "has_seasonality", "has_drift")])
    rows = models.select("predictability_score", F.explode(flags).alias("f"))
    return rows.groupBy(F.col("f.flag").alias("flag"), F.col("f.v").alias("value")).agg(
        F.avg("predictability_score").alias("mean_score"), F.count(F.lit(1)).alias("n_series")
    )


def focus_list(models: DataFrame, k: int = 50) -> DataFrame:
    best = models.where("focus_recommended").orderBy(F.col("predictability_score").desc(), "series_id").limit(k)
    return best.select("series_id", "predictability_score", "model_type", "mean", "has_seasonality")


def problem_list(models: DataFrame, k: int = 30) -> DataFrame:
    """The least predictable series of the low class with what is wrong with them."""
    issues = joined_text(
        [
            F.when(F.col("is_sparse"), F.concat(F.lit("희소("), fixed_decimals(F.col("zero_ratio") * 100, 0), F.lit("%)"))),
            F.when(F.col("has_drift"), F.lit("드리프트")),
            F.when(~F.col("has_seasonality"), F.lit("계절성↓")),
        ],
        ", ",
        empty="-",
    )
    worst = models.where(F.col("predictability_category") == "low").orderBy("predictability_score", "series_id").limit(k)
    return worst.select("series_id", "predictability_score", issues.alias("issues"), "model_type")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value (the last bin is closed)."""
    v = F.col(column)
    span = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias("s")).scalar()
    width = (span["hi"] - span["lo"]) / bins
    number = F.least(F.floor(F.coalesce(ratio(v - span["lo"], width), F.lit(0.0))), F.lit(bins - 1)).cast("int")
    return (
        df.where(v.isNotNull())
        .groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (span["lo"] + F.col("bin") * width).alias("from_value"), "n")
    )


def month_history(compare: DataFrame, candidates: DataFrame) -> DataFrame:
    """Series, MAE, WMAPE and number to retrain per processed month."""
    y, p = F.col("claim_count"), F.col("y_pred")
    scores = compare.groupBy("year", "month").agg(
        F.countDistinct("series_id").alias("n_series"),
        F.avg(F.abs(y - p)).alias("mae"),
        (ratio(F.sum(F.abs(y - p)), F.sum(y)) * 100).alias("wmape"),
    )
    retrain = candidates.groupBy("year", "month").agg(F.countDistinct("series_id").alias("n_retrain"))
    return (
        scores.join(retrain, ["year", "month"], "left")
        .withColumn("n_retrain", F.coalesce("n_retrain", F.lit(0).cast("long")))
        .withColumn("period", calendar.month_label(F.col("year"), F.col("month")))
    )


def month_changes(history: DataFrame) -> DataFrame:
    """Change of each KPI against the month before.

    One row per processed month of the calendar meets in the window, however many series there are.
    """
    w = W.orderBy("year", "month")
    change = lambda c: (F.col(c) - F.lag(c).over(w)).alias(f"{c}_change")
    return history.select("period", "wmape", "mae", "n_retrain", change("wmape"), change("mae"), change("n_retrain"))


def coverage(panel: DataFrame, years: list[int]) -> DataFrame:
    """Series with data per calendar month (rows) and year (columns), with a status per cell: full
    from 80 % of all series, partial from 40 %, else missing."""
    total = panel.agg(F.countDistinct("series_id").alias("n")).scalar()
    wide = panel.groupBy("month").agg(
        *[F.countDistinct(F.when(F.col("year") == y, F.col("series_id"))).alias(f"y{y}") for y in years]
    )
    status = lambda c: (
        F.when(F.col(c) >= total * 0.8, "full").when(F.col(c) >= total * 0.4, "partial").otherwise("missing")
    )
    return wide.withColumns({f"s{y}": status(f"y{y}") for y in years})


def forecast_card(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """Per series: mean of the last 12 months, mean, highest (with month) and total forecast."""
    from panelwright.operators.scoring import risk_months

    past = history.where(F.col("idx") >= F.col("n") - 12).groupBy("series_id").agg(F.avg("claim_count").alias("past_mean"))
    ahead = forecast.groupBy("series_id").agg(F.avg("y_pred").alias("forecast_mean"), F.sum("y_pred").alias("forecast_sum"))
    return ahead.join(past, "series_id", "left").join(risk_months(forecast), "series_id")


def forecast_statistics(forecast: DataFrame) -> DataFrame:
    """Rows, series, months, mean and total of a forecast run, as one row."""
    label = calendar.month_label(F.col("year"), F.col("month"))
    return forecast.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("series_id").alias("n_series"),
        F.min(label).alias("first_month"),
        F.max(label).alias("last_month"),
        F.avg("y_pred").alias("mean_prediction"),
        F.sum("y_pred").alias("total_prediction"),
    )


def best_models(models: DataFrame, by: str = "wmape", k: int = 10) -> DataFrame:
    """The k models with the lowest metric (unknown ones left out)."""
    return models.where(F.col(by).isNotNull()).orderBy(F.round(by, 9), "series_id").limit(k)


def order_distribution(models: DataFrame) -> DataFrame:
    """Mean and most frequent value (lowest on ties) of each order component."""
    parts = F.array(*[F.struct(F.lit(c).alias("part"), F.col(f"order.{c}").alias("v")) for c in ("p", "d", "q", "sp", "sd", "sq")])
    rows = models.where(F.col("order").isNotNull()).select(F.explode(parts).alias("x"))
    counts = rows.groupBy(F.col("x.part").alias("component"), F.col("x.v").alias("v")).agg(F.count(F.lit(1)).alias("k"))
    return counts.groupBy("component").agg(
        (F.sum(F.col("v") * F.col("k")) / F.sum("k")).alias("mean"), F.min_by("v", F.struct(-F.col("k"), "v")).alias("mode")
    )
