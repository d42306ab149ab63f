"""Lag policy: days between manufacture and occurrence, per product category.

Lags are whole days, so every statistic starts from a frequency table (category, lag, rows).  It is
built by one map-side combined count whatever the skew, and has at most one row per category and
distinct lag; quantiles are then exact and weighted, and raw rows are never gathered per category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.config import LAG_WEIGHTS
from panelwright.functions.columns import ratio
from panelwright.operators import ranking, sizing

CATEGORY = "product_cat2"


def with_lag_days(claims: DataFrame, occurred="occurrence_date", made="manufacturing_date") -> DataFrame:
    return claims.withColumn("lag_days", F.datediff(occurred, made))


def lag_frequencies(claims: DataFrame, by: str = CATEGORY) -> DataFrame:
    """(category, lag_days, freq), null categories and lags left out."""
    df = claims if "lag_days" in claims.columns else with_lag_days(claims)
    return (
        df.dropna(subset=[by, "lag_days"]).groupBy(by, "lag_days").agg(F.count(F.lit(1)).alias("freq"))
    )


def _moments() -> dict[str, Column]:
    lag = F.col("lag_days").cast("double")
    n = F.sum("freq")
    mean = F.sum(lag * F.col("freq")) / n
    var = F.greatest(F.sum(lag * lag * F.col("freq")) / n - mean * mean, F.lit(0.0))
    return {"n": n, "mean": mean, "var_pop": var}


def _sample_std(m: dict[str, Column]) -> Column:
    return F.sqrt(m["var_pop"] * ratio(m["n"], m["n"] - 1))


def _quantiles(*p: float) -> Column:
    return F.percentile("lag_days", list(p), F.col("freq"))


def global_lag_stats(freq: DataFrame) -> DataFrame:
    """One row over all categories: mean, sample deviation, p90, p95 of the non-negative lags."""
    m = _moments()
    q = _quantiles(0.90, 0.95)
    return freq.where(F.col("lag_days") >= 0).agg(
        m["mean"].alias("mu"), _sample_std(m).alias("sigma"), q[0].alias("p90"), q[1].alias("p95")
    )


def lag_stats(freq: DataFrame, min_rows: int = 30) -> DataFrame:
    """Mean, population deviation, p90 and p95 per category; small ones take the global figures."""
    m = _moments()
    q = _quantiles(0.90, 0.95)
    own = (
        freq.where(F.col("lag_days") >= 0)
        .groupBy(CATEGORY)
        .agg(
            m["mean"].alias("mu"),
            F.sqrt(m["var_pop"]).alias("sigma"),
            q[0].alias("p90"),
            q[1].alias("p95"),
            m["n"].alias("n"),
        )
        .withColumn("use_global", F.col("n") < min_rows)
    )
    everywhere = global_lag_stats(freq).select(F.struct("mu", "sigma", "p90", "p95").alias("g")).scalar()
    pick = [
        F.when(F.col("use_global"), everywhere[c]).otherwise(F.col(c)).alias(c)
        for c in ("mu", "sigma", "p90", "p95")
    ]
    return own.select(CATEGORY, *pick, "n", "use_global")


def label_lags(claims: DataFrame, stats: DataFrame, fallback: DataFrame) -> DataFrame:
    """Add `lag_days` and `lag_class` by the mean and deviation of the row's category.

    Up to mu + sigma is normal, up to mu + 2 sigma borderline, beyond it (or without a lag) extreme,
    below zero invalid.  A category without statistics uses the one-row `fallback`.  The rows are
    not shuffled as long as the statistics are small.
    """
    df = claims if "lag_days" in claims.columns else with_lag_days(claims)
    limits = stats.select(CATEGORY, F.struct("mu", "sigma").alias("_limit"))
    default = fallback.select(F.struct("mu", "sigma").alias("g")).scalar()
    limit = F.coalesce(F.col("_limit"), default)
    lag = F.col("lag_days")
    label = (
        F.when(lag < 0, "invalid_negative")
        .when(lag <= limit["mu"] + limit["sigma"], "normal")
        .when(lag <= limit["mu"] + 2 * limit["sigma"], "borderline")
        .otherwise("extreme")
    )
    return sizing.join_small(df, limits, CATEGORY, "left").withColumn("lag_class", label).drop("_limit")


def retrain_candidates(labelled: DataFrame) -> DataFrame:
    """Normal and borderline rows with their sample weight."""
    weight = F.when(F.col("lag_class") == "normal", LAG_WEIGHTS["normal"]).otherwise(LAG_WEIGHTS["borderline"])
    return labelled.where(F.col("lag_class").isin(*LAG_WEIGHTS)).withColumn("sample_weight", weight)


def label_share(labelled: DataFrame) -> DataFrame:
    """Rows and percent per class."""
    counts = labelled.groupBy("lag_class").agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("t")).scalar()
    return counts.withColumn("pct", F.col("n_rows") * 100.0 / total)


def monthly_label_stats(labelled: DataFrame, date_col: str = "occurrence_date") -> DataFrame:
    """Per month: rows, rows per class and the share kept for training."""
    classes = ("normal", "borderline", "extreme", "invalid_negative")
    return (
        labelled.groupBy(F.year(date_col).alias("year"), F.month(date_col).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(F.col("lag_class") == c).alias(c) for c in classes],
        )
        .withColumn("kept_pct", (F.col("normal") + F.col("borderline")) * 100.0 / F.col("total"))
    )


def candidate_series(candidates: DataFrame, keys=("plant", "product_cat2", "mid_category")) -> DataFrame:
    """Per series: claims, mean weight and rows labelled normal."""
    return candidates.groupBy(*keys).agg(
        F.sum("claim_count").alias("claim_count"),
        F.avg("sample_weight").alias("mean_weight"),
        F.count_if(F.col("lag_class") == "normal").alias("n_normal"),
    )


def lag_distribution(freq: DataFrame, by: str = CATEGORY, min_rows: int = 10) -> DataFrame:
    """Shape of the lags per category with fences at 1.5 interquartile ranges."""
    m = _moments()
    q = _quantiles(0.25, 0.5, 0.75)
    return (
        freq.groupBy(F.col(by).alias("product"))
        .agg(
            m["n"].alias("count"),
            m["mean"].alias("mean"),
            _sample_std(m).alias("std"),
            F.min("lag_days").alias("min"),
            q[0].alias("q25"),
            q[1].alias("median"),
            q[2].alias("q75"),
            F.max("lag_days").alias("max"),
        )
        .where(F.col("count") >= min_rows)
        .withColumn("iqr", F.col("q75") - F.col("q25"))
        .withColumn("lower_fence", F.col("q25") - 1.5 * F.col("iqr"))
        .withColumn("upper_fence", F.col("q75") + 1.5 * F.col("iqr"))
    )


def iqr_bounds(freq: DataFrame, by: str = CATEGORY, multiplier: float = 1.5, min_rows: int = 10) -> DataFrame:
    """Accepted lag range per category; null bounds where there are too few rows to judge."""
    q = _quantiles(0.25, 0.75)
    enough = F.col("_n") >= min_rows
    iqr = F.col("_q")[1] - F.col("_q")[0]
    return (
        freq.groupBy(by)
        .agg(F.sum("freq").alias("_n"), q.alias("_q"))
        .select(
            by,
            F.when(enough, F.col("_q")[0] - multiplier * iqr).alias("lower_bound"),
            F.when(enough, F.col("_q")[1] + multiplier * iqr).alias("upper_bound"),
        )
    )


def percentile_bounds(
    freq: DataFrame, by: str = CATEGORY, lower: float = 5, upper: float = 95, min_rows: int = 10
) -> DataFrame:
    q = _quantiles(lower / 100, upper / 100)
    enough = F.col("_n") >= min_rows
    return (
        freq.groupBy(by)
        .agg(F.sum("freq").alias("_n"), q.alias("_q"))
        .select(
            by,
            F.when(enough, F.col("_q")[0]).alias("lower_bound"),
            F.when(enough, F.col("_q")[1]).alias("upper_bound"),
        )
    )


def _inside() -> Column:
    lag = F.col("lag_days")
    return F.col("lower_bound").isNull() | lag.between(F.col("lower_bound"), F.col("upper_bound"))


def within_bounds(claims: DataFrame, bounds: DataFrame, by: str = CATEGORY) -> DataFrame:
    """Rows with a lag inside their category's range (or of a category too small to judge)."""
    df = claims if "lag_days" in claims.columns else with_lag_days(claims)
    rows = df.where(F.col("lag_days").isNotNull())
    return sizing.join_small(rows, bounds, by).where(_inside()).drop("lower_bound", "upper_bound")


def bound_stats(freq: DataFrame, bounds: DataFrame, by: str = CATEGORY) -> DataFrame:
    """Rows inside and outside the range per judged category, from the frequency table alone."""
    return (
        freq.join(bounds.where(F.col("lower_bound").isNotNull()), by)
        .groupBy(F.col(by).alias("product"), "lower_bound", "upper_bound")
        .agg(
            F.sum("freq").alias("total"),
            F.sum(F.when(_inside(), F.col("freq")).otherwise(F.lit(0))).alias("normal"),
        )
        .withColumn("outliers", F.col("total") - F.col("normal"))
        .withColumn("outlier_ratio", F.col("outliers") / F.col("total"))
    )


def filter_report(freq: DataFrame, stats: DataFrame) -> DataFrame:
    """One row: rows before and after, share removed, and how outlier shares spread over products.

    Checkpoints the statistics, one row per product.
    """
    stats = ranking.checkpointed(stats)
    median = ranking.quantiles(stats, {"q": ("outlier_ratio", 0.5)}).scalar()
    rows = freq.agg(F.sum("freq").alias("n")).scalar()
    return stats.agg(
        F.sum("outliers").alias("removed_rows"),
        F.count(F.lit(1)).alias("products_analyzed"),
        F.avg("outlier_ratio").alias("mean_outlier_ratio"),
        F.max("outlier_ratio").alias("max_outlier_ratio"),
    ).select(
        rows.alias("original_rows"),
        (rows - F.coalesce("removed_rows", F.lit(0))).alias("filtered_rows"),
        F.coalesce("removed_rows", F.lit(0)).alias("removed_rows"),
        ratio(F.coalesce("removed_rows", F.lit(0)), rows).alias("removal_ratio"),
        "products_analyzed",
        "mean_outlier_ratio",
        median.alias("median_outlier_ratio"),
        "max_outlier_ratio",
    )
