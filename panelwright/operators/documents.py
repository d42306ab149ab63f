"""Nested documents per series and per model, and back to flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.config import KEYS


def series_documents(panel: DataFrame, min_nonzero: int = 10) -> DataFrame:
    """One document per series with at least `min_nonzero` non-zero slots: header, statistics and the
    ordered data array (bounded by the calendar).  Quality statistics are null without lag classes.
    """
    y = F.col("claim_count")
    quality = {"lag_class", "sample_weight"} <= set(panel.columns)
    share = lambda c: F.count_if(F.col("lag_class") == c) / F.count(F.lit(1))
    stats = (
        F.struct(
            share("normal").alias("normal_ratio"),
            share("borderline").alias("borderline_ratio"),
            F.avg("sample_weight").alias("mean_sample_weight"),
        )
        if quality
        else F.lit(None).cast("struct<normal_ratio: double, borderline_ratio: double, mean_sample_weight: double>")
    )
    point = F.struct(
        "year",
        "month",
        "claim_count",
        (F.col("lag_class") if quality else F.lit(None).cast("string")).alias("lag_class"),
        (F.col("sample_weight") if quality else F.lit(None).cast("double")).alias("sample_weight"),
    )
    return (
        panel.groupBy("series_id", *KEYS)
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(y > 0).alias("non_zero_records"),
            F.sum(y).alias("total_claims"),
            F.avg(y).alias("mean_claims"),
            F.max(y).alias("max_claims"),
            stats.alias("quality_stats"),
            F.sort_array(F.collect_list(point)).alias("data"),
        )
        .where(F.col("non_zero_records") >= min_nonzero)
    )


def flat_panel(documents: DataFrame) -> DataFrame:
    """The rows of the data arrays with the key columns."""
    return documents.select("series_id", *KEYS, F.explode("data").alias("d")).select("series_id", *KEYS, "d.*")


def document_summary(panel: DataFrame, documents: DataFrame) -> DataFrame:
    """Series in the panel, documents made, series left out."""
    total = panel.agg(F.countDistinct("series_id").alias("n")).scalar()
    return documents.agg(F.count(F.lit(1)).alias("created")).select(
        total.alias("total_series"), "created", (total - F.col("created")).alias("skipped_series")
    )


def model_documents(models: DataFrame, guards: DataFrame, stats: DataFrame) -> DataFrame:
    """Nested model documents from the flat model, guard and history tables."""
    g = guards.select(
        "series_id", F.struct("is_sparse", "zero_ratio", "has_drift", "has_seasonality", "seasonality_strength").alias("guard_results")
    )
    h = stats.select(
        "series_id",
        "n_train_points",
        F.struct(F.col("hist_mean").alias("mean"), F.col("hist_std").alias("std"), "nonzero_pct").alias("historical_stats"),
    )
    return models.join(g, "series_id").join(h, "series_id")


def flat_models(documents: DataFrame) -> DataFrame:
    """Model documents as columns; failed models are left out, a missing score counts as 0.5."""
    return documents.where(F.coalesce("status", F.lit("")) != "failed").select(
        "series_id",
        "model_type",
        "n_train_points",
        F.coalesce("predictability_score", F.lit(0.5)).alias("predictability_score"),
        "guard_results.*",
        "historical_stats.*",
    )
