"""Column contracts and header aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Headers accepted for each logical column.
ALIASES = {
    "occurrence_date": ("occurrence_date", "발생일자", "접수일", "클레임일자", "claim_date"),
    "manufacturing_date": ("manufacturing_date", "제조일자", "mfg_date", "생산일자", "production_date"),
    "plant": ("plant", "플랜트"),
    "product_cat2": ("product_cat2", "제품범주2"),
    "mid_category": ("mid_category", "중분류(보정)", "중분류"),
    "claim_count": ("claim_count", "count", "클레임건수", "y"),
    "lag_class": ("lag_class",),
    "sample_weight": ("sample_weight",),
}

FORECAST_ALIASES = {
    "series_id": ("series_id",),
    "year": ("year", "forecast_year"),
    "month": ("month", "forecast_month"),
    "y_pred": ("y_pred", "forecast_value", "yhat"),
    "y_pred_lower": ("y_pred_lower", "yhat_lower", "y_lo"),
    "y_pred_upper": ("y_pred_upper", "yhat_upper", "y_hi"),
}

RAW_CLAIMS = T.StructType(
    [
        T.StructField("occurrence_date", T.StringType()),
        T.StructField("mid_category", T.StringType()),
        T.StructField("plant", T.StringType()),
        T.StructField("product_cat2", T.StringType()),
        T.StructField("manufacturing_date", T.StringType()),
        T.StructField("claim_count", T.StringType()),
    ]
)

SERIES_DOCUMENT = (
    "series_id string, plant string, product_cat2 string, mid_category string, "
    "records long, non_zero_records long, total_claims double, mean_claims double, "
    "max_claims double, quality_stats struct<normal_ratio: double, borderline_ratio: double, "
    "mean_sample_weight: double>, data array<struct<year: int, month: int, claim_count: double, "
    "lag_class: string, sample_weight: double>>"
)

MODEL_DOCUMENT = (
    "series_id string, status string, model_type string, n_train_points int, "
    "predictability_score double, guard_results struct<is_sparse: boolean, zero_ratio: double, "
    "has_drift: boolean, has_seasonality: boolean, seasonality_strength: double>, "
    "historical_stats struct<mean: double, std: double, nonzero_pct: double>"
)


class MissingColumn(ValueError):
    """A required logical column has no matching header."""


def normalise_columns(
    df: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES, required: tuple[str, ...] = ()
) -> DataFrame:
    """Rename headers to their logical names by alias (never by position) and drop the rest.

    Headers are stripped of blanks and a leading byte-order mark first.  A logical column listed in
    `required` without a match raises MissingColumn.
    """
    headers = {c.strip().lstrip("﻿").strip(): c for c in df.columns}
    picked = []
    for logical, names in aliases.items():
        found = next((headers[n] for n in names if n in headers), None)
        if found is not None:
            picked.append(F.col(f"`{found}`").alias(logical))
        elif logical in required:
            raise MissingColumn(f"no column for {logical}: looked for {', '.join(names)}")
    return df.select(*picked)
