"""Base training run: model table, KPI summary and manifest."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.config import OrderGrid, SparseRule
from panelwright.operators import accuracy, forecast, manifest, panel, ranking, reports, seasonal_models


def train_base(history: DataFrame, run_id: str, grid: OrderGrid = OrderGrid(), rule: SparseRule = SparseRule(), seed: int = 42) -> dict[str, DataFrame]:
    """Model table (checkpointed: the fits run once), KPI summary, status counts and manifest rows."""
    began = time.time()
    models = ranking.checkpointed(seasonal_models.train(history, grid, rule))
    settings = {
        "seed": seed,
        "cv_scheme": "holdout_last_6",
        "val_window": 6,
        "candidates": len(grid.candidates()),
        "duration_sec": round(time.time() - began, 1),
    }
    return {
        "models": models,
        "kpi": reports.kpi_summary(models.where(F.col("status") == "success")),
        "status": reports.share_of(models, "status"),
        "manifest": manifest.manifest(history.sparkSession, run_id, settings, history.select("series_id", "year", "month", "claim_count")),
    }


def forecast_next(history: DataFrame, models: DataFrame, horizon: int = 6) -> DataFrame:
    """Forecast with the orders of the model table, bounded by each series' history.

    Series without a usable model get the seasonal naive forecast.
    """
    spare = forecast.seasonal_naive(history, horizon, 12)
    vectors = panel.series_vectors(history).join(models.where(F.col("order").isNotNull()).select("series_id", "order"), "series_id")
    fitted = seasonal_models.forecast_rows(seasonal_models.fit_orders(vectors, horizon).where(F.col("fit").isNotNull()), history)
    modelled = forecast.guarded_forecast(fitted, forecast.history_stats(history), spare)
    rest = spare.join(modelled.select("series_id").distinct(), "series_id", "left_anti")
    return modelled.unionByName(rest.select(*modelled.columns))


def tune_poor(history: DataFrame, metrics: DataFrame, grid: OrderGrid = OrderGrid(max_complexity=8), most: int | None = None) -> DataFrame:
    """Tune the series that perform poorly, the worst first when only `most` of them are wanted.

    `metrics` has `mape`, `bias` and `mase` per series; the result sets the tuned against the
    original MASE.
    """
    poor = accuracy.poor_performers(metrics)
    if most is not None:
        poor = ranking.top(poor, most, [F.round("priority_score", 9).desc_nulls_last(), F.col("series_id")])
    rows = panel.only_series(history, poor)
    tuned = seasonal_models.tune_by_validation(panel.series_vectors(rows), forecast.unit_root(rows), grid)
    return accuracy.tuning_gain(tuned, metrics)


def evaluate_years(p: DataFrame, first: int, last: int, horizon: int = 12) -> DataFrame:
    """Roll over target years in one job: train up to the year before, forecast, score per series."""
    ahead = forecast.seasonal_naive(forecast.rolling_years(p, first, last), horizon, 12, by=("series_id", "target_year"))
    joined = ahead.join(p.select("series_id", "idx", "claim_count"), ["series_id", "idx"])
    return accuracy.metrics_by(joined, "series_id", "target_year")
