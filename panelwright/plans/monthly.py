"""The monthly increment: upsert a month, compare with the forecast, decide what to retrain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.config import OrderGrid
from panelwright.operators import accuracy, documents, manifest, panel, ranking, seasonal_models
from panelwright.operators.lag import retrain_candidates
from panelwright.plans.curate import labelled_claims


def month_counts(claims: DataFrame, year: int, month: int, stats: DataFrame | None = None, fallback: DataFrame | None = None) -> DataFrame:
    """Counts of the claims manufactured in one month; with statistics, after the lag policy."""
    rows = claims
    if stats is not None:
        rows = retrain_candidates(labelled_claims(claims, stats, fallback))
    d = F.col("manufacturing_date")
    rows = rows.where((F.year(d) == year) & (F.month(d) == month))
    return panel.slot_counts(rows).select("series_id", *panel.KEYS, "year", "month", "claim_count")


def dropped_rows(claims: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of an upload that belong to another manufacture month, as one row."""
    d = F.col("manufacturing_date")
    inside = F.coalesce((F.year(d) == year) & (F.month(d) == month), F.lit(False))
    return claims.agg(F.count_if(~inside).alias("dropped"), F.count_if(inside).alias("kept"))


def update_master(master: DataFrame, claims: DataFrame, year: int, month: int, min_claims: float = 10) -> tuple[DataFrame, DataFrame]:
    """(master panel with the month replaced, viable series among those updated)."""
    fresh = month_counts(claims, year, month)
    updated = panel.upsert_month(master, fresh, year, month)
    touched = updated.join(fresh.select("series_id").distinct(), "series_id", "left_semi")
    return updated, panel.viable_series(touched, min_claims).where("viable")


def overwrite_month(panel_path: str, fresh: DataFrame) -> None:
    """Replace exactly the (year, month) partitions present in `fresh`; repeating it changes nothing."""
    (
        fresh.repartition("year", "month", F.pmod(F.xxhash64("series_id"), F.lit(64)))
        .sortWithinPartitions("year", "month", "series_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(panel_path)
    )


def refresh_documents(existing: DataFrame, fresh: DataFrame, min_nonzero: int = 10) -> DataFrame:
    """Series documents with the new months put in (the new record wins)."""
    flat = documents.flat_panel(existing)
    new = fresh.select(
        "series_id",
        *panel.KEYS,
        "year",
        "month",
        "claim_count",
        *[
            (F.col(c) if c in fresh.columns else F.lit(None).cast(t)).alias(c)
            for c, t in (("lag_class", "string"), ("sample_weight", "double"))
        ],
    )
    return documents.series_documents(panel.upsert_keyed(flat, new), min_nonzero)


def process_month(
    claims: DataFrame,
    stats: DataFrame,
    fallback: DataFrame,
    forecast: DataFrame,
    history: DataFrame,
    models: DataFrame,
    year: int,
    month: int,
    grid: OrderGrid = OrderGrid(),
) -> dict[str, DataFrame]:
    """The six steps of a month as lazy tables: candidates, counts, comparison, retrained models,
    new forecast and a one-row log.

    The comparison is checkpointed, as the log and the choice of series both read it.
    """
    candidates = retrain_candidates(labelled_claims(claims, stats, fallback))
    counts = panel.slot_counts(candidates, date_col="occurrence_date", quality=True)
    this_month = counts.where((F.col("year") == year) & (F.col("month") == month))
    compare = ranking.checkpointed(accuracy.compare_left(this_month, forecast))
    wanted = accuracy.retrain_candidates(compare.withColumn("y_pred", F.coalesce("y_pred", F.lit(0.0)))).select("series_id").distinct()
    rows = history.join(wanted, "series_id", "left_semi")
    retrained = seasonal_models.retrain(rows, models, grid)
    ahead = seasonal_models.forecast_rows(retrained.where(F.col("fit").isNotNull()), rows)
    return {
        "candidates": candidates,
        "counts": counts,
        "comparison": compare,
        "models": retrained,
        "forecast": ahead,
        "log": accuracy.monthly_totals(compare),
    }


def log_month(totals: DataFrame, path: str) -> None:
    """Append the run statistics of a month to the evaluation table."""
    manifest.append(totals, path)
