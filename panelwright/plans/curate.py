"""Raw claim files to curated panels and series documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.operators import documents, lag, panel, ranking
from panelwright.sources import arrivals, files


def labelled_claims(claims: DataFrame, stats: DataFrame | None = None, fallback: DataFrame | None = None) -> DataFrame:
    """Claims with lag and class, against given statistics or those of the claims themselves.

    In the latter case the claims are read twice: once for their lag frequencies, which are
    checkpointed, and once to label them.
    """
    if stats is None or fallback is None:
        freq = ranking.checkpointed(lag.lag_frequencies(claims))
        stats, fallback = lag.lag_stats(freq), lag.global_lag_stats(freq)
    return lag.label_lags(claims, stats, fallback)


def curated_panel(
    claims: DataFrame,
    end: tuple[int, int],
    mode: str = "incremental",
    min_claims: float = 10,
    start: tuple[int, int] | None = None,
) -> DataFrame:
    """Merged claims as a dense monthly panel.

    `incremental` keeps normal and borderline rows and adds the class and weight of each month;
    `legacy` counts all rows.
    """
    merged = panel.merge_duplicates(claims)
    if mode == "legacy":
        counts = panel.slot_counts(merged)
    elif mode == "incremental":
        counts = panel.slot_counts(lag.retrain_candidates(labelled_claims(merged)), quality=True)
    else:
        raise ValueError(f"unknown mode: {mode}")
    return panel.dense_panel(counts, end=end, start=start, min_claims=min_claims)


def weekly_panel(claims: DataFrame, quality: bool = False, min_claims: float = 0) -> DataFrame:
    """Dense weekly panel over all years present, each with 53 weeks."""
    rows = lag.retrain_candidates(labelled_claims(claims)) if quality else claims
    return panel.dense_panel(
        panel.slot_counts(rows, slot="week", quality=quality), end=None, slot="week", min_claims=min_claims
    )


def build(
    spark: SparkSession, sources: list[str | arrivals.Layout], panel_path: str, documents_path: str, end: tuple[int, int],
    mode: str = "incremental", start: tuple[int, int] | None = None, rejected_path: str | None = None, **csv_options,
) -> None:
    """CSV files (paths read with `csv_options`, or layouts) to a partitioned parquet panel and a set of series documents.

    Rows that cannot be read are left out and, with `rejected_path`, written there with their reason (a second reading of
    the files).  The documents are made from the written panel.
    """
    raw = arrivals.read_layouts(spark, [s if isinstance(s, arrivals.Layout) else arrivals.Layout(s, **csv_options) for s in sources])
    files.write_panel(curated_panel(arrivals.accepted(raw), end, mode, start=start), panel_path)
    files.write_documents(documents.series_documents(files.read_panel(spark, panel_path)), documents_path)
    if rejected_path is not None:
        arrivals.rejected(raw).write.mode("overwrite").parquet(rejected_path)
