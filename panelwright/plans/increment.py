"""A month's delivery carried through to the tables behind the panel, for the series that it changes only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators import panel
from panelwright.plans.monthly import overwrite_month


def series_totals(counts: DataFrame) -> DataFrame:
    """Months with claims, their sum, their greatest and the last of them (yyyymm) per series."""
    y = F.col("claim_count")
    return counts.groupBy("series_id", *panel.KEYS).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(y).alias("total_claims"),
        F.max(y).alias("max_claims"),
        F.max(F.col("year") * 100 + F.col("month")).alias("last_month"),
    )


def changed_series(master: DataFrame, fresh: DataFrame, year: int, month: int) -> DataFrame:
    """Series whose rows change when `fresh` replaces a month: new, gone or with another count.

    Only that month of the master is read.
    """
    this = (F.col("year") == year) & (F.col("month") == month)
    before, after = (df.where(this).select("series_id", "claim_count") for df in (master, fresh))
    return before.exceptAll(after).unionByName(after.exceptAll(before)).select("series_id").distinct()


def carried(totals: DataFrame, updated: DataFrame, changed: DataFrame) -> DataFrame:
    """Totals computed anew for the changed series (`redone`); those of all others are taken over."""
    kept = totals.drop("redone").join(changed, "series_id", "left_anti").withColumn("redone", F.lit(False))
    anew = series_totals(updated.join(changed, "series_id", "left_semi")).withColumn("redone", F.lit(True))
    return kept.unionByName(anew)


def replace_month(spark: SparkSession, panel_path: str, totals: DataFrame, fresh: DataFrame, year: int, month: int) -> DataFrame:
    """Replace a month of the panel on disk by `fresh` and return the totals that follow.

    The changed series are appended to a list (`_changed` behind the panel's name) before the month is replaced, and the
    totals of all series on the list for that month are computed anew.  A run that fails after the replacement, when
    nothing differs any more, therefore still finds them when it is repeated.
    """
    listed = f"{panel_path}_changed"
    this = (F.col("year") == year) & (F.col("month") == month)
    found = changed_series(spark.read.parquet(panel_path), fresh, year, month)
    found.withColumns({"year": F.lit(year), "month": F.lit(month)}).write.mode("append").parquet(listed)
    overwrite_month(panel_path, fresh.where(this))
    changed = spark.read.parquet(listed).where(this).select("series_id").distinct()
    return carried(totals, spark.read.parquet(panel_path), changed)
