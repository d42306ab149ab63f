"""From claim rows to dense panels.

Raw rows are reduced by one map-side combined aggregate per (keys, slot); everything after it is
sized by series x calendar, so no later step depends on how many raw rows one key holds.  The
calendar is generated inside each series row, without a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.config import KEYS, LAG_CLASSES, SplitDates
from panelwright.functions import calendar, columns, labels


def merge_duplicates(claims: DataFrame, value: str = "claim_count") -> DataFrame:
    """Sum the counts of rows that share every other column (at least four key columns)."""
    keys = [
        c
        for c in ("occurrence_date", "mid_category", "plant", "product_cat2", "manufacturing_date")
        if c in claims.columns
    ]
    if len(keys) < 4 or value not in claims.columns:
        return claims
    return claims.dropna(subset=keys).groupBy(*keys).agg(F.sum(value).alias(value))


def duplicate_keys(claims: DataFrame) -> DataFrame:
    """Keys that occur on more than one row, with the number of rows and the summed count."""
    keys = [c for c in claims.columns if c != "claim_count"]
    return (
        claims.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("claim_count").alias("claim_count"))
        .where(F.col("n_rows") > 1)
    )


def duplicate_report(claims: DataFrame, date_col: str = "manufacturing_date") -> DataFrame:
    """Rows before and after merging, per year and in total (null year)."""
    keys = [c for c in claims.columns if c != "claim_count"]
    per_key = claims.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_key.rollup(F.year(date_col).alias("year"))
        .agg(
            F.sum("n").alias("rows_before"),
            F.count(F.lit(1)).alias("rows_after"),
            F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(0))).alias("rows_in_duplicates"),
        )
        .withColumn("reduction", F.col("rows_before") - F.col("rows_after"))
    )


def slot_counts(
    claims: DataFrame,
    date_col: str = "manufacturing_date",
    slot: str = "month",
    value: str = "claim_count",
    keys: tuple[str, ...] = KEYS,
    quality: bool = False,
) -> DataFrame:
    """Summed counts per series and month or ISO week; rows with a null key or date are left out.

    With `quality`, also the most frequent lag class (ties to the alphabetically first) and the mean
    sample weight of each slot.
    """
    d = F.col(date_col)
    year, part = (
        (F.year(d), F.month(d)) if slot == "month" else (calendar.iso_year(d), calendar.iso_week(d))
    )
    aggs = [F.sum(value).cast("double").alias("claim_count")]
    if quality:
        aggs += [F.count_if(F.col("lag_class") == c).alias(f"_n_{c}") for c in LAG_CLASSES]
        if "sample_weight" in claims.columns:
            aggs.append(F.avg("sample_weight").alias("sample_weight"))
    out = (
        claims.dropna(subset=[*keys, date_col])
        .groupBy(*keys, year.cast("int").alias("year"), part.cast("int").alias(slot))
        .agg(*aggs)
        .withColumn("series_id", columns.series_id(*keys))
    )
    if quality:
        counts = {c: F.col(f"_n_{c}") for c in LAG_CLASSES}
        out = out.withColumn("lag_class", labels.modal_class(counts)).drop(*[f"_n_{c}" for c in LAG_CLASSES])
    names = ["series_id", *keys, "year", slot, "claim_count"]
    names += [c for c in ("lag_class", "sample_weight") if c in out.columns]
    return out.select(*names)


def _scalar_int(df: DataFrame, agg: Column) -> Column:
    return df.agg(agg.cast("int").alias("v")).scalar()


def dense_panel(
    counts: DataFrame,
    end: tuple[int, int] | None,
    start: tuple[int, int] | None = None,
    slot: str = "month",
    min_claims: float = 10,
    keys: tuple[str, ...] = KEYS,
    iso_exact: bool = False,
) -> DataFrame:
    """One row per series and slot, zero where nothing was counted.

    Series with fewer than `min_claims` in total are dropped.  The grid runs from `start` (default:
    first slot of the first year present) to `end` (default: last slot of the last year present);
    counts outside a grid that the caller bounds are not in it (`outside_grid` counts them).  Output adds `idx`, the position from 0, and `n`, the number of
    slots.  `iso_exact` removes week 53 from years that have none.

    Each series becomes one row holding its non-zero slots, bounded by the calendar, and is then
    expanded by a generated sequence.  The result stays hashed by series, so windows and group-bys
    on `series_id` that follow need no further shuffle.
    """
    per_year = calendar.MONTHS if slot == "month" else calendar.WEEKS
    measures = [c for c in counts.columns if c not in ("series_id", *keys, "year", slot)]
    fill = {"claim_count": F.lit(0.0), "lag_class": F.lit("normal"), "sample_weight": F.lit(1.0)}
    number = calendar.slot_number(F.col("year"), F.col(slot), per_year)

    packed = (
        counts.repartition("series_id")
        .groupBy("series_id", *keys)
        .agg(
            F.sum("claim_count").alias("_total"),
            F.min("year").alias("_first"),
            F.max("year").alias("_last"),
            F.map_from_entries(
                F.collect_list(F.struct(number.alias("k"), F.struct(*measures).alias("v")))
            ).alias("_seen"),
        )
        .where(F.col("_total") >= min_claims)
    )
    if start is None:
        first = _scalar_int(packed, F.min("_first")) * per_year
    else:
        first = F.lit(start[0] * per_year + start[1] - 1)
    if end is None:
        last = _scalar_int(packed, F.max("_last")) * per_year + per_year - 1
    else:
        last = F.lit(end[0] * per_year + end[1] - 1)

    grid = packed.select(
        "series_id", *keys, "_seen", (last - first + 1).cast("int").alias("n"),
        F.posexplode(F.sequence(first, last)).alias("idx", "_k"),
    ).withColumn("_v", F.try_element_at(F.col("_seen"), F.col("_k")))
    out = grid.select(
        "series_id",
        *keys,
        calendar.slot_year(F.col("_k"), per_year).alias("year"),
        calendar.slot_in_year(F.col("_k"), per_year).alias(slot),
        "idx",
        "n",
        *[F.coalesce(F.col(f"_v.{m}"), fill[m]).alias(m) for m in measures],
    )
    if slot == "week" and iso_exact:
        kept = out.where((F.col("week") < 53) | calendar.has_week_53(F.col("year")))
        out = with_position(kept.drop("idx", "n"), slot="week")
    return out


def sparse_panel(counts: DataFrame, min_claims: float = 10) -> DataFrame:
    """The observed slots of viable series only, without padding."""
    return viable_rows(counts, min_claims)


def viable_rows(counts: DataFrame, min_claims: float) -> DataFrame:
    """Rows of series whose total reaches `min_claims` (one shuffle on the series)."""
    total = F.sum("claim_count").over(W.partitionBy("series_id"))
    return counts.withColumn("_total", total).where(F.col("_total") >= min_claims).drop("_total")


def viable_series(panel: DataFrame, min_claims: float) -> DataFrame:
    """Total per series and whether it reaches `min_claims`."""
    return (
        panel.groupBy("series_id")
        .agg(F.sum("claim_count").alias("total_claims"))
        .withColumn("viable", F.col("total_claims") >= min_claims)
    )


def with_position(panel: DataFrame, slot: str = "month") -> DataFrame:
    """Add `idx` (0-based order in the series) and `n` (length) to a panel that lacks them."""
    by_time = W.partitionBy("series_id").orderBy("year", slot)
    whole = W.partitionBy("series_id")
    return panel.withColumn("idx", (F.row_number().over(by_time) - 1).cast("int")).withColumn(
        "n", F.count(F.lit(1)).over(whole).cast("int")
    )


def reindex_observed(panel: DataFrame, slot: str = "month") -> DataFrame:
    """Give every series all the periods that occur anywhere in the panel, zero-filled.

    The periods are a calendar column: their number is bounded by the span of the data, and they
    arrive as one array through a scalar subquery.
    """
    per_year = calendar.MONTHS if slot == "month" else calendar.WEEKS
    number = calendar.slot_number(F.col("year"), F.col(slot), per_year)
    periods = (
        panel.select(number.alias("k")).distinct().agg(F.sort_array(F.collect_list("k")).alias("ks")).scalar()
    )
    packed = panel.groupBy("series_id").agg(
        F.map_from_entries(F.collect_list(F.struct(number.alias("k"), F.col("claim_count").alias("v")))).alias("_seen")
    )
    return packed.select("series_id", "_seen", F.posexplode(periods).alias("idx", "_k")).select(
        "series_id",
        calendar.slot_year(F.col("_k"), per_year).alias("year"),
        calendar.slot_in_year(F.col("_k"), per_year).alias(slot),
        "idx",
        F.coalesce(F.try_element_at(F.col("_seen"), F.col("_k")), F.lit(0.0)).alias("claim_count"),
    )


def attach_quality(panel: DataFrame, meta: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Left join of per-slot quality columns; padded slots count as normal with weight 1."""
    out = panel.join(meta, [*keys, "year", "month"], "left").withColumn(
        "lag_class", F.coalesce("lag_class", F.lit("normal"))
    )
    if "sample_weight" in meta.columns:
        out = out.withColumn("sample_weight", F.coalesce("sample_weight", F.lit(1.0)))
    return out


def train_window(panel: DataFrame, first_year: int, last_year: int) -> DataFrame:
    return panel.where(F.col("year").between(first_year, last_year))


def outside_grid(counts: DataFrame, end: tuple[int, int], start: tuple[int, int], slot: str = "month") -> DataFrame:
    """One row: how many counts, and of what sum, fall outside a grid that is bounded by hand."""
    per_year = calendar.MONTHS if slot == "month" else calendar.WEEKS
    number = calendar.slot_number(F.col("year"), F.col(slot), per_year)
    first, last = (calendar.slot_number(F.lit(y), F.lit(k), per_year) for y, k in (start, end))
    out = counts.where((number < first) | (number > last))
    return out.agg(F.count(F.lit(1)).alias("n_counts"), F.coalesce(F.sum("claim_count"), F.lit(0.0)).alias("claims"))


def split_by_dates(df: DataFrame, date_col: str, dates: SplitDates = SplitDates()) -> tuple[DataFrame, DataFrame]:
    """(training rows, test rows) by fixed date ranges."""
    d = F.col(date_col)
    inside = lambda a, b: d.between(F.lit(a).cast("date"), F.lit(b).cast("date"))
    return df.where(inside(dates.train_start, dates.train_end)), df.where(inside(dates.test_start, dates.test_end))


def save_series_list(series: DataFrame, path: str) -> None:
    """Write the ids of a selection, to be read back by `only_series`."""
    series.select("series_id").distinct().write.mode("overwrite").parquet(path)


def only_series(panel: DataFrame, series: DataFrame) -> DataFrame:
    """Rows of the listed series."""
    return panel.join(series.select("series_id"), "series_id", "left_semi")


def trailing_months(panel: DataFrame, before: tuple[int, int], months: int = 12) -> DataFrame:
    """The `months` calendar months that end just before (year, month)."""
    end = before[0] * 12 + before[1] - 1
    number = calendar.slot_number(F.col("year"), F.col("month"), 12)
    return panel.where(number.between(end - months, end - 1))


def upsert_month(master: DataFrame, fresh: DataFrame, year: int, month: int) -> DataFrame:
    """Replace one month: drop its rows from the master panel and add the new ones."""
    kept = master.where(~((F.col("year") == year) & (F.col("month") == month)))
    added = fresh.where((F.col("year") == year) & (F.col("month") == month))
    return kept.unionByName(added.select(*master.columns))


def upsert_keyed(master: DataFrame, fresh: DataFrame) -> DataFrame:
    """Update or add rows by (series, year, month); the new row wins."""
    keys = ["series_id", "year", "month"]
    rest = [c for c in master.columns if c not in keys]
    new = fresh.select(*keys, F.struct(*rest).alias("_new"))
    old = master.select(*keys, F.struct(*rest).alias("_old"))
    row = F.coalesce("_new", "_old")
    return old.join(new, keys, "full").select(*keys, *[row[c].alias(c) for c in rest])


def series_vectors(panel: DataFrame, value: str = "claim_count") -> DataFrame:
    """One row per series with its values in order, as an array bounded by the calendar."""
    pairs = F.sort_array(F.collect_list(F.struct("idx", value)))
    return panel.groupBy("series_id").agg(pairs[value].alias("ys"))


def panel_summary(panel: DataFrame) -> DataFrame:
    return panel.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("series_id").alias("n_series"),
        (F.avg((F.col("claim_count") > 0).cast("double")) * 100).alias("nonzero_pct"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count_if(F.col("lag_class") == "normal").alias("n_normal"),
        F.count_if(F.col("lag_class") == "borderline").alias("n_borderline"),
    )
