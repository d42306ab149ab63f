"""Queries on claim rows: merging, lag policy, panels, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog.base import END, START, query
from panelwright.functions import calendar
from panelwright.operators import lag, panel
from panelwright.plans.curate import labelled_claims
from panelwright.sources import tables

KEYS_SQL = "occurrence_date, mid_category, plant, product_cat2, manufacturing_date"


@query(
    "claims_dedup",
    f"""SELECT strftime(occurrence_date, '%Y-%m-%d') AS occurrence_date, mid_category, plant, product_cat2,
        strftime(manufacturing_date, '%Y-%m-%d') AS manufacturing_date, CAST(sum(claim_count) AS BIGINT) AS claim_count
        FROM claims_s GROUP BY {KEYS_SQL}""",
)
def claims_dedup(spark, sf_dir):
    merged = panel.merge_duplicates(tables.claims(spark, sf_dir, "sparse"))
    return merged.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("occurrence_date", "manufacturing_date")})


@query(
    "duplicate_report",
    f"""SELECT CAST(year AS INT) AS year, CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
        CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_in_duplicates,
        CAST(sum(n) - count(*) AS BIGINT) AS reduction
        FROM (SELECT year(manufacturing_date) AS year, count(*) AS n FROM claims_s GROUP BY {KEYS_SQL})
        GROUP BY ROLLUP (year)""",
)
def duplicate_report(spark, sf_dir):
    return panel.duplicate_report(tables.claims(spark, sf_dir, "sparse"))


@query(
    "duplicate_keys",
    f"""SELECT strftime(occurrence_date, '%Y-%m-%d') AS occurrence_date, mid_category, plant, product_cat2,
        strftime(manufacturing_date, '%Y-%m-%d') AS manufacturing_date, count(*) AS n_rows,
        CAST(sum(claim_count) AS BIGINT) AS claim_count
        FROM claims_d GROUP BY {KEYS_SQL} HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf_dir):
    dup = panel.duplicate_keys(tables.claims(spark, sf_dir))
    return dup.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("occurrence_date", "manufacturing_date")})


@query(
    "year_month_rows",
    """SELECT CAST(year(occurrence_date) AS INT) AS year, CAST(month(occurrence_date) AS INT) AS month, count(*) AS n_rows
       FROM claims_d GROUP BY ALL""",
)
def year_month_rows(spark, sf_dir):
    rows = tables.claims(spark, sf_dir)
    return rows.groupBy(F.year("occurrence_date").alias("year"), F.month("occurrence_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


# --- lag policy -----------------------------------------------------------------------------------

STATS = """
 gl AS (SELECT avg(lag_days) AS mu, stddev_samp(lag_days) AS sigma, quantile_cont(lag_days, 0.9) AS p90,
                 quantile_cont(lag_days, 0.95) AS p95 FROM claims_{g} WHERE lag_days >= 0),
 own AS (SELECT product_cat2, avg(lag_days) AS mu, stddev_pop(lag_days) AS sigma, quantile_cont(lag_days, 0.9) AS p90,
                quantile_cont(lag_days, 0.95) AS p95, count(*) AS n FROM claims_{g} WHERE lag_days >= 0 GROUP BY 1),
 stats AS (SELECT product_cat2, CASE WHEN n < 30 THEN gl.mu ELSE own.mu END AS mu,
                  CASE WHEN n < 30 THEN gl.sigma ELSE own.sigma END AS sigma,
                  CASE WHEN n < 30 THEN gl.p90 ELSE own.p90 END AS p90,
                  CASE WHEN n < 30 THEN gl.p95 ELSE own.p95 END AS p95, n, n < 30 AS use_global FROM own, gl),
 labelled AS (SELECT c.*, CASE WHEN lag_days < 0 THEN 'invalid_negative'
                WHEN lag_days <= coalesce(s.mu, gl.mu) + coalesce(s.sigma, gl.sigma) THEN 'normal'
                WHEN lag_days <= coalesce(s.mu, gl.mu) + 2 * coalesce(s.sigma, gl.sigma) THEN 'borderline'
                ELSE 'extreme' END AS lag_class
              FROM claims_{g} c LEFT JOIN stats s USING (product_cat2), gl)"""


def with_stats(select: str, g: str = "d") -> str:
    return f"WITH {STATS.format(g=g)} {select}"


def labelled(spark, sf_dir, grain="dense"):
    return labelled_claims(tables.claims(spark, sf_dir, grain))


@query("lag_stats", with_stats("SELECT * FROM stats"), "mu sigma p90 p95")
def lag_stats(spark, sf_dir):
    return lag.lag_stats(lag.lag_frequencies(tables.claims(spark, sf_dir)))


@query("lag_stats_global", with_stats("SELECT * FROM gl"), "mu sigma p90 p95")
def lag_stats_global(spark, sf_dir):
    return lag.global_lag_stats(lag.lag_frequencies(tables.claims(spark, sf_dir)))


@query(
    "lag_labels",
    with_stats(
        """SELECT plant, product_cat2, mid_category, strftime(occurrence_date, '%Y-%m-%d') AS occurrence_date,
           strftime(manufacturing_date, '%Y-%m-%d') AS manufacturing_date, claim_count, CAST(lag_days AS INT) AS lag_days, lag_class
           FROM labelled"""
    ),
)
def lag_labels(spark, sf_dir):
    return labelled(spark, sf_dir).withColumns(
        {c: F.date_format(c, "yyyy-MM-dd") for c in ("occurrence_date", "manufacturing_date")}
    )


@query(
    "lag_label_share",
    with_stats("SELECT lag_class, count(*) AS n_rows, count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM labelled GROUP BY 1").replace(
        "count(*) * 100.0", "CAST(count(*) AS DOUBLE) * 100"
    ),
    "pct",
)
def lag_label_share(spark, sf_dir):
    return lag.label_share(labelled(spark, sf_dir))


@query(
    "lag_monthly_stats",
    with_stats(
        """SELECT CAST(year(occurrence_date) AS INT) AS year, CAST(month(occurrence_date) AS INT) AS month, count(*) AS total,
        count_if(lag_class = 'normal')::BIGINT AS normal, count_if(lag_class = 'borderline')::BIGINT AS borderline,
        count_if(lag_class = 'extreme')::BIGINT AS extreme, count_if(lag_class = 'invalid_negative')::BIGINT AS invalid_negative,
        CAST(count_if(lag_class IN ('normal', 'borderline')) AS DOUBLE) * 100 / count(*) AS kept_pct
        FROM labelled GROUP BY 1, 2"""
    ),
    "kept_pct",
)
def lag_monthly_stats(spark, sf_dir):
    return lag.monthly_label_stats(labelled(spark, sf_dir))


@query(
    "lag_candidate_series",
    with_stats(
        """SELECT plant, product_cat2, mid_category, CAST(sum(claim_count) AS BIGINT) AS claim_count,
        avg(CASE lag_class WHEN 'normal' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END) AS mean_weight,
        count_if(lag_class = 'normal')::BIGINT AS n_normal
        FROM labelled WHERE lag_class IN ('normal', 'borderline') GROUP BY 1, 2, 3""",
        "s",
    ),
    "mean_weight",
)
def lag_candidate_series(spark, sf_dir):
    return lag.candidate_series(lag.retrain_candidates(labelled(spark, sf_dir, "sparse")))


@query(
    "lag_candidate_top",
    with_stats(
        """SELECT plant, product_cat2, mid_category, CAST(sum(claim_count) AS BIGINT) AS claim_count,
        avg(CASE lag_class WHEN 'normal' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END) AS mean_weight,
        count_if(lag_class = 'normal')::BIGINT AS n_normal
        FROM labelled WHERE lag_class IN ('normal', 'borderline') GROUP BY 1, 2, 3
        ORDER BY claim_count DESC, plant, product_cat2, mid_category LIMIT 10"""
    ),
    "mean_weight",
)
def lag_candidate_top(spark, sf_dir):
    series = lag.candidate_series(lag.retrain_candidates(labelled(spark, sf_dir)))
    return series.orderBy(F.col("claim_count").desc(), "plant", "product_cat2", "mid_category").limit(10)


@query(
    "lag_distribution",
    """SELECT *, q25 - 1.5 * iqr AS lower_fence, q75 + 1.5 * iqr AS upper_fence FROM (
       SELECT product_cat2 AS product, count(*) AS count, avg(lag_days) AS mean, stddev_samp(lag_days) AS std,
       CAST(min(lag_days) AS INT) AS min, quantile_cont(lag_days, 0.25) AS q25, quantile_cont(lag_days, 0.5) AS median,
       quantile_cont(lag_days, 0.75) AS q75, CAST(max(lag_days) AS INT) AS max,
       quantile_cont(lag_days, 0.75) - quantile_cont(lag_days, 0.25) AS iqr
       FROM claims_s GROUP BY 1 HAVING count(*) >= 10)""",
    "mean std q25 median q75 iqr lower_fence upper_fence",
)
def lag_distribution(spark, sf_dir):
    return lag.lag_distribution(lag.lag_frequencies(tables.claims(spark, sf_dir, "sparse")))


_BOUNDS = """bounds AS (SELECT {by}, CASE WHEN count(*) >= 10 THEN {lo} END AS lower_bound,
   CASE WHEN count(*) >= 10 THEN {hi} END AS upper_bound FROM claims_d WHERE lag_days IS NOT NULL GROUP BY 1),
 judged AS (SELECT c.*, lower_bound, upper_bound, lower_bound IS NULL OR lag_days BETWEEN lower_bound AND upper_bound AS inside
   FROM claims_d c JOIN bounds USING ({by}))"""
_IQR = _BOUNDS.format(
    by="product_cat2",
    lo="quantile_cont(lag_days, 0.25) - 1.5 * (quantile_cont(lag_days, 0.75) - quantile_cont(lag_days, 0.25))",
    hi="quantile_cont(lag_days, 0.75) + 1.5 * (quantile_cont(lag_days, 0.75) - quantile_cont(lag_days, 0.25))",
)
_PCT = _BOUNDS.format(by="product_cat2", lo="quantile_cont(lag_days, 0.05)", hi="quantile_cont(lag_days, 0.95)")
_KEPT = """SELECT plant, product_cat2, mid_category, CAST(lag_days AS INT) AS lag_days, claim_count FROM judged WHERE inside"""
_STATS = """SELECT product_cat2 AS product, lower_bound, upper_bound, count(*) AS total, count_if(inside)::BIGINT AS normal,
   (count(*) - count_if(inside))::BIGINT AS outliers, CAST(count(*) - count_if(inside) AS DOUBLE) / count(*) AS outlier_ratio
   FROM judged WHERE lower_bound IS NOT NULL GROUP BY 1, 2, 3"""


@query("lag_filter_iqr", f"WITH {_IQR} {_KEPT}")
def lag_filter_iqr(spark, sf_dir):
    rows = lag.with_lag_days(tables.claims(spark, sf_dir))
    kept = lag.within_bounds(rows, lag.iqr_bounds(lag.lag_frequencies(rows)))
    return kept.select("plant", "product_cat2", "mid_category", "lag_days", "claim_count")


@query("lag_filter_iqr_stats", f"WITH {_IQR} {_STATS}", "lower_bound upper_bound outlier_ratio")
def lag_filter_iqr_stats(spark, sf_dir):
    freq = lag.lag_frequencies(tables.claims(spark, sf_dir))
    return lag.bound_stats(freq, lag.iqr_bounds(freq))


@query("lag_filter_percentile", f"WITH {_PCT} {_KEPT}")
def lag_filter_percentile(spark, sf_dir):
    rows = lag.with_lag_days(tables.claims(spark, sf_dir))
    kept = lag.within_bounds(rows, lag.percentile_bounds(lag.lag_frequencies(rows)))
    return kept.select("plant", "product_cat2", "mid_category", "lag_days", "claim_count")


@query(
    "lag_filter_report",
    f"""WITH {_PCT}, stats AS ({_STATS})
    SELECT (SELECT count(*) FROM claims_d) AS original_rows, ((SELECT count(*) FROM claims_d) - sum(outliers))::BIGINT AS filtered_rows,
    sum(outliers)::BIGINT AS removed_rows, CAST(sum(outliers) AS DOUBLE) / (SELECT count(*) FROM claims_d) AS removal_ratio,
    count(*) AS products_analyzed, avg(outlier_ratio) AS mean_outlier_ratio,
    quantile_cont(outlier_ratio, 0.5) AS median_outlier_ratio, max(outlier_ratio) AS max_outlier_ratio FROM stats""",
    "removal_ratio mean_outlier_ratio median_outlier_ratio max_outlier_ratio",
)
def lag_filter_report(spark, sf_dir):
    freq = lag.lag_frequencies(tables.claims(spark, sf_dir))
    return lag.filter_report(freq, lag.bound_stats(freq, lag.percentile_bounds(freq)))


@query(
    "lag_outlier_products",
    f"""WITH {_PCT}, stats AS ({_STATS})
    SELECT product, total, outliers, outlier_ratio FROM stats ORDER BY outlier_ratio DESC, product LIMIT 10""",
    "outlier_ratio",
)
def lag_outlier_products(spark, sf_dir):
    freq = lag.lag_frequencies(tables.claims(spark, sf_dir))
    stats = lag.bound_stats(freq, lag.percentile_bounds(freq))
    worst = stats.orderBy(F.col("outlier_ratio").desc(), "product").limit(10)
    return worst.select("product", "total", "outliers", "outlier_ratio")


# --- panels ---------------------------------------------------------------------------------------


@query("monthly_panel", "SELECT series_id, plant, product_cat2, mid_category, year, month, idx, y AS claim_count FROM panel_s")
def monthly_panel(spark, sf_dir):
    counts = panel.slot_counts(tables.claims(spark, sf_dir, "sparse"))
    return panel.dense_panel(counts, end=END, start=START).drop("n")


@query(
    "monthly_panel_from_data",
    """SELECT s.series_id, CAST(f.y0 + g.i // 12 AS INT) AS year, CAST(g.i % 12 + 1 AS INT) AS month, coalesce(c.v, 0.0) AS claim_count
       FROM (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id FROM claims_s GROUP BY 1 HAVING sum(claim_count) >= 10) s
       CROSS JOIN (SELECT min(year(manufacturing_date)) AS y0 FROM claims_s
                   WHERE plant || '|' || product_cat2 || '|' || mid_category IN
                   (SELECT plant || '|' || product_cat2 || '|' || mid_category FROM claims_s GROUP BY 1 HAVING sum(claim_count) >= 10)) f
       CROSS JOIN LATERAL (SELECT unnest(range((2001 - f.y0) * 12 + 12)) AS i) g
       LEFT JOIN (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, year(manufacturing_date) AS yr,
                  month(manufacturing_date) AS mo, CAST(sum(claim_count) AS DOUBLE) AS v FROM claims_s GROUP BY 1, 2, 3) c
       ON c.series_id = s.series_id AND c.yr = f.y0 + g.i // 12 AND c.mo = g.i % 12 + 1""",
)
def monthly_panel_from_data(spark, sf_dir):
    counts = panel.slot_counts(tables.claims(spark, sf_dir, "sparse"))
    return panel.dense_panel(counts, end=None).select("series_id", "year", "month", "claim_count")


@query(
    "sparse_panel",
    """SELECT series_id, plant, product_cat2, mid_category, year, month, y AS claim_count FROM counts_s
       WHERE series_id IN (SELECT series_id FROM series_s)""",
)
def sparse_panel(spark, sf_dir):
    return panel.sparse_panel(panel.slot_counts(tables.claims(spark, sf_dir, "sparse")), 10)


_EVENTS = """ev AS (SELECT 'G' || (user_id % 10) AS plant, event_type AS product_cat2,
   CASE WHEN value >= 50 THEN 'high' ELSE 'low' END AS mid_category, CAST(ts AS DATE) AS d FROM events)"""


@query(
    "weekly_panel",
    """WITH w AS (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, isoyear(manufacturing_date) AS yr,
         week(manufacturing_date) AS wk, CAST(sum(claim_count) AS DOUBLE) AS v FROM claims_d GROUP BY 1, 2, 3),
       f AS (SELECT min(yr) AS y0 FROM w)
       SELECT s.series_id, CAST(f.y0 + g.i // 53 AS INT) AS year, CAST(g.i % 53 + 1 AS INT) AS week, coalesce(w.v, 0.0) AS claim_count
       FROM (SELECT DISTINCT series_id FROM w) s CROSS JOIN f CROSS JOIN LATERAL (SELECT unnest(range((2001 - f.y0) * 53 + 53)) AS i) g
       LEFT JOIN w ON w.series_id = s.series_id AND w.yr = f.y0 + g.i // 53 AND w.wk = g.i % 53 + 1""",
)
def weekly_panel(spark, sf_dir):
    counts = panel.slot_counts(tables.claims(spark, sf_dir), slot="week")
    return panel.dense_panel(counts, end=None, slot="week", min_claims=0).select(
        "series_id", "year", "week", "claim_count"
    )


@query(
    "weekly_panel_exact",
    """WITH w AS (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, isoyear(manufacturing_date) AS yr,
         week(manufacturing_date) AS wk, CAST(sum(claim_count) AS DOUBLE) AS v FROM claims_d GROUP BY 1, 2, 3),
       f AS (SELECT min(yr) AS y0 FROM w),
       grid AS (SELECT s.series_id, f.y0 + g.i // 53 AS year, g.i % 53 + 1 AS week
         FROM (SELECT DISTINCT series_id FROM w) s CROSS JOIN f CROSS JOIN LATERAL (SELECT unnest(range((2001 - f.y0) * 53 + 53)) AS i) g)
       SELECT g.series_id, CAST(g.year AS INT) AS year, CAST(g.week AS INT) AS week,
         CAST(row_number() OVER (PARTITION BY g.series_id ORDER BY g.year, g.week) - 1 AS INT) AS idx, coalesce(w.v, 0.0) AS claim_count
       FROM grid g LEFT JOIN w ON w.series_id = g.series_id AND w.yr = g.year AND w.wk = g.week
       WHERE g.week < 53 OR week(make_date(g.year, 12, 28)) = 53""",
)
def weekly_panel_exact(spark, sf_dir):
    counts = panel.slot_counts(tables.claims(spark, sf_dir), slot="week")
    p = panel.dense_panel(counts, end=None, slot="week", min_claims=0, iso_exact=True)
    return p.select("series_id", "year", "week", "idx", "claim_count")


@query(
    "weekly_event_counts",
    f"""WITH {_EVENTS} SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, CAST(isoyear(d) AS INT) AS year,
        CAST(week(d) AS INT) AS week, CAST(count(*) AS DOUBLE) AS claim_count FROM ev GROUP BY 1, 2, 3""",
)
def weekly_event_counts(spark, sf_dir):
    return panel.slot_counts(tables.event_counts(spark, sf_dir), slot="week").select(
        "series_id", "year", "week", "claim_count"
    )


_QUALITY = """q AS (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, {yr} AS yr, {part} AS part,
      CAST(sum(claim_count) AS DOUBLE) AS v, avg(CASE lag_class WHEN 'normal' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END) AS w,
      CASE WHEN count_if(lag_class = 'borderline') >= count_if(lag_class = 'normal') THEN 'borderline' ELSE 'normal' END AS c
      FROM labelled WHERE lag_class IN ('normal', 'borderline') GROUP BY 1, 2, 3)"""


@query(
    "panel_quality",
    f"""WITH {STATS.format(g='s')}, {_QUALITY.format(yr='year(manufacturing_date)', part='month(manufacturing_date)')},
      s AS (SELECT series_id FROM q GROUP BY 1 HAVING sum(v) >= 10)
      SELECT s.series_id, CAST(@start + g.i // 12 AS INT) AS year, CAST(g.i % 12 + 1 AS INT) AS month, coalesce(v, 0.0) AS claim_count,
      coalesce(c, 'normal') AS lag_class, coalesce(w, 1.0) AS sample_weight
      FROM s CROSS JOIN range(@slots) g(i) LEFT JOIN q ON q.series_id = s.series_id AND q.yr = @start + g.i // 12 AND q.part = g.i % 12 + 1""",
    "sample_weight",
)
def panel_quality(spark, sf_dir):
    rows = lag.retrain_candidates(labelled(spark, sf_dir, "sparse"))
    p = panel.dense_panel(panel.slot_counts(rows, quality=True), end=END, start=START)
    return p.select("series_id", "year", "month", "claim_count", "lag_class", "sample_weight")


@query(
    "panel_quality_weekly",
    f"""WITH {STATS.format(g='d')}, {_QUALITY.format(yr='isoyear(manufacturing_date)', part='week(manufacturing_date)')},
      f AS (SELECT min(yr) AS y0, max(yr) AS y1 FROM q)
      SELECT s.series_id, CAST(f.y0 + g.i // 53 AS INT) AS year, CAST(g.i % 53 + 1 AS INT) AS week, coalesce(v, 0.0) AS claim_count,
      coalesce(c, 'normal') AS lag_class, coalesce(w, 1.0) AS sample_weight
      FROM (SELECT DISTINCT series_id FROM q) s CROSS JOIN f CROSS JOIN LATERAL (SELECT unnest(range((f.y1 - f.y0) * 53 + 53)) AS i) g
      LEFT JOIN q ON q.series_id = s.series_id AND q.yr = f.y0 + g.i // 53 AND q.part = g.i % 53 + 1""",
    "sample_weight",
)
def panel_quality_weekly(spark, sf_dir):
    rows = lag.retrain_candidates(labelled(spark, sf_dir))
    p = panel.dense_panel(panel.slot_counts(rows, slot="week", quality=True), end=None, slot="week", min_claims=0)
    return p.select("series_id", "year", "week", "claim_count", "lag_class", "sample_weight")


@query(
    "panel_summary",
    f"""WITH {STATS.format(g='s')}, {_QUALITY.format(yr='year(manufacturing_date)', part='month(manufacturing_date)')},
      s AS (SELECT series_id FROM q GROUP BY 1 HAVING sum(v) >= 10),
      p AS (SELECT s.series_id, @start + g.i // 12 AS year, coalesce(v, 0.0) AS v, coalesce(c, 'normal') AS c
      FROM s CROSS JOIN range(@slots) g(i) LEFT JOIN q ON q.series_id = s.series_id AND q.yr = @start + g.i // 12 AND q.part = g.i % 12 + 1)
      SELECT count(*) AS n_rows, count(DISTINCT series_id) AS n_series, 100 * avg(CASE WHEN v > 0 THEN 1.0::DOUBLE ELSE 0 END) AS nonzero_pct,
      CAST(min(year) AS INT) AS first_year, CAST(max(year) AS INT) AS last_year, count_if(c = 'normal')::BIGINT AS n_normal,
      count_if(c = 'borderline')::BIGINT AS n_borderline FROM p""",
    "nonzero_pct",
)
def panel_summary(spark, sf_dir):
    rows = lag.retrain_candidates(labelled(spark, sf_dir, "sparse"))
    return panel.panel_summary(panel.dense_panel(panel.slot_counts(rows, quality=True), end=END, start=START))


@query(
    "month_by_occurrence",
    f"""WITH {STATS.format(g='d')}, {_QUALITY.format(yr='year(occurrence_date)', part='month(occurrence_date)')}
      SELECT series_id, CAST(yr AS INT) AS year, CAST(part AS INT) AS month, v AS claim_count, c AS lag_class, w AS sample_weight FROM q""",
    "sample_weight",
)
def month_by_occurrence(spark, sf_dir):
    rows = lag.retrain_candidates(labelled(spark, sf_dir))
    counts = panel.slot_counts(rows, date_col="occurrence_date", quality=True)
    return counts.select("series_id", "year", "month", "claim_count", "lag_class", "sample_weight")


@query(
    "candidate_week_rows",
    with_stats(
        """SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, CAST(isoyear(manufacturing_date) AS INT) AS year,
        CAST(week(manufacturing_date) AS INT) AS week, claim_count, lag_class,
        CASE lag_class WHEN 'normal' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS sample_weight
        FROM labelled WHERE lag_class IN ('normal', 'borderline')"""
    ),
)
def candidate_week_rows(spark, sf_dir):
    rows = lag.retrain_candidates(labelled(spark, sf_dir))
    d = F.col("manufacturing_date")
    return rows.select(
        F.concat_ws("|", "plant", "product_cat2", "mid_category").alias("series_id"),
        calendar.iso_year(d).cast("int").alias("year"),
        calendar.iso_week(d).alias("week"),
        "claim_count",
        "lag_class",
        "sample_weight",
    )


@query(
    "reindexed_periods",
    """SELECT s.series_id, p.year, p.month, CAST(dense_rank() OVER (ORDER BY p.year, p.month) - 1 AS INT) AS idx, coalesce(c.y, 0.0) AS claim_count
       FROM (SELECT DISTINCT series_id FROM counts_s) s CROSS JOIN (SELECT DISTINCT year, month FROM counts_s) p
       LEFT JOIN counts_s c USING (series_id, year, month)""",
)
def reindexed_periods(spark, sf_dir):
    return panel.reindex_observed(panel.slot_counts(tables.claims(spark, sf_dir, "sparse")))


# --- upserts --------------------------------------------------------------------------------------

_FRESH = """fresh AS (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, CAST(2000 AS INT) AS year, CAST(12 AS INT) AS month,
     CAST(sum(claim_count) AS DOUBLE) AS claim_count FROM claims_d WHERE year(manufacturing_date) = 2000
     AND month(manufacturing_date) = 12 AND lag_days >= 0 GROUP BY 1)"""


@query(
    "month_upsert",
    f"""WITH {_FRESH} SELECT series_id, year, month, y AS claim_count FROM counts_d WHERE NOT (year = 2000 AND month = 12)
        UNION ALL SELECT * FROM fresh""",
)
def month_upsert(spark, sf_dir):
    rows = tables.claims(spark, sf_dir)
    master = panel.slot_counts(rows).select("series_id", "year", "month", "claim_count")
    late = rows.where(F.datediff("occurrence_date", "manufacturing_date") >= 0)
    return panel.upsert_month(master, panel.slot_counts(late), 2000, 12)


@query(
    "keyed_upsert",
    """SELECT series_id, year, month, coalesce(f.v, c.y) AS claim_count FROM counts_d c FULL JOIN
       (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, CAST(year(manufacturing_date) AS INT) AS year,
        CAST(month(manufacturing_date) AS INT) AS month, CAST(sum(claim_count) AS DOUBLE) AS v FROM claims_d
        WHERE manufacturing_date >= DATE '2001-01-01' AND lag_days >= 0 GROUP BY 1, 2, 3) f USING (series_id, year, month)""",
)
def keyed_upsert(spark, sf_dir):
    master = panel.slot_counts(tables.claims(spark, sf_dir)).select("series_id", "year", "month", "claim_count")
    later = tables.claims(spark, sf_dir, made=("2001-01-01", "2100-01-01"))
    fresh = panel.slot_counts(later.where(F.datediff("occurrence_date", "manufacturing_date") >= 0))
    return panel.upsert_keyed(master, fresh)


@query(
    "series_viability",
    """SELECT series_id, sum(y) AS total_claims, sum(y) >= 20 AS viable FROM counts_s GROUP BY 1""",
)
def series_viability(spark, sf_dir):
    return panel.viable_series(panel.slot_counts(tables.claims(spark, sf_dir, "sparse")), 20)
