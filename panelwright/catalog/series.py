"""Queries on panels: features, changepoints, guards, documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog.base import TRAIN_SLOTS, history, month_panel, query
from panelwright.config import GuardRules
from panelwright.operators import changepoints, documents, features, guards, panel
from panelwright.sources import tables

MONTHLY_GUARDS = GuardRules(window=12, period=12, expected_length=TRAIN_SLOTS, gap_days=31)


def hist(spark, sf_dir, grain="sparse"):
    return history(month_panel(spark, sf_dir, grain))


def frame(a: int, b: int) -> str:
    side = lambda k: f"{-k} PRECEDING" if k < 0 else f"{k} FOLLOWING"
    return f"OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN {side(a)} AND {side(b)})"


@query(
    "rolling_psi",
    f"""SELECT series_id, year, month, CASE WHEN idx >= 12 AND avg(y) {frame(-12, -1)} > 0
        THEN stddev_pop(y) {frame(-12, -1)} / avg(y) {frame(-12, -1)} ELSE 0.0 END AS psi FROM hist_s""",
    "psi",
)
def rolling_psi(spark, sf_dir):
    return features.rolling_psi(hist(spark, sf_dir)).select("series_id", "year", "month", "psi")


@query(
    "rolling_amplitude",
    f"SELECT series_id, year, month, CASE WHEN idx >= 12 THEN stddev_pop(y) {frame(-12, -1)} ELSE 0.0 END AS amplitude FROM hist_s",
    "amplitude",
)
def rolling_amplitude(spark, sf_dir):
    return features.rolling_amplitude(hist(spark, sf_dir)).select("series_id", "year", "month", "amplitude")


@query("value_range", "SELECT series_id, max(y) - min(y) AS range FROM hist_s GROUP BY 1")
def value_range(spark, sf_dir):
    return features.value_range(hist(spark, sf_dir))


@query(
    "diff_changepoints",
    f"""SELECT series_id, year, month, CASE WHEN idx >= 12 AND sd > 0 AND abs(step) > 2 * sd + 1e-9 THEN 1 ELSE 0 END AS changepoint
        FROM (SELECT *, stddev_pop(step) {frame(-12, -1)} AS sd FROM
        (SELECT *, coalesce(y - lag(y) OVER (PARTITION BY series_id ORDER BY idx), 0.0) AS step FROM hist_s))""",
)
def diff_changepoints(spark, sf_dir):
    return features.difference_flags(hist(spark, sf_dir)).select("series_id", "year", "month", "changepoint")


_CENTRED = f"""m AS (SELECT *, CASE WHEN count(y) {frame(-3, 2)} = 6 THEN avg(y) {frame(-3, 2)} END AS ma FROM hist_s),
 d AS (SELECT *, round(abs(ma - lag(ma) OVER (PARTITION BY series_id ORDER BY idx)), 9) AS move FROM m),
 c AS (SELECT series_id, round(quantile_cont(move, 0.75), 9) AS cut FROM d GROUP BY 1)"""


@query(
    "centred_changepoints",
    f"""WITH {_CENTRED} SELECT series_id, coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) FILTER (move > cut), '') AS changepoints,
        coalesce(bool_or(move > cut AND idx >= @half), false) AS has_recent FROM d JOIN c USING (series_id) GROUP BY 1""",
)
def centred_changepoints(spark, sf_dir):
    found = features.centred_changepoints(hist(spark, sf_dir))
    return found.select("series_id", F.array_join(F.col("changepoints").cast("array<string>"), ",").alias("changepoints"), "has_recent")


@query(
    "peaks",
    """WITH p AS (SELECT a.series_id, a.idx AS i, min(b.idx) AS j, any_value(a.y) AS h FROM hist_s a
         JOIN hist_s l ON l.series_id = a.series_id AND l.idx = a.idx - 1 AND l.y < a.y
         JOIN hist_s b ON b.series_id = a.series_id AND b.idx > a.idx AND b.y <> a.y GROUP BY 1, 2),
       t AS (SELECT p.series_id, (i + j - 1) // 2 AS idx, h FROM p JOIN hist_s b ON b.series_id = p.series_id AND b.idx = j AND b.y < h),
       e AS (SELECT t.series_id, t.idx, h, coalesce(max(x.idx) FILTER (x.idx < t.idx AND x.y > h), -1) AS lo,
         coalesce(min(x.idx) FILTER (x.idx > t.idx AND x.y > h), @train) AS hi FROM t JOIN hist_s x USING (series_id) GROUP BY 1, 2, 3)
       SELECT e.series_id, CAST(e.idx AS INT) AS idx, h AS height,
         h - greatest(min(x.y) FILTER (x.idx > lo AND x.idx <= e.idx), min(x.y) FILTER (x.idx >= e.idx AND x.idx < hi)) AS prominence
       FROM e JOIN hist_s x USING (series_id) GROUP BY 1, 2, 3
       HAVING h - greatest(min(x.y) FILTER (x.idx > lo AND x.idx <= e.idx), min(x.y) FILTER (x.idx >= e.idx AND x.idx < hi)) >= 1""".replace(
        "JOIN hist_s x USING (series_id) GROUP BY 1, 2, 3)", "JOIN hist_s x ON x.series_id = t.series_id GROUP BY 1, 2, 3)"
    )
    .replace("FROM e JOIN hist_s x USING (series_id) GROUP BY 1, 2, 3", "FROM e JOIN hist_s x ON x.series_id = e.series_id GROUP BY 1, 2, 3"),
)
def peaks(spark, sf_dir):
    return features.peaks(panel.series_vectors(hist(spark, sf_dir))).drop("width")


# the bases are the lowest points nearest to the peak; half height is crossed between them, by linear interpolation
@query(
    "peak_widths",
    """WITH p AS (SELECT a.series_id, a.idx AS i, min(b.idx) AS j, any_value(a.y) AS h FROM hist_s a
         JOIN hist_s l ON l.series_id = a.series_id AND l.idx = a.idx - 1 AND l.y < a.y
         JOIN hist_s b ON b.series_id = a.series_id AND b.idx > a.idx AND b.y <> a.y GROUP BY 1, 2),
       t AS (SELECT p.series_id, (i + j - 1) // 2 AS pos, h FROM p JOIN hist_s b ON b.series_id = p.series_id AND b.idx = j AND b.y < h),
       e AS (SELECT t.series_id, t.pos, h, coalesce(max(x.idx) FILTER (x.idx < t.pos AND x.y > h), -1) AS lo,
         coalesce(min(x.idx) FILTER (x.idx > t.pos AND x.y > h), @train) AS hi FROM t JOIN hist_s x ON x.series_id = t.series_id GROUP BY 1, 2, 3),
       m AS (SELECT e.*, (SELECT min(x.y) FROM hist_s x WHERE x.series_id = e.series_id AND x.idx > lo AND x.idx <= pos) AS left_min,
         (SELECT min(x.y) FROM hist_s x WHERE x.series_id = e.series_id AND x.idx >= pos AND x.idx < hi) AS right_min FROM e),
       b AS (SELECT m.series_id, pos, any_value(h) AS h, any_value(h - greatest(left_min, right_min)) AS prominence,
         any_value(h - (h - greatest(left_min, right_min)) * 0.5::DOUBLE) AS level,
         max(x.idx) FILTER (x.idx > lo AND x.idx <= pos AND x.y = left_min) AS lb, min(x.idx) FILTER (x.idx >= pos AND x.idx < hi AND x.y = right_min) AS rb
         FROM m JOIN hist_s x ON x.series_id = m.series_id WHERE h - greatest(left_min, right_min) >= 1 GROUP BY 1, 2),
       c AS (SELECT b.series_id, pos, any_value(h) AS h, any_value(prominence) AS prominence, any_value(level) AS level,
         coalesce(max(x.idx) FILTER (x.idx BETWEEN lb AND pos AND x.y <= level), any_value(lb)) AS l,
         coalesce(min(x.idx) FILTER (x.idx BETWEEN pos AND rb AND x.y <= level), any_value(rb)) AS r
         FROM b JOIN hist_s x ON x.series_id = b.series_id GROUP BY 1, 2)
       SELECT c.series_id, CAST(pos AS INT) AS idx, h AS height, prominence,
         (CASE WHEN y.y < level THEN r - (level - y.y) / (yb.y - y.y) ELSE r END) - (CASE WHEN x.y < level THEN l + (level - x.y) / (xa.y - x.y) ELSE l END) AS width
       FROM c JOIN hist_s x ON x.series_id = c.series_id AND x.idx = l JOIN hist_s xa ON xa.series_id = c.series_id AND xa.idx = l + 1
       JOIN hist_s y ON y.series_id = c.series_id AND y.idx = r JOIN hist_s yb ON yb.series_id = c.series_id AND yb.idx = r - 1""",
    "width",
)
def peak_widths(spark, sf_dir):
    return features.peaks(panel.series_vectors(hist(spark, sf_dir)))


@query(
    "cusum_flags",
    """WITH z AS (SELECT h.*, CASE WHEN s.sd > 0 THEN (y - s.m) / s.sd ELSE 0 END AS z FROM hist_s h
         JOIN (SELECT series_id, avg(y) AS m, stddev_pop(y) AS sd FROM hist_s GROUP BY 1) s USING (series_id)),
       c AS (SELECT *, sum(CASE WHEN idx > 0 THEN z - 0.5::DOUBLE ELSE 0 END) OVER w AS up, sum(CASE WHEN idx > 0 THEN -z - 0.5::DOUBLE ELSE 0 END) OVER w AS dn
         FROM z WINDOW w AS (PARTITION BY series_id ORDER BY idx ROWS UNBOUNDED PRECEDING)),
       f AS (SELECT *, up - min(up) OVER w AS cusum_pos, dn - min(dn) OVER w AS cusum_neg
         FROM c WINDOW w AS (PARTITION BY series_id ORDER BY idx ROWS UNBOUNDED PRECEDING))
       SELECT series_id, year, month, cusum_pos, cusum_neg, greatest(cusum_pos, cusum_neg) > 3 + 1e-9 AS changepoint FROM f""",
    "cusum_pos cusum_neg",
)
def cusum_flags(spark, sf_dir):
    return changepoints.cusum(hist(spark, sf_dir)).select("series_id", "year", "month", "cusum_pos", "cusum_neg", "changepoint")


_TTEST = f"""f AS (SELECT series_id, idx, year, month, idx >= 10 AND idx < @train - 10 AND coalesce(CASE WHEN se = 0 THEN diff <> 0 ELSE abs(diff) / se > 2.878440472738608 END, false) AS cp
  FROM (SELECT *, avg(y) {frame(-10, -1)} - avg(y) {frame(0, 9)} AS diff,
        sqrt((var_samp(y) {frame(-10, -1)} + var_samp(y) {frame(0, 9)}) / 2 * 2 / 10) AS se FROM hist_d))"""


@query("ttest_changepoints", f"WITH {_TTEST} SELECT series_id, year, month, cp AS changepoint FROM f")
def ttest_changepoints(spark, sf_dir):
    return changepoints.t_test_flags(hist(spark, sf_dir, "dense")).select("series_id", "year", "month", "changepoint")


@query(
    "stable_regions",
    f"""WITH {_TTEST}, m AS (SELECT series_id, idx, lag(idx) OVER (PARTITION BY series_id ORDER BY idx) AS prev,
          lead(idx) OVER (PARTITION BY series_id ORDER BY idx) AS nxt FROM f WHERE cp),
        r AS (SELECT series_id, 0 AS b, idx - 5 AS e FROM m WHERE prev IS NULL
          UNION ALL SELECT series_id, idx + 5, coalesce(nxt - 5, @train) FROM m
          UNION ALL SELECT DISTINCT series_id, 0, @train FROM f WHERE series_id NOT IN (SELECT series_id FROM m))
        SELECT series_id, CAST(b AS INT) AS begin, CAST(e AS INT) AS "end" FROM r WHERE e > b""",
)
def stable_regions(spark, sf_dir):
    return changepoints.stable_regions(changepoints.t_test_flags(hist(spark, sf_dir, "dense")))


@query(
    "stable_rows",
    f"""WITH {_TTEST} SELECT a.series_id, a.year, a.month FROM f a WHERE NOT EXISTS
        (SELECT 1 FROM f b WHERE b.cp AND b.series_id = a.series_id AND a.idx < b.idx + 5 AND a.idx >= b.idx - 5)""",
)
def stable_rows(spark, sf_dir):
    return changepoints.stable_rows(changepoints.t_test_flags(hist(spark, sf_dir, "dense"))).select("series_id", "year", "month")


@query("segment_changepoints")
def segment_changepoints(spark, sf_dir):
    vectors = panel.series_vectors(hist(spark, sf_dir))
    found = changepoints.listed_changepoints(changepoints.penalised_segments(vectors, rule="log_deviation"))
    return found.select("series_id", F.size("segment_ends").alias("n_segments"), "changepoints")


@query(
    "recent_alert",
    """SELECT series_id, recent > baseline + sigma AS alert, coalesce((recent - baseline) / nullif(sigma, 0), 0.0) AS score, recent, baseline, sigma
       FROM (SELECT series_id, avg(y) FILTER (idx >= @train - 4) AS recent, avg(y) FILTER (idx BETWEEN @train - 16 AND @train - 5) AS baseline,
             stddev_samp(y) FILTER (idx BETWEEN @train - 16 AND @train - 5) AS sigma FROM hist_s GROUP BY 1)""",
    "score recent baseline sigma",
)
def recent_alert(spark, sf_dir):
    return features.recent_alert(hist(spark, sf_dir))


@query(
    "seasonal_index",
    """SELECT *, CASE WHEN avg(season_mean) OVER (PARTITION BY series_id) > 0
       THEN season_mean / avg(season_mean) OVER (PARTITION BY series_id) ELSE 1.0 END AS seasonal_factor
       FROM (SELECT series_id, CAST(idx % 12 AS INT) AS position, avg(y) AS season_mean, count(*) AS n_cycles FROM hist_s GROUP BY 1, 2)""",
    "season_mean seasonal_factor",
)
def seasonal_index(spark, sf_dir):
    return features.seasonal_index(hist(spark, sf_dir))


@query(
    "recent_motion",
    """SELECT series_id, avg(v) FILTER (idx >= @half + 1) AS mean_velocity, stddev_pop(v) FILTER (idx >= @half + 1) AS sd_velocity,
       avg(a) FILTER (idx >= @half + 2) AS mean_acceleration, avg(a) FILTER (idx >= @half + 2 AND a > 0) AS mean_rising, regr_slope(y, idx) AS slope
       FROM (SELECT *, y - lag(y) OVER w AS v, y - 2 * lag(y) OVER w + lag(y, 2) OVER w AS a FROM hist_s
             WINDOW w AS (PARTITION BY series_id ORDER BY idx)) WHERE idx >= @half GROUP BY 1""",
    "mean_velocity sd_velocity mean_acceleration mean_rising slope",
)
def recent_motion(spark, sf_dir):
    return features.recent_motion(hist(spark, sf_dir))


@query(
    "rolling_range",
    f"""SELECT series_id, avg(r) AS mean_range FROM (SELECT series_id, idx, max(y) {frame(0, 11)} - min(y) {frame(0, 11)} AS r FROM hist_s)
        WHERE idx <= @year GROUP BY 1""",
    "mean_range",
)
def rolling_range(spark, sf_dir):
    return features.rolling_range_mean(hist(spark, sf_dir))


@query(
    "date_gaps",
    """SELECT series_id, strftime(d, '%Y-%m-%d') AS manufacturing_date, CAST(gap AS INT) AS gap_days FROM (
       SELECT series_id, d, date_diff('day', lag(d) OVER (PARTITION BY series_id ORDER BY d), d) AS gap FROM
       (SELECT DISTINCT plant || '|' || product_cat2 || '|' || mid_category AS series_id, manufacturing_date AS d FROM claims_d))
       WHERE gap > 10""",
)
def date_gaps(spark, sf_dir):
    rows = tables.claims(spark, sf_dir)
    days = rows.select(F.concat_ws("|", "plant", "product_cat2", "mid_category").alias("series_id"), "manufacturing_date").distinct()
    gaps = features.value_gaps(days, "manufacturing_date")
    return gaps.withColumn("manufacturing_date", F.date_format("manufacturing_date", "yyyy-MM-dd"))


# --- guards ---------------------------------------------------------------------------------------

_GUARDS = """g AS (SELECT series_id, count_if(y = 0) / @train::DOUBLE AS zero_ratio,
   avg(y) FILTER (idx >= @year) AS rm, var_pop(y) FILTER (idx >= @year) AS rv, avg(y) FILTER (idx < @year) AS pm, var_pop(y) FILTER (idx < @year) AS pv,
   var_pop(y) AS v, avg(y) AS m, stddev_pop(y) AS sd, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM hist_{g} GROUP BY 1),
 sv AS (SELECT series_id, var_pop(sm) AS sv FROM (SELECT series_id, idx % 12 AS p, avg(y) AS sm FROM hist_{g} GROUP BY 1, 2) GROUP BY 1),
 o AS (SELECT series_id, count_if({cond}) AS k FROM hist_{g} JOIN g USING (series_id) GROUP BY 1),
 t AS (SELECT series_id, zero_ratio >= 0.8 AS is_sparse, zero_ratio,
   round(coalesce(abs(rm - pm) / nullif(sqrt(pv), 0), 0), 9) > 3 OR round(coalesce(abs(rv - pv) / nullif(pv, 0), 0), 9) > 1 AS has_drift,
   coalesce(abs(rm - pm) / nullif(sqrt(pv), 0), 0.0) AS mean_shift_sigma, true AS is_complete, k > 0 AS has_outliers,
   k / @train::DOUBLE AS outlier_ratio, least(1.0, coalesce(sv / nullif(v, 0), 0)) AS seasonality_strength,
   round(least(1.0, coalesce(sv / nullif(v, 0), 0)), 9) >= 0.3 AS has_seasonality FROM g JOIN sv USING (series_id) JOIN o USING (series_id)),
 guards AS (SELECT *, concat_ws(',', CASE WHEN is_sparse THEN 'USE_NAIVE_MODEL' END, CASE WHEN has_drift THEN 'APPLY_SEASONAL_RECALIBRATION' END,
   CASE WHEN outlier_ratio > 0.1 THEN 'PREPROCESS_OUTLIERS' END, CASE WHEN NOT has_seasonality THEN 'USE_SIMPLE_MODEL' END) AS recommendations FROM t)"""
_IQR = "y < q1 - 3 * (q3 - q1) OR y > q3 + 3 * (q3 - q1)"
_Z = "sd > 0 AND abs((y - m) / sd) > 3"
GUARD_DOUBLES = "zero_ratio mean_shift_sigma outlier_ratio seasonality_strength"


def dated(spark, sf_dir, grain="sparse"):
    return hist(spark, sf_dir, grain).withColumn("slot_date", F.make_date("year", "month", F.lit(1)))


@query("guard_table", f"WITH {_GUARDS.format(g='s', cond=_IQR)} SELECT * FROM guards", GUARD_DOUBLES)
def guard_table(spark, sf_dir):
    return guards.guard_table(dated(spark, sf_dir), MONTHLY_GUARDS, date_col="slot_date")


@query("guard_table_zscore", f"WITH {_GUARDS.format(g='d', cond=_Z)} SELECT * FROM guards", GUARD_DOUBLES)
def guard_table_zscore(spark, sf_dir):
    return guards.guard_table(dated(spark, sf_dir, "dense"), MONTHLY_GUARDS, date_col="slot_date", outliers="zscore")


@query(
    "guard_filtered",
    f"""WITH {_GUARDS.format(g='s', cond=_IQR)} SELECT series_id, year, month, y AS claim_count FROM hist_s
        WHERE series_id NOT IN (SELECT series_id FROM guards WHERE is_sparse OR NOT is_complete)""",
)
def guard_filtered(spark, sf_dir):
    rows = dated(spark, sf_dir)
    kept = guards.apply_guards(rows, guards.guard_table(rows, MONTHLY_GUARDS, date_col="slot_date"))
    return kept.select("series_id", "year", "month", "claim_count")


@query(
    "outlier_rows",
    f"""WITH g AS (SELECT series_id, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM hist_s GROUP BY 1)
        SELECT series_id, year, month, y AS claim_count FROM hist_s JOIN g USING (series_id) WHERE {_IQR}""",
)
def outlier_rows(spark, sf_dir):
    return guards.outlier_positions(hist(spark, sf_dir)).select("series_id", "year", "month", "claim_count")


@query(
    "sparse_status",
    """SELECT series_id, CASE WHEN sparse OR sd < 0.01 THEN 'skipped' ELSE 'ok' END AS status,
       CASE WHEN sparse THEN 'sparse_series (' || txt || ')' WHEN sd < 0.01 THEN 'zero_variance' ELSE '' END AS reason,
       sparse AS sparse_flag, CASE WHEN sparse THEN txt ELSE '' END AS sparse_reason, n AS n_obs, m AS mean_claims, sd AS std_claims, nz AS nonzero_ratio
       FROM (SELECT *, m < 0.5 OR nz < 0.3 AS sparse, concat_ws('; ', CASE WHEN m < 0.5 THEN 'avg=' || CAST(round(m, 2) AS DECIMAL(28, 2)) || '<0.5' END,
         CASE WHEN nz < 0.3 THEN 'nonzero=' || CAST(round(nz * 100, 1) AS DECIMAL(28, 1)) || '%<30%' END) AS txt
       FROM (SELECT series_id, count(*) AS n, avg(y) AS m, stddev_pop(y) AS sd, CAST(count_if(y <> 0) AS DOUBLE) / count(*) AS nz FROM hist_s GROUP BY 1))""",
    "mean_claims std_claims nonzero_ratio",
)
def sparse_status(spark, sf_dir):
    return guards.model_eligibility(hist(spark, sf_dir))


# --- documents ------------------------------------------------------------------------------------


@query(
    "series_documents",
    """SELECT series_id, plant, product_cat2, mid_category, count(*) AS records, count_if(y > 0)::BIGINT AS non_zero_records, sum(y) AS total_claims,
       avg(y) AS mean_claims, max(y) AS max_claims, string_agg(CAST(CAST(y AS INT) AS VARCHAR), ',' ORDER BY idx) AS series
       FROM hist_s GROUP BY 1, 2, 3, 4 HAVING count_if(y > 0) >= 10""",
    "total_claims mean_claims max_claims",
)
def series_documents(spark, sf_dir):
    docs = documents.series_documents(hist(spark, sf_dir))
    series = F.array_join(F.transform("data", lambda d: d["claim_count"].cast("int").cast("string")), ",")
    return docs.withColumn("series", series).drop("data", "quality_stats")


@query(
    "documents_flattened",
    """SELECT series_id, plant, product_cat2, mid_category, year, month, y AS claim_count FROM hist_s
       WHERE series_id IN (SELECT series_id FROM hist_s GROUP BY 1 HAVING count_if(y > 0) >= 10)""",
)
def documents_flattened(spark, sf_dir):
    return documents.flat_panel(documents.series_documents(hist(spark, sf_dir))).drop("lag_class", "sample_weight")


@query(
    "document_summary",
    """SELECT (SELECT count(DISTINCT series_id) FROM hist_s) AS total_series, count(*) AS created,
       (SELECT count(DISTINCT series_id) FROM hist_s) - count(*) AS skipped_series
       FROM (SELECT series_id FROM hist_s GROUP BY 1 HAVING count_if(y > 0) >= 10)""",
)
def document_summary(spark, sf_dir):
    rows = hist(spark, sf_dir)
    return documents.document_summary(rows, documents.series_documents(rows))


@query(
    "train_window",
    "SELECT series_id, year, month, y AS claim_count FROM panel_s WHERE year BETWEEN 1999 AND 2000",
)
def train_window(spark, sf_dir):
    return panel.train_window(month_panel(spark, sf_dir, "sparse"), 1999, 2000).select("series_id", "year", "month", "claim_count")


@query(
    "trailing_months",
    "SELECT series_id, year, month, y AS claim_count FROM panel_s WHERE idx BETWEEN @train - 12 AND @train - 1",
)
def trailing_months(spark, sf_dir):
    return panel.trailing_months(month_panel(spark, sf_dir, "sparse"), (2001, 3)).select("series_id", "year", "month", "claim_count")


@query(
    "series_positions",
    """SELECT series_id, year, month, CAST(row_number() OVER (PARTITION BY series_id ORDER BY year, month) - 1 AS INT) AS idx,
       CAST(count(*) OVER (PARTITION BY series_id) AS INT) AS n FROM counts_s""",
)
def series_positions(spark, sf_dir):
    counts = panel.slot_counts(tables.claims(spark, sf_dir, "sparse"))
    return panel.with_position(counts).select("series_id", "year", "month", "idx", "n")
