"""Queries on forecasts, accuracy and corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog.base import END, LAST_HALF, LAST_YEAR, START, TRAIN_SLOTS, actuals, comparison, history, holdout_errors, month_panel, naive, query
from panelwright.catalog.series import _TTEST, MONTHLY_GUARDS
from panelwright.config import SplitDates
from panelwright.functions import accuracy as acc
from panelwright.operators import accuracy, corrections, forecast, panel, ranking, reports
from panelwright.sources import tables

FORECAST = "SELECT series_id, CAST(h AS INT) AS h, idx, year, month, y_pred, y_pred_lower, y_pred_upper, 'naive_seasonal' AS model FROM fc_s"
BOUNDS = "y_pred y_pred_lower y_pred_upper"


@query("naive_forecast", FORECAST, BOUNDS)
def naive_forecast(spark, sf_dir):
    return naive(month_panel(spark, sf_dir, "sparse"))


@query(
    "naive_forecast_short",
    """SELECT series_id, CAST(h AS INT) AS h, CAST(9 + h AS INT) AS idx, CAST(@start + (9 + h) // 12 AS INT) AS year, CAST((9 + h) % 12 + 1 AS INT) AS month,
       m AS y_pred, m - 1.6449 * sd AS y_pred_lower, m + 1.6449 * sd AS y_pred_upper, 'naive_seasonal' AS model
       FROM (SELECT series_id, avg(y) AS m, stddev_pop(y) AS sd FROM hist_s WHERE idx BETWEEN 2 AND 9 GROUP BY 1) CROSS JOIN range(1, 5) r(h)""",
    BOUNDS,
)
def naive_forecast_short(spark, sf_dir):
    short = history(month_panel(spark, sf_dir, "sparse")).where(F.col("idx") < 10).withColumn("n", F.lit(10))
    return forecast.seasonal_naive(short, horizon=4, season=12, level=0.90)


@query(
    "weekly_naive_forecast",
    """WITH w AS (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, isoyear(manufacturing_date) AS yr,
         week(manufacturing_date) AS wk, CAST(sum(claim_count) AS DOUBLE) AS v FROM claims_d GROUP BY 1, 2, 3),
       g AS (SELECT s.series_id, i, coalesce(w.v, 0.0) AS y FROM (SELECT DISTINCT series_id FROM w) s CROSS JOIN range(402) r(i)
         LEFT JOIN w ON w.series_id = s.series_id AND w.yr = 1994 + r.i // 53 AND w.wk = r.i % 53 + 1),
       b AS (SELECT series_id, stddev_pop(y) AS sd FROM g WHERE i >= 350 GROUP BY 1)
       SELECT g.series_id, CAST(i - 349 AS INT) AS h, CAST(1994 + (i + 52) // 53 AS INT) AS year, CAST((i + 52) % 53 + 1 AS INT) AS week, y AS y_pred, y - 1.96 * sd AS y_pred_lower, y + 1.96 * sd AS y_pred_upper
       FROM g JOIN b USING (series_id) WHERE i BETWEEN 350 AND 375""",
    BOUNDS,
)
def weekly_naive_forecast(spark, sf_dir):
    counts = panel.slot_counts(tables.claims(spark, sf_dir), slot="week")
    weekly = panel.dense_panel(counts, end=(2001, 31), start=(1994, 1), slot="week", min_claims=0)
    ahead = forecast.seasonal_naive(weekly, horizon=26, season=52, slot="week")
    return ahead.drop("idx", "model")


_GUARDED = """hs AS (SELECT series_id, max(y) AS mx, min(y) AS mn, avg(y) AS m, stddev_pop(y) AS sd FROM hist_s GROUP BY 1),
 gf AS (SELECT f.series_id, h, idx, year, month, least(greatest(y_pred, greatest(0, mn * 0.5)), greatest(mx * 1.5, m + 10 * sd)) AS p,
   least(greatest(y_pred_lower, greatest(0, mn * 0.5)), greatest(mx * 1.5, m + 10 * sd)) AS lo,
   least(greatest(y_pred_upper, greatest(0, mn * 0.5)), greatest(mx * 1.5, m + 10 * sd)) AS hi FROM fc_s f JOIN hs USING (series_id))"""


@query(
    "guarded_forecast",
    f"""WITH {_GUARDED} SELECT series_id, CAST(h AS INT) AS h, idx, year, month, p AS y_pred, least(lo, p) AS y_pred_lower,
        greatest(hi, p) AS y_pred_upper, 'naive_seasonal' AS model FROM gf""",
    BOUNDS,
)
def guarded_forecast(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    f = naive(p)
    return forecast.guarded_forecast(f, forecast.history_stats(history(p)), f)


@query(
    "coherent_forecast",
    """SELECT series_id, year, month, greatest(y_pred, 0) AS y_pred, least(greatest(y_pred_lower, 0), greatest(y_pred, 0)) AS y_pred_lower,
       greatest(greatest(y_pred_upper, 0), greatest(y_pred, 0)) AS y_pred_upper FROM fc_s""",
    BOUNDS,
)
def coherent_forecast(spark, sf_dir):
    f = forecast.coherent_bounds(naive(month_panel(spark, sf_dir, "sparse")))
    return f.select("series_id", "year", "month", "y_pred", "y_pred_lower", "y_pred_upper")


@query(
    "proportional_forecast",
    """SELECT series_id, year, month, y_pred, y_pred * 0.9::DOUBLE AS y_pred_lower, y_pred * 1.1::DOUBLE AS y_pred_upper, 'naive-v1' AS model_ver,
       2000 AS train_until FROM fc_d""",
    BOUNDS,
)
def proportional_forecast(spark, sf_dir):
    f = forecast.proportional_bounds(naive(month_panel(spark, sf_dir)), "naive-v1", 2000)
    return f.select("series_id", "year", "month", "y_pred", "y_pred_lower", "y_pred_upper", "model_ver", "train_until")


@query(
    "history_stats",
    """SELECT series_id, count(*) AS n_train_points, avg(y) AS hist_mean, stddev_pop(y) AS hist_std, max(y) AS hist_max, min(y) AS hist_min,
       100.0::DOUBLE * count_if(y > 0) / count(*) AS nonzero_pct, arg_max(y, idx) AS last_value FROM hist_s GROUP BY 1""",
    "hist_mean hist_std nonzero_pct",
)
def history_stats(spark, sf_dir):
    return forecast.history_stats(history(month_panel(spark, sf_dir, "sparse")))


@query(
    "forecast_check",
    """SELECT *, n_missing = 0 AND n_negative = 0 AND n_crossed = 0 AS valid FROM (SELECT count(*) AS n_rows,
       count_if(y_pred IS NULL)::BIGINT AS n_missing, count_if(least(y_pred, y_pred_lower, y_pred_upper) < 0)::BIGINT AS n_negative,
       count_if(y_pred_lower > y_pred OR y_pred > y_pred_upper)::BIGINT AS n_crossed FROM fc_s)""",
)
def forecast_check(spark, sf_dir):
    return forecast.check_forecast(naive(month_panel(spark, sf_dir, "sparse")))


@query(
    "forecast_nonnegative",
    "SELECT series_id, year, month, y_pred FROM fc_s WHERE y_pred >= 0 AND y_pred_lower >= 0 AND y_pred_upper >= 0",
    "y_pred",
)
def forecast_nonnegative(spark, sf_dir):
    kept = accuracy.clip_nonnegative(naive(month_panel(spark, sf_dir, "sparse")), "y_pred", "y_pred_lower", "y_pred_upper")
    return kept.select("series_id", "year", "month", "y_pred")


METRICS = """100 * sum(abs(y - p)) FILTER (y > 0) / nullif(sum(y) FILTER (y > 0), 0) AS wmape,
  100 * avg(CASE WHEN abs(y) + abs(p) > 0 THEN abs(y - p) / ((abs(y) + abs(p)) / 2) END) AS smape,
  100 * avg(p - y) FILTER (y > 0) / nullif(avg(y) FILTER (y > 0), 0) AS bias, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse"""
METRIC_COLS = "wmape smape bias mae rmse"


@query(
    "rolling_cv",
    f"""WITH cv AS (SELECT t.series_id, f AS fold, o AS train_size, t.y, b.y AS p FROM (SELECT unnest([1, 2, 3]) AS f, unnest([@year, @half, @train]) AS o) x
        JOIN panel_s t ON t.idx BETWEEN o AND o + 5 JOIN panel_s b ON b.series_id = t.series_id AND b.idx = t.idx - 12)
        SELECT series_id, fold, train_size, {METRICS}, count(*) AS test_size FROM cv GROUP BY 1, 2, 3""",
    METRIC_COLS,
)
def rolling_cv(spark, sf_dir):
    return forecast.rolling_origin_metrics(month_panel(spark, sf_dir, "sparse"))


@query(
    "rolling_cv_mean",
    f"""WITH cv AS (SELECT t.series_id, f AS fold, o AS train_size, t.y, b.y AS p FROM (SELECT unnest([1, 2, 3]) AS f, unnest([@year, @half, @train]) AS o) x
        JOIN panel_s t ON t.idx BETWEEN o AND o + 5 JOIN panel_s b ON b.series_id = t.series_id AND b.idx = t.idx - 12),
        m AS (SELECT series_id, fold, {METRICS} FROM cv GROUP BY 1, 2)
        SELECT series_id, avg(wmape) AS wmape, avg(smape) AS smape, avg(bias) AS bias, avg(mae) AS mae, avg(rmse) AS rmse FROM m GROUP BY 1""",
    METRIC_COLS,
)
def rolling_cv_mean(spark, sf_dir):
    return forecast.mean_over_folds(forecast.rolling_origin_metrics(month_panel(spark, sf_dir, "sparse")), ("series_id",))


@query(
    "rolling_years",
    f"""WITH f AS (SELECT t.series_id, t.year AS target_year, t.y, b.y AS p FROM panel_d t JOIN panel_d b ON b.series_id = t.series_id
          AND b.idx = t.idx - 12 WHERE t.year IN (2000, 2001))
        SELECT series_id, target_year, {METRICS} FROM f GROUP BY 1, 2""",
    METRIC_COLS,
)
def rolling_years(spark, sf_dir):
    p = month_panel(spark, sf_dir)
    ahead = forecast.seasonal_naive(forecast.rolling_years(p, 2000, 2001), 12, 12, by=("series_id", "target_year"))
    joined = ahead.join(p.select("series_id", "idx", "claim_count"), ["series_id", "idx"])
    return accuracy.metrics_by(joined, "series_id", "target_year")


@query(
    "unit_root",
    """WITH d AS (SELECT series_id, y - lag(y) OVER w AS s, lag(y) OVER w AS l FROM hist_s WINDOW w AS (PARTITION BY series_id ORDER BY idx)),
       r AS (SELECT series_id, count(s) AS m, regr_sxx(s, l) AS sxx, regr_sxy(s, l) AS sxy, regr_syy(s, l) AS syy FROM d GROUP BY 1),
       t AS (SELECT series_id, (sxy / nullif(sxx, 0)) / nullif(sqrt(greatest(syy - sxy / nullif(sxx, 0) * sxy, 0) / (m - 2) / nullif(sxx, 0)), 0) AS t_stat FROM r)
       SELECT series_id, t_stat, CASE WHEN t_stat < -2.86 THEN 0 ELSE 1 END AS d FROM t""",
    "t_stat",
)
def unit_root(spark, sf_dir):
    return forecast.unit_root(history(month_panel(spark, sf_dir, "sparse")))


# --- comparisons ----------------------------------------------------------------------------------


@query(
    "compare_inner",
    "SELECT series_id, year, month, y AS claim_count, y_pred, e AS error, abs(e) AS abs_error FROM cmp_s",
    "y_pred error abs_error",
)
def compare_inner(spark, sf_dir):
    return comparison(spark, sf_dir, "sparse").select("series_id", "year", "month", "claim_count", "y_pred", "error", "abs_error")


@query(
    "compare_left",
    """SELECT a.series_id, a.year, a.month, a.y AS claim_count, f.y_pred, a.y - coalesce(f.y_pred, 0) AS error, abs(a.y - coalesce(f.y_pred, 0)) AS abs_error,
       CASE WHEN a.y > 0 THEN (a.y - coalesce(f.y_pred, 0)) / a.y * 100 ELSE 0.0 END AS pct_error
       FROM act_s a LEFT JOIN (SELECT * FROM fc_s WHERE month <= 3) f USING (series_id, idx)""",
    "y_pred error abs_error pct_error",
)
def compare_left(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    return accuracy.compare_left(actuals(p), naive(p).where(F.col("month") <= 3))


_WEEKS = """wk AS (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, isoyear(manufacturing_date) AS yr, week(manufacturing_date) AS wk,
  CAST(sum(claim_count) AS DOUBLE) AS v FROM claims_d GROUP BY 1, 2, 3),
 wf AS (SELECT series_id, yr + 1 AS yr, wk, v AS p FROM wk WHERE yr < (SELECT max(yr) FROM wk)),
 wa AS (SELECT * FROM wk WHERE yr > (SELECT min(yr) FROM wk)),
 cw AS (SELECT series_id, CAST(yr AS INT) AS year, CAST(wk AS INT) AS week, coalesce(v, 0.0) AS y, coalesce(p, 0.0) AS p
   FROM (SELECT * FROM wa WHERE series_id IN (SELECT series_id FROM wf)) a
   FULL JOIN (SELECT * FROM wf WHERE series_id IN (SELECT series_id FROM wa)) b USING (series_id, yr, wk))"""


def weekly_sides(spark, sf_dir):
    """Weekly counts of every year but the first and, as their forecast, the counts of the same week a year before."""
    counts = panel.slot_counts(tables.claims(spark, sf_dir), slot="week")
    first, last = (counts.agg(f("year").alias("v")).scalar() for f in (F.min, F.max))
    actual = counts.where(F.col("year") > first)
    expected = counts.where(F.col("year") < last).select(
        "series_id", (F.col("year") + 1).alias("year"), "week", F.col("claim_count").alias("y_pred")
    )
    return actual, expected


@query("compare_outer", f"WITH {_WEEKS} SELECT series_id, year, week, y AS claim_count, p AS y_pred FROM cw")
def compare_outer(spark, sf_dir):
    return accuracy.compare_outer(*weekly_sides(spark, sf_dir))


EVALUATION = """100 * avg(abs((y - p) / y)) FILTER (y <> 0) AS mape, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
  1 - sum((y - p) * (y - p)) / nullif(greatest(var_pop(y) * count(*), 0), 0) AS r2, count(*) AS n_points, sum(y) AS total_actual, sum(p) AS total_predicted,
  (sum(p) - sum(y)) / nullif(sum(y), 0) AS bias"""
EVALUATION_COLS = "mape mae rmse r2 total_actual total_predicted bias"


@query("weekly_evaluation", f"WITH {_WEEKS} SELECT series_id, {EVALUATION} FROM cw GROUP BY 1", EVALUATION_COLS)
def weekly_evaluation(spark, sf_dir):
    return accuracy.evaluation(accuracy.compare_outer(*weekly_sides(spark, sf_dir)), "series_id")


@query(
    "weekly_kpi",
    f"""WITH {_WEEKS}, m AS (SELECT series_id, {EVALUATION} FROM cw GROUP BY 1)
        SELECT *, mean_mape / 100 < 0.2 AND mean_abs_bias < 0.05 AS passed FROM
        (SELECT avg(mape) AS mean_mape, avg(abs(bias)) AS mean_abs_bias, count(*) AS n_series FROM m)""",
    "mean_mape mean_abs_bias",
)
def weekly_kpi(spark, sf_dir):
    return accuracy.mean_series_kpi(accuracy.evaluation(accuracy.compare_outer(*weekly_sides(spark, sf_dir)), "series_id"))


_POSITIONAL = """wk AS (SELECT plant || '|' || product_cat2 || '|' || mid_category AS series_id, isoyear(manufacturing_date) AS yr, week(manufacturing_date) AS wk,
  CAST(sum(claim_count) AS DOUBLE) AS v FROM claims_d GROUP BY 1, 2, 3),
 base AS (SELECT series_id || '|' || (yr + 1) AS series_id, row_number() OVER (PARTITION BY series_id, yr ORDER BY wk) AS pos, v AS p FROM wk),
 m AS (SELECT base.series_id, wk.wk AS week, wk.v AS y, base.p FROM wk JOIN base ON base.series_id = wk.series_id || '|' || wk.yr AND base.pos = wk.wk)"""


def positional(spark, sf_dir):
    counts = panel.slot_counts(tables.claims(spark, sf_dir), slot="week")
    of_year = lambda shift: F.concat_ws("|", "series_id", F.col("year") + shift)
    arrays = (
        counts.groupBy(of_year(1).alias("series_id"))
        .agg(F.sort_array(F.collect_list(F.struct("week", "claim_count")))["claim_count"].alias("yhat"))
    )
    return accuracy.match_by_position(counts.select(of_year(0).alias("series_id"), "week", "claim_count"), arrays)


@query("positional_eval", f"WITH {_POSITIONAL} SELECT series_id, {EVALUATION} FROM m GROUP BY 1", EVALUATION_COLS)
def positional_eval(spark, sf_dir):
    return accuracy.evaluation(positional(spark, sf_dir), "series_id")


@query(
    "evaluation_documents",
    f"""WITH {_POSITIONAL} SELECT series_id, split_part(series_id, '|', 1) AS plant, split_part(series_id, '|', 2) AS product_cat2,
        split_part(series_id, '|', 3) AS mid_category, string_agg(CAST(week AS VARCHAR), ',' ORDER BY week) AS weeks,
        string_agg(CAST(CAST(y AS INT) AS VARCHAR), ',' ORDER BY week) AS actual, string_agg(CAST(CAST(p AS INT) AS VARCHAR), ',' ORDER BY week) AS predicted,
        avg(abs(y - p)) AS mae FROM m GROUP BY 1""",
    "mae",
)
def evaluation_documents(spark, sf_dir):
    docs = accuracy.evaluation_documents(positional(spark, sf_dir))
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("int").cast("string")), ",")
    return docs.select(
        "series_id", "plant", "product_cat2", "mid_category", text("weeks_evaluated").alias("weeks"),
        text("actual_values").alias("actual"), text("predicted_values").alias("predicted"), F.col("metrics.mae").alias("mae"),
    )


# --- metrics --------------------------------------------------------------------------------------

_M = "SELECT *, y_pred AS p FROM cmp_{g}"


@query("series_metrics", f"SELECT series_id, {METRICS} FROM ({_M.format(g='s')}) GROUP BY 1", METRIC_COLS)
def series_metrics(spark, sf_dir):
    return accuracy.metrics_by(comparison(spark, sf_dir, "sparse"), "series_id")


@query(
    "metrics_by_group",
    f"""SELECT split_part(series_id, '|', 1) AS plant, month, avg(abs((y - p) / y)) FILTER (y <> 0) AS mape, avg(abs(y - p)) AS mae,
        sqrt(avg((y - p) * (y - p))) AS rmse, (sum(p) - sum(y)) / nullif(sum(y), 0) AS bias, count(*) AS n_observations FROM ({_M.format(g='s')}) GROUP BY 1, 2""",
    "mape mae rmse bias",
)
def metrics_by_group(spark, sf_dir):
    df = comparison(spark, sf_dir, "sparse").withColumn("plant", F.split("series_id", r"\|")[0])
    return accuracy.fraction_metrics_by(df, "plant", "month")


@query(
    "metric_variants",
    f"""SELECT series_id, avg(abs(y - p) / y) FILTER (y > 0) AS mape_positive, 100 * avg(abs(y - p) / (y + 1)) AS mape_plus_one,
        log10(1 + avg(abs(y - p) / greatest(y, 1e-9))) AS log_mape_guarded, avg(y - p) / nullif(avg(y), 0) AS mean_error_bias,
        avg(p - y) / greatest(avg(y), 1e-9) AS guarded_bias FROM ({_M.format(g='d')}) GROUP BY 1""",
    "mape_positive mape_plus_one log_mape_guarded mean_error_bias guarded_bias",
)
def metric_variants(spark, sf_dir):
    y, p = F.col("claim_count"), F.col("y_pred")
    return comparison(spark, sf_dir).groupBy("series_id").agg(
        acc.mape_positive(y, p).alias("mape_positive"),
        acc.mape_plus_one_pct(y, p).alias("mape_plus_one"),
        F.log10(1 + acc.mape_guarded(y, p)).alias("log_mape_guarded"),
        acc.mean_error_bias(y, p).alias("mean_error_bias"),
        acc.guarded_bias(y, p).alias("guarded_bias"),
    )


_SCALE = """sc AS (SELECT series_id, avg(abs(y - b)) AS nm FROM (SELECT series_id, y, lag(y, 12) OVER (PARTITION BY series_id ORDER BY idx) AS b FROM hist_s)
   WHERE b IS NOT NULL GROUP BY 1),
 fm AS (SELECT series_id, avg(abs((y - p) / y)) FILTER (y <> 0) AS mape, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
   (sum(p) - sum(y)) / nullif(sum(y), 0) AS bias, count(*) AS n_observations FROM (SELECT *, y_pred AS p FROM cmp_s) GROUP BY 1),
 ms AS (SELECT fm.*, mae / nullif(nm, 0) AS mase FROM fm LEFT JOIN sc USING (series_id))"""


def with_mase(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    m = accuracy.fraction_metrics_by(accuracy.compare_inner(actuals(p), naive(p)), "series_id")
    return accuracy.with_mase(m, accuracy.naive_scale(history(p), 12))


@query("mase", f"WITH {_SCALE} SELECT * FROM ms", "mape mae rmse bias mase")
def mase(spark, sf_dir):
    return with_mase(spark, sf_dir)


@query(
    "poor_performers",
    f"""WITH {_SCALE} SELECT *, mape / 0.2 * 0.4 + abs(bias) / 0.05 * 0.3 + mase / 1.5 * 0.3 AS priority_score FROM ms
        WHERE mape > 0.2 OR abs(bias) > 0.05 OR mase > 1.5""",
    "mape mae rmse bias mase priority_score",
)
def poor_performers(spark, sf_dir):
    return accuracy.poor_performers(with_mase(spark, sf_dir))


@query(
    "overall_scores",
    """SELECT avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 100 * avg(abs(e) / (y + 1)) AS mape, 100 * sum(abs(e)) / sum(y) AS wmape, avg(-e) AS bias,
       count(*) AS n_records FROM cmp_s""",
    "mae rmse mape wmape bias",
)
def overall_scores(spark, sf_dir):
    return accuracy.overall_scores(comparison(spark, sf_dir, "sparse"))


_RETRAIN = """k AS (SELECT avg(abs(e)) AS mae, 100 * sum(abs(e)) / sum(y) AS wmape FROM cmp_{g}),
 rc AS (SELECT series_id, year, month, y, y_pred, abs(e) / (y + 1) * 100 AS pct FROM cmp_{g}, k WHERE abs(e) > k.mae * 2 OR abs(e) / (y + 1) * 100 > k.wmape * 1.5
   OR -e > y * 0.5 OR -e < -y * 0.5 OR (y >= 10 AND abs(e) / (y + 1) * 100 > 30))"""


@query(
    "retrain_candidates",
    f"WITH {_RETRAIN.format(g='d')} SELECT series_id, year, month, y AS claim_count, y_pred, pct AS abs_pct_error FROM rc",
    "y_pred abs_pct_error",
)
def retrain_candidates(spark, sf_dir):
    rows = accuracy.retrain_candidates(comparison(spark, sf_dir))
    return rows.select("series_id", "year", "month", "claim_count", "y_pred", "abs_pct_error")


KPI = """avg(abs(e) / y) FILTER (y > 0) AS mape, CASE WHEN avg(y) > 0 THEN avg(e) / avg(y) END AS bias, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
  count(*) AS n_records, count(DISTINCT series_id) AS n_series"""


@query(
    "kpi_gate",
    f"SELECT *, coalesce(mape < 0.2 AND abs(bias) < 0.05, false) AS passed FROM (SELECT {KPI} FROM cmp_d)",
    "mape bias mae rmse",
)
def kpi_gate(spark, sf_dir):
    return accuracy.kpi(comparison(spark, sf_dir))


@query(
    "kpi_by_month",
    f"SELECT *, coalesce(mape < 0.2 AND abs(bias) < 0.05, false) AS passed FROM (SELECT year, month, {KPI} FROM cmp_s GROUP BY 1, 2)",
    "mape bias mae rmse",
)
def kpi_by_month(spark, sf_dir):
    return accuracy.kpi(comparison(spark, sf_dir, "sparse"), by=("year", "month"))


@query(
    "monthly_totals",
    """SELECT year, month, count(*) AS n_records, count(DISTINCT series_id) AS n_series, avg(e) AS mean_error, avg(abs(e)) AS mae FROM cmp_s GROUP BY 1, 2""",
    "mean_error mae",
)
def monthly_totals(spark, sf_dir):
    return accuracy.monthly_totals(comparison(spark, sf_dir, "sparse"))


@query(
    "year_metrics",
    """SELECT series_id, log10(1 + avg(abs(e) / greatest(y, 1e-9))) AS log_mape, avg(abs(e)) / coalesce(nullif(avg(abs(y - b)), 0), 1) AS mase,
       avg(-e) / greatest(avg(y), 1e-9) AS bias, sqrt(avg(e * e)) AS rmse
       FROM (SELECT *, lag(y) OVER (PARTITION BY series_id ORDER BY idx) AS b FROM cmp_d) GROUP BY 1""",
    "log_mape mase bias rmse",
)
def year_metrics(spark, sf_dir):
    return accuracy.year_metrics(comparison(spark, sf_dir)).withColumn("mape", F.log10(1 + F.col("mape"))).withColumnRenamed("mape", "log_mape")


@query(
    "reliability_score",
    """WITH s AS (SELECT *, avg(y) OVER w AS m, stddev_pop(y) OVER w AS sd, max(y) OVER w * 1.5 AS hi_c, greatest(0, min(y) OVER w * 0.5) AS lo_c
         FROM cmp_d WINDOW w AS (PARTITION BY series_id)),
       c AS (SELECT *, least(greatest(y_pred, lo_c), hi_c) AS p, least(greatest(y_pred_lower, lo_c), hi_c) AS lo, least(greatest(y_pred_upper, lo_c), hi_c) AS hi FROM s),
       g AS (SELECT series_id, max(m) AS m, max(sd) AS sd, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, sum((y - p) * (y - p)) AS rss,
         sum((y - m) * (y - m)) AS tss, avg(hi - lo) AS w, avg(CASE WHEN y >= lo AND y <= hi THEN 1.0::DOUBLE ELSE 0 END) AS cov, avg(p) AS pm, stddev_pop(p) AS psd FROM c GROUP BY 1),
       x AS (SELECT series_id, greatest(0, 100 * (1 - mae / CASE WHEN m + sd > 0 THEN m + sd ELSE 1 END)) AS mae_score,
         greatest(0, 100 * (1 - rmse / CASE WHEN m + 2 * sd > 0 THEN m + 2 * sd ELSE 1 END)) AS rmse_score,
         CASE WHEN w > 0 THEN 100 * exp(-abs(log2(w / greatest(1e-6, 2 * sd)))) ELSE 0.0 END AS width_score, 100 * exp(-abs(0.95 - cov)) AS interval_score,
         CASE WHEN tss <> 0 THEN 1 - rss / tss ELSE 0.0 END AS r2,
         100 * exp(-abs(log2((psd / (pm + 1e-10)) / (sd / (m + 1e-10) + 1e-10) + 1e-10))) AS volatility_score FROM g)
       SELECT *, mae_score * 0.25 + rmse_score * 0.25 + width_score * 0.2 + interval_score * 0.2 + volatility_score * 0.1 AS reliability_score FROM x""",
    "mae_score rmse_score width_score interval_score r2 volatility_score reliability_score",
)
def reliability_score(spark, sf_dir):
    return accuracy.reliability(comparison(spark, sf_dir))


_RESIDUALS = """r AS (SELECT t.series_id, t.idx, t.y - b.y AS e FROM hist_d t JOIN hist_d b ON b.series_id = t.series_id AND b.idx = t.idx - 12),
 m AS (SELECT series_id, avg(e) AS mu, stddev_samp(e) AS sd, count(*) AS n, stddev_pop(e) AS sp FROM r GROUP BY 1),
 c AS (SELECT r.series_id, idx, e - mu AS c FROM r JOIN m USING (series_id)),
 a AS (SELECT x.series_id, y.idx - x.idx AS k, sum(x.c * y.c) AS s FROM c x JOIN c y ON y.series_id = x.series_id AND y.idx - x.idx BETWEEN 0 AND 10 GROUP BY 1, 2),
 q AS (SELECT a.series_id, m.n * (m.n + 2) * sum(pow(a.s / z.s, 2) / (m.n - a.k)) AS q FROM a JOIN a z ON z.series_id = a.series_id AND z.k = 0
   JOIN m ON m.series_id = a.series_id WHERE a.k > 0 GROUP BY a.series_id, m.n),
 h AS (SELECT c.series_id, avg(pow(c.c / sp, 3)) AS sk, avg(pow(c.c / sp, 4)) - 3 AS ku FROM c JOIN m ON m.series_id = c.series_id GROUP BY 1),
 d AS (SELECT m.series_id, m.n AS n_residuals, exp(-q / 2) * (1 + q / 2 + pow(q / 2, 2) / 2 + pow(q / 2, 3) / 6 + pow(q / 2, 4) / 24) AS ljungbox_pvalue,
   exp(-(m.n / 6.0::DOUBLE * (sk * sk + ku * ku / 4)) / 2) AS normality_pvalue, mu AS residual_mean, sd AS residual_std, sk AS residual_skew, ku AS residual_kurtosis
   FROM m JOIN q USING (series_id) JOIN h USING (series_id)),
 diag AS (SELECT *, ljungbox_pvalue > 0.05 AS ljungbox_pass, normality_pvalue > 0.05 AS normality_pass FROM d)"""


def residuals(spark, sf_dir):
    """Errors of the seasonal naive forecast inside the history (24 per series)."""
    h = history(month_panel(spark, sf_dir))
    expected = h.select("series_id", (F.col("idx") + 12).alias("idx"), F.col("claim_count").alias("y_pred"))
    return h.join(expected, ["series_id", "idx"]).withColumn("error", F.col("claim_count") - F.col("y_pred"))


@query(
    "residual_diagnostics",
    f"WITH {_RESIDUALS} SELECT * FROM diag",
    "ljungbox_pvalue normality_pvalue residual_mean residual_std residual_skew residual_kurtosis",
)
def residual_diagnostics(spark, sf_dir):
    return accuracy.residual_diagnostics(residuals(spark, sf_dir))


@query(
    "residual_pass_rates",
    f"""WITH {_RESIDUALS} SELECT count(*) AS n_series, avg(CASE WHEN ljungbox_pass THEN 1.0::DOUBLE ELSE 0 END) AS ljungbox_pass_rate,
        avg(CASE WHEN normality_pass THEN 1.0::DOUBLE ELSE 0 END) AS normality_pass_rate, count_if(NOT ljungbox_pass)::BIGINT AS n_autocorrelated FROM diag""",
    "ljungbox_pass_rate normality_pass_rate",
)
def residual_pass_rates(spark, sf_dir):
    return accuracy.residual_pass_rates(accuracy.residual_diagnostics(residuals(spark, sf_dir)))


@query(
    "residual_failures",
    f"""WITH {_RESIDUALS} SELECT series_id, concat_ws(',', CASE WHEN NOT ljungbox_pass THEN 'ljungbox' END, CASE WHEN NOT normality_pass THEN 'normality' END) AS failed,
        ljungbox_pvalue, normality_pvalue FROM diag WHERE NOT (coalesce(ljungbox_pass, true) AND coalesce(normality_pass, true))""",
    "ljungbox_pvalue normality_pvalue",
)
def residual_failures(spark, sf_dir):
    return accuracy.failing_series(accuracy.residual_diagnostics(residuals(spark, sf_dir)))


# --- corrections ----------------------------------------------------------------------------------

CORRECTED = "SELECT series_id, year, month, y AS claim_count, p AS y_pred, y - p AS error, abs(y - p) AS abs_error FROM x"
CORRECTED_COLS = "y_pred error abs_error"
KEEP = ["series_id", "year", "month", "claim_count", "y_pred", "error", "abs_error"]


@query(
    "bias_map_position",
    f"""WITH b AS (SELECT split_part(series_id, '|', 1) AS plant, month, avg(e) AS bias FROM cmp_s GROUP BY 1, 2),
        x AS (SELECT c.*, y_pred + coalesce(bias, 0) AS p FROM cmp_s c LEFT JOIN b ON b.plant = split_part(c.series_id, '|', 1) AND b.month = c.month) {CORRECTED}""",
    CORRECTED_COLS,
)
def bias_map_position(spark, sf_dir):
    df = comparison(spark, sf_dir, "sparse").withColumn("plant", F.split("series_id", r"\|")[0])
    bias = corrections.position_bias(df, by=("plant",))
    return corrections.apply_position_bias(df, bias, by=("plant",)).select(*KEEP)


@query(
    "bias_map_week_month",
    f"""WITH {_WEEKS}, b AS (SELECT series_id, CAST(least(floor((week - 1) / 4.3::DOUBLE) + 1, 12) AS INT) AS pos, avg(y - p) AS bias FROM cw GROUP BY 1, 2),
        x AS (SELECT cw.series_id, cw.year, week, y, p + bias AS q FROM cw JOIN b ON b.series_id = cw.series_id AND b.pos = least(floor((week - 1) / 4.3::DOUBLE) + 1, 12))
        SELECT series_id, year, week, y AS claim_count, q AS y_pred, y - q AS error, abs(y - q) AS abs_error FROM x""",
    CORRECTED_COLS,
)
def bias_map_week_month(spark, sf_dir):
    df = accuracy.compare_outer(*weekly_sides(spark, sf_dir))
    return corrections.apply_position_bias(df, corrections.position_bias(df, "week_month"), "week_month")


_BY_SERIES = "x AS (SELECT *, greatest(y_pred + avg(e) OVER (PARTITION BY series_id), 0) AS p FROM cmp_{g})"


@query("bias_map_series", f"WITH {_BY_SERIES.format(g='s')} {CORRECTED}", CORRECTED_COLS)
def bias_map_series(spark, sf_dir):
    return corrections.apply_series_bias(comparison(spark, sf_dir, "sparse")).select(*KEEP)


@query(
    "bias_map_table",
    "SELECT series_id, avg(e) AS avg_bias, count(*) AS n_obs, avg(e) AS bias_correction FROM cmp_s GROUP BY 1",
    "avg_bias bias_correction",
)
def bias_map_table(spark, sf_dir):
    return corrections.series_bias(comparison(spark, sf_dir, "sparse"))


@query(
    "bias_improvement",
    f"""WITH {_BY_SERIES.format(g='s')} SELECT avg(abs(e)) AS before_mae, avg(abs(y - p)) AS after_mae,
        (avg(abs(e)) - avg(abs(y - p))) / avg(abs(e)) * 100 AS improvement_pct FROM x""",
    "before_mae after_mae improvement_pct",
)
def bias_improvement(spark, sf_dir):
    before = comparison(spark, sf_dir, "sparse")
    return corrections.improvement(before, corrections.apply_series_bias(before))


@query("bias_intercepts", "SELECT series_id, avg(e) AS bias_intercept FROM cmp_s GROUP BY 1", "bias_intercept")
def bias_intercepts(spark, sf_dir):
    return corrections.bias_intercepts(comparison(spark, sf_dir, "sparse"))


_FACTORS = """sm AS (SELECT series_id, {pos} AS pos, avg(y) AS m FROM hist_{g} WHERE idx >= @train - 24 GROUP BY 1, 2),
 sf AS (SELECT series_id, pos, CASE WHEN avg(m) OVER (PARTITION BY series_id) > 0 THEN m / avg(m) OVER (PARTITION BY series_id) ELSE 1 END AS f FROM sm)"""


@query(
    "seasonal_recalibration",
    f"""WITH {_FACTORS.format(g='s', pos='month - 1')}, x AS (SELECT c.*, y_pred * coalesce(f, 1) AS p FROM cmp_s c LEFT JOIN sf ON sf.series_id = c.series_id
        AND pos = month - 1) {CORRECTED}""",
    CORRECTED_COLS,
)
def seasonal_recalibration(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    df = accuracy.compare_inner(actuals(p), naive(p))
    return corrections.apply_seasonal_factors(df, corrections.seasonal_factors(history(p))).select(*KEEP)


_COMPONENT = """tr AS (SELECT series_id, idx - @train + 24 AS i, y - CASE WHEN count(*) OVER w = 13
    THEN (sum(y) OVER w - (first_value(y) OVER w + last_value(y) OVER w) / 2) / 12 END AS d
  FROM hist_{g} WHERE idx >= @train - 24 WINDOW w AS (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
 cm AS (SELECT series_id, i % 12 AS pos, avg(d) AS m FROM tr GROUP BY 1, 2),
 co AS (SELECT series_id, pos, m - avg(m) OVER (PARTITION BY series_id) AS s FROM cm
   WHERE series_id IN (SELECT series_id FROM hist_{g} WHERE idx >= @train - 24 GROUP BY 1 HAVING stddev_pop(y) > 0))"""


@query(
    "seasonal_shift",
    f"""WITH {_COMPONENT.format(g='s')}, x AS (SELECT c.*, CASE WHEN s IS NULL THEN y_pred ELSE greatest(y_pred + 0.5 * s, 0) END AS p
        FROM cmp_s c LEFT JOIN co ON co.series_id = c.series_id AND pos = (idx - @train) % 12) {CORRECTED}""",
    CORRECTED_COLS,
)
def seasonal_shift(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    df = accuracy.compare_inner(actuals(p), naive(p))
    return corrections.apply_seasonal_shift(df, history(p), mode="per_position").select(*KEEP)


@query(
    "staged_correction",
    f"""WITH g0 AS (SELECT coalesce(avg(abs(e) / y) FILTER (y > 0) < 0.2 AND abs(avg(e) / avg(y)) < 0.05, false) AS ok FROM cmp_s),
        {_BY_SERIES.format(g='s').replace('x AS', 's1 AS')},
        g1 AS (SELECT g0.ok OR coalesce(avg(abs(y - p) / y) FILTER (y > 0) < 0.2 AND abs(avg(y - p) / avg(y)) < 0.05, false) AS ok1, g0.ok AS ok0 FROM s1, g0 GROUP BY g0.ok),
        {_COMPONENT.format(g='s')}, sh AS (SELECT series_id, avg(s) * 0.5 AS s FROM co GROUP BY 1),
        x AS (SELECT s1.series_id, s1.year, s1.month, s1.y, CASE WHEN ok0 THEN s1.y_pred WHEN ok1 OR s IS NULL THEN s1.p ELSE greatest(s1.p + s, 0) END AS p
              FROM s1 CROSS JOIN g1 LEFT JOIN sh ON sh.series_id = s1.series_id) {CORRECTED}""",
    CORRECTED_COLS,
)
def staged_correction(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    df = accuracy.compare_inner(actuals(p), naive(p))
    corrected, _ = corrections.staged_correction(df, history(p), stages=("bias", "seasonal"))
    return corrected.select(*KEEP)


@query(
    "staged_correction_trail",
    f"""WITH {_BY_SERIES.format(g='s').replace('x AS', 's1 AS')}, {_COMPONENT.format(g='s')},
        sh AS (SELECT series_id, avg(s) * 0.5 AS s FROM co GROUP BY 1),
        st AS (SELECT 0 AS step, 'start' AS stage, series_id, y, y_pred AS p FROM cmp_s UNION ALL SELECT 1, 'bias', series_id, y, p FROM s1
          UNION ALL SELECT 2, 'seasonal', s1.series_id, y, CASE WHEN s IS NULL THEN p ELSE greatest(p + s, 0) END
          FROM s1 LEFT JOIN sh ON sh.series_id = s1.series_id),
        k AS (SELECT step, stage, avg(abs(y - p) / y) FILTER (y > 0) AS mape, avg(y - p) / avg(y) AS bias, avg(abs(y - p)) AS mae,
          sqrt(avg((y - p) * (y - p))) AS rmse, count(*) AS n_records, count(DISTINCT series_id) AS n_series FROM st GROUP BY 1, 2),
        r AS (SELECT *, coalesce(mape < 0.2 AND abs(bias) < 0.05, false) AS passed FROM k)
        SELECT *, step <= coalesce((SELECT min(step) FROM r WHERE passed), 2) AS applied FROM r""",
    "mape bias mae rmse",
)
def staged_correction_trail(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    stages = ("bias", "seasonal")
    staged = corrections.staged_columns(accuracy.compare_inner(actuals(p), naive(p)), history(p), stages)
    return corrections.stage_trail(staged, stages)


_CONDITIONAL = f"""fl AS (SELECT series_id, count_if(y = 0) / @train::DOUBLE >= 0.8 AS sparse FROM hist_d GROUP BY 1),
 mp AS (SELECT series_id, avg(abs(e) / greatest(y, 1e-9)) AS m FROM cmp_d GROUP BY 1),
 b AS (SELECT series_id, month, avg(e) AS bias FROM cmp_d GROUP BY 1, 2), {_FACTORS.format(g='d', pos='(idx - @train + 24) % 12')},
 x AS (SELECT c.series_id, c.year, c.month, y, y_pred AS y_pred_original, m > 0.1 AND NOT sparse AS bias_adj_applied, m > 0.2 AND NOT sparse AS seasonal_recal_applied,
   (y_pred + CASE WHEN m > 0.1 AND NOT sparse THEN bias ELSE 0 END) * CASE WHEN m > 0.2 AND NOT sparse THEN coalesce(f, 1) ELSE 1 END AS p
   FROM cmp_d c JOIN fl USING (series_id) JOIN mp USING (series_id) JOIN b ON b.series_id = c.series_id AND b.month = c.month
   LEFT JOIN sf ON sf.series_id = c.series_id AND sf.pos = c.idx - @train)"""


@query(
    "conditional_correction",
    f"""WITH {_CONDITIONAL}
        SELECT series_id, year, month, y AS claim_count, p AS y_pred, y_pred_original, bias_adj_applied, seasonal_recal_applied FROM x""",
    "y_pred y_pred_original",
)
def conditional_correction(spark, sf_dir):
    p = month_panel(spark, sf_dir)
    df = accuracy.compare_inner(actuals(p), naive(p))
    out = corrections.conditional_correction(df, history(p), rules=MONTHLY_GUARDS)
    return out.select("series_id", "year", "month", "claim_count", "y_pred", "y_pred_original", "bias_adj_applied", "seasonal_recal_applied")


@query(
    "correction_summary",
    f"""WITH {_CONDITIONAL}, {_TTEST}, cp AS (SELECT series_id, count_if(cp)::BIGINT AS n_changepoints FROM f GROUP BY 1),
        nm AS (SELECT series_id, avg(abs(y - b)) AS nm FROM (SELECT series_id, y, lag(y, 12) OVER (PARTITION BY series_id ORDER BY idx) AS b FROM hist_d) WHERE b IS NOT NULL GROUP BY 1),
        s AS (SELECT series_id, log10(1 + avg(abs(y - y_pred_original) / greatest(y, 1e-9))) AS log_mape_original, avg(abs((y - p) / y)) FILTER (y <> 0) AS mape_adjusted,
          avg(y_pred_original - y) / greatest(avg(y), 1e-9) AS bias_original, (sum(p) - sum(y)) / nullif(sum(y), 0) AS bias_adjusted, sqrt(avg((y - p) * (y - p))) AS rmse,
          count(*) AS n_points, avg(y - y_pred_original) AS bias_intercept, bool_or(bias_adj_applied) AS bias_adj_applied, bool_or(seasonal_recal_applied) AS seasonal_recal_applied,
          avg(abs(y - p)) AS mae FROM x GROUP BY 1)
        SELECT s.* EXCLUDE (mae), mae / nullif(nm, 0) AS mase, n_changepoints FROM s JOIN cp USING (series_id) JOIN nm USING (series_id)""",
    "log_mape_original mape_adjusted bias_original bias_adjusted rmse bias_intercept mase",
)
def correction_summary(spark, sf_dir):
    p = month_panel(spark, sf_dir)
    df = accuracy.compare_inner(actuals(p), naive(p))
    h = history(p)
    out = corrections.correction_summary(corrections.conditional_correction(df, h, rules=MONTHLY_GUARDS), h)
    return out.withColumn("mape_original", F.log10(1 + F.col("mape_original"))).withColumnRenamed("mape_original", "log_mape_original")


@query(
    "stable_correction",
    f"""WITH {_TTEST}, st AS (SELECT a.series_id, a.idx FROM f a WHERE NOT EXISTS
          (SELECT 1 FROM f b WHERE b.cp AND b.series_id = a.series_id AND a.idx < b.idx + 5 AND a.idx >= b.idx - 5)),
        ok AS (SELECT f.series_id FROM f GROUP BY 1 HAVING NOT bool_or(cp) OR (SELECT count(*) FROM st WHERE st.series_id = f.series_id) > 10),
        fb AS (SELECT t.series_id, t.month, avg(t.y - b.y) AS bias FROM hist_d t JOIN hist_d b ON b.series_id = t.series_id AND b.idx = t.idx - 12
          JOIN st ON st.series_id = t.series_id AND st.idx = t.idx WHERE t.series_id IN (SELECT series_id FROM ok) GROUP BY 1, 2),
        {_FACTORS.format(g='d', pos='month - 1')},
        x AS (SELECT c.series_id, c.year, c.month, c.y, (c.y_pred + coalesce(bias, 0)) * coalesce(sf.f, 1) AS p FROM cmp_d c
          LEFT JOIN fb ON fb.series_id = c.series_id AND fb.month = c.month LEFT JOIN sf ON sf.series_id = c.series_id AND sf.pos = c.month - 1) {CORRECTED}""",
    CORRECTED_COLS,
)
def stable_correction(spark, sf_dir):
    p = month_panel(spark, sf_dir)
    h = history(p)
    fitted = h.join(
        h.select("series_id", (F.col("idx") + 12).alias("idx"), F.col("claim_count").alias("y_pred")), ["series_id", "idx"]
    )
    return corrections.stable_correction(fitted, accuracy.compare_inner(actuals(p), naive(p)), h).select(*KEEP)


@query(
    "worst_series",
    """SELECT series_id, mape, n_obs FROM (SELECT *, row_number() OVER (ORDER BY mape DESC, series_id) AS r, count(*) OVER () AS c FROM
       (SELECT series_id, avg(abs(e) / y) FILTER (y > 0) AS mape, count(*) AS n_obs FROM cmp_s GROUP BY 1) WHERE mape IS NOT NULL)
       WHERE r <= least(10, CASE WHEN floor(c * 0.1) < 1 THEN 5 ELSE floor(c * 0.1) END)""",
    "mape",
)
def worst_series(spark, sf_dir):
    return corrections.worst_series(comparison(spark, sf_dir, "sparse"), min_obs=6)


# --- top lists and reports ------------------------------------------------------------------------


@query(
    "top_errors",
    """SELECT series_id, year, month, y AS claim_count, y_pred, e AS error, abs(e) AS abs_error FROM cmp_s
       ORDER BY abs(e) DESC, series_id, month LIMIT 20""",
    CORRECTED_COLS,
)
def top_errors(spark, sf_dir):
    order = [F.col("abs_error").desc(), F.col("series_id"), F.col("month")]
    return ranking.top(comparison(spark, sf_dir, "sparse"), 20, order).select(*KEEP)


@query(
    "best_and_worst",
    """WITH m AS (SELECT series_id, 100 * avg(abs(e / y)) FILTER (y <> 0) AS mape FROM cmp_s GROUP BY 1)
       (SELECT 'best' AS side, series_id, mape FROM m WHERE mape IS NOT NULL ORDER BY mape, series_id LIMIT 5) UNION ALL
       (SELECT 'worst', series_id, mape FROM m WHERE mape IS NOT NULL ORDER BY mape DESC, series_id LIMIT 5)""",
    "mape",
)
def best_and_worst(spark, sf_dir):
    m = accuracy.evaluation(comparison(spark, sf_dir, "sparse"), "series_id").where(F.col("mape").isNotNull()).select("series_id", "mape")
    best = ranking.top(m, 5, [F.col("mape"), F.col("series_id")]).withColumn("side", F.lit("best"))
    worst = ranking.top(m, 5, [F.col("mape").desc(), F.col("series_id")]).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


@query(
    "top_series",
    "SELECT series_id, sum(y) AS total_claims, true AS viable FROM panel_s GROUP BY 1 ORDER BY total_claims DESC, series_id LIMIT 10",
)
def top_series(spark, sf_dir):
    totals = panel.viable_series(month_panel(spark, sf_dir, "sparse"), 10)
    return ranking.top(totals, 10, [F.col("total_claims").desc(), F.col("series_id")])


@query(
    "error_histogram",
    """WITH s AS (SELECT min(e) AS lo, (max(e) - min(e)) / 50 AS w FROM cmp_s),
       b AS (SELECT CAST(least(floor(coalesce((e - lo) / nullif(w, 0), 0)), 49) AS INT) AS bin FROM cmp_s, s)
       SELECT bin, lo + bin * w AS from_value, count(*) AS n FROM b, s GROUP BY bin, lo, w""",
    "from_value",
)
def error_histogram(spark, sf_dir):
    return reports.histogram(comparison(spark, sf_dir, "sparse"), "error")


_LEVELS = """lv AS (SELECT *, {w} AS wmape_level FROM (SELECT series_id, {metrics} FROM ({m}) GROUP BY 1))""".format(
    w="CASE WHEN wmape IS NULL THEN 'UNKNOWN' WHEN wmape < 20 THEN 'EXCELLENT' WHEN wmape < 50 THEN 'GOOD' WHEN wmape < 100 THEN 'FAIR' ELSE 'POOR' END",
    metrics=METRICS,
    m=_M.format(g="s"),
)


def leveled(spark, sf_dir):
    from panelwright.functions import labels

    m = accuracy.metrics_by(comparison(spark, sf_dir, "sparse"), "series_id")
    return m.withColumn("wmape_level", labels.performance_level("wmape", F.col("wmape")))


@query(
    "kpi_summary",
    f"""WITH {_LEVELS} SELECT count(*) AS n_series, avg(wmape) AS wmape_mean, quantile_cont(wmape, 0.5) AS wmape_median, avg(smape) AS smape_mean,
        quantile_cont(smape, 0.5) AS smape_median, avg(bias) AS bias_mean, quantile_cont(bias, 0.5) AS bias_median, avg(mae) AS mae_mean,
        count_if(wmape_level = 'EXCELLENT')::BIGINT AS wmape_excellent, count_if(wmape_level = 'GOOD')::BIGINT AS wmape_good,
        count_if(wmape_level = 'FAIR')::BIGINT AS wmape_fair, count_if(wmape_level = 'POOR')::BIGINT AS wmape_poor,
        count_if(wmape_level = 'UNKNOWN')::BIGINT AS wmape_unknown FROM lv""",
    "wmape_mean wmape_median smape_mean smape_median bias_mean bias_median mae_mean",
)
def kpi_summary(spark, sf_dir):
    return reports.kpi_summary(leveled(spark, sf_dir))


@query(
    "level_share",
    f"WITH {_LEVELS} SELECT wmape_level, count(*) AS n, CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct FROM lv GROUP BY 1",
    "pct",
)
def level_share(spark, sf_dir):
    return reports.share_of(leveled(spark, sf_dir), "wmape_level")


def mixed_models(spark, sf_dir):
    """Forecast with two model tags: a fallback for series that are mostly zero."""
    p = month_panel(spark, sf_dir, "sparse")
    stats = forecast.history_stats(history(p)).select("series_id", "nonzero_pct")
    tag = F.when(F.col("nonzero_pct") < 30, "fallback_naive").otherwise("seasonal")
    return naive(p).join(stats, "series_id").withColumn("model", tag)


_MODELS = """mm AS (SELECT f.*, CASE WHEN nz < 30 THEN 'fallback_naive' ELSE 'seasonal' END AS model FROM fc_s f
  JOIN (SELECT series_id, 100.0::DOUBLE * count_if(y > 0) / count(*) AS nz FROM hist_s GROUP BY 1) USING (series_id))"""


@query(
    "model_share",
    f"WITH {_MODELS} SELECT model, count(*) AS n, CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct FROM mm GROUP BY 1",
    "pct",
)
def model_share(spark, sf_dir):
    return reports.share_of(mixed_models(spark, sf_dir), "model")


@query(
    "fallback_rate",
    f"""WITH {_MODELS} SELECT count(*) AS n_series, count_if(model = 'fallback_naive')::BIGINT AS n_fallback,
        CAST(count_if(model = 'fallback_naive') AS DOUBLE) * 100 / count(*) AS fallback_pct FROM (SELECT DISTINCT series_id, model FROM mm)""",
    "fallback_pct",
)
def fallback_rate(spark, sf_dir):
    return reports.fallback_rate(mixed_models(spark, sf_dir))


@query(
    "metrics_by_model",
    f"""WITH {_MODELS}, x AS (SELECT a.series_id, mm.model, a.y, mm.y_pred AS p FROM act_s a JOIN mm USING (series_id, idx)),
        m AS (SELECT series_id, model, {METRICS} FROM x GROUP BY 1, 2)
        SELECT model, count(*) AS n_series, avg(wmape) AS wmape, avg(smape) AS smape, avg(bias) AS bias, avg(mae) AS mae, avg(rmse) AS rmse FROM m GROUP BY 1""",
    METRIC_COLS,
)
def metrics_by_model(spark, sf_dir):
    df = accuracy.compare_inner(actuals(month_panel(spark, sf_dir, "sparse")), mixed_models(spark, sf_dir))
    return reports.metrics_by_model(accuracy.metrics_by(df, "series_id", "model"))


_HISTORY = f"""{_RETRAIN.format(g='s')}, mh AS (SELECT year, month, count(DISTINCT series_id) AS n_series, avg(abs(e)) AS mae, 100 * sum(abs(e)) / sum(y) AS wmape,
  CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period FROM cmp_s GROUP BY 1, 2),
 mr AS (SELECT mh.*, coalesce(k, 0) AS n_retrain FROM mh LEFT JOIN (SELECT year, month, count(DISTINCT series_id) AS k FROM rc GROUP BY 1, 2) USING (year, month))"""


@query("month_history", f"WITH {_HISTORY} SELECT * FROM mr", "mae wmape")
def month_history(spark, sf_dir):
    df = comparison(spark, sf_dir, "sparse")
    return reports.month_history(df, accuracy.retrain_candidates(df))


@query(
    "month_changes",
    f"""WITH {_HISTORY} SELECT period, wmape, mae, n_retrain, wmape - lag(wmape) OVER w AS wmape_change, mae - lag(mae) OVER w AS mae_change,
        n_retrain - lag(n_retrain) OVER w AS n_retrain_change FROM mr WINDOW w AS (ORDER BY year, month)""",
    "wmape mae wmape_change mae_change",
)
def month_changes(spark, sf_dir):
    df = comparison(spark, sf_dir, "sparse")
    return reports.month_changes(reports.month_history(df, accuracy.retrain_candidates(df)))


COVERED = range(START[0], END[0] + 1)
_SHARE = "CASE WHEN y{y} >= n * 0.8 THEN 'full' WHEN y{y} >= n * 0.4 THEN 'partial' ELSE 'missing' END AS s{y}"


@query(
    "coverage_pivot",
    f"""WITH t AS (SELECT count(DISTINCT series_id) AS n FROM counts_s),
       c AS (SELECT month, {', '.join(f'count(DISTINCT series_id) FILTER (year = {y}) AS y{y}' for y in COVERED)} FROM counts_s GROUP BY 1)
       SELECT c.*, {', '.join(_SHARE.format(y=y) for y in COVERED)} FROM c, t""",
)
def coverage_pivot(spark, sf_dir):
    counts = panel.slot_counts(tables.claims(spark, sf_dir, "sparse"))
    return reports.coverage(counts, list(COVERED))


_RISK = """rm AS (SELECT series_id, '2001-' || lpad(CAST(month AS VARCHAR), 2, '0') AS risk_month, y_pred AS risk_value FROM
  (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY y_pred DESC, idx) AS r FROM fc_s) WHERE r = 1)"""


@query(
    "forecast_card",
    f"""WITH {_RISK}, p AS (SELECT series_id, avg(y) AS past_mean FROM hist_s WHERE idx >= @year GROUP BY 1),
        f AS (SELECT series_id, avg(y_pred) AS forecast_mean, sum(y_pred) AS forecast_sum FROM fc_s GROUP BY 1)
        SELECT f.*, past_mean, risk_month, risk_value FROM f JOIN p USING (series_id) JOIN rm USING (series_id)""",
    "forecast_mean forecast_sum past_mean risk_value",
)
def forecast_card(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    return reports.forecast_card(history(p), naive(p))


@query(
    "forecast_statistics",
    """SELECT count(*) AS n_rows, count(DISTINCT series_id) AS n_series, '2001-03' AS first_month, '2001-08' AS last_month, avg(y_pred) AS mean_prediction,
       sum(y_pred) AS total_prediction FROM fc_s""",
    "mean_prediction total_prediction",
)
def forecast_statistics(spark, sf_dir):
    return reports.forecast_statistics(naive(month_panel(spark, sf_dir, "sparse")))


@query("holdout_errors", "SELECT series_id, wmape FROM holdout_s", "wmape")
def holdout(spark, sf_dir):
    return holdout_errors(month_panel(spark, sf_dir, "sparse")).select("series_id", "wmape")




@query(
    "baseline_table",
    f"""WITH {_MODELS}, x AS (SELECT a.series_id, mm.model, a.y, mm.y_pred AS p FROM act_s a JOIN mm USING (series_id, idx))
        SELECT series_id, model, {METRICS} FROM x GROUP BY 1, 2""",
    METRIC_COLS,
)
def baseline_table(spark, sf_dir):
    df = accuracy.compare_inner(actuals(month_panel(spark, sf_dir, "sparse")), mixed_models(spark, sf_dir))
    return accuracy.metrics_by(df, "series_id", "model")


@query(
    "top_models",
    f"""SELECT * FROM (SELECT series_id, {METRICS} FROM ({_M.format(g='s')}) GROUP BY 1) WHERE wmape IS NOT NULL ORDER BY round(wmape, 9), series_id LIMIT 10""",
    METRIC_COLS,
)
def top_models(spark, sf_dir):
    return reports.best_models(accuracy.metrics_by(comparison(spark, sf_dir, "sparse"), "series_id"))


@query(
    "date_split",
    """SELECT 'train' AS part, count(*) AS n_rows, CAST(sum(claim_count) AS BIGINT) AS claims FROM claims_d WHERE manufacturing_date BETWEEN '1995-01-01' AND '2001-02-28'
       UNION ALL SELECT 'test', count(*), CAST(sum(claim_count) AS BIGINT) FROM claims_d WHERE manufacturing_date BETWEEN '2001-03-01' AND '2001-08-31'""",
)
def date_split(spark, sf_dir):
    dates = SplitDates("1995-01-01", "2001-02-28", "2001-03-01", "2001-08-31")
    parts = panel.split_by_dates(tables.claims(spark, sf_dir), "manufacturing_date", dates)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("claim_count").alias("claims")).withColumn("part", F.lit(name))
    return count(parts[0], "train").unionByName(count(parts[1], "test"))
