"""Queries on early-warning scores, model selection, backtests and manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelwright.catalog.base import LAST_HALF, LAST_YEAR, SLOTS, TRAIN_SLOTS, actuals, comparison, history, holdout_errors, month_panel, naive, query
from panelwright.catalog.forecasts import KPI, METRICS
from panelwright.catalog.series import _GUARDS, _IQR, MONTHLY_GUARDS
from panelwright.config import FACTORS, SCORE100_WEIGHTS, OrderGrid
from panelwright.operators import (
    accuracy,
    backtest,
    corrections,
    documents,
    forecast,
    guards,
    manifest,
    panel,
    ranking,
    reports,
    scoring,
    seasonal_models,
)
from panelwright.plans import training
from panelwright.sources import files, tables
from panelwright.streaming import month_files

FACTOR_COLS = " ".join(FACTORS)


def factors_sql(g: str) -> str:
    """History factors, forecast mean and hold-out error into `fac`, as published."""
    return f"""season AS (SELECT series_id, avg(CASE WHEN sd > 0 THEN greatest(0, 1 - sd / (m + 0.01)) END) AS f3 FROM
    (SELECT series_id, idx % 12 AS pos, stddev_pop(y) AS sd, avg(y) AS m FROM hist_{g} WHERE idx < @train // 12 * 12 GROUP BY 1, 2) GROUP BY 1),
 swing AS (SELECT series_id, avg(r) AS sw FROM (SELECT series_id, idx, max(y) OVER w - min(y) OVER w AS r FROM hist_{g}
    WINDOW w AS (PARTITION BY series_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)) WHERE idx <= @year GROUP BY 1),
 motion AS (SELECT series_id, stddev_pop(v) FILTER (idx >= @half + 1) AS sv, avg(a) FILTER (idx >= @half + 2 AND a > 0) AS up FROM
    (SELECT *, y - lag(y) OVER w AS v, y - 2 * lag(y) OVER w + lag(y, 2) OVER w AS a FROM hist_{g} WINDOW w AS (PARTITION BY series_id ORDER BY idx)) GROUP BY 1),
 base AS (SELECT series_id, avg(y) AS mean_y, CAST(count_if(y <> 0) AS DOUBLE) / count(*) AS nonzero_ratio, avg(y) FILTER (idx >= @year) AS recent FROM hist_{g} GROUP BY 1),
 cp_m AS (SELECT series_id, idx, CASE WHEN count(y) OVER w = 6 THEN avg(y) OVER w END AS ma FROM hist_{g}
    WINDOW w AS (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)),
 cp_d AS (SELECT series_id, idx, round(abs(ma - lag(ma) OVER (PARTITION BY series_id ORDER BY idx)), 9) AS move FROM cp_m),
 cp_c AS (SELECT series_id, round(quantile_cont(move, 0.75), 9) AS cut FROM cp_d GROUP BY 1),
 cp AS (SELECT series_id, count_if(move > cut AND idx >= @half) / 6.0::DOUBLE AS cp_prob FROM cp_d JOIN cp_c USING (series_id) GROUP BY 1),
 ahead AS (SELECT series_id, avg(y_pred) AS a FROM fc_{g} GROUP BY 1),
 fac AS (SELECT b.series_id, CASE WHEN recent >= 0.01 THEN a / recent END AS f1_ratio,
   CASE WHEN wmape IS NULL OR wmape > 1000 THEN 0 ELSE least(greatest(1 - wmape / 200, 0), 1) END AS f2_conf, coalesce(f3, 0) AS f3_season,
   CASE WHEN mean_y < 0.01 THEN 0 ELSE least(sw / mean_y, 1) END AS f4_ampl,
   0.5 * coalesce(least(greatest(up / nullif(sv, 0), 0), 3) / 3, 0) + 0.5 * coalesce(cp_prob, 0) AS f5_inflect,
   mean_y < 0.5 OR nonzero_ratio < 0.3 AS sparse_flag,
   concat_ws('; ', CASE WHEN mean_y < 0.5 THEN 'avg=' || CAST(round(mean_y, 2) AS DECIMAL(28, 2)) || '<0.5' END,
     CASE WHEN nonzero_ratio < 0.3 THEN 'nonzero=' || CAST(round(nonzero_ratio * 100, 1) AS DECIMAL(28, 1)) || '%<30%' END) AS sparse_reason,
   mean_y, nonzero_ratio
   FROM base b JOIN season USING (series_id) JOIN swing USING (series_id) JOIN motion USING (series_id) JOIN ahead USING (series_id) LEFT JOIN cp USING (series_id) LEFT JOIN holdout_{g} USING (series_id))"""


_SCORE = """least(greatest((coalesce(f1_ratio * 0.2, 0) + f2_conf * 0.15 + f3_season * 0.3 + f4_ampl * 0.15 + f5_inflect * 0.2)
   / (CASE WHEN f1_ratio IS NULL THEN 0 ELSE 0.2 END + 0.8), 0), 1)"""
_FLAGS = """sc AS (SELECT *, {score} AS ews_score, f3_season >= 0.4 AND f4_ampl >= 0.3 AS candidate, f2_conf < 0.2 AS low_confidence FROM fac WHERE NOT sparse_flag),
 lv AS (SELECT *, CASE WHEN f2_conf < 0.2 THEN 'LOW_CONF' WHEN ews_score >= 0.7 THEN 'HIGH' WHEN ews_score >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS level,
   coalesce(nullif(concat_ws('; ', CASE WHEN f1_ratio > 1.5 THEN '증가율' || CAST(round(f1_ratio, 1) AS DECIMAL(28, 1)) || 'x' END,
     CASE WHEN f3_season >= 0.6 THEN '강한계절성' || CAST(round(f3_season, 2) AS DECIMAL(28, 2)) END,
     CASE WHEN f4_ampl >= 0.5 THEN '큰진폭' || CAST(round(f4_ampl, 2) AS DECIMAL(28, 2)) END,
     CASE WHEN f5_inflect >= 0.5 THEN '변곡위험' || CAST(round(f5_inflect, 2) AS DECIMAL(28, 2)) END,
     CASE WHEN f2_conf < 0.2 THEN '낮은신뢰도' || CAST(round(f2_conf, 2) AS DECIMAL(28, 2)) END), ''), 'normal') AS rationale FROM sc)"""
SCORED = _FLAGS.format(score=_SCORE)
REPORT_SQL = f"row_number() OVER (ORDER BY round(ews_score, 9) DESC, series_id) AS rank, series_id, ews_score, level, {', '.join(FACTORS)}, candidate, rationale"


def factors(spark, sf_dir, grain="sparse", with_changes=False):
    p = month_panel(spark, sf_dir, grain)
    h = history(p)
    shares = scoring.change_share(panel.series_vectors(h)) if with_changes else scoring.move_share(h)
    return scoring.five_factors(h, naive(p), holdout_errors(p), shares)


@query("ews_factors", f"WITH {factors_sql('s')} SELECT * FROM fac", FACTOR_COLS + " mean_y nonzero_ratio")
def ews_factors(spark, sf_dir):
    return factors(spark, sf_dir)


@query("ews_report", f"WITH {factors_sql('s')}, {SCORED} SELECT {REPORT_SQL} FROM lv", FACTOR_COLS + " ews_score")
def ews_report(spark, sf_dir):
    """Flagship: claims to panel, forecast, five factors, score, level, rationale and rank."""
    return scoring.report(factors(spark, sf_dir))


@query("ews_report_dense", f"WITH {factors_sql('d')}, {SCORED} SELECT {REPORT_SQL} FROM lv", FACTOR_COLS + " ews_score")
def ews_report_dense(spark, sf_dir):
    return scoring.report(factors(spark, sf_dir, "dense"))


@query("ews_report_changepoints")
def ews_report_changepoints(spark, sf_dir):
    return scoring.report(factors(spark, sf_dir, "dense", with_changes=True))


_SCALED = """sp AS (SELECT min(f1_ratio) AS a1, max(f1_ratio) AS b1, min(f3_season) AS a3, max(f3_season) AS b3, min(f4_ampl) AS a4, max(f4_ampl) AS b4,
   min(f5_inflect) AS a5, max(f5_inflect) AS b5 FROM fac WHERE NOT sparse_flag),
 nf AS (SELECT series_id, CASE WHEN b1 - a1 < 1e-10 THEN 0 ELSE (f1_ratio - a1) / (b1 - a1) END AS f1_ratio, f2_conf,
   CASE WHEN b3 - a3 < 1e-10 THEN 0 ELSE (f3_season - a3) / (b3 - a3) END AS f3_season, CASE WHEN b4 - a4 < 1e-10 THEN 0 ELSE (f4_ampl - a4) / (b4 - a4) END AS f4_ampl,
   CASE WHEN b5 - a5 < 1e-10 THEN 0 ELSE (f5_inflect - a5) / (b5 - a5) END AS f5_inflect FROM fac, sp WHERE NOT sparse_flag)"""


@query("ews_minmax_score", f"WITH {factors_sql('s')}, {_SCALED} SELECT series_id, {_SCORE} AS ews_score FROM nf", "ews_score")
def ews_minmax_score(spark, sf_dir):
    return scoring.scored(factors(spark, sf_dir), normalize="minmax").select("series_id", "ews_score")


@query(
    "ews_discriminating",
    f"""WITH {factors_sql('s')}, {SCORED}, m AS (SELECT series_id, level, ews_score * 0.4 + coalesce(f1_ratio, 0) * 0.3 + f2_conf * 0.3 AS mixed_score
        FROM lv WHERE level <> 'LOW_CONF') SELECT *, row_number() OVER (ORDER BY round(mixed_score, 9) DESC, series_id) AS rank FROM m""",
    "mixed_score",
)
def ews_discriminating(spark, sf_dir):
    return scoring.discriminating(scoring.scored(factors(spark, sf_dir))).select("series_id", "level", "mixed_score", "rank")


@query(
    "ews_filtered",
    f"""WITH {factors_sql('s')}, {SCORED} SELECT series_id, level, ews_score, f1_ratio, f2_conf FROM lv WHERE level IN ('MEDIUM', 'LOW')
        AND f2_conf >= 0.3 AND f1_ratio >= 0.8 AND ews_score >= 0.2 AND contains(lower(series_id), 'brand#1')""",
    "ews_score f1_ratio f2_conf",
)
def ews_filtered(spark, sf_dir):
    found = scoring.filter_scores(scoring.scored(factors(spark, sf_dir)), ["MEDIUM", "LOW"], 0.3, 0.8, 0.2, "BRAND#1")
    return found.select("series_id", "level", "ews_score", "f1_ratio", "f2_conf")


@query(
    "ews_top_by_factor",
    f"WITH {factors_sql('s')}, {SCORED} SELECT series_id, f1_ratio, ews_score FROM lv ORDER BY round(f1_ratio, 9) DESC NULLS LAST, series_id LIMIT 20",
    "f1_ratio ews_score",
)
def ews_top_by_factor(spark, sf_dir):
    order = [F.round("f1_ratio", 9).desc_nulls_last(), F.col("series_id")]
    return scoring.scored(factors(spark, sf_dir)).orderBy(*order).limit(20).select("series_id", "f1_ratio", "ews_score")


@query(
    "ews_levels",
    f"WITH {factors_sql('s')}, {SCORED} SELECT level, count(*) AS n_series, avg(ews_score) AS mean_score, CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct FROM lv GROUP BY 1",
    "mean_score pct",
)
def ews_levels(spark, sf_dir):
    return scoring.score_summary(scoring.scored(factors(spark, sf_dir)))


@query(
    "ews_factor_summary",
    f"""WITH {factors_sql('s')}, u AS (SELECT unnest(['f1_ratio', 'f2_conf', 'f3_season', 'f4_ampl', 'f5_inflect']) AS factor,
        unnest([f1_ratio, f2_conf, f3_season, f4_ampl, f5_inflect]) AS v FROM fac)
        SELECT factor, count(*) AS n_series, CAST(count(v) AS DOUBLE) / count(*) AS known_ratio, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, max(v) AS max,
        quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75,
        count_if(round(v, 9) >= 0.5)::BIGINT AS n_high FROM u GROUP BY 1""",
    "known_ratio mean std min max q25 q50 q75",
)
def ews_factor_summary(spark, sf_dir):
    return scoring.factor_summary(factors(spark, sf_dir))


@query(
    "factor_histogram",
    f"""WITH {factors_sql('s')}, s AS (SELECT min(f3_season) AS lo, (max(f3_season) - min(f3_season)) / 20 AS w FROM fac),
        b AS (SELECT CAST(least(floor(coalesce((f3_season - lo) / nullif(w, 0), 0)), 19) AS INT) AS bin FROM fac, s)
        SELECT bin, lo + bin * w AS from_value, count(*) AS n FROM b, s GROUP BY bin, lo, w""",
    "from_value",
)
def factor_histogram(spark, sf_dir):
    return reports.histogram(factors(spark, sf_dir), "f3_season", 20)


_RISK = """rm AS (SELECT series_id, '2001-' || lpad(CAST(month AS VARCHAR), 2, '0') AS risk_month, y_pred AS risk_value FROM
  (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY y_pred DESC, idx) AS r FROM fc_{g}) WHERE r = 1)"""


@query("risk_month", f"WITH {_RISK.format(g='s')} SELECT * FROM rm", "risk_value")
def risk_month(spark, sf_dir):
    return scoring.risk_months(naive(month_panel(spark, sf_dir, "sparse")))


@query(
    "ews_with_risk_month",
    f"""WITH {factors_sql('s')}, {SCORED}, {_RISK.format(g='s')}, r AS (SELECT * FROM rm WHERE risk_value > 0)
        SELECT lv.series_id, ews_score, coalesce(risk_month, 'N/A') AS risk_month, coalesce(risk_value, 0.0) AS risk_value FROM lv LEFT JOIN r USING (series_id)""",
    "ews_score risk_value",
)
def ews_with_risk_month(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    f = naive(p)
    s = scoring.scored(scoring.five_factors(history(p), f, holdout_errors(p), scoring.move_share(history(p))))
    return scoring.with_risk_months(s, f.where(F.col("y_pred") > 0)).select("series_id", "ews_score", "risk_month", "risk_value")


@query(
    "interval_confidence",
    """SELECT series_id, least(greatest(0.5 * CASE WHEN m > 0 THEN least(greatest(1 - w / m, 0), 1) ELSE 0 END + 0.5 * c, 0), 1) AS f2_conf FROM
       (SELECT series_id, avg(y_pred_upper - y_pred_lower) AS w, avg((y_pred_upper + y_pred_lower) / 2) AS m,
        avg(CASE WHEN y BETWEEN y_pred_lower AND y_pred_upper THEN 1.0::DOUBLE ELSE 0 END) AS c FROM cmp_d GROUP BY 1)""",
    "f2_conf",
)
def interval_confidence(spark, sf_dir):
    p = month_panel(spark, sf_dir)
    return scoring.interval_confidence(naive(p), actuals(p))


_V1 = """h AS (SELECT series_id, avg(y) AS hm, stddev_pop(y) AS hs, max(y) AS hx, avg(y) FILTER (idx < 6) AS sm, regr_slope(y, idx) FILTER (idx >= @half) AS rs FROM hist_s
   GROUP BY 1 HAVING avg(y) >= 0.5),
 f AS (SELECT f.series_id, avg(y_pred) AS fm, max(y_pred) AS fx, avg(CASE WHEN y_pred > hm + 2 * hs THEN 1.0::DOUBLE ELSE 0 END) AS ex, regr_slope(y_pred, h) AS fs
   FROM fc_s f JOIN h USING (series_id) GROUP BY 1),
 c AS (SELECT h.*, fm, fx, CASE WHEN hm < 0.01 THEN 0 ELSE least(greatest((fm - hm) / hm * 100, 0), 100) END AS growth_score,
   CASE WHEN hs < 0.01 OR hm < 0.01 THEN 0 ELSE least(greatest(ex * 200, 0), 100) END AS volatility_score,
   CASE WHEN sm < 0.01 THEN 0 ELSE least(greatest((fm - sm) / sm * 100, 0), 100) END AS seasonality_score,
   CASE WHEN abs(rs) < 0.001 THEN 0 ELSE least(greatest((fs - rs) / abs(rs) * 100, 0), 100) END AS acceleration_score FROM h JOIN f USING (series_id)),
 v1 AS (SELECT c.series_id, growth_score * 0.35 + volatility_score * 0.25 + seasonality_score * 0.2 + acceleration_score * 0.2 AS total_score,
   growth_score, volatility_score, seasonality_score, acceleration_score, fm AS forecast_mean, hm AS historical_mean, fx AS forecast_max, hx AS historical_max,
   (fm - hm) / hm * 100 AS growth_rate_pct, round(CASE WHEN wmape IS NULL OR wmape > 1000 THEN 0 ELSE greatest(0, 100 - wmape) END, 1) AS confidence,
   risk_month AS expected_time, round(risk_value, 2) AS expected_count FROM c LEFT JOIN holdout_s USING (series_id) JOIN rm USING (series_id))"""
_V1_COLS = "total_score growth_score volatility_score seasonality_score acceleration_score forecast_mean historical_mean forecast_max historical_max growth_rate_pct confidence expected_count"


def score100(spark, sf_dir, same_month="first"):
    p = month_panel(spark, sf_dir, "sparse")
    return scoring.score100(history(p), naive(p), holdout_errors(p), SCORE100_WEIGHTS, same_month)


@query("ews_v1", f"WITH {_RISK.format(g='s')}, {_V1} SELECT *, row_number() OVER (ORDER BY round(total_score, 9) DESC, series_id) AS rank FROM v1", _V1_COLS)
def ews_v1(spark, sf_dir):
    return scoring.score100_report(score100(spark, sf_dir))


@query(
    "ews_v1_top",
    f"WITH {_RISK.format(g='s')}, {_V1} SELECT series_id, total_score, row_number() OVER (ORDER BY round(total_score, 9) DESC, series_id) AS rank FROM v1 ORDER BY rank LIMIT 5",
    "total_score",
)
def ews_v1_top(spark, sf_dir):
    order = [F.round("total_score", 9).desc(), F.col("series_id")]
    return ranking.top(score100(spark, sf_dir), 5, order, out="rank").select("series_id", "total_score", "rank")


@query(
    "ews_v1_calendar",
    f"""WITH {_RISK.format(g='s')}, {_V1.replace('FILTER (idx < 6) AS sm', 'FILTER (month BETWEEN 3 AND 8) AS sm')} SELECT series_id, total_score, seasonality_score FROM v1""",
    "total_score seasonality_score",
)
def ews_v1_calendar(spark, sf_dir):
    return score100(spark, sf_dir, "calendar").select("series_id", "total_score", "seasonality_score")


# --- backtest -------------------------------------------------------------------------------------


@query(
    "backtest_labels",
    """SELECT series_id, CASE WHEN sum(y) FILTER (idx >= @train) >= 1.3 * 6 * avg(y) FILTER (idx BETWEEN @year AND @train - 1) - 1e-9 THEN 1 ELSE 0 END AS label FROM panel_s GROUP BY 1""",
)
def backtest_labels(spark, sf_dir):
    return backtest.growth_labels(month_panel(spark, sf_dir, "sparse"))


_PR = """l AS (SELECT series_id, CASE WHEN sum(y) FILTER (idx >= @train) >= 1.3 * 6 * avg(y) FILTER (idx BETWEEN @year AND @train - 1) - 1e-9 THEN 1 ELSE 0 END AS label FROM panel_s GROUP BY 1),
 x AS (SELECT round(nonzero_ratio, 9) + round(f5_inflect, 3) AS score, label FROM fac JOIN l USING (series_id)),
 g AS (SELECT score AS threshold, CAST(sum(label) AS BIGINT) AS pos, count(*) AS "all" FROM x GROUP BY 1),
 r AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum("all") OVER w AS BIGINT) AS seen FROM g WINDOW w AS (ORDER BY threshold DESC)),
 pr AS (SELECT *, tp / CAST(seen AS DOUBLE) AS precision, tp / CAST((SELECT sum(label) FROM x) AS DOUBLE) AS recall FROM r),
 prf AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-10) AS f1 FROM pr)"""


def curve(spark, sf_dir):
    p = month_panel(spark, sf_dir, "sparse")
    f = scoring.five_factors(history(p), naive(p), holdout_errors(p), scoring.move_share(history(p)))
    score = F.round("nonzero_ratio", 9) + F.round("f5_inflect", 3)
    rows = f.join(backtest.growth_labels(p), "series_id").select(score.alias("score"), "label")
    return backtest.precision_recall(rows)


@query("pr_curve", f"WITH {factors_sql('s')}, {_PR} SELECT * FROM prf", "threshold precision recall f1")
def pr_curve(spark, sf_dir):
    return curve(spark, sf_dir)


@query(
    "pr_summary",
    f"""WITH {factors_sql('s')}, {_PR}, t AS (SELECT *, lag(precision, 1, 1.0) OVER w AS p0, lag(recall, 1, 0.0) OVER w AS r0 FROM prf WINDOW w AS (ORDER BY threshold DESC))
        SELECT max(f1) AS f1, min(threshold) FILTER (f1 >= (SELECT max(f1) FROM prf) - 1e-12) AS threshold, sum((recall - r0) * (precision + p0) / 2) AS pr_auc,
        CAST(sum("all") AS BIGINT) AS n_samples, CAST(sum(pos) AS BIGINT) AS n_positive FROM t""",
    "f1 threshold pr_auc",
)
def pr_summary(spark, sf_dir):
    return backtest.curve_summary(curve(spark, sf_dir))


def _fold_factors(cut: int, fold: int) -> str:
    return f"""SELECT series_id, {fold} AS fold, a / recent AS f1_ratio, 0.0::DOUBLE AS f2_conf, CASE WHEN future >= 1.3 * 6 * recent - 1e-9 THEN 1 ELSE 0 END AS label FROM
      (SELECT series_id, avg(y) FILTER (idx >= {cut} AND idx < {cut} + 6) AS a, avg(y) FILTER (idx >= {cut} - 12 AND idx < {cut}) AS recent,
       sum(y) FILTER (idx >= {cut} AND idx < {cut} + 6) AS future, avg(y) FILTER (idx < {cut}) AS m, CAST(count_if(idx < {cut} AND y <> 0) AS DOUBLE) / {cut} AS nz
       FROM panel_s GROUP BY 1) WHERE NOT (m < 0.5 OR nz < 0.3)"""


@query(
    "backtest_factors",
    f"""SELECT series_id, fold, CASE WHEN isfinite(f1_ratio) THEN f1_ratio END AS f1_ratio, f2_conf, label FROM
        ({_fold_factors(LAST_HALF, 1)} UNION ALL {_fold_factors(TRAIN_SLOTS, 2)})""",
    "f1_ratio f2_conf",
)
def backtest_factors(spark, sf_dir):
    rows = backtest.point_in_time(month_panel(spark, sf_dir, "sparse"), [LAST_HALF, TRAIN_SLOTS])
    return rows.select("series_id", "fold", "f1_ratio", "f2_conf", "label")


@query("backtest_factors_forecast_proxy")
def backtest_factors_forecast_proxy(spark, sf_dir):
    return backtest.point_in_time(month_panel(spark, sf_dir), [LAST_HALF, TRAIN_SLOTS], proxy="forecast", with_changes=True)


@query("weight_learning")
def weight_learning(spark, sf_dir):
    """Weights learned in the folds of the whole 80-month span."""
    return backtest.average_folds(weight_folds(spark, sf_dir))


@query("weight_folds")
def weight_folds(spark, sf_dir):
    return backtest.backtest_folds(month_panel(spark, sf_dir), SLOTS)


# --- seasonal models ------------------------------------------------------------------------------

SMALL_GRID = OrderGrid(max_p=1, max_q=1)


def models(spark, sf_dir, grid=SMALL_GRID):
    return seasonal_models.train(history(month_panel(spark, sf_dir)), grid)


@query("model_training")
def model_training(spark, sf_dir):
    """Selection over the full 64 candidates, hold-out metrics and levels per series."""
    return models(spark, sf_dir, OrderGrid()).select(
        "series_id", "status", "reason", F.col("order").cast("string").alias("order"), "aic", "bic", "wmape", "smape", "bias", "mae", "wmape_level", "n_obs"
    )


@query("sarima_select")
def sarima_select(spark, sf_dir):
    h = history(month_panel(spark, sf_dir))
    chosen = seasonal_models.select_orders(panel.series_vectors(h), forecast.unit_root(h), SMALL_GRID)
    return chosen.select("series_id", F.col("order").cast("string").alias("order"), F.col("fit.aic").alias("aic"), "n_tried")


@query("sarima_forecast")
def sarima_forecast(spark, sf_dir):
    h = history(month_panel(spark, sf_dir))
    fitted = seasonal_models.fit_orders(panel.series_vectors(h).withColumn("order", seasonal_models.order_column()))
    return seasonal_models.forecast_rows(fitted, h)


@query("sarima_guarded_forecast")
def sarima_guarded_forecast(spark, sf_dir):
    p = month_panel(spark, sf_dir)
    h = history(p)
    fitted = seasonal_models.fit_orders(panel.series_vectors(h).withColumn("order", seasonal_models.order_column((0, 1, 1, 0, 1, 1, 12))))
    return forecast.guarded_forecast(seasonal_models.forecast_rows(fitted, h), forecast.history_stats(h), naive(p))


@query("sarima_holdout")
def sarima_holdout(spark, sf_dir):
    vectors = panel.series_vectors(history(month_panel(spark, sf_dir)))
    orders = vectors.select("series_id", seasonal_models.order_column().alias("order"))
    return seasonal_models.holdout_metrics(vectors, orders)


_MOVES = """m AS (SELECT *, CASE WHEN count(y) OVER w = 6 THEN avg(y) OVER w END AS ma FROM hist_s
    WINDOW w AS (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)),
 d AS (SELECT *, round(abs(ma - lag(ma) OVER (PARTITION BY series_id ORDER BY idx)), 9) AS move FROM m),
 c AS (SELECT series_id, round(quantile_cont(move, 0.75), 9) AS cut FROM d GROUP BY 1),
 rc AS (SELECT series_id, coalesce(bool_or(move > cut AND idx >= @half), false) AS has_recent FROM d JOIN c USING (series_id) GROUP BY 1)"""


@query(
    "retrain_policy",
    f"""WITH {_MOVES}, k AS (SELECT series_id FROM hist_s GROUP BY 1 HAVING CAST(count_if(y > 0) AS DOUBLE) / @train >= 0.3)
        SELECT rc.series_id, CASE WHEN k.series_id IS NULL THEN 'new_series' WHEN has_recent THEN 'changepoint_detected' ELSE 'fast_update' END AS strategy,
        k.series_id IS NULL OR has_recent AS reselect FROM rc LEFT JOIN k ON k.series_id = rc.series_id""",
)
def retrain_policy(spark, sf_dir):
    h = history(month_panel(spark, sf_dir, "sparse"))
    known = guards.model_eligibility(h).where(F.col("nonzero_ratio") >= 0.3).select("series_id", seasonal_models.order_column().alias("order"))
    return seasonal_models.retrain_strategy(h, known).drop("kept_order")


@query(
    "strategy_share",
    f"""WITH {_MOVES}, k AS (SELECT series_id FROM hist_s GROUP BY 1 HAVING CAST(count_if(y > 0) AS DOUBLE) / @train >= 0.3),
        s AS (SELECT CASE WHEN k.series_id IS NULL THEN 'new_series' WHEN has_recent THEN 'changepoint_detected' ELSE 'fast_update' END AS strategy
              FROM rc LEFT JOIN k ON k.series_id = rc.series_id)
        SELECT strategy, count(*) AS n, CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct FROM s GROUP BY 1""",
    "pct",
)
def strategy_share(spark, sf_dir):
    return reports.share_of(retrain_policy(spark, sf_dir), "strategy")


@query("incremental_retrain")
def incremental_retrain(spark, sf_dir):
    """Models of half of the plants are known; the rest counts as new."""
    h = history(month_panel(spark, sf_dir))
    known = h.select("series_id", "plant").distinct().where(F.col("plant").isin("ASIA", "EUROPE"))
    known = known.select("series_id", seasonal_models.order_column().alias("order"))
    out = seasonal_models.retrain(h, known, SMALL_GRID)
    return out.select("series_id", "status", "strategy", F.col("order").cast("string").alias("order"), "aic", "n_obs")


@query("tune_mase")
def tune_mase(spark, sf_dir):
    """Tuning of all series that miss a limit, by validation MASE."""
    p = month_panel(spark, sf_dir)
    h = history(p)
    metrics = accuracy.with_mase(
        accuracy.fraction_metrics_by(accuracy.compare_inner(actuals(p), naive(p)), "series_id"), accuracy.naive_scale(h, 12)
    )
    gain = training.tune_poor(h, metrics, OrderGrid(1, 1, 1, 1, max_complexity=8))
    return gain.select("series_id", F.col("order").cast("string").alias("order"), "best_mase", "original_mase", "improvement_pct")


@query("order_distribution")
def order_distribution(spark, sf_dir):
    return reports.order_distribution(models(spark, sf_dir))


@query("reselect_worst")
def reselect_worst(spark, sf_dir):
    p = month_panel(spark, sf_dir)
    df = accuracy.compare_inner(actuals(p), naive(p))
    return corrections.reselect_worst(df, history(p), SMALL_GRID).select("series_id", "year", "month", "claim_count", "y_pred", "error")


@query(
    "model_holdout_kpi",
    f"""WITH x AS (SELECT t.series_id, t.y, b.y AS p FROM hist_d t JOIN hist_d b ON b.series_id = t.series_id AND b.idx = t.idx - 12 WHERE t.idx >= @half)
        SELECT series_id, {METRICS} FROM x GROUP BY 1""",
    "wmape smape bias mae rmse",
)
def model_holdout_kpi(spark, sf_dir):
    return holdout_errors(month_panel(spark, sf_dir))


# --- predictability -------------------------------------------------------------------------------

_PREDICT = f"""{_GUARDS.format(g='s', cond=_IQR)}, pm AS (SELECT g.*, CASE WHEN g.is_sparse THEN 'fallback_naive' ELSE 'seasonal' END AS model_type,
   least(greatest(1 - g.zero_ratio, 0), 1) AS predictability_score, m AS mean FROM guards g JOIN (SELECT series_id, avg(y) AS m FROM hist_s GROUP BY 1) USING (series_id)),
 cl AS (SELECT *, CASE WHEN predictability_score >= 0.7 THEN 'high' WHEN predictability_score >= 0.4 THEN 'medium' ELSE 'low' END AS predictability_category,
   predictability_score >= 0.7 AND mean > (SELECT quantile_cont(mean, 0.25) FROM pm) AS focus_recommended FROM pm)"""


def predictability(spark, sf_dir):
    """Nested model documents (score: share of non-zero months) read back as a classified table."""
    h = history(month_panel(spark, sf_dir, "sparse")).withColumn("slot_date", F.make_date("year", "month", F.lit(1)))
    g = guards.guard_table(h, MONTHLY_GUARDS, date_col="slot_date")
    flat = g.select(
        "series_id",
        F.lit("success").alias("status"),
        F.when(F.col("is_sparse"), "fallback_naive").otherwise("seasonal").alias("model_type"),
        (1 - F.col("zero_ratio")).alias("predictability_score"),
    )
    docs = documents.model_documents(flat, g, forecast.history_stats(h))
    return reports.classified(documents.flat_models(docs))


@query(
    "predictability_classes",
    f"WITH {_PREDICT} SELECT series_id, model_type, predictability_score, predictability_category, focus_recommended FROM cl",
    "predictability_score",
)
def predictability_classes(spark, sf_dir):
    return predictability(spark, sf_dir).select("series_id", "model_type", "predictability_score", "predictability_category", "focus_recommended")


@query(
    "predictability_shares",
    f"""WITH {_PREDICT} SELECT predictability_category, count(*) AS n, CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct,
        avg(predictability_score) AS mean_score FROM cl GROUP BY 1""",
    "pct mean_score",
)
def predictability_shares(spark, sf_dir):
    return reports.class_shares(predictability(spark, sf_dir))


@query(
    "predictability_flags",
    f"""WITH {_PREDICT}, u AS (SELECT unnest(['is_sparse', 'has_seasonality', 'has_drift']) AS flag, unnest([is_sparse, has_seasonality, has_drift]) AS value,
        predictability_score FROM cl) SELECT flag, value, avg(predictability_score) AS mean_score, count(*) AS n_series FROM u GROUP BY 1, 2""",
    "mean_score",
)
def predictability_flags(spark, sf_dir):
    return reports.flag_effects(predictability(spark, sf_dir))


@query(
    "focus_list",
    f"""WITH {_PREDICT} SELECT series_id, predictability_score, model_type, mean, has_seasonality FROM cl WHERE focus_recommended
        ORDER BY predictability_score DESC, series_id LIMIT 50""",
    "predictability_score mean",
)
def focus_list(spark, sf_dir):
    return reports.focus_list(predictability(spark, sf_dir))


@query(
    "problem_list",
    f"""WITH {_PREDICT} SELECT series_id, predictability_score, coalesce(nullif(concat_ws(', ', CASE WHEN is_sparse THEN '희소(' || CAST(round(zero_ratio * 100, 0) AS DECIMAL(28, 0)) || '%)' END,
        CASE WHEN has_drift THEN '드리프트' END, CASE WHEN NOT has_seasonality THEN '계절성↓' END), ''), '-') AS issues, model_type FROM cl
        WHERE predictability_category = 'low' ORDER BY predictability_score, series_id LIMIT 30""",
    "predictability_score",
)
def problem_list(spark, sf_dir):
    return reports.problem_list(predictability(spark, sf_dir))


# --- uploads and manifests ------------------------------------------------------------------------


@query(
    "month_detection",
    """SELECT (SELECT CAST(year(manufacturing_date) AS INT) FROM claims_s GROUP BY year(manufacturing_date) ORDER BY count(*) DESC, year(manufacturing_date) LIMIT 1) AS year,
       (SELECT CAST(month(manufacturing_date) AS INT) FROM claims_s GROUP BY month(manufacturing_date) ORDER BY count(*) DESC, month(manufacturing_date) LIMIT 1) AS month,
       count(DISTINCT plant || '|' || product_cat2 || '|' || mid_category) AS n_series, strftime(min(manufacturing_date), '%Y-%m-%d') AS first_date,
       strftime(max(manufacturing_date), '%Y-%m-%d') AS last_date, CAST(sum(claim_count) AS BIGINT) AS total_claims FROM claims_s""",
)
def month_detection(spark, sf_dir):
    found = reports.month_detection(tables.claims(spark, sf_dir, "sparse"))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_date", "last_date")})


_PRINT = """rows_ AS (SELECT md5(concat_ws('|', {cells})) AS h FROM claims_d),
 halves AS (SELECT CAST('0x' || substr(h, 1, 16) AS UBIGINT)::HUGEINT AS a, CAST('0x' || substr(h, 17, 16) AS UBIGINT)::HUGEINT AS b FROM rows_),
 print AS (SELECT count(*) AS n_rows, lower(lpad(hex(CAST(sum(a) % 18446744073709551616::HUGEINT AS UBIGINT)), 16, '0')) || '-' ||
   lower(lpad(hex(CAST(sum(b) % 18446744073709551616::HUGEINT AS UBIGINT)), 16, '0')) AS data_hash FROM halves)""".format(
    cells=", ".join(
        f"coalesce('=' || replace(replace(CAST({c} AS VARCHAR), '%', '%25'), '|', '%7C'), '')"
        for c in ("claim_count", "manufacturing_date", "mid_category", "occurrence_date", "plant", "product_cat2")
    )
)


@query("manifest_fingerprint", f"WITH {_PRINT} SELECT n_rows, data_hash FROM print")
def manifest_fingerprint(spark, sf_dir):
    return manifest.fingerprint(tables.claims(spark, sf_dir))


@query(
    "manifest_comparison",
    f"""WITH {_PRINT} SELECT 'data_hash' AS key, data_hash AS value_a, data_hash AS value_b, true AS same FROM print
        UNION ALL SELECT 'n_rows', CAST(n_rows AS VARCHAR), CAST(n_rows AS VARCHAR), true FROM print
        UNION ALL SELECT * FROM (VALUES ('cv_scheme', 'rolling3fold_24m', 'rolling3fold_24m', true), ('seed', '42', '7', false), ('val_window', '6', '6', true))""",
)
def manifest_comparison(spark, sf_dir):
    """Two runs on the same claims, the second with another seed and its rows dealt out anew."""
    rows = tables.claims(spark, sf_dir)
    settings = {"seed": 42, "cv_scheme": "rolling3fold_24m", "val_window": 6}
    first = manifest.manifest(spark, "a", settings, rows)
    second = manifest.manifest(spark, "b", {**settings, "seed": 7}, rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.compare_manifests(first, second)


@query(
    "stream_month_panel",
    """SELECT 'G' || (user_id % 10) || '|' || event_type || '|' || CASE WHEN value >= 50 THEN 'high' ELSE 'low' END AS series_id,
       CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(count(*) AS DOUBLE) AS claim_count FROM events GROUP BY 1, 2, 3""",
)
def stream_month_panel(spark, sf_dir):
    """The events as a delivered folder of part files for each month, run through the stream into a partitioned panel."""
    folder = f"{ranking.shared_folder(spark)}/month-stream-{uuid.uuid4().hex}"
    source = tables.table(spark, sf_dir, "events")
    inbox = f"{folder}/inbox"
    source.withColumn("of_month", F.date_format("ts", "yyyy-MM")).write.partitionBy("of_month").parquet(inbox)
    stream = spark.readStream.schema(source.schema).option("recursiveFileLookup", True).parquet(inbox)
    rows = tables.as_event_claims(stream, month_files.delivery(inbox, F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.file_modification_time").alias("_at"))
    month_files.ingest_months(rows, f"{folder}/panel", f"{folder}/progress").awaitTermination()
    return files.read_panel(spark, f"{folder}/panel").select("series_id", "year", "month", "claim_count")


def _redelivered(spark, sf_dir):
    """All claims delivered by month in two parts each, in several batches: parts of one delivery arrive apart, every March is
    first sent with one category only, and second parts hold stray rows of the month after.  Returns the panel's path."""
    folder = f"{ranking.shared_folder(spark)}/month-stream-{uuid.uuid4().hex}"
    inbox = f"{folder}/inbox"
    rows = tables.claims(spark, sf_dir).select(*(F.col(c).cast("string") for c in ("plant", "product_cat2", "mid_category", "manufacturing_date", "claim_count")))
    made = F.to_date("manufacturing_date")
    of_month = F.date_format(made, "yyyy-MM")
    second = F.xxhash64("product_cat2") % 2 == 0
    stale = rows.where((F.month(made) == 3) & (F.col("mid_category") == "R")).withColumn("delivery", F.concat(F.lit("first-"), of_month))
    stray = rows.where((F.dayofmonth(made) == 1) & (F.col("mid_category") == "N") & (F.month(made) > 1))
    stray = stray.withColumn("delivery", F.date_format(F.add_months(made, -1), "yyyy-MM"))
    whole = rows.withColumn("delivery", of_month)
    for part in (stale, whole.where(~second), whole.where(second).unionByName(stray)):
        part.repartition("delivery").write.mode("append").partitionBy("delivery").parquet(inbox)
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 60).parquet(inbox)
    delivery = month_files.delivery(inbox, F.col("_metadata.file_path")).alias("_file")
    arrived = stream.select("*", delivery, F.col("_metadata.file_modification_time").alias("_at"))
    month_files.ingest_months(arrived, f"{folder}/panel", f"{folder}/progress").awaitTermination()
    return f"{folder}/panel"


@query("stream_redelivery", "SELECT series_id, year, month, y AS claim_count FROM counts_d")
def stream_redelivery(spark, sf_dir):
    return files.read_panel(spark, _redelivered(spark, sf_dir)).select("series_id", "year", "month", "claim_count")


@query(
    "stream_left_out",
    """SELECT 'first-' || strftime(manufacturing_date, '%Y-%m') AS delivery, CAST(year(manufacturing_date) AS INT) AS year, CAST(3 AS INT) AS month,
       count(*) AS rows, 'superseded' AS reason FROM claims_d WHERE month(manufacturing_date) = 3 AND mid_category = 'R' GROUP BY 1, 2
       UNION ALL
       SELECT strftime(CAST(manufacturing_date - INTERVAL 1 MONTH AS DATE), '%Y-%m'), CAST(year(manufacturing_date) AS INT), CAST(month(manufacturing_date) AS INT),
       count(*), 'stray' FROM claims_d WHERE day(manufacturing_date) = 1 AND mid_category = 'N' AND month(manufacturing_date) > 1 GROUP BY 1, 2, 3""",
)
def stream_left_out(spark, sf_dir):
    rows = spark.read.parquet(f"{_redelivered(spark, sf_dir)}_dropped")
    return rows.withColumn("delivery", F.substring_index("delivery", "=", -1))


@query(
    "comparison_kpi_by_series",
    f"SELECT *, coalesce(mape < 0.2 AND abs(bias) < 0.05, false) AS passed FROM (SELECT series_id, {KPI} FROM cmp_d GROUP BY 1)",
    "mape bias mae rmse",
)
def comparison_kpi_by_series(spark, sf_dir):
    return accuracy.kpi(comparison(spark, sf_dir), by=("series_id",))
