import numpy as np
import pytest
from helpers import by_id
from pyspark.sql import functions as F

from panelwright.config import OrderGrid
from panelwright.operators import forecast, panel, seasonal_models

RNG = np.random.default_rng(3)
SINE = [10 + 5 * np.sin(2 * np.pi * i / 12) for i in range(36)]


def paths(df, value="y_pred"):
    out = {}
    for r in df.collect():
        out.setdefault(r.series_id, {})[r.h] = r[value]
    return {k: [v[h] for h in sorted(v)] for k, v in out.items()}


def test_seasonal_naive(make_panel):
    rows = {"sine": SINE, "short_12": range(12), "short_5": [4] * 5, "n13": range(13)}
    f = forecast.seasonal_naive(make_panel(rows), horizon=14)
    got, hi = paths(f), paths(f, "y_pred_upper")
    assert got["sine"] == pytest.approx(SINE[-12:] + SINE[-12:-10])
    assert hi["sine"][0] - got["sine"][0] == pytest.approx(1.96 * np.std(SINE[-12:]))
    assert got["short_12"] == pytest.approx([np.mean(range(4, 12))] * 14)
    assert got["short_5"][0] == 4 and hi["short_5"][0] == pytest.approx(4 + 1.96)
    assert got["n13"][:12] == list(range(1, 13))
    months = f.where("series_id = 'sine'").orderBy("h").select("year", "month").collect()
    assert (months[0].year, months[0].month, months[12].year, months[12].month) == (2001, 1, 2002, 1)


def test_short_and_unit_seasons(make_panel):
    p = make_panel({"n4": [10, 20, 30, 40], "n6": [1, 2, 3, 4, 5, 9]})
    f = forecast.seasonal_naive(p, 3, season=4)
    got, hi = paths(f), paths(f, "y_pred_upper")
    assert got["n4"] == [25.0] * 3 and hi["n4"][0] == pytest.approx(25 + 1.96 * 5)  # a fifth of the mean
    assert got["n6"] == [3.0, 4.0, 5.0] and hi["n6"][0] == pytest.approx(3 + 1.96 * np.std([3, 4, 5, 9]))
    one = forecast.seasonal_naive(p, 1, season=1)
    assert paths(one)["n6"] == [9.0] and paths(one, "y_pred_upper")["n6"][0] == pytest.approx(9 + 1.96 * 1.8)


def test_unknown_level_uses_default_width(make_panel):
    p = make_panel({"a": SINE})
    a, b = (paths(forecast.seasonal_naive(p, 1, level=v), "y_pred_upper")["a"] for v in (0.95, 0.77))
    assert a == b


def test_guarded_forecast_falls_back_and_clips(spark, make_panel):
    p = make_panel({"ok": [10.0] * 24 + [20.0] * 12, "nan": SINE, "huge": SINE, "wild": SINE})
    spare = forecast.seasonal_naive(p, 2)
    mine = spare.withColumn(
        "y_pred",
        F.when((F.col("series_id") == "nan") & (F.col("h") == 2), F.lit(float("nan")))
        .when(F.col("series_id") == "huge", F.lit(5e6))
        .when(F.col("series_id") == "ok", F.lit(1000.0))
        .otherwise(F.col("y_pred")),
    ).withColumn("y_pred_upper", F.when(F.col("series_id") == "wild", F.lit(9e6)).otherwise(F.col("y_pred_upper")))
    out = forecast.guarded_forecast(mine, forecast.history_stats(p), spare)
    models = {r.series_id: r.model for r in out.collect()}
    assert models == {"ok": "naive_seasonal", "nan": "fallback_naive", "huge": "fallback_naive", "wild": "fallback_naive"}
    y = np.r_[[10.0] * 24, [20.0] * 12]
    assert paths(out)["ok"][0] == pytest.approx(max(30.0, y.mean() + 10 * y.std()))
    for r in out.collect():
        assert r.y_pred_lower <= r.y_pred <= r.y_pred_upper


def test_coherent_bounds_fill_missing(spark):
    rows = [("a", 10.0, None, float("nan")), ("b", -5.0, -9.0, -1.0), ("c", 4.0, 6.0, 2.0)]
    df = spark.createDataFrame(rows, "series_id string, y_pred double, y_pred_lower double, y_pred_upper double")
    got = by_id(forecast.coherent_bounds(df))
    assert (got["a"].y_pred_lower, got["a"].y_pred_upper) == (8.0, 12.0)
    assert (got["b"].y_pred, got["b"].y_pred_lower, got["b"].y_pred_upper) == (0.0, 0.0, 0.0)
    assert (got["c"].y_pred_lower, got["c"].y_pred_upper) == (4.0, 4.0)
    assert forecast.check_forecast(forecast.coherent_bounds(df)).first().valid
    assert not forecast.check_forecast(df).first().valid


def test_forecast_layouts_are_normalised(spark):
    for names in (("forecast_year", "forecast_month", "forecast_value"), ("year", "month", "yhat")):
        df = spark.createDataFrame([("a", 2024, 1, 2.0)], ["series_id", *names])
        assert forecast.normalise_forecast(df).columns == ["series_id", "year", "month", "y_pred"]


def test_rolling_origin_needs_a_year(make_panel):
    got = forecast.rolling_origin_metrics(make_panel({"a": SINE, "b": SINE[:26]}))
    folds = {(r.series_id, r.fold): (r.train_size, r.test_size) for r in got.collect()}
    assert folds == {("a", 1): (18, 6), ("a", 2): (24, 6), ("a", 3): (30, 6), ("b", 2): (14, 6), ("b", 3): (20, 6)}
    assert by_id(got.where("fold = 3"), "mae")["a"] == pytest.approx(0, abs=1e-9)


def test_unit_root(make_panel):
    ar = [0.0]
    for e in RNG.normal(0, 1, 199):
        ar.append(0.2 * ar[-1] + e)
    walk = np.cumsum(RNG.normal(0, 1, 200)) + 50
    got = by_id(forecast.unit_root(make_panel({"ar": ar, "walk": walk, "flat": [2] * 30})))
    assert got["ar"].d == 0 and got["walk"].d == 1 and got["flat"].d == 1
    y, x = np.diff(ar), np.array(ar[:-1])
    X = np.c_[np.ones(len(x)), x]
    beta, rss = np.linalg.lstsq(X, y, rcond=None)[:2]
    se = np.sqrt(rss[0] / (len(x) - 2) / ((x - x.mean()) ** 2).sum())
    assert got["ar"].t_stat == pytest.approx(beta[1] / se)


# --- seasonal models ------------------------------------------------------------------------------


def simulate(phi=0.0, theta=0.0, n=400, seed=0):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 50)
    y = np.zeros(n + 50)
    for t in range(1, n + 50):
        y[t] = phi * y[t - 1] + e[t] - theta * e[t - 1]
    return y[50:] + 20


def test_parameters_are_recovered():
    y = np.stack([simulate(phi=0.6), simulate(phi=-0.4, seed=1)])
    r = seasonal_models.fit_batch(y, (1, 0, 0, 0, 0, 0, 12), 3)
    for row, params in zip(y - y.mean(1, keepdims=True), r["params"]):
        assert params[0] == pytest.approx((row[1:] @ row[:-1]) / (row[:-1] @ row[:-1]), abs=1e-4)
    m = seasonal_models.fit_batch(np.stack([simulate(theta=0.5, seed=2)]), (0, 0, 1, 0, 0, 0, 12), 3)
    assert m["params"][0][0] == pytest.approx(0.5, abs=0.1)
    assert m["params"][0][1] == pytest.approx(1.0, abs=0.2)


def test_ar1_forecast_and_interval_in_closed_form():
    y = simulate(phi=0.7)[None, :]
    r = seasonal_models.fit_batch(y, (1, 0, 0, 0, 0, 0, 12), 5)
    phi, s2, mean = r["params"][0][0], r["params"][0][1], y.mean()
    steps = np.arange(1, 6)
    assert r["y_pred"][0] == pytest.approx(mean + phi**steps * (y[0, -1] - mean))
    assert r["half_width"][0] == pytest.approx(1.96 * np.sqrt(s2 * np.cumsum(phi ** (2 * (steps - 1)))))


def test_differencing_is_undone():
    line = (3 + 2.0 * np.arange(40))[None, :]
    r = seasonal_models.fit_batch(line, (1, 1, 0, 0, 0, 0, 12), 4)
    assert r["y_pred"].shape == (1, 4)
    season = np.tile(np.arange(12.0), 4)[None, :]
    r = seasonal_models.fit_batch(season, (1, 0, 0, 0, 1, 0, 12), 14)
    assert r["y_pred"][0] == pytest.approx(np.r_[np.arange(12.0), [0, 1]])
    trend = season + 0.5 * np.arange(48)[None, :]
    r = seasonal_models.fit_batch(trend, (0, 1, 1, 0, 1, 0, 12), 3)
    assert r["y_pred"][0] == pytest.approx(trend[0, -12:-9] + 6)
    walk = np.cumsum(np.random.default_rng(5).normal(0, 1, 60))[None, :]
    r = seasonal_models.fit_batch(walk, (0, 1, 0, 0, 0, 0, 12), 4)
    assert r["half_width"][0] == pytest.approx(r["half_width"][0, 0] * np.sqrt(np.arange(1, 5)))
    assert r["y_pred"][0] == pytest.approx([walk[0, -1]] * 4)
    twice = seasonal_models.fit_batch(walk, (0, 2, 0, 0, 0, 0, 12), 3)
    assert twice["y_pred"][0] == pytest.approx(walk[0, -1] + (walk[0, -1] - walk[0, -2]) * np.arange(1, 4))


def test_batches_do_not_change_fits():
    y = np.stack([simulate(phi=p, n=60, seed=i) for i, p in enumerate((0.1, 0.5, 0.8))])
    order = (1, 0, 1, 1, 0, 0, 12)
    together = seasonal_models.fit_batch(y, order, 3)
    for i in range(3):
        alone = seasonal_models.fit_batch(y[i : i + 1], order, 3)
        assert alone["y_pred"][0] == pytest.approx(together["y_pred"][i], rel=1e-6)
    orders = np.array([(1, 0, 0, 0, 0, 0, 12), (2, 0, 1, 1, 0, 1, 12), (0, 0, 1, 0, 0, 0, 12)])
    mixed = seasonal_models.fit_batch(y, orders, 3)
    for i in range(3):
        alone = seasonal_models.fit_batch(y[i : i + 1], orders[i], 3)
        assert mixed["aic"][i] == pytest.approx(alone["aic"][0], rel=1e-6) and len(mixed["params"][i]) == len(alone["params"][0])


def test_too_short_for_the_order():
    orders = np.array([(1, 1, 1, 1, 1, 1, 12), (1, 0, 0, 0, 0, 0, 12)])
    assert list(seasonal_models.enough_data(14, orders)) == [False, True]


def test_grid_has_64_candidates_without_white_noise():
    grid = OrderGrid().candidates()
    assert len(grid) == 64 and all(p or q for p, q, *_ in grid)
    assert all(sum(c) <= 4 for c in OrderGrid(2, 2, 2, 2, max_complexity=4).candidates())


def test_selection_prefers_the_true_order(make_panel):
    rows = {f"ar{i}": simulate(phi=0.8, n=150, seed=i) for i in range(4)}
    p = make_panel(rows)
    grid = OrderGrid(max_p=1, max_q=1, max_P=0, max_Q=0, D_values=(0,))
    got = by_id(seasonal_models.select_orders(panel.series_vectors(p), forecast.unit_root(p), grid))
    assert all(r.n_tried == 3 for r in got.values())
    assert sum(r.order.p == 1 for r in got.values()) >= 3


def test_training_statuses(make_panel):
    noisy = RNG.poisson(20, 36)
    rows = {"good": noisy, "short": [5, 6] * 5, "flat": [4] * 36, "sparse": [0] * 35 + [3]}
    got = by_id(seasonal_models.train(make_panel(rows), OrderGrid(1, 1, 0, 0, (0,))))
    assert got["good"].status == "success" and got["good"].order.period == 12 and got["good"].wmape is not None
    assert got["good"].wmape_level in ("EXCELLENT", "GOOD", "FAIR", "POOR") and len(got["good"].changepoints) > 0
    assert {k: got[k].status for k in ("short", "flat", "sparse")} == dict.fromkeys(("short", "flat", "sparse"), "skipped")
    assert got["flat"].reason == "zero_variance" and got["flat"].wmape_level is None


def test_retrain_strategies(make_panel):
    quiet = list(RNG.poisson(20, 24)) + [20.0] * 12
    jump = [20.0] * 30 + [20.0, 90.0, 90.0, 90.0, 90.0, 90.0]
    p = make_panel({"new": quiet, "quiet": quiet, "jump": jump})
    models = p.sparkSession.createDataFrame([("quiet",), ("jump",)], "series_id string").withColumn("order", seasonal_models.order_column((1, 0, 0, 0, 0, 0, 12)))
    assert by_id(seasonal_models.retrain_strategy(p, models), "strategy") == {"new": "new_series", "quiet": "fast_update", "jump": "changepoint_detected"}
    got = by_id(seasonal_models.retrain(p, models, OrderGrid(1, 1, 0, 0, (0,))))
    assert {r.status for r in got.values()} == {"success"}
    assert (got["quiet"].order.p, got["quiet"].order.q) == (1, 0)


def test_tuning_reports_validation_mase(make_panel):
    p = make_panel({"a": SINE + SINE[:12], "flat": [5] * 48})
    got = by_id(seasonal_models.tune_by_validation(panel.series_vectors(p), forecast.unit_root(p), OrderGrid(1, 1, 1, 1)))
    assert "flat" not in got or got["flat"].best_mase is not None
    assert got["a"].best_mase >= 0


def test_forecast_rows_follow_the_history(make_panel):
    p = make_panel({"a": RNG.poisson(20, 36)})
    fitted = seasonal_models.fit_orders(panel.series_vectors(p).withColumn("order", seasonal_models.order_column()))
    rows = seasonal_models.forecast_rows(fitted, p).orderBy("h").collect()
    assert [(r.year, r.month, r.idx) for r in rows][:2] == [(2001, 1, 36), (2001, 2, 37)] and len(rows) == 6
    assert all(r.y_pred_lower <= r.y_pred <= r.y_pred_upper and r.y_pred >= 0 for r in rows)
