import numpy as np
import pytest
from helpers import by_id
from pyspark.sql import functions as F

from panelwright.config import KpiGate
from panelwright.functions import labels
from panelwright.operators import accuracy, corrections, forecast, reports

RNG = np.random.default_rng(11)


def compare(spark, series, start=(2001, 1)):
    """Comparison table from {series_id: [(actual, forecast), ...]}."""
    rows = [(s, start[0], start[1] + i, i, len(v), float(y), float(p), float(p) - 2, float(p) + 2) for s, v in series.items() for i, (y, p) in enumerate(v)]
    df = spark.createDataFrame(
        rows, "series_id string, year int, month int, idx int, n int, claim_count double, y_pred double, y_pred_lower double, y_pred_upper double"
    )
    return corrections.refreshed(df, F.col("y_pred"))


def test_metric_degeneracies(spark):
    df = compare(spark, {"perfect": [(3, 3), (4, 4)], "all_zero": [(0, 1), (0, 2)], "nothing": [(0, 0), (0, 0)], "mixed": [(10, 8), (0, 5), (20, 30)]})
    m = by_id(accuracy.metrics_by(df, "series_id"))
    assert (m["perfect"].wmape, m["perfect"].smape, m["perfect"].bias, m["perfect"].rmse) == (0, 0, 0, 0)
    assert m["all_zero"].wmape is None and m["all_zero"].bias is None and m["all_zero"].smape == pytest.approx(200)
    assert m["nothing"].smape is None
    assert m["mixed"].wmape == pytest.approx(12 / 30 * 100)
    assert m["mixed"].bias == pytest.approx((8 / 2) / 15 * 100)
    assert m["mixed"].mae == pytest.approx(17 / 3)
    f = by_id(accuracy.fraction_metrics_by(df, "series_id"))
    assert f["all_zero"].bias is None and f["mixed"].mape == pytest.approx((0.2 + 0.5) / 2)
    e = by_id(accuracy.evaluation(df, "series_id"))
    y, p = np.array([10, 0, 20.0]), np.array([8, 5, 30.0])
    assert e["mixed"].r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert e["nothing"].r2 is None


def test_mase_scales(spark, make_panel):
    train = make_panel({"long": [1, 5] * 10, "short": [1, 3, 6]})
    scale = by_id(accuracy.naive_scale(train, 12), "naive_mae")
    assert scale == {"long": 0.0, "short": 2.5}
    m = spark.createDataFrame([("long", 2.0), ("short", 5.0)], "series_id string, mae double")
    assert by_id(accuracy.with_mase(m, accuracy.naive_scale(train, 12)), "mase") == {"long": None, "short": 2.0}


def test_gate_fails_on_unknown(spark):
    gate = KpiGate()
    assert accuracy.kpi(compare(spark, {"a": [(100, 101)]}), gate).first().passed
    assert not accuracy.kpi(compare(spark, {"a": [(0, 1)]}), gate).first().passed


def test_left_comparison_counts_missing_as_zero(spark, make_panel):
    actual = make_panel({"a": [4, 0]})
    f = spark.createDataFrame([("a", 1998, 2, 3.0)], "series_id string, year int, month int, y_pred double")
    rows = accuracy.compare_left(actual, f).orderBy("month").collect()
    assert [(r.error, r.pct_error) for r in rows] == [(4.0, 100.0), (-3.0, 0.0)] and rows[0].y_pred is None


def test_positional_join(spark):
    actual = spark.createDataFrame([("a", 1, 5.0), ("a", 3, 7.0), ("a", 9, 1.0)], "series_id string, week int, claim_count double")
    arrays = spark.createDataFrame([("a", [4.0, 5.0, 6.0])], "series_id string, yhat array<double>")
    got = accuracy.match_by_position(actual, arrays)
    assert sorted((r.week, r.y_pred) for r in got.collect()) == [(1, 4.0), (3, 6.0)]
    docs = accuracy.evaluation_documents(got.withColumn("series_id", F.lit("P|C|M"))).first()
    assert docs.weeks_evaluated == [1, 3] and docs.plant == "P" and docs.metrics.n_points == 2


def test_retrain_rules(spark):
    rows = {f"s{i}": [(100, 100)] for i in range(20)} | {"off": [(100, 40)], "small": [(1, 1.4)], "big": [(50, 70)]}
    got = {r.series_id for r in accuracy.retrain_candidates(compare(spark, rows)).collect()}
    assert got == {"off", "small", "big"}


def plain_reliability(y, p, lo, hi):
    high, low = y.max() * 1.5, max(0.0, y.min() * 0.5)
    p, lo, hi = (np.clip(v, low, high) for v in (p, lo, hi))
    mae, rmse = np.abs(y - p).mean(), np.sqrt(((y - p) ** 2).mean())
    width = (hi - lo).mean() / max(1e-6, 2 * y.std())
    inside = ((y >= lo) & (y <= hi)).mean()
    swing = (p.std() / (p.mean() + 1e-10)) / (y.std() / (y.mean() + 1e-10) + 1e-10)
    parts = [
        max(0, 100 * (1 - mae / (y.mean() + y.std()))),
        max(0, 100 * (1 - rmse / (y.mean() + 2 * y.std()))),
        100 * np.exp(-abs(np.log2(width))) if width > 0 else 0,
        100 * np.exp(-abs(0.95 - inside)),
        100 * np.exp(-abs(np.log2(swing + 1e-10))),
    ]
    return float(np.dot(parts, [0.25, 0.25, 0.2, 0.2, 0.1]))


def test_reliability(spark):
    y, p = RNG.poisson(30, 8).astype(float), RNG.poisson(30, 8).astype(float)
    got = accuracy.reliability(compare(spark, {"a": list(zip(y, p))})).first()
    assert got.reliability_score == pytest.approx(plain_reliability(y, p, p - 2, p + 2))


def test_residual_diagnostics(spark):
    e = RNG.normal(0, 1, 60)
    got = accuracy.residual_diagnostics(compare(spark, {"a": [(v + 10, 10) for v in e], "few": [(1, 2)] * 9})).collect()
    assert [r.series_id for r in got] == ["a"]
    c = e - e.mean()
    q = sum((c[k:] @ c[:-k] / (c @ c)) ** 2 / (60 - k) for k in range(1, 11)) * 60 * 62
    tail = np.exp(-q / 2) * sum((q / 2) ** k / np.prod(np.arange(1, k + 1)) for k in range(5))
    assert got[0].ljungbox_pvalue == pytest.approx(tail)
    skew, kurt = (c**3).mean() / c.std() ** 3, (c**4).mean() / c.std() ** 4 - 3
    assert got[0].normality_pvalue == pytest.approx(np.exp(-(60 / 6 * (skew**2 + kurt**2 / 4)) / 2))


def test_levels(spark):
    df = spark.createDataFrame([(19.9,), (20.0,), (99.0,), (100.0,), (None,)], "v double")
    assert [r[0] for r in df.select(labels.performance_level("wmape", F.col("v"))).collect()] == ["EXCELLENT", "GOOD", "FAIR", "POOR", "UNKNOWN"]
    df = spark.createDataFrame([(-4.0,), (-6.0,), (15.0,), (-30.0,)], "v double")
    assert [r[0] for r in df.select(labels.performance_level("bias", F.col("v"))).collect()] == ["EXCELLENT", "GOOD", "FAIR", "POOR"]


# --- corrections ----------------------------------------------------------------------------------


def test_series_bias_needs_four_rows(spark):
    df = compare(spark, {"four": [(10, 8)] * 4, "three": [(10, 8)] * 3, "low": [(0, 1)] * 4 })
    got = corrections.apply_series_bias(df)
    assert {(r.series_id, r.y_pred) for r in got.collect()} == {("four", 10.0), ("three", 8.0), ("low", 0.0)}
    gain = corrections.improvement(df, got).first()
    assert gain.before_mae > gain.after_mae and gain.improvement_pct > 0


def test_position_bias_leaves_unseen_positions(spark):
    fit = compare(spark, {"a": [(10, 8), (5, 6)]})
    target = compare(spark, {"a": [(0, 1), (0, 1), (0, 1)]})
    got = corrections.apply_position_bias(target, corrections.position_bias(fit))
    assert [r.y_pred for r in got.orderBy("month").collect()] == [3.0, 0.0, 1.0]


def test_seasonal_factors_by_phase(make_panel):
    y = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12] * 3
    p = make_panel({"a": y, "short": y[:11], "zero": [0] * 36})
    calendar = {(r.series_id, r.position): r.factor for r in corrections.seasonal_factors(p).collect()}
    assert calendar["a", 0] == pytest.approx(1 / 6.5) and calendar["zero", 3] == 1.0
    assert ("short", 0) not in calendar
    shifted = make_panel({"a": y}, start=(1998, 4))
    slice_ = {r.position: r.factor for r in corrections.seasonal_factors(shifted, phase="slice").collect()}
    assert slice_[0] == pytest.approx(1 / 6.5)
    by_month = {r.position: r.factor for r in corrections.seasonal_factors(shifted).collect()}
    assert by_month[3] == pytest.approx(1 / 6.5)


def test_seasonal_component_of_a_pure_season(make_panel):
    wave = [5 * np.sin(2 * np.pi * i / 12) for i in range(36)]
    p = make_panel({"a": [10 + w for w in wave]})
    got = {r.position: r.seasonal for r in corrections.seasonal_component(p).collect()}
    assert [got[i] for i in range(12)] == pytest.approx(wave[:12], abs=1e-9)


def test_seasonal_shift_modes(spark, make_panel):
    wave = [5 * np.sin(2 * np.pi * i / 12) for i in range(36)]
    h = make_panel({"a": [10 + w for w in wave], "flat": [4] * 36, "short": wave[:20]})
    df = compare(spark, {s: [(10, 10)] * 6 for s in ("a", "flat", "short")}).withColumn("idx", F.col("idx") + 36)
    mean = {(r.series_id, r.month): r.y_pred for r in corrections.apply_seasonal_shift(df, h).collect()}
    assert all(v == pytest.approx(10, abs=1e-9) for v in mean.values())
    each = {(r.series_id, r.month): r.y_pred for r in corrections.apply_seasonal_shift(df, h, mode="per_position").collect()}
    assert [each["a", m] for m in range(1, 7)] == pytest.approx([10 + w / 2 for w in wave[:6]])
    assert each["flat", 2] == 10 and each["short", 2] == 10


def test_worst_series_bounds(spark):
    rows = {f"s{i:03d}": [(10, 10 + i)] * 6 for i in range(150)}
    got = corrections.worst_series(compare(spark, rows), min_obs=6)
    assert [r.series_id for r in got.orderBy(F.col("mape").desc()).collect()] == [f"s{i:03d}" for i in range(149, 139, -1)]
    few = corrections.worst_series(compare(spark, dict(list(rows.items())[:7])), min_obs=6)
    assert few.count() == 5


def test_staged_correction_stops_at_the_gate(spark, make_panel):
    h = make_panel({"a": RNG.poisson(50, 36)})
    good, trail = corrections.staged_correction(compare(spark, {"a": [(100, 100)] * 6}), h)
    assert [t["stage"] for t in trail] == ["start"] and good.count() == 6
    fixed, trail = corrections.staged_correction(compare(spark, {"a": [(100, 70)] * 6}), h)
    assert [t["stage"] for t in trail] == ["start", "bias"] and trail[-1]["passed"]
    rough = [(100, 10), (10, 100)] * 3
    _, trail = corrections.staged_correction(compare(spark, {"a": rough}), h)
    assert [t["stage"] for t in trail] == ["start", "bias", "seasonal", "reselect"]


@pytest.mark.parametrize("pairs", [[(100, 100)] * 6, [(100, 70)] * 6, [(100, 10), (10, 100)] * 3])
def test_stage_trail_agrees_with_the_stepwise_job(spark, make_panel, pairs):
    h = make_panel({"a": RNG.poisson(50, 36)})
    stages = ("bias", "seasonal")
    last, steps = corrections.staged_correction(compare(spark, {"a": pairs}), h, stages=stages)
    staged = corrections.staged_columns(compare(spark, {"a": pairs}), h, stages)
    rows = corrections.stage_trail(staged, stages).orderBy("step").collect()
    assert [r.stage for r in rows if r.applied] == [t["stage"] for t in steps]
    for r, t in zip(rows, steps):
        assert (r.passed, r.mape, r.mae) == (t["passed"], pytest.approx(t["mape"]), pytest.approx(t["mae"]))
    final = {(r.year, r.month): r[f"y_{steps[-1]['stage']}"] for r in staged.collect()}
    assert final == pytest.approx({(r.year, r.month): r.y_pred for r in last.collect()})


def test_reselection_refreshes_the_forecast(spark, make_panel):
    h = make_panel({"a": RNG.poisson(50, 36), "b": RNG.poisson(50, 36)})
    df = compare(spark, {"a": [(50, 500)] * 6, "b": [(50, 51)] * 6})
    from panelwright.config import OrderGrid

    got = {r.series_id: r.y_pred for r in corrections.reselect_worst(df, h, OrderGrid(1, 0, 0, 0, (0,))).collect()}
    assert got["a"] < 100


def test_stable_correction_runs_on_changed_series(spark, make_panel):
    step = np.r_[RNG.normal(20, 1, 18), RNG.normal(60, 1, 18)]
    h = make_panel({"step": step, "calm": RNG.normal(20, 1, 36)})
    fitted = h.select("series_id", "year", "month", "idx", "n", "claim_count", (F.col("claim_count") - 3).alias("y_pred"))
    target = compare(spark, {s: [(30, 20)] * 6 for s in ("step", "calm")}).withColumn("idx", F.col("idx") + 36)
    got = corrections.stable_correction(fitted, target, h)
    assert got.count() == 12 and all(r.y_pred > 0 for r in got.collect())


def test_month_changes_and_coverage(make_panel, spark):
    df = compare(spark, {"a": [(10, 9), (10, 5)], "b": [(4, 4), (4, 4)]})
    history = reports.month_history(df, accuracy.retrain_candidates(df))
    rows = reports.month_changes(history).orderBy("period").collect()
    assert rows[0].mae_change is None and rows[1].mae_change == pytest.approx(2.0)
    cover = {r.month: r for r in reports.coverage(make_panel({f"s{i}": [1] * (12 if i < 5 else 6) for i in range(10)}), [1998]).collect()}
    assert (cover[1].s1998, cover[12].y1998, cover[12].s1998) == ("full", 5, "partial")


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    got = {r.bin: r.n for r in reports.histogram(df, "v", 10).collect()}
    assert sum(got.values()) == 11 and got[9] == 2
    same = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert reports.histogram(same, "v").first().n == 2


def test_fallback_rate_takes_the_primary_model(spark):
    rows = [("a", "seasonal"), ("a", "seasonal"), ("a", "fallback_naive"), ("b", "fallback_naive")]
    got = reports.fallback_rate(spark.createDataFrame(rows, "series_id string, model string")).first()
    assert (got.n_series, got.n_fallback, got.fallback_pct) == (2, 1, 50.0)
    assert forecast.DEFAULT_Z == 1.96
