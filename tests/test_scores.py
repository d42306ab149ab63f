import hashlib

import numpy as np
import pytest
from helpers import by_id
from pyspark.sql import functions as F

from panelwright.catalog import QUERIES
from panelwright.config import FACTORS, SCORE100_WEIGHTS, BacktestRules
from panelwright.operators import backtest, changepoints, forecast, manifest, panel, ranking, scoring

RNG = np.random.default_rng(5)
SERIES = {f"s{i}": RNG.poisson(3 + i, 36).astype(float) for i in range(6)} | {"zero": np.zeros(36), "short_23": np.ones(23), "flat": np.full(36, 2.0)}


def expected_factors(y, ahead, wmape):
    recent = y[-12:].mean()
    f1 = ahead.mean() / recent if recent >= 0.01 else None
    f2 = 0.0 if wmape is None or wmape > 1000 else min(max(1 - wmape / 200, 0), 1)
    steady = []
    for m in range(12):
        v = y[m::12][: len(y) // 12]
        if v.std() > 0:
            steady.append(max(0, 1 - v.std() / (v.mean() + 0.01)))
    f3 = float(np.mean(steady)) if steady else 0.0
    ranges = [y[i : i + 12].max() - y[i : i + 12].min() for i in range(len(y) - 11)]
    f4 = 0.0 if y.mean() < 0.01 else min(np.mean(ranges) / y.mean(), 1.0)
    v = np.diff(y[-6:])
    a = np.diff(v)
    up = a[a > 0]
    rise = min(up.mean() / v.std(), 3) / 3 if len(up) and v.std() > 0 else 0.0
    return f1, f2, f3, f4, 0.5 * rise


def test_factors_against_numpy(spark, make_panel):
    p = make_panel(SERIES)
    f = forecast.seasonal_naive(p, 6)
    errors = spark.createDataFrame([(s, 50.0 if s != "s1" else 2000.0) for s in SERIES if s != "s2"], "series_id string, wmape double")
    got = by_id(scoring.five_factors(p, f, errors))
    assert "short_23" not in got and got["zero"].sparse_flag
    for s, y in SERIES.items():
        if s == "short_23":
            continue
        want = expected_factors(y, y[-12:-6], {"s1": 2000.0, "s2": None}.get(s, 50.0))
        for name, w in zip(FACTORS, want):
            assert got[s][name] == (None if w is None else pytest.approx(w, abs=1e-9)), (s, name)


def test_change_share_enters_the_fifth_factor(make_panel, spark):
    p = make_panel({"a": SERIES["s3"]})
    errors = spark.createDataFrame([("a", 10.0)], "series_id string, wmape double")
    share = spark.createDataFrame([("a", 1.0)], "series_id string, cp_prob double")
    f = forecast.seasonal_naive(p, 6)
    without, with_ = (scoring.five_factors(p, f, errors, s).first().f5_inflect for s in (None, share))
    assert with_ - without == pytest.approx(0.5)
    assert 0 <= scoring.change_share(panel.series_vectors(p)).first().cp_prob


def test_score_renormalises_missing_factors(spark):
    rows = [("all", 1.0, 0.5, 0.5, 0.5, 0.5, False), ("one_null", None, 0.5, 0.5, 0.5, 0.5, False), ("none", None, None, None, None, None, False), ("sparse", 9.0, 1.0, 1.0, 1.0, 1.0, True), ("over", 50.0, 1.0, 1.0, 1.0, 1.0, False)]
    df = spark.createDataFrame(rows, "series_id string, " + ", ".join(f"{c} double" for c in FACTORS) + ", sparse_flag boolean")
    got = by_id(df.withColumn("v", scoring.weighted_score()), "v")
    assert got == pytest.approx({"all": 0.6, "one_null": 0.5, "none": 0.0, "sparse": 0.0, "over": 1.0})
    scaled = by_id(scoring.normalised(df))
    assert scaled["over"].f1_ratio == 1.0 and scaled["all"].f1_ratio == 0.0 and scaled["one_null"].f1_ratio is None


def test_report_levels_and_rationale(spark):
    rows = [("a", 1.64, 0.1, 0.7, 0.9, 0.55, False), ("b", 0.5, 0.9, 0.1, 0.1, 0.0, False)]
    df = spark.createDataFrame(rows, "series_id string, " + ", ".join(f"{c} double" for c in FACTORS) + ", sparse_flag boolean")
    got = by_id(scoring.report(df))
    assert (got["a"].rank, got["a"].level, got["b"].level) == (1, "LOW_CONF", "LOW")
    assert got["a"].rationale == "증가율1.6x; 강한계절성0.70; 큰진폭0.90; 변곡위험0.55; 낮은신뢰도0.10"
    assert got["b"].rationale == "normal" and got["a"].candidate and not got["b"].candidate


def test_risk_month_takes_the_first_peak(spark):
    rows = [("a", 2024, 1, 5.0), ("a", 2024, 3, 7.0), ("a", 2024, 2, 7.0)]
    df = spark.createDataFrame(rows, "series_id string, year int, month int, y_pred double")
    assert scoring.risk_months(df).first().risk_month == "2024-02"
    joined = by_id(scoring.with_risk_months(spark.createDataFrame([("a",), ("b",)], "series_id string"), df))
    assert (joined["b"].risk_month, joined["b"].risk_value) == ("N/A", 0.0)


def test_score100(make_panel, spark):
    p = make_panel({"a": [4.0] * 30 + [4, 5, 6, 7, 8, 9], "tiny": [0.1] * 36})
    f = forecast.seasonal_naive(p, 6).withColumn("y_pred", F.lit(10.0) + 2.0 * F.col("h"))
    errors = spark.createDataFrame([("a", 30.0)], "series_id string, wmape double")
    got = by_id(scoring.score100(p, f, errors, SCORE100_WEIGHTS))
    assert set(got) == {"a"}
    a = got["a"]
    assert (a.growth_score, a.volatility_score, a.seasonality_score, a.acceleration_score) == (100.0, 100.0, 100.0, pytest.approx(100.0))
    assert a.confidence == 70.0 and a.expected_time == "2001-06" and a.expected_count == 22.0


# --- distributed order ----------------------------------------------------------------------------


def test_rank_is_exact_across_ranges(spark):
    n = 20_000
    df = spark.range(n).select(F.concat(F.lit("id"), F.lpad("id", 6, "0")).alias("series_id"), F.when(F.col("id") % 3 == 0, 0.0).otherwise((F.col("id") * 37 % 1000) / 1000).alias("score"))
    got = ranking.ranked(df, [-F.col("score")]).toPandas()
    want = got.sort_values(["score", "series_id"], ascending=[False, True], kind="stable").reset_index(drop=True)
    assert list(want["rank"]) == list(range(1, n + 1))


def test_ranges_are_even_under_ties(spark):
    df = spark.range(20_000).select(F.concat(F.lit("id"), F.lpad("id", 6, "0")).alias("series_id"), F.lit(0.0).alias("score"))
    sizes = [r["count"] for r in ranking.with_ranges(df, [F.col("score")], "series_id", ranges=32).groupBy("_range").count().collect()]
    assert len(sizes) == 32 and max(sizes) < 4 * 20_000 / 32


def test_small_and_empty_tables_are_ranked(spark):
    few = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "series_id string, score double")
    assert by_id(ranking.ranked(few, [-F.col("score")]), "rank") == {"a": 2, "b": 1}
    assert ranking.ranked(few.where("score > 9"), [-F.col("score")]).count() == 0


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(4)
    v = np.round(rng.gamma(2, 3, 5001), 2)
    df = ranking.checkpointed(spark.createDataFrame([(float(x), 1.5) for x in v], "v double, c double").union(spark.createDataFrame([(None, 1.5)], "v double, c double")))
    got = ranking.quantiles(df, {"med": ("v", 0.5), "q1": ("v", 0.25), "p93": ("v", 0.93), "const": ("c", 0.3)}).first()
    assert (got.med, got.q1, got.p93, got.const) == pytest.approx((*np.quantile(v, [0.5, 0.25, 0.93]), 1.5))
    assert ranking.quantiles(df.where("v < 0"), {"m": ("v", 0.5)}).first().m is None


# --- backtest -------------------------------------------------------------------------------------


def test_labels(make_panel):
    rows = {"up": [10] * 12 + [14] * 6, "flat": [10] * 18, "exact": [10] * 12 + [13] * 6, "short": [1] * 17}
    assert by_id(backtest.growth_labels(make_panel(rows)), "label") == {"up": 1, "flat": 0, "exact": 1, "short": 0}


def test_fold_cuts():
    assert backtest.fold_cuts(48) == [12, 24, 36]


def test_precision_recall_and_area(spark):
    rng = np.random.default_rng(1)
    score, label = np.round(rng.random(300), 2), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(float(s), int(v)) for s, v in zip(score, label)], "score double, label int")
    curve = backtest.precision_recall(df)
    points = {r.threshold: (r.precision, r.recall) for r in curve.collect()}
    area, before = 0.0, (1.0, 0.0)
    best = (-1.0, None)
    for t in sorted(set(score), reverse=True):
        hit = score >= t
        prec, rec = label[hit].mean(), label[hit].sum() / label.sum()
        assert points[t] == pytest.approx((prec, rec))
        area += (rec - before[1]) * (prec + before[0]) / 2
        before = (prec, rec)
        f1 = 2 * prec * rec / (prec + rec + 1e-10)
        if f1 >= best[0]:
            best = (f1, t)
    s = backtest.curve_summary(curve).first()
    assert s.pr_auc == pytest.approx(area) and (s.f1, s.threshold) == pytest.approx(best)


def test_weights_of_separable_clusters(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        v = i % 2
        rows.append((v + 0.05 * rng.normal(), 0.0, rng.random(), rng.random(), rng.random(), v))
    df = spark.createDataFrame([tuple(map(float, r[:5])) + (r[5],) for r in rows], ", ".join(f"{c} double" for c in FACTORS) + ", label int")
    r = backtest.learn_weights(df)
    assert sum(r["weights"].values()) == pytest.approx(1.0)
    assert r["weights"]["f1_ratio"] == max(r["weights"].values()) and r["weights"]["f2_conf"] == 0.0
    assert r["f1"] == pytest.approx(1.0, abs=1e-6) and r["pr_auc"] == pytest.approx(1.0)
    X = np.array([r_[:5] for r_ in rows])
    Z = np.where(X.std(0) > 0, (X - X.mean(0)) / np.where(X.std(0) > 0, X.std(0), 1), 0)
    y = np.array([r_[5] for r_ in rows])
    w, b = np.zeros(5), 0.0
    for _ in range(200):  # Newton steps on the same penalised likelihood
        pr = 1 / (1 + np.exp(-(Z @ w + b)))
        A = np.c_[Z, np.ones(60)]
        H = A.T @ (A * (pr * (1 - pr))[:, None]) + np.diag([1.0] * 5 + [1e-9])
        step = np.linalg.solve(H, A.T @ (pr - y) + np.r_[w, 0])
        w, b = w - step[:5], b - step[5]
    want = np.abs(w) / np.abs(w).sum()
    assert [r["weights"][c] for c in FACTORS] == pytest.approx(list(want), abs=1e-3)


def test_few_rows_keep_the_prior(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0, 0.0, 0.0, 1)] * 5, ", ".join(f"{c} double" for c in FACTORS) + ", label int")
    assert backtest.learn_weights(df)["weights"] == BacktestRules().weights


def test_folds_and_average(make_panel, spark, tmp_path):
    rng = np.random.default_rng(9)
    rows = {f"s{i}": rng.poisson(6 + 4 * (i % 3), 60) for i in range(40)}
    folds = backtest.backtest_folds(make_panel(rows), 60)
    assert {r.fold for r in folds.collect()} <= {1, 2, 3} and folds.count() >= 2
    avg = backtest.average_folds(folds).first()
    assert sum(avg[f"w_{c}"] for c in FACTORS) == pytest.approx(1.0)
    assert avg.success == (avg.f1_mean >= 0.75)
    backtest.write_config(backtest.average_folds(folds), str(tmp_path / "cfg"))
    assert set(spark.read.json(str(tmp_path / "cfg")).columns) == {"weights", "cutoff", "metric", "cv", "updated"}


def test_point_in_time_uses_only_the_past(make_panel):
    y = SERIES["s4"].copy()
    a = by_id(backtest.point_in_time(make_panel({"a": y}), [24], proxy="forecast"))["a"]
    y[30:] = 999
    b = by_id(backtest.point_in_time(make_panel({"a": y}), [24], proxy="forecast"))["a"]
    assert tuple(a) == tuple(b)
    with pytest.raises(ValueError):
        backtest.point_in_time(make_panel({"a": y}), [24], proxy="x")


# --- manifests ------------------------------------------------------------------------------------


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    one = manifest.fingerprint(df).first()
    assert manifest.fingerprint(df.orderBy(F.rand(1)).repartition(7).select("v", "id")).first() == one
    assert manifest.fingerprint(df.where("id < 99")).first() != one
    assert manifest.fingerprint(df.union(df)).first().data_hash != manifest.fingerprint(df.where("id < 0")).first().data_hash


def test_manifest_comparison(spark):
    df = spark.range(5)
    a = manifest.manifest(spark, "a", {"seed": 1, "cv_scheme": "x"}, df)
    b = manifest.manifest(spark, "b", {"seed": 2, "cv_scheme": "x", "extra": 1}, df)
    cmp = manifest.compare_manifests(a, b)
    assert {r.key for r in cmp.where("NOT same").collect()} == {"seed", "extra"}
    r = manifest.reproducible(cmp).first()
    assert (r.data_match, r.cv_match, r.seed_match, r.reproducible) == (True, True, False, False)


def test_fingerprint_of_odd_values(spark):
    """Sums modulo 2^64 of the halves of each row's MD5, with nulls and the signs that join the columns."""
    rows = [(k, None if k % 5 == 0 else f"a|{k}%7C%", k % 2 == 0) for k in range(300)] + [(None, "", None)] * 3
    cell = lambda v: "" if v is None else "=" + str(v).replace("%", "%25").replace("|", "%7C")
    prints = [hashlib.md5("|".join([cell(n), cell(s), "" if b is None else f"={str(b).lower()}"]).encode()).hexdigest() for n, s, b in rows]
    want = "-".join(f"{sum(int(h[a : a + 16], 16) for h in prints) % 2**64:016x}" for a in (0, 16))
    df = spark.createDataFrame(rows, "a int, b string, c boolean")
    assert tuple(manifest.fingerprint(df).first()) == (len(rows), want)
    assert tuple(manifest.fingerprint(df.limit(0)).first()) == (0, "0" * 16 + "-" + "0" * 16)


def test_compared_runs_are_dealt_to_all_tasks(spark, monkeypatch):
    """The second run's rows go to as many partitions as the session shuffles into, not to a fixed few."""
    seen, real = [], manifest.manifest
    monkeypatch.setattr(manifest, "manifest", lambda s, run_id, settings, data: seen.append(data) or real(s, run_id, settings, data))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert QUERIES["manifest_comparison"](spark, "/root/testdata/sf0.001").where("key = 'data_hash' AND same").count() == 1
        assert seen[1].rdd.getNumPartitions() == 7
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_penalty_rules(make_panel):
    v = panel.series_vectors(make_panel({"a": SERIES["s5"]}))
    ends = changepoints.penalised_segments(v, rule="10").first().segment_ends
    assert ends[-1] == 36


def test_move_share(make_panel):
    """A level shift just before the end counts in the fifth factor."""
    from panelwright.operators import scoring

    flat = [5.0, 6.0] * 18
    shifted = flat[:30] + [40.0 + k for k in range(6)]
    got = by_id(scoring.move_share(make_panel({"flat": flat, "shifted": shifted})), "cp_prob")
    assert got["flat"] == 0.0 and 0.0 < got["shifted"] <= 1.0
