import itertools

import numpy as np
import pytest
from helpers import by_id
from pyspark.sql import functions as F

from panelwright.config import GuardRules
from panelwright.operators import changepoints, features, guards, panel

RNG = np.random.default_rng(7)
RANDOM = {f"r{i}": RNG.poisson(6, 36).astype(float) for i in range(6)} | {"flat": np.full(36, 3.0), "zero": np.zeros(36)}


def column(df, name):
    out = {}
    for r in df.select("series_id", "idx", name).collect():
        out.setdefault(r.series_id, {})[r.idx] = r[name]
    return {k: [v[i] for i in sorted(v)] for k, v in out.items()}


def test_rolling_psi_and_amplitude(make_panel):
    p = make_panel(RANDOM)
    psi, amp = column(features.rolling_psi(p), "psi"), column(features.rolling_amplitude(p), "amplitude")
    for sid, y in RANDOM.items():
        for i in range(36):
            seg = y[i - 12 : i]
            sd = np.std(seg) if i >= 12 else 0.0
            assert amp[sid][i] == pytest.approx(sd, abs=1e-9)
            assert psi[sid][i] == pytest.approx(sd / seg.mean() if i >= 12 and seg.mean() > 0 else 0.0, abs=1e-9)


def test_difference_flags(make_panel):
    y = [5.0, 6.0] * 10 + [40.0] + [5.0, 6.0] * 5
    got = column(features.difference_flags(make_panel({"a": y})), "changepoint")["a"]
    assert got[20] == 1 and sum(got[:20]) == 0


def test_centred_changepoints(make_panel):
    import pandas as pd

    got = by_id(features.centred_changepoints(make_panel(RANDOM)))
    for sid, y in RANDOM.items():
        # equal moves differ in their last bits by how they were summed: compare at nine decimals
        moves = pd.Series(y).rolling(6, center=True).mean().diff().abs().round(9)
        want = [int(i) for i in np.where(moves > round(moves.quantile(0.75), 9))[0]]
        assert got[sid].changepoints == want
        assert got[sid].has_recent == any(i >= 30 for i in want)
    assert by_id(features.centred_changepoints(make_panel({"short": range(11)})))["short"].changepoints == []


def brute_peaks(y, min_prominence):
    out = []
    n = len(y)
    i = 1
    while i < n - 1:
        j = i
        while j < n - 1 and y[j + 1] == y[i]:
            j += 1
        if y[i - 1] < y[i] and j < n - 1 and y[j + 1] < y[i]:
            k = (i + j) // 2
            l, left = k, y[k]
            while l >= 0 and y[l] <= y[k]:
                left = min(left, y[l])
                l -= 1
            r, right = k, y[k]
            while r < n and y[r] <= y[k]:
                right = min(right, y[r])
                r += 1
            prom = y[k] - max(left, right)
            if prom >= min_prominence:
                level = y[k] - prom / 2
                a = k
                while a > l + 1 and y[a] > level:
                    a -= 1
                left_x = a + (level - y[a]) / (y[a + 1] - y[a]) if y[a] < level else float(a)
                b = k
                while b < r - 1 and y[b] > level:
                    b += 1
                right_x = b - (level - y[b]) / (y[b - 1] - y[b]) if y[b] < level else float(b)
                out.append((k, prom, right_x - left_x))
        i = j + 1
    return out


def test_peaks_against_a_walk(make_panel):
    cases = {f"p{i}": RNG.integers(0, 6, 30).astype(float) for i in range(30)} | {"plateau": [0, 2, 2, 2, 0, 5, 5, 5, 5], "up": range(5)}
    got = features.peaks(panel.series_vectors(make_panel(cases))).collect()
    for sid, y in cases.items():
        mine = sorted((r.idx, r.prominence, r.width) for r in got if r.series_id == sid)
        want = brute_peaks(list(map(float, y)), 1.0)
        assert len(mine) == len(want)
        for a, b in zip(mine, want):
            assert a == pytest.approx(b)


def test_recent_alert(make_panel):
    rows = {"calm": [5, 6] * 8, "jump": [5, 6] * 6 + [20] * 4, "short": [1] * 15, "flat": [3] * 16}
    got = by_id(features.recent_alert(make_panel(rows)))
    assert got["jump"].alert and not got["calm"].alert and not got["short"].alert
    assert got["short"].recent is None and got["flat"].score == 0.0


def test_cusum_equals_the_recursion(make_panel):
    got = changepoints.cusum(make_panel(RANDOM))
    up, down, flag = (column(got, c) for c in ("cusum_pos", "cusum_neg", "changepoint"))
    for sid, y in RANDOM.items():
        if y.std() == 0:
            assert not any(flag[sid])
            continue
        a = b = 0.0
        for i in range(36):
            if i:
                z = (y[i] - y.mean()) / y.std()
                a, b = max(0, a + z - 0.5), max(0, b - z - 0.5)
            assert up[sid][i] == pytest.approx(a, abs=1e-9) and down[sid][i] == pytest.approx(b, abs=1e-9)


def brute_stable(cps, n, margin):
    if not cps:
        return [(0, n)]
    out = [(0, cps[0] - margin)] if cps[0] > margin else []
    out += [(a + margin, b - margin) for a, b in zip(cps, cps[1:]) if b - margin > a + margin]
    if cps[-1] + margin < n:
        out.append((cps[-1] + margin, n))
    return out


def test_t_test_flags_and_stable_regions(make_panel):
    step = np.concatenate([RNG.normal(5, 1, 18), RNG.normal(15, 1, 18)])
    rows = RANDOM | {"step": step, "clean": [1.0] * 18 + [2.0] * 18, "short": np.arange(19)}
    flags = changepoints.t_test_flags(make_panel(rows))
    found = column(flags, "changepoint")
    for sid, y in rows.items():
        y = np.asarray(y, float)
        for i in range(len(y)):
            want = False
            if len(y) >= 20 and 10 <= i < len(y) - 10:
                b, a = y[i - 10 : i], y[i : i + 10]
                se = np.sqrt((b.var(ddof=1) + a.var(ddof=1)) / 10)
                want = b.mean() != a.mean() if se == 0 else abs(b.mean() - a.mean()) / se > 2.878440472738608
            assert found[sid][i] == want
    regions = changepoints.stable_regions(flags).collect()
    kept = changepoints.stable_rows(flags).collect()
    for sid, y in rows.items():
        cps = [i for i, f in enumerate(found[sid]) if f]
        want = brute_stable(cps, len(y), 5)
        assert sorted((r.begin, r["end"]) for r in regions if r.series_id == sid) == want
        assert sorted(r.idx for r in kept if r.series_id == sid) == [i for a, b in want for i in range(a, b)]


def kernel_cost(y, a, b):
    gaps = (y[:, None] - y[None, :]) ** 2
    typical = np.median(gaps[np.triu_indices(len(y), 1)])
    k = np.exp(-np.clip(gaps * (1 / typical if typical else 1.0), 1e-2, 1e2))
    np.fill_diagonal(k, 1.0)
    return (b - a) - k[a:b, a:b].sum() / (b - a)


def test_segmentation_is_optimal():
    for y in (RNG.normal(0, 1, 11), np.r_[RNG.normal(0, 1, 6), RNG.normal(9, 1, 6)], np.zeros(9)):
        n, pen = len(y), 0.8
        best = None
        for k in range(0, n // 3):
            for cuts in itertools.combinations(range(3, n - 2), k):
                ends = [0, *cuts, n]
                if min(b - a for a, b in zip(ends, ends[1:])) < 3:
                    continue
                cost = sum(kernel_cost(y, a, b) + pen for a, b in zip(ends, ends[1:]))
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, ends[1:])
        got = changepoints.segment_ends(y[None, :], np.array([pen]), 3)[0]
        cost = sum(kernel_cost(y, a, b) + pen for a, b in zip([0, *got], got))
        assert cost == pytest.approx(best[0]) and got[-1] == n


def test_change_share_counts_the_end(spark):
    rows = [("one", [1.0] * 20, [20]), ("late", [1.0] * 20, [16, 20]), ("early", [1.0] * 20, [5, 20]), ("both", [1.0] * 20, [5, 16, 20])]
    df = spark.createDataFrame(rows, "series_id string, ys array<double>, segment_ends array<int>")
    assert by_id(changepoints.recent_change_share(df), "cp_prob") == {"one": 0.0, "late": 2.0, "early": 1.0, "both": 1.0}
    assert by_id(changepoints.listed_changepoints(df), "changepoints")["both"] == [4, 15]


def test_segmentation_job_handles_mixed_lengths(spark, make_panel):
    rows = {"step": np.r_[np.zeros(15), np.full(15, 8.0)], "tiny": [1, 2, 3], "flat": np.full(20, 2.0)}
    got = by_id(changepoints.penalised_segments(panel.series_vectors(make_panel(rows)), rule="1.0"), "segment_ends")
    assert got == {"step": [15, 30], "tiny": [3], "flat": [20]}


def test_guards(make_panel):
    rules = GuardRules(window=12, period=12, expected_length=36)
    season = [10 + 8 * np.sin(2 * np.pi * i / 12) for i in range(36)]
    rows = {"sparse": [0] * 30 + [1] * 6, "season": season, "drift": [5, 6] * 12 + [50] * 12, "short": [1, 2] * 5, "spike": [5, 6] * 17 + [5, 500], "holes": [1.0, None] * 18}
    got = by_id(guards.guard_table(make_panel(rows), rules))
    assert got["sparse"].is_sparse and "USE_NAIVE_MODEL" in got["sparse"].recommendations
    assert got["season"].has_seasonality and got["season"].seasonality_strength == pytest.approx(1.0)
    assert got["drift"].has_drift and got["short"].mean_shift_sigma is None and not got["short"].is_complete
    assert got["spike"].has_outliers and got["spike"].outlier_ratio == pytest.approx(1 / 36)
    assert not got["holes"].is_complete
    kept = guards.apply_guards(make_panel(rows), guards.guard_table(make_panel(rows), rules))
    assert {r.series_id for r in kept.select("series_id").distinct().collect()} == {"season", "drift", "spike"}


def test_outlier_methods(make_panel):
    p = make_panel({"a": [5, 6] * 17 + [5, 500]})
    for method in ("iqr", "zscore"):
        assert [r.idx for r in guards.outlier_positions(p, method).collect()] == [35]
    with pytest.raises(ValueError):
        guards.outlier_positions(p, "other")


def test_eligibility_reasons(make_panel):
    rows = {"short_11": [1] * 11, "short_12": [1, 2] * 6, "flat": [3] * 12, "thin": [0] * 30 + [10] * 6, "low": [0, 0, 1, 0] * 9}
    got = by_id(guards.model_eligibility(make_panel(rows)))
    assert got["short_11"].reason == "insufficient_data (only 11 months)"
    assert got["short_12"].status == "ok" and got["flat"].reason == "zero_variance"
    assert got["thin"].sparse_reason == "nonzero=16.7%<30%"
    assert got["low"].reason == "sparse_series (avg=0.25<0.5; nonzero=25.0%<30%)"


def test_value_gaps(spark):
    df = spark.sql("SELECT 'a' AS series_id, d FROM VALUES (DATE '2021-01-01'), (DATE '2021-01-11'), (DATE '2021-01-22') AS t(d)")
    assert [r.gap_days for r in features.value_gaps(df, "d").collect()] == [11]


def test_seasonal_index_of_zeros_is_one(make_panel):
    got = features.seasonal_index(make_panel({"zero": [0] * 24})).collect()
    assert {r.seasonal_factor for r in got} == {1.0} and len(got) == 12


def test_windows_share_one_shuffle(make_panel):
    p = make_panel(RANDOM).repartition(4, "series_id")
    chained = features.rolling_amplitude(features.rolling_psi(changepoints.cusum(p)))
    plan = chained._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert chained.agg(F.count("*")).first()[0] == 36 * len(RANDOM)


def test_outside_grid(spark):
    from panelwright.operators import panel

    counts = spark.createDataFrame([("s", 1994, 12, 2.0), ("s", 1995, 1, 3.0), ("s", 2001, 8, 4.0), ("s", 2001, 9, 5.0)], "series_id string, year int, month int, claim_count double")
    assert tuple(panel.outside_grid(counts, (2001, 8), (1995, 1)).first()) == (2, 7.0)
