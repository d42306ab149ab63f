"""Seasonal ARMA models per series: order selection, hold-out evaluation, forecasts, retraining.

Spark does the distribution: one row per (series, candidate order) carries the series as an array
bounded by the calendar, rows are spread evenly, and the choice of the best candidate is an
aggregate.  The Python part is one least-squares fit applied to Arrow batches, vectorised over the
rows of a batch that share length and differencing.

The estimator is conditional sum of squares on the differenced, centred series (residuals before the
first full lag set to zero), minimised by damped Gauss-Newton steps from zero.  AIC and BIC use the
Gaussian likelihood of those residuals.  It is not the exact likelihood, so parameters differ
slightly from a state-space fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.config import DEFAULT_Z, OrderGrid, SparseRule
from panelwright.functions import accuracy, calendar, labels
from panelwright.operators import features, forecast, guards

# seasonal parts are prefixed with s: column names do not tell upper from lower case
ORDER = "struct<p:int,d:int,q:int,sp:int,sd:int,sq:int,period:int>"
DEFAULT_ORDER = (1, 0, 1, 1, 0, 1, 12)
BATCH_ROWS = 2048

FIT_TYPE = "aic double, bic double, params array<double>, y_pred array<double>, half_width array<double>"


def _polynomial(low: np.ndarray, high: np.ndarray, s: int) -> np.ndarray:
    """Lag weights (rows, lags) of (1 - sum low_i B^i)(1 - sum high_j B^sj), as 1 - sum w_k B^k."""
    rows, p = low.shape
    P = high.shape[1]
    out = np.zeros((rows, p + s * P))
    out[:, :p] += low
    for j in range(P):
        out[:, s * (j + 1) - 1] += high[:, j]
        for i in range(p):
            out[:, s * (j + 1) + i] -= low[:, i] * high[:, j]
    return out


class _Layout:
    """Where the parameters of a batch of orders lie: one block per part, as wide as its largest
    order, with a mask of the parameters each row really has (the others stay 0)."""

    def __init__(self, orders: np.ndarray):
        parts = orders[:, [0, 2, 3, 5]]
        self.width = parts.max(0)
        self.edges = np.r_[0, self.width.cumsum()]
        self.mask = np.concatenate([np.arange(w)[None, :] < parts[:, [i]] for i, w in enumerate(self.width)], 1)
        self.period = int(orders[0, 6])

    def lags(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, q, P, Q = (theta[:, self.edges[i] : self.edges[i + 1]] for i in range(4))
        return _polynomial(p, P, self.period), _polynomial(q, Q, self.period)


def _residuals(x: np.ndarray, theta: np.ndarray, layout: _Layout) -> np.ndarray:
    """One-step errors of a batch, bounded so that unstable parameters stay finite."""
    ar, ma = layout.lags(theta)
    m = x.shape[1]
    e = np.zeros_like(x)
    for t in range(m):
        v = x[:, t].copy()
        k = min(t, ar.shape[1])
        if k:
            v -= np.einsum("rk,rk->r", ar[:, :k], x[:, t - k : t][:, ::-1])
        k = min(t, ma.shape[1])
        if k:
            v += np.einsum("rk,rk->r", ma[:, :k], e[:, t - k : t][:, ::-1])
        e[:, t] = np.clip(v, -1e8, 1e8)
    return e


def _fit_parameters(x: np.ndarray, layout: _Layout, steps: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Damped Gauss-Newton on the sum of squared residuals.

    Every row has its own damping and stops on its own, so its result does not depend on the rows it
    shares a batch with.
    """
    rows, k = layout.mask.shape
    theta, damping = np.zeros((rows, k)), np.full(rows, 1e-2)
    e = _residuals(x, theta, layout)
    sse = (e * e).sum(1)
    active = np.flatnonzero((sse > 0) & layout.mask.any(1))
    diagonal = np.arange(k)
    for _ in range(steps):
        if not len(active):
            break
        xa, ta, ea, mask = x[active], theta[active], e[active], layout.mask[active]
        nudged = (ta[None] + 1e-5 * np.eye(k)[:, None, :]).reshape(-1, k)
        moved = _residuals(np.tile(xa, (k, 1)), nudged, layout).reshape(k, len(active), -1)
        J = np.moveaxis((moved - ea) / 1e-5, 0, 2) * mask[:, None, :]
        A = np.einsum("rti,rtj->rij", J, J)
        g = np.einsum("rti,rt->ri", J, ea)
        A[:, diagonal, diagonal] += damping[active][:, None] * (A[:, diagonal, diagonal] + 1e-8) + np.where(mask, 1e-12, 1.0)
        trial = np.clip(ta - np.linalg.solve(A, g[:, :, None])[:, :, 0], -0.98, 0.98)
        trial_e = _residuals(xa, trial, layout)
        trial_sse = (trial_e * trial_e).sum(1)
        gain = sse[active] - trial_sse
        better = gain > 0
        won = active[better]
        theta[won], e[won], sse[won] = trial[better], trial_e[better], trial_sse[better]
        damping[active] = np.where(better, damping[active] / 3, damping[active] * 10)
        settled = np.where(better, gain <= 1e-7 * trial_sse, damping[active] > 1e5)
        active = active[~settled]
    return theta, e


def _difference(y: np.ndarray, d: int, D: int, s: int) -> np.ndarray:
    for _ in range(D):
        y = y[:, s:] - y[:, :-s]
    return np.diff(y, d, axis=1) if d else y


def enough_data(n: int, orders: np.ndarray) -> np.ndarray:
    """Which orders leave enough points of a series of length n after differencing."""
    p, d, q, P, D, Q, s = orders.T
    return n - d - s * D >= np.maximum(np.maximum(p + q + P + Q + 3, p + s * P + 1), 5)


def fit_batch(y: np.ndarray, orders, horizon: int) -> dict:
    """Fit rows of equal length, each with its own order; differencing and period are shared."""
    orders = np.broadcast_to(np.asarray(orders, dtype=int), (len(y), 7))
    d, D, s = (int(orders[0, i]) for i in (1, 4, 6))
    layout = _Layout(orders)
    seasonal = _difference(y, 0, D, s)
    w = np.diff(seasonal, d, axis=1) if d else seasonal
    m = w.shape[1]
    mean = w.mean(1, keepdims=True) if d + D == 0 else np.zeros((len(y), 1))
    theta, e = _fit_parameters(w - mean, layout)
    sigma2 = np.maximum((e * e).mean(1), 1e-10)
    ar, ma = layout.lags(theta)
    ahead = np.zeros((len(y), horizon))
    x, errors = np.concatenate([w - mean, ahead], 1), np.concatenate([e, ahead], 1)
    psi = np.zeros((len(y), horizon))  # response to one unit error
    for t in range(horizon):
        at = m + t
        kx, ke = min(at, ar.shape[1]), min(at, ma.shape[1])
        x[:, at] = (ar[:, :kx] * x[:, at - kx : at][:, ::-1]).sum(1) - (ma[:, :ke] * errors[:, at - ke : at][:, ::-1]).sum(1)
        psi[:, t] = 1.0 if t == 0 else (-ma[:, t - 1] if t <= ma.shape[1] else 0.0)
        k = min(t, ar.shape[1])
        psi[:, t] += (ar[:, :k] * psi[:, t - k : t][:, ::-1]).sum(1)
    # undo the differencing, for the path and for the response alike
    future, response = x[:, m:] + mean, psi
    for level in range(d - 1, -1, -1):
        future, response = np.diff(seasonal, level, axis=1)[:, -1:] + future.cumsum(1), response.cumsum(1)
    for level in range(D):
        path = np.concatenate([_difference(y, 0, D - 1 - level, s)[:, -s:], future], 1)
        unit = np.concatenate([np.zeros((len(y), s)), response], 1)
        for t in range(horizon):
            path[:, s + t] += path[:, t]
            unit[:, s + t] += unit[:, t]
        future, response = path[:, s:], unit[:, s:]
    k = layout.mask.sum(1)
    deviance = m * (np.log(2 * np.pi * sigma2) + 1)
    return {
        "aic": deviance + 2 * (k + 1),
        "bic": deviance + np.log(m) * (k + 1),
        "params": [np.r_[t[mask], v] for t, mask, v in zip(theta, layout.mask, sigma2)],
        "y_pred": future,
        "half_width": DEFAULT_Z * np.sqrt(sigma2[:, None] * (response**2).cumsum(1)),
    }


def _fitted(horizon: int):
    names = ["aic", "bic", "params", "y_pred", "half_width"]

    @F.pandas_udf(FIT_TYPE)
    def fit(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for ys, frame in batches:
            ys, orders = ys.reset_index(drop=True), frame.to_numpy(dtype=int)
            lengths = ys.map(len).to_numpy()
            out = {n: np.full(len(ys), None, dtype=object) for n in names}
            shared = np.c_[lengths, orders[:, [1, 4, 6]]]
            for key in np.unique(shared, axis=0):
                rows = np.flatnonzero((shared == key).all(1))
                rows = rows[enough_data(int(key[0]), orders[rows])]
                for at in range(0, len(rows), BATCH_ROWS):
                    part = rows[at : at + BATCH_ROWS]
                    result = fit_batch(np.stack([np.asarray(ys[i], dtype=float) for i in part]), orders[part], horizon)
                    for n in names:
                        for i, value in zip(part, result[n]):
                            out[n][i] = value
            yield pd.DataFrame(out).astype({"aic": float, "bic": float})

    # declared so that a filter on the result is not pushed below it, which would fit twice
    return fit.asNondeterministic()


def order_column(order=DEFAULT_ORDER) -> Column:
    names = ("p", "d", "q", "sp", "sd", "sq", "period")
    return F.struct(*[F.lit(v).cast("int").alias(n) for n, v in zip(names, order)])


def with_candidates(
    vectors: DataFrame, differencing: DataFrame, grid: OrderGrid = OrderGrid(), min_seasonal: int = 24
) -> DataFrame:
    """One row per series and candidate order; seasonal differencing only from two full seasons.

    The compact vectors are hashed by series into a fixed number of partitions (adaptive execution
    would merge them by bytes, but the work here is CPU), and unfold inside their task: the copies
    per candidate are never shuffled, and neither is the choice among them.
    """
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tried = F.array(
        *[
            F.struct(*[F.lit(v).alias(n) for n, v in zip(("p", "q", "sp", "sq", "sd"), c)])
            for c in grid.candidates()
        ]
    )
    c = F.col("_c")
    order = F.struct(
        c["p"].alias("p"),
        F.col("d").alias("d"),
        c["q"].alias("q"),
        *[c[name].alias(name) for name in ("sp", "sd", "sq")],
        F.lit(grid.period).alias("period"),
    )
    rows = (
        vectors.join(differencing.select("series_id", "d"), "series_id")
        .repartition(partitions, "series_id")
        .select("*", F.posexplode(tried).alias("candidate", "_c"))
    )
    allowed = (c["sd"] == 0) | (F.size("ys") >= min_seasonal)
    return rows.where(allowed).withColumn("order", order.cast(ORDER)).drop("_c", "d")


def fit_orders(rows: DataFrame, horizon: int = 6) -> DataFrame:
    """Fit `ys` with `order` on every row and add `fit` (null where there is too little data)."""
    return rows.withColumn("fit", _fitted(horizon)("ys", "order"))


def select_orders(vectors: DataFrame, differencing: DataFrame, grid: OrderGrid = OrderGrid()) -> DataFrame:
    """Order with the least AIC per series (ties to the earlier candidate) and its fit.

    The winner is an aggregate with map-side combine; the candidates are never sorted.
    """
    fits = fit_orders(with_candidates(vectors, differencing, grid)).where(F.col("fit.aic").isNotNull())
    key = F.struct(F.col("fit.aic").alias("aic"), "candidate")
    return fits.groupBy("series_id").agg(
        F.min_by(F.struct("order", "fit"), key).alias("best"), F.count(F.lit(1)).alias("n_tried")
    ).select("series_id", "best.order", "best.fit", "n_tried")


def holdout_metrics(vectors: DataFrame, orders: DataFrame, horizon: int = 6, min_train: int = 12) -> DataFrame:
    """Refit without the last `horizon` points and score the forecast of them."""
    rows = vectors.join(orders.select("series_id", "order"), "series_id").where(F.size("ys") >= horizon + min_train)
    train = rows.withColumn("held", F.slice("ys", -horizon, horizon)).withColumn(
        "ys", F.expr(f"slice(ys, 1, size(ys) - {horizon})")
    )
    scored = fit_orders(train, horizon).where(F.col("fit.aic").isNotNull())
    pairs = scored.select(
        "series_id", F.explode(F.arrays_zip(F.col("held").alias("y"), F.col("fit.y_pred").alias("f"))).alias("z")
    )
    y, f = F.col("z.y"), F.greatest(F.col("z.f"), F.lit(0.0))
    return pairs.groupBy("series_id").agg(*accuracy.bundle(y, f))


def tune_by_validation(
    vectors: DataFrame,
    differencing: DataFrame,
    grid: OrderGrid = OrderGrid(max_complexity=8),
    split: float = 0.8,
    horizon: int = 24,
) -> DataFrame:
    """Order with the least validation MASE on an 80/20 split of each series.

    The error of a candidate is scaled by the seasonal naive error of the training part.  `horizon`
    must reach the longest validation part; a series whose part is longer fails the query.
    """
    cut = F.floor(F.size("ys") * split).cast("int")
    parts = vectors.withColumn("_cut", cut).withColumn("held", F.expr("slice(ys, _cut + 1, size(ys) - _cut)")).withColumn("ys", F.expr("slice(ys, 1, _cut)"))
    s = grid.period
    lagged = F.expr(
        f"CASE WHEN size(ys) > {s} THEN transform(slice(ys, {s} + 1, greatest(size(ys) - {s}, 0)), (v, i) -> abs(v - ys[i]))"
        " ELSE transform(slice(ys, 2, greatest(size(ys) - 1, 0)), (v, i) -> abs(v - ys[i])) END"
    )
    scaled = parts.withColumn("_naive", F.aggregate(lagged, F.lit(0.0), lambda a, v: a + v) / F.size(lagged)).where(F.col("_naive") > 0)
    fits = fit_orders(with_candidates(scaled, differencing, grid), horizon).where(F.col("fit.aic").isNotNull())
    held = F.when(F.size("held") <= horizon, F.col("held")).otherwise(
        F.raise_error(F.lit("validation part longer than the horizon")).cast("array<double>")
    )
    errors = F.zip_with(held, F.slice("fit.y_pred", F.lit(1), F.size("held")), lambda y, f: F.abs(y - f))
    usable = F.filter(errors, lambda e: e.isNotNull())
    mase = F.aggregate(usable, F.lit(0.0), lambda a, v: a + v) / F.size(usable) / F.col("_naive")
    scored = fits.withColumn("mase", mase).where(F.col("mase").isNotNull() & ~F.isnan("mase"))
    key = F.struct("mase", "candidate")
    return scored.groupBy("series_id").agg(
        F.min_by(F.struct("order", "mase"), key).alias("best"), F.count(F.lit(1)).alias("n_tried")
    ).select("series_id", "best.order", F.col("best.mase").alias("best_mase"), "n_tried")


def forecast_rows(fitted: DataFrame, history: DataFrame) -> DataFrame:
    """Unfold `fit` into the forecast table, without negative predictions."""
    slot = calendar.slot_number(F.col("year"), F.col("month"), 12)
    ends = history.groupBy("series_id").agg(F.max("idx").alias("last_idx"), F.max(slot).alias("last_slot"))
    rows = fitted.join(ends, "series_id").select(
        "series_id", "last_idx", "last_slot", F.posexplode(F.arrays_zip(F.col("fit.y_pred").alias("y"), F.col("fit.half_width").alias("w"))).alias("_i", "z")
    )
    number = F.col("last_slot") + F.col("_i") + 1
    return rows.select(
        "series_id",
        (F.col("_i") + 1).alias("h"),
        (F.col("last_idx") + F.col("_i") + 1).cast("int").alias("idx"),
        calendar.slot_year(number, 12).alias("year"),
        calendar.slot_in_year(number, 12).alias("month"),
        F.greatest(F.col("z.y"), F.lit(0.0)).alias("y_pred"),
        (F.col("z.y") - F.col("z.w")).alias("y_pred_lower"),
        (F.col("z.y") + F.col("z.w")).alias("y_pred_upper"),
        F.lit("seasonal_arma").alias("model"),
    )


def eligible(history: DataFrame, rule: SparseRule = SparseRule()) -> tuple[DataFrame, DataFrame]:
    """(status per series, rows of the series worth fitting): skipped series never reach Python."""
    status = guards.model_eligibility(history, rule)
    ok = status.where(F.col("status") == "ok").select("series_id")
    return status, history.join(ok, "series_id", "left_semi")


def train(history: DataFrame, grid: OrderGrid = OrderGrid(), rule: SparseRule = SparseRule(), horizon: int = 6) -> DataFrame:
    """Model table: status and reason, chosen order, parameters, AIC, hold-out metrics and levels."""
    from panelwright.operators.panel import series_vectors

    status, usable = eligible(history, rule)
    vectors = series_vectors(usable)
    chosen = select_orders(vectors, forecast.unit_root(usable), grid)
    scores = holdout_metrics(vectors, chosen, horizon)
    changes = features.centred_changepoints(usable).select("series_id", "changepoints")
    out = (
        status.join(chosen, "series_id", "left").join(scores, "series_id", "left").join(changes, "series_id", "left")
    )
    fitted = F.col("fit").isNotNull()
    return out.select(
        "series_id",
        F.when(F.col("status") == "skipped", "skipped").when(fitted, "success").otherwise("error").alias("status"),
        F.when((F.col("status") == "ok") & ~fitted, "no_fit").otherwise(F.col("reason")).alias("reason"),
        "order",
        F.col("fit.params").alias("params"),
        F.col("fit.aic").alias("aic"),
        F.col("fit.bic").alias("bic"),
        "wmape",
        "smape",
        "bias",
        "mae",
        *[F.when(fitted, labels.performance_level(m, F.col(m))).alias(f"{m}_level") for m in ("wmape", "smape", "bias")],
        "sparse_flag",
        "sparse_reason",
        "n_obs",
        "nonzero_ratio",
        "changepoints",
    )


def retrain_strategy(history: DataFrame, models: DataFrame, recent: int = 6, force: bool = False) -> DataFrame:
    """Per series: `new_series`, `changepoint_detected` or `fast_update`, and the order to keep.

    Only the last keeps its order; the others go through the selection again.
    """
    known = models.where(F.col("order").isNotNull()).select("series_id", F.col("order").alias("kept_order"))
    recent_change = features.centred_changepoints(history, recent=recent).select("series_id", "has_recent")
    strategy = (
        F.when(F.col("kept_order").isNull(), "new_series")
        .when(F.col("has_recent"), "changepoint_detected")
        .otherwise("fast_update")
    )
    out = recent_change.join(known, "series_id", "left").withColumn("strategy", strategy)
    return out.select(
        "series_id",
        "strategy",
        ((F.col("strategy") != "fast_update") | F.lit(force)).alias("reselect"),
        "kept_order",
    )


def retrain(history: DataFrame, models: DataFrame, grid: OrderGrid = OrderGrid(), rule: SparseRule = SparseRule(), force: bool = False, horizon: int = 6) -> DataFrame:
    """Refit every usable series: kept orders directly, the rest by selection; one table."""
    from panelwright.operators.panel import series_vectors

    rule = SparseRule(rule.min_mean, 0.0, rule.min_std, rule.min_obs)  # no share-of-zeros limit here
    status, usable = eligible(history, rule)
    plan = retrain_strategy(usable, models, force=force)
    vectors = series_vectors(usable).join(plan, "series_id")
    reselected = select_orders(vectors.where("reselect"), forecast.unit_root(usable), grid).select("series_id", "order", "fit")
    kept = fit_orders(
        vectors.where(~F.col("reselect")).select("series_id", "ys", F.col("kept_order").alias("order")), horizon
    ).select("series_id", "order", "fit")
    fits = reselected.unionByName(kept)
    return (
        status.select("series_id", "status", "reason", "n_obs")
        .join(plan.select("series_id", "strategy"), "series_id", "left")
        .join(fits, "series_id", "left")
        .select("series_id", F.when(F.col("fit").isNotNull(), "success").otherwise(F.col("status")).alias("status"), "reason", "strategy", "order", F.col("fit.aic").alias("aic"), "n_obs", "fit")
    )
