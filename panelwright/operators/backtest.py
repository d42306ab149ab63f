"""Weight-learning backtest: labels, factors at past dates, logistic weights, precision-recall."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.config import FACTORS, BacktestRules
from panelwright.functions.columns import ratio
from panelwright.operators import forecast, ranking, scoring


def growth_labels(panel: DataFrame, horizon: int = 6, delta: float = 0.3) -> DataFrame:
    """1 when the last `horizon` points sum to (1 + delta) times what the 12 before would give.

    Series with fewer than 12 + horizon points get 0.  A sum equal to the limit counts, whatever the
    rounding of the limit.
    """
    y = F.col("claim_count")
    from_end = F.col("n") - F.col("idx")
    s = panel.groupBy("series_id", "n").agg(
        F.sum(F.when(from_end <= horizon, y)).alias("future"),
        F.avg(F.when((from_end > horizon) & (from_end <= 12 + horizon), y)).alias("recent"),
    )
    hit = (F.col("n") >= 12 + horizon) & (F.col("future") >= (1 + delta) * horizon * F.col("recent") - 1e-9)
    return s.select("series_id", F.coalesce(hit, F.lit(False)).cast("int").alias("label"))


def fold_cuts(total_slots: int, n_splits: int = 3) -> list[int]:
    """Training lengths of the folds: multiples of a (n_splits + 1)-th of the whole span."""
    step = total_slots // (n_splits + 1)
    return [(i + 1) * step for i in range(n_splits)]


def folded(panel: DataFrame, cuts: list[int], horizon: int) -> DataFrame:
    """Rows of each fold: the history before its cut and the `horizon` slots after it.

    Every row is copied once per fold that uses it; folds are a short literal list.
    """
    folds = F.array(*[F.struct(F.lit(i + 1).alias("fold"), F.lit(c).alias("cut")) for i, c in enumerate(cuts)])
    return (
        panel.select("*", F.explode(folds).alias("f"))
        .select(*panel.columns, "f.fold", "f.cut")
        .where(F.col("idx") < F.col("cut") + horizon)
    )


def point_in_time(
    panel: DataFrame, cuts: list[int], rules: BacktestRules = BacktestRules(), proxy: str = "actual", with_changes: bool = False
) -> DataFrame:
    """Five factors and label per fold and series, sparse and short ones left out.

    `proxy="actual"` takes the coming actuals as the forecast (as published; it looks ahead),
    `"forecast"` the seasonal naive forecast.  Confidence is 0, as no error is known at the cut.
    """
    h = rules.horizon
    rows = folded(panel, cuts, h)
    past = rows.where(F.col("idx") < F.col("cut")).withColumn("n", F.col("cut"))
    ahead = rows.where(F.col("idx") >= F.col("cut"))
    by = ("series_id", "fold")
    y = F.col("claim_count")
    future = ahead.groupBy(*by).agg(F.sum(y).alias("future"), F.count(F.lit(1)).alias("_k")).where(F.col("_k") >= h)
    if proxy == "actual":
        predicted = ahead.select(*by, y.alias("y_pred"))
    elif proxy == "forecast":
        predicted = forecast.seasonal_naive(past, h, 12, by=by).select(*by, "y_pred")
    else:
        raise ValueError(f"unknown proxy: {proxy}")
    unknown = future.select(*by, F.lit(None).cast("double").alias("wmape"))
    shares = None
    if with_changes:
        from panelwright.operators import changepoints

        pairs = F.sort_array(F.collect_list(F.struct("idx", y.alias("y"))))
        vectors = past.groupBy(*by).agg(pairs["y"].alias("ys"))
        shares = changepoints.recent_change_share(changepoints.penalised_segments(vectors)).select(*by, "cp_prob")
    factors = scoring.five_factors(past, predicted, unknown, shares, by=by).where(~F.col("sparse_flag"))
    recent = past.where(F.col("idx") >= F.col("cut") - 12).groupBy(*by).agg(F.avg(y).alias("recent"))
    label = (F.col("future") >= (1 + rules.delta) * h * F.col("recent") - 1e-9).cast("int")
    return (
        factors.join(future.drop("_k"), list(by)).join(recent, list(by)).select(*by, *FACTORS, label.alias("label"))
    )


def precision_recall(scored: DataFrame, score: str = "score") -> DataFrame:
    """Precision, recall and F1 at every distinct score, highest first.

    Rows with equal scores are summed first.  The running counts over all scores come from range
    partitions with offsets, so no task sees the whole curve.
    """
    points = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col("label").cast("long")).alias("pos"), F.count(F.lit(1)).alias("all")
    )
    points = ranking.checkpointed(points)
    positives = points.agg(F.sum("pos").alias("p")).scalar()
    run = ranking.running_totals(points, [-F.col("threshold")], "threshold", {"tp": F.col("pos"), "seen": F.col("all")})
    precision, recall = F.col("tp") / F.col("seen"), ratio(F.col("tp"), positives)
    f1 = 2 * precision * recall / (precision + recall + 1e-10)
    return run.select("threshold", "pos", "all", "tp", "seen", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def curve_summary(curve: DataFrame) -> DataFrame:
    """Best F1 with its threshold (the lowest on ties) and the trapezoid area under the curve.

    The point before each threshold follows from its own counts; before the first it is recall 0 at
    precision 1.
    """
    before_seen = F.col("seen") - F.col("all")
    before_tp = F.col("tp") - F.col("pos")
    before_precision = F.coalesce(ratio(before_tp, before_seen), F.lit(1.0))
    before_recall = F.coalesce(F.col("recall") * ratio(before_tp, F.col("tp")), F.lit(0.0))
    area = (F.col("recall") - before_recall) * (F.col("precision") + before_precision) / 2
    return curve.agg(
        F.max("f1").alias("f1"),
        F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold"))).alias("threshold"),
        F.sum(area).alias("pr_auc"),
        F.sum("all").alias("n_samples"),
        F.sum("pos").alias("n_positive"),
    )


def standardised(rows: DataFrame, names: tuple[str, ...] = FACTORS) -> DataFrame:
    """Each factor minus its mean over its population deviation; a constant factor becomes 0."""
    stats = rows.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in names]).alias("a")
    ).scalar()
    return rows.withColumns({c: F.coalesce(ratio(F.col(c) - stats[c]["m"], stats[c]["s"]), F.lit(0.0)) for c in names})


def learn_weights(rows: DataFrame, rules: BacktestRules = BacktestRules(), names: tuple[str, ...] = FACTORS) -> dict:
    """L2 logistic regression of the label on the standardised factors; weights are the absolute
    coefficients over their sum.  Fewer than `min_rows` complete rows keep the prior weights.

    The training rows are checkpointed once: the optimiser reads them many times.
    """
    data = ranking.checkpointed(rows.dropna(subset=list(names)).select(*names, F.col("label").cast("double").alias("label")))
    n = data.count()
    if n < rules.min_rows:
        return {"weights": dict(rules.weights), "f1": 0.0, "pr_auc": 0.0, "threshold": 0.5, "n_samples": n, "n_positive": 0}
    vectors = VectorAssembler(inputCols=list(names), outputCol="features").transform(standardised(data, names))
    model = LogisticRegression(
        regParam=1.0 / (rules.inverse_penalty * n), elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-8
    ).fit(vectors)
    sizes = [abs(float(c)) for c in model.coefficients]
    total = sum(sizes) or 1.0
    scores = model.transform(vectors).select("label", vector_to_array("probability")[1].alias("score"))
    best = curve_summary(precision_recall(scores)).first().asDict()
    return {
        "weights": {name: s / total for name, s in zip(names, sizes)},
        "f1": best["f1"] or 0.0,
        "pr_auc": best["pr_auc"] or 0.0,
        "threshold": best["threshold"],
        "n_samples": n,
        "n_positive": best["n_positive"],
    }


FOLD_SCHEMA = "fold int, f1 double, pr_auc double, threshold double, n_samples long, n_positive long, " + ", ".join(
    f"w_{c} double" for c in FACTORS
)


def backtest_folds(panel: DataFrame, total_slots: int, rules: BacktestRules = BacktestRules(), proxy: str = "actual", with_changes: bool = False) -> DataFrame:
    """One row per fold with learned weights and in-sample metrics.

    Factors of all folds are one job; the loop below runs over the few folds of the scheme, each fit
    being a distributed optimisation.
    """
    rows = ranking.checkpointed(point_in_time(panel, fold_cuts(total_slots, rules.n_splits), rules, proxy, with_changes))
    found = []
    for fold in range(1, rules.n_splits + 1):
        part = rows.where(F.col("fold") == fold)
        if part.dropna(subset=list(FACTORS)).limit(rules.min_rows).count() < rules.min_rows:
            continue
        r = learn_weights(part, rules)
        found.append((fold, r["f1"], r["pr_auc"], r["threshold"], r["n_samples"], r["n_positive"], *r["weights"].values()))
    return panel.sparkSession.createDataFrame(found, FOLD_SCHEMA)


def average_folds(folds: DataFrame, rules: BacktestRules = BacktestRules()) -> DataFrame:
    """Mean weights (renormalised), mean and deviation of the metrics, and the success check."""
    means = folds.agg(
        *[F.avg(f"w_{c}").alias(f"w_{c}") for c in FACTORS],
        F.avg("f1").alias("f1_mean"),
        F.stddev_samp("f1").alias("f1_std"),
        F.avg("pr_auc").alias("pr_auc_mean"),
        F.stddev_samp("pr_auc").alias("pr_auc_std"),
        F.avg("threshold").alias("threshold_mean"),
    )
    total = sum((F.col(f"w_{c}") for c in FACTORS), F.lit(0.0))
    return means.withColumns({f"w_{c}": ratio(F.col(f"w_{c}"), total) for c in FACTORS}).withColumn(
        "success", F.col("f1_mean") >= rules.f1_target
    )


def write_config(averaged: DataFrame, path: str, scheme: str = "rolling3fold_24m") -> None:
    """The learned weights and cut-off as one JSON document."""
    averaged.select(
        F.create_map(*[x for c in FACTORS for x in (F.lit(c), F.col(f"w_{c}"))]).alias("weights"),
        F.struct(F.round("threshold_mean", 2).alias("H6")).alias("cutoff"),
        F.struct(F.round("f1_mean", 2).alias("F1"), F.round("pr_auc_mean", 2).alias("PRAUC")).alias("metric"),
        F.lit(scheme).alias("cv"),
        F.date_format(F.current_date(), "yyyy-MM-dd").alias("updated"),
    ).coalesce(1).write.mode("overwrite").json(path)
