"""Native forecasts: seasonal naive with intervals, safety rules, rolling origins, unit-root rule.

Forecasts are a long table: `series_id, h` (step from 1), `idx` (position after the history),
`year, month`, `y_pred, y_pred_lower, y_pred_upper, model`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.config import DEFAULT_Z, Z_VALUES
from panelwright.functions import accuracy, calendar
from panelwright.functions.columns import clip, floor_at, ratio
from panelwright.operators.features import by_series, in_order
from panelwright.schema import FORECAST_ALIASES, normalise_columns


def _history(history: DataFrame, by: tuple[str, ...], slot: str, per_year: int) -> DataFrame:
    """One row per series (and further key) with its ordered values and the last slot."""
    pairs = F.sort_array(F.collect_list(F.struct("idx", F.col("claim_count").alias("y"))))
    number = calendar.slot_number(F.col("year"), F.col(slot), per_year)
    return history.groupBy(*by).agg(pairs["y"].alias("ys"), F.max("idx").alias("last_idx"), F.max(number).alias("last_slot"))


def _mean(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, v: a + v) / F.size(array)


def _std(array: Column, mean: Column) -> Column:
    return F.sqrt(F.aggregate(array, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)) / F.size(array))


def seasonal_naive(
    history: DataFrame,
    horizon: int = 6,
    season: int = 12,
    level: float = 0.95,
    by: tuple[str, ...] = ("series_id",),
    slot: str = "month",
) -> DataFrame:
    """Repeat the last season, with an interval of z deviations of that season.

    A series with fewer than season + 1 points gets the mean and deviation of its last 8 points
    (all points, and a fifth of the mean but at least 1, below 8).  `slot` is `month` or `week`.
    """
    z = Z_VALUES.get(level, DEFAULT_Z)
    per_year = calendar.MONTHS if slot == "month" else calendar.WEEKS
    n = F.size("ys")
    short = n < season + 1
    # the points the forecast rests on: the last season, or the last 8 of a short series
    taken = F.least(n, F.when(short, F.lit(8)).otherwise(F.lit(season)))
    guess = F.greatest(F.lit(1.0), F.abs("m") * 0.2)
    rows = (
        _history(history, by, slot, per_year)
        .withColumn("base", F.slice(F.col("ys"), n - taken + 1, taken))
        .withColumn("m", _mean(F.col("base")))
        .withColumn("sd", F.when((short & (n < 8)) | (taken == 1), guess).otherwise(_std(F.col("base"), F.col("m"))))
    )
    steps = rows.select("*", short.alias("short"), F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    y_pred = F.when(F.col("short"), F.col("m")).otherwise(
        F.try_element_at("base", (F.pmod(F.col("h") - 1, F.lit(season)) + 1).cast("int"))
    )
    number = F.col("last_slot") + F.col("h")
    return steps.select(
        *by,
        "h",
        (F.col("last_idx") + F.col("h")).cast("int").alias("idx"),
        calendar.slot_year(number, per_year).alias("year"),
        calendar.slot_in_year(number, per_year).alias(slot),
        y_pred.alias("y_pred"),
        (y_pred - z * F.col("sd")).alias("y_pred_lower"),
        (y_pred + z * F.col("sd")).alias("y_pred_upper"),
        F.lit("naive_seasonal").alias("model"),
    )


def history_stats(history: DataFrame) -> DataFrame:
    """Fit-quality record per series: size, mean, deviation, range, share of non-zero, last value."""
    y = F.col("claim_count")
    return history.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_train_points"),
        F.avg(y).alias("hist_mean"),
        F.stddev_pop(y).alias("hist_std"),
        F.max(y).alias("hist_max"),
        F.min(y).alias("hist_min"),
        (F.avg((y > 0).cast("double")) * 100).alias("nonzero_pct"),
        F.max_by(y, F.col("idx")).alias("last_value"),
    )


def guarded_forecast(forecast: DataFrame, stats: DataFrame, fallback: DataFrame) -> DataFrame:
    """Replace unusable forecasts of a series by the fallback, then bound all values by the history.

    Unusable: any null, NaN, infinite or huge prediction, or an interval absurdly wide on average.
    Values are kept in [max(0, min/2), max(1.5 max, mean + 10 deviations)] and the interval always
    contains the prediction.  All three inputs are hashed by series.
    """
    keys = ["series_id", "h"]
    sd = F.when(F.col("n_train_points") > 1, F.col("hist_std")).otherwise(F.greatest(F.lit(1.0), F.abs("hist_mean") * 0.1))
    limits = stats.select(
        "series_id",
        F.greatest(F.lit(1e6), F.col("hist_max") * 100 + 10).alias("_huge"),
        F.greatest(F.lit(1e6), sd * 1000 + 10).alias("_wide"),
        F.greatest(F.lit(0.0), F.col("hist_min") * 0.5).alias("_low"),
        F.greatest(F.col("hist_max") * 1.5, F.col("hist_mean") + 10 * sd).alias("_high"),
    )
    p = F.col("y_pred")
    broken = p.isNull() | F.isnan(p) | (F.abs(p) > F.col("_huge"))
    whole = by_series()
    bad = (F.max(broken.cast("int")).over(whole) == 1) | (
        F.coalesce(F.avg(F.abs(F.col("y_pred_upper") - F.col("y_pred_lower"))).over(whole), F.lit(0.0)) > F.col("_wide")
    )
    checked = forecast.join(limits, "series_id").withColumn("_bad", bad)
    spare = fallback.select(
        *keys,
        F.struct("y_pred", "y_pred_lower", "y_pred_upper", F.lit("fallback_naive").alias("model")).alias("_spare"),
    )
    own = F.struct("y_pred", "y_pred_lower", "y_pred_upper", "model")
    chosen = checked.join(spare, keys, "left").withColumn("_c", F.when(F.col("_bad"), F.col("_spare")).otherwise(own))
    mid, lo, hi = (clip(F.col(f"_c.{c}"), F.col("_low"), F.col("_high")) for c in ("y_pred", "y_pred_lower", "y_pred_upper"))
    return chosen.select(
        *keys,
        "idx",
        "year",
        "month",
        mid.alias("y_pred"),
        F.least(lo, mid).alias("y_pred_lower"),
        F.greatest(hi, mid).alias("y_pred_upper"),
        F.col("_c.model").alias("model"),
    )


def coherent_bounds(forecast: DataFrame, spread: float = 0.2) -> DataFrame:
    """No negative values, missing bounds at +-20 % of the prediction, lower <= prediction <= upper."""
    p = F.col("y_pred")
    lo = F.coalesce(F.nanvl("y_pred_lower", F.lit(None).cast("double")), p - p * spread)
    hi = F.coalesce(F.nanvl("y_pred_upper", F.lit(None).cast("double")), p + p * spread)
    mid = floor_at(p, 0.0)
    return forecast.withColumns(
        {
            "y_pred_lower": F.least(floor_at(lo, 0.0), mid),
            "y_pred_upper": F.greatest(floor_at(hi, 0.0), mid),
            "y_pred": mid,
        }
    )


def proportional_bounds(forecast: DataFrame, version: str, train_until: int, share: float = 0.1) -> DataFrame:
    """Bounds at +-10 % of the prediction, tagged with the model version and the last training year."""
    p = F.col("y_pred")
    return forecast.withColumns(
        {
            "y_pred_lower": p * (1 - share),
            "y_pred_upper": p * (1 + share),
            "model_ver": F.lit(version),
            "train_until": F.lit(train_until),
        }
    )


def normalise_forecast(df: DataFrame) -> DataFrame:
    """Bring any of the known forecast layouts to `series_id, year, month, y_pred, bounds`."""
    return normalise_columns(df, FORECAST_ALIASES, required=("series_id", "year", "month", "y_pred"))


def check_forecast(forecast: DataFrame) -> DataFrame:
    """Counts of missing, negative and incoherent values, and whether the table is clean."""
    values = [F.col(c) for c in ("y_pred", "y_pred_lower", "y_pred_upper")]
    missing = values[0].isNull() | values[1].isNull() | values[2].isNull()
    negative = F.least(*values) < 0
    crossed = (values[1] > values[0]) | (values[0] > values[2])
    return forecast.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(missing).alias("n_missing"),
        F.count_if(negative).alias("n_negative"),
        F.count_if(crossed).alias("n_crossed"),
    ).withColumn("valid", (F.col("n_missing") == 0) & (F.col("n_negative") == 0) & (F.col("n_crossed") == 0))


def rolling_origin(panel: DataFrame, n_splits: int = 3, test_size: int = 6, min_train: int = 12) -> DataFrame:
    """Training rows of each fold: `fold, train_size` and the rows before the fold's origin.

    Each row is copied at most n_splits times, to the folds whose origin lies after it.
    """
    fold = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("_f")
    origin = F.col("n") - (n_splits - F.col("_f")) * test_size
    return (
        panel.select("*", fold)
        .withColumn("train_size", origin.cast("int"))
        .where((F.col("train_size") >= min_train) & (F.col("idx") < F.col("train_size")))
        .withColumn("fold", F.col("_f") + 1)
        .drop("_f")
    )


def rolling_origin_metrics(panel: DataFrame, forecast_fn=None, n_splits: int = 3, test_size: int = 6) -> DataFrame:
    """Accuracy per series and fold of `forecast_fn(training rows, horizon)`.

    The function gets the rows of `rolling_origin`, must keep `series_id, fold` and return
    `idx, y_pred`; the default is the seasonal naive forecast.
    """
    train = rolling_origin(panel, n_splits, test_size)
    if forecast_fn is None:
        predicted = seasonal_naive(train, test_size, by=("series_id", "fold", "train_size"))
    else:
        predicted = forecast_fn(train, test_size)
    actual = panel.select("series_id", "idx", "claim_count")
    y, f = F.col("claim_count"), F.col("y_pred")
    return (
        predicted.join(actual, ["series_id", "idx"])
        .groupBy("series_id", "fold", "train_size")
        .agg(*accuracy.bundle(y, f), F.count(F.lit(1)).alias("test_size"))
    )


def mean_over_folds(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    names = ("wmape", "smape", "bias", "mae", "rmse")
    return metrics.groupBy(*by).agg(*[F.avg(c).alias(c) for c in names])


def rolling_years(panel: DataFrame, first: int, last: int) -> DataFrame:
    """Training rows per target year: every row up to the year before it, in one job."""
    years = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("target_year")
    return panel.select("*", years).where(F.col("year") < F.col("target_year"))


def unit_root(panel: DataFrame, critical: float = -2.86) -> DataFrame:
    """Differencing order per series: 0 when the Dickey-Fuller t of the lagged level is below
    `critical` (5 %, with constant), else 1.

    The regression of the step on the lagged level is closed form, from sums of one window lag.
    """
    step, level = F.col("_step"), F.col("_level")
    lagged = panel.withColumn("_level", F.lag("claim_count").over(in_order())).withColumn(
        "_step", F.col("claim_count") - F.col("_level")
    )
    s = lagged.groupBy("series_id").agg(
        F.count(step).alias("m"),
        F.regr_sxx(step, level).alias("sxx"),
        F.regr_sxy(step, level).alias("sxy"),
        F.regr_syy(step, level).alias("syy"),
    )
    slope = ratio(F.col("sxy"), F.col("sxx"))
    rss = F.greatest(F.col("syy") - slope * F.col("sxy"), F.lit(0.0))
    se = F.sqrt(F.try_divide(F.try_divide(rss, F.col("m") - 2), F.col("sxx")))
    t = F.try_divide(slope, se)
    return s.select("series_id", t.alias("t_stat"), F.when(t < critical, 0).otherwise(1).alias("d"))
