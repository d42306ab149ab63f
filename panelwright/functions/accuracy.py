"""Aggregate expressions for forecast accuracy.

All take the actual value y and the forecast f and return an aggregate Column to use inside
`groupBy(...).agg(...)`; error is y - f unless the name says otherwise.  Undefined results are null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions.columns import ratio


def mae(y: Column, f: Column) -> Column:
    return F.avg(F.abs(y - f))


def rmse(y: Column, f: Column) -> Column:
    return F.sqrt(F.avg((y - f) * (y - f)))


def wmape_pct(y: Column, f: Column) -> Column:
    """Sum of absolute errors over sum of actuals, both over y > 0, in percent."""
    return ratio(F.sum(F.when(y > 0, F.abs(y - f))), F.sum(F.when(y > 0, y))) * 100


def smape_pct(y: Column, f: Column) -> Column:
    half = (F.abs(y) + F.abs(f)) / 2
    return F.avg(F.when(half > 0, F.abs(y - f) / half)) * 100


def signed_bias_pct(y: Column, f: Column) -> Column:
    """Mean of f - y over mean of y, both over y > 0, in percent (positive: over-forecast)."""
    return ratio(F.avg(F.when(y > 0, f - y)), F.avg(F.when(y > 0, y))) * 100


def mape_nonzero(y: Column, f: Column) -> Column:
    """Mean relative error as a fraction, over y <> 0."""
    return F.avg(F.when(y != 0, F.abs((y - f) / y)))


def mape_positive(y: Column, f: Column) -> Column:
    """Mean relative error as a fraction, over y > 0."""
    return F.avg(F.when(y > 0, F.abs(y - f) / y))


def mape_plus_one_pct(y: Column, f: Column) -> Column:
    """Relative error against y + 1, in percent; defined for zero actuals."""
    return F.avg(F.abs(y - f) / (y + 1)) * 100


def mape_guarded(y: Column, f: Column, eps: float = 1e-9) -> Column:
    """Relative error against max(y, eps), as a fraction."""
    return F.avg(F.abs(y - f) / F.greatest(y, F.lit(eps)))


def total_bias(y: Column, f: Column) -> Column:
    """(sum of forecasts - sum of actuals) / sum of actuals."""
    return ratio(F.sum(f) - F.sum(y), F.sum(y))


def mean_error_bias(y: Column, f: Column) -> Column:
    """mean(y - f) / mean(y), null unless mean(y) > 0."""
    return F.when(F.avg(y) > 0, ratio(F.avg(y - f), F.avg(y)))


def guarded_bias(y: Column, f: Column, eps: float = 1e-9) -> Column:
    """mean(f - y) / max(mean(y), eps)."""
    return F.avg(f - y) / F.greatest(F.avg(y), F.lit(eps))


def bundle(y: Column, f: Column) -> list[Column]:
    """The percent metrics with MAE and RMSE, named."""
    return [
        wmape_pct(y, f).alias("wmape"),
        smape_pct(y, f).alias("smape"),
        signed_bias_pct(y, f).alias("bias"),
        mae(y, f).alias("mae"),
        rmse(y, f).alias("rmse"),
    ]


def fraction_bundle(y: Column, f: Column) -> list[Column]:
    """The fraction metrics with MAE, RMSE and the number of rows, named."""
    return [
        mape_nonzero(y, f).alias("mape"),
        mae(y, f).alias("mae"),
        rmse(y, f).alias("rmse"),
        total_bias(y, f).alias("bias"),
        F.count(F.lit(1)).alias("n_observations"),
    ]
