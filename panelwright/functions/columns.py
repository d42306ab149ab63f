"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def obs() -> Column:
    return F.col("claim_count")


def pred() -> Column:
    return F.col("y_pred")


def clip(x: Column, low, high) -> Column:
    """Bound x; null stays null (greatest/least alone would drop it)."""
    lo = low if isinstance(low, Column) else F.lit(float(low))
    hi = high if isinstance(high, Column) else F.lit(float(high))
    return F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi))


def floor_at(x: Column, low: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(x, F.lit(float(low))))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def series_id(*keys: str, sep: str = "|") -> Column:
    return F.concat_ws(sep, *[F.col(k).cast("string") for k in keys])


def key_part(sid: Column, position: int, missing: str = "Unknown") -> Column:
    """Part of a joined series id, counted from 0."""
    return F.coalesce(F.try_element_at(F.split(sid, r"\|"), F.lit(position + 1)), F.lit(missing))


def fixed_decimals(x: Column, digits: int) -> Column:
    """Number as text with a fixed count of decimals."""
    return F.round(x, digits).cast(f"decimal(28,{digits})").cast("string")


def joined_text(parts: list[Column], sep: str, empty: str = "") -> Column:
    """Join the non-null texts; `empty` when none is left."""
    text = F.concat_ws(sep, *parts)
    return F.when(text == "", F.lit(empty)).otherwise(text)


def chi2_tail_df10(x: Column) -> Column:
    """P(X > x) for a chi-square variable with 10 degrees of freedom (closed form)."""
    half = x / 2
    total = F.lit(1.0)
    term = F.lit(1.0)
    for k in range(1, 5):
        term = term * half / k
        total = total + term
    return F.exp(-half) * total


def round_all(df, digits: int = 6):
    """Round every double column (and make -0 a 0); used where results are compared or shown."""
    return df.select(
        *[
            (F.round(F.col(f"`{name}`"), digits) + 0.0).alias(name) if kind == "double" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )
