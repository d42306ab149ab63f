"""Dates, ISO weeks and positions on a regular calendar.

A *slot* is a (year, month) or (year, week) pair numbered `year * per_year + slot - 1`, so that
neighbouring slots differ by one and any window is plain integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = 12
WEEKS = 53  # every year carries a week 53 on the padded grid


def parse_date(x: Column) -> Column:
    """ISO or yyyyMMdd text to date; null when neither fits."""
    text = F.trim(x.cast("string"))
    compact = F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))
    return F.coalesce(compact, F.when(~text.rlike(r"^\d{8}$"), F.try_to_date(text)))


def parse_count(x: Column) -> Column:
    """Integer with thousands separators; anything unreadable counts as 0."""
    text = F.trim(F.replace(x.cast("string"), F.lit(","), F.lit("")))
    return F.coalesce(text.try_cast("double"), F.lit(0.0)).cast("int")


def iso_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d)


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def slot_number(year: Column, slot: Column, per_year: int) -> Column:
    return year * per_year + slot - 1


def slot_year(number: Column, per_year: int) -> Column:
    return F.floor(number / per_year).cast("int")


def slot_in_year(number: Column, per_year: int) -> Column:
    return (F.pmod(number, F.lit(per_year)) + 1).cast("int")


def has_week_53(year: Column) -> Column:
    """An ISO year has 53 weeks when it starts or ends on a Thursday."""
    thursday = 5
    return (F.dayofweek(F.make_date(year, F.lit(1), F.lit(1))) == thursday) | (
        F.dayofweek(F.make_date(year, F.lit(12), F.lit(31))) == thursday
    )


def week_to_month(week: Column) -> Column:
    """Coarse month of a week (4.3 weeks each), never beyond 12."""
    return F.least(F.floor((week - 1) / F.lit(4.3)) + 1, F.lit(12)).cast("int")


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year.cast("int"), month.cast("int"))


def month_steps(start: Column, horizon: int) -> Column:
    """Array of the first days of `horizon` months, starting with the month of `start`."""
    first = F.trunc(start, "month")
    return F.sequence(first, F.add_months(first, horizon - 1), F.expr("interval 1 month"))
