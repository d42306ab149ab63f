"""Levels, reasons and explanations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.config import (
    PERFORMANCE_CUTS,
    PERFORMANCE_NAMES,
    RATIONALE_PARTS,
    RiskCuts,
    SparseRule,
)
from panelwright.functions.columns import fixed_decimals, joined_text


def performance_level(metric: str, value: Column) -> Column:
    """Four-step level of wmape, smape or bias (by size); null is UNKNOWN."""
    size = F.abs(value) if metric == "bias" else value
    level = F.when(value.isNull(), F.lit("UNKNOWN"))
    for cut, name in zip(PERFORMANCE_CUTS[metric], PERFORMANCE_NAMES):
        level = level.when(size < cut, F.lit(name))
    return level.otherwise(F.lit(PERFORMANCE_NAMES[-1]))


def risk_level(score: Column, confidence: Column, cuts: RiskCuts = RiskCuts()) -> Column:
    return (
        F.when(confidence < cuts.low_confidence, F.lit("LOW_CONF"))
        .when(score >= cuts.high, F.lit("HIGH"))
        .when(score >= cuts.medium, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def rationale() -> Column:
    """Which factors crossed their cut, with their values; `normal` when none did."""
    parts = []
    for name, op, cut, before, digits, after in RATIONALE_PARTS:
        x = F.col(name)
        hit = {">": x > cut, ">=": x >= cut, "<": x < cut}[op]
        text = F.concat(F.lit(before), fixed_decimals(x, digits), F.lit(after))
        parts.append(F.when(hit, text))
    return joined_text(parts, "; ", empty="normal")


def sparse_flag(mean: Column, nonzero: Column, rule: SparseRule = SparseRule()) -> Column:
    return (mean < rule.min_mean) | (nonzero < rule.min_nonzero)


def sparse_reason(mean: Column, nonzero: Column, rule: SparseRule = SparseRule()) -> Column:
    """`avg=..<0.5; nonzero=..%<30%`, empty when neither limit is missed."""
    low_mean = F.concat(F.lit("avg="), fixed_decimals(mean, 2), F.lit(f"<{rule.min_mean}"))
    low_share = F.concat(
        F.lit("nonzero="),
        fixed_decimals(nonzero * 100, 1),
        F.lit(f"%<{rule.min_nonzero * 100:.0f}%"),
    )
    return joined_text(
        [F.when(mean < rule.min_mean, low_mean), F.when(nonzero < rule.min_nonzero, low_share)], "; "
    )


def predictability(score: Column, high: float = 0.7, low: float = 0.4) -> Column:
    return F.when(score >= high, "high").when(score >= low, "medium").otherwise("low")


def modal_class(counts: dict[str, Column]) -> Column:
    """Class with the largest count; ties go to the name that comes first in the alphabet.

    `counts` holds one aggregate per class, so the mode is a map-side combined sum, not a
    collected group.
    """
    names = sorted(counts)
    best = F.greatest(*[counts[n] for n in names])
    choice = F.when(counts[names[0]] == best, F.lit(names[0]))
    for n in names[1:]:
        choice = choice.when(counts[n] == best, F.lit(n))
    return choice
