"""Settings of the operators, as frozen dataclasses.

The numbers and words below are fixed values: results only agree with the published behaviour when
they are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

KEYS = ("plant", "product_cat2", "mid_category")

LAG_CLASSES = ("borderline", "extreme", "invalid_negative", "normal")  # alphabetical: tie order
LAG_WEIGHTS = {"normal": 1.0, "borderline": 0.5}

# Half-width of a normal interval per confidence level; any other level uses DEFAULT_Z.
Z_VALUES = {0.80: 1.2816, 0.90: 1.6449, 0.95: 1.96, 0.99: 2.5758, 0.999: 3.2905}
DEFAULT_Z = 1.96

PERFORMANCE_CUTS = {"wmape": (20, 50, 100), "smape": (15, 30, 50), "bias": (5, 10, 20)}
PERFORMANCE_NAMES = ("EXCELLENT", "GOOD", "FAIR", "POOR")

FACTORS = ("f1_ratio", "f2_conf", "f3_season", "f4_ampl", "f5_inflect")
FACTOR_WEIGHTS = {
    "f1_ratio": 0.20,
    "f2_conf": 0.15,
    "f3_season": 0.30,
    "f4_ampl": 0.15,
    "f5_inflect": 0.20,
}
# (factor, comparison, cut, text before the number, decimals, text after the number)
RATIONALE_PARTS = (
    ("f1_ratio", ">", 1.5, "증가율", 1, "x"),
    ("f3_season", ">=", 0.6, "강한계절성", 2, ""),
    ("f4_ampl", ">=", 0.5, "큰진폭", 2, ""),
    ("f5_inflect", ">=", 0.5, "변곡위험", 2, ""),
    ("f2_conf", "<", 0.2, "낮은신뢰도", 2, ""),
)

SCORE100_WEIGHTS = {"growth": 0.35, "volatility": 0.25, "seasonality": 0.20, "acceleration": 0.20}


@dataclass(frozen=True)
class SplitDates:
    train_start: str = "2021-01-01"
    train_end: str = "2024-12-31"
    test_start: str = "2025-01-01"
    test_end: str = "2025-12-31"


@dataclass(frozen=True)
class SparseRule:
    min_mean: float = 0.5
    min_nonzero: float = 0.3
    min_std: float = 0.01
    min_obs: int = 12


@dataclass(frozen=True)
class KpiGate:
    mape: float = 0.20
    bias: float = 0.05


@dataclass(frozen=True)
class RiskCuts:
    high: float = 0.7
    medium: float = 0.5
    low_confidence: float = 0.2
    candidate_season: float = 0.4
    candidate_amplitude: float = 0.3


@dataclass(frozen=True)
class GuardRules:
    zero_ratio: float = 0.8
    window: int = 52
    sigma: float = 3.0
    variance_ratio: float = 1.0
    expected_length: int = 52
    gap_days: int = 10
    outlier_factor: float = 3.0
    outlier_share: float = 0.1
    period: int = 52
    strength: float = 0.3


@dataclass(frozen=True)
class OrderGrid:
    """Bounds of the seasonal model orders tried per series."""

    max_p: int = 2
    max_q: int = 2
    max_P: int = 1
    max_Q: int = 1
    D_values: tuple = (0, 1)
    period: int = 12
    max_complexity: int | None = None

    def candidates(self) -> list[tuple[int, int, int, int, int]]:
        """(p, q, P, Q, D) in a fixed order; the pair p = q = 0 is left out."""
        grid = [
            (p, q, P, Q, D)
            for p in range(self.max_p + 1)
            for q in range(self.max_q + 1)
            if p or q
            for P in range(self.max_P + 1)
            for Q in range(self.max_Q + 1)
            for D in self.D_values
        ]
        if self.max_complexity is not None:
            grid = [c for c in grid if sum(c) <= self.max_complexity]
        return grid


@dataclass(frozen=True)
class BacktestRules:
    delta: float = 0.3
    horizon: int = 6
    n_splits: int = 3
    inverse_penalty: float = 1.0
    min_rows: int = 10
    f1_target: float = 0.75
    weights: dict = field(default_factory=lambda: dict(FACTOR_WEIGHTS))
