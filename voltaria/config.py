"""Tunable constants of the tariff domain, passed explicitly to operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TariffConfig:
    """Prices per kWh, thresholds on utilization, and the weights of the reward (fixed values)."""

    baseline_price: float = 15.0
    min_price: float = 5.0
    max_price: float = 30.0
    elasticity: float = 0.3
    surge_threshold: float = 0.8
    off_peak_threshold: float = 0.3
    surge_multiplier: float = 0.3
    discount_multiplier: float = -0.2
    revenue_weight: float = 1.0
    balance_weight: float = 0.5
    congestion_weight: float = 2.0
    target_utilization: float = 0.7
    congestion_knee: float = 0.9


@dataclass(frozen=True)
class MonitorConfig:
    """Drift window, retrain limits and the feedback weights per metric."""

    window: int = 100
    z_threshold: float = 2.0
    min_values: int = 8
    min_std: float = 1e-8
    min_revenue_gain: float = -5.0
    max_congestion_rate: float = 0.3
    default_weight: float = 0.1
    # Weight of each tracked metric in the feedback score.
    weights: dict[str, float] = field(
        default_factory=lambda: {
            "revenue_gain_pct": 0.4,
            "utilization_rate": 0.25,
            "congestion_rate": 0.2,
            "wait_time_proxy": 0.1,
            "pricing_efficiency_score": 0.05,
        }
    )


# The tariff actions, as relative price changes with their labels.
ACTIONS: list[tuple[int, float, str]] = [
    (0, -0.20, "-20%"),
    (1, -0.10, "-10%"),
    (2, 0.00, "0%"),
    (3, 0.10, "+10%"),
    (4, 0.20, "+20%"),
    (5, 0.30, "+30%"),
]

# Hour ranges, start inclusive and end exclusive.
PEAK_HOURS: list[tuple[int, int]] = [(7, 10), (17, 21)]
OFF_PEAK_HOURS: list[tuple[int, int]] = [(22, 24), (0, 7)]

# Weights of the congestion score parts.
CONGESTION_WEIGHTS: dict[str, float] = {
    "utilization": 0.5,
    "queue_proxy": 0.3,
    "occupancy_density": 0.2,
}

# Lags and windows of the default and of the configured features.
DEFAULT_LAGS = (1, 3, 6, 12)
DEFAULT_WINDOWS = (12, 36, 288)
CONFIG_LAGS = (1, 2, 3, 6, 12, 24, 48)
CONFIG_WINDOWS = (3, 6, 12, 24)
