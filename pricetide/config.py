"""Every threshold of the library, as small frozen dataclasses.

Operators take one of these instead of loose numbers, so a caller can see and
change each rule in one place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass


@dataclass(frozen=True)
class ChangeRules:
    """When two consecutive prices of an item count as a price change.

    ``min_price`` is exclusive and applies to both prices; the other limits are
    inclusive.  ``None`` switches a limit off.  An unchanged price is never a
    change.
    """

    min_price: float | None = 50.0
    max_abs_diff: float | None = 50.0
    max_rel_diff: float | None = 0.30
    max_gap_seconds: int | None = 6 * 3600


@dataclass(frozen=True)
class BandRules:
    """Temperature bands: Cool < ``cool_below`` <= Normal < ``hot_from`` <= Hot."""

    cool_below: float = 25.0
    hot_from: float = 32.0


@dataclass(frozen=True)
class VerdictRules:
    """Fewest change events before a condition effect is called significant."""

    rain: int = 5
    weekend: int = 3
    temperature: int = 3


@dataclass(frozen=True)
class PairRules:
    """Co-movement of two entities over the hours in which both moved."""

    min_overlap: int = 2
    min_abs_r: float = 0.4
    strong_abs_r: float = 0.7
    block_entities: int = 1024
    """Entities that a block should have at least, where small tables are cut for parallel work."""
    most_block_entities: int = 16_384
    """Entities per block at most, about; a task holds two blocks, 1.5 kB per entity."""


@dataclass(frozen=True)
class IndexRules:
    """The composite index.

    ``mode`` is ``capped`` (clip to [0, cap] and scale to 100), ``zscore``
    (``15 z + 50`` clamped to [0, 100]) or ``minmax``.
    """

    mode: str = "capped"
    rain_cap: float = 20.0
    weekend_cap: float = 20.0
    temperature_cap: float = 15.0
    rain_weight: float = 0.20
    weekend_weight: float = 0.20
    temperature_weight: float = 0.10
    volatility_weight: float = 0.50
    right_closed_bands: bool = False

    def __post_init__(self) -> None:
        weights = (
            self.rain_weight,
            self.weekend_weight,
            self.temperature_weight,
            self.volatility_weight,
        )
        if self.mode not in ("capped", "zscore", "minmax"):
            raise ValueError(f"unknown index mode {self.mode!r}")
        if min(weights) < 0 or not math.isclose(sum(weights), 1.0, abs_tol=1e-9):
            raise ValueError("index weights must be non-negative and sum to 1")
        if min(self.rain_cap, self.weekend_cap, self.temperature_cap) <= 0:
            raise ValueError("index caps must be positive")


@dataclass(frozen=True)
class AlertRules:
    """Smallest change, in percent of the earlier price, that is reported."""

    min_abs_pct: float = 25.0


@dataclass(frozen=True)
class SkewRules:
    """How keys that hold very many rows are cut into slices.

    Every key with at least ``hot_rows`` rows is cut along its order column into slices of
    about ``rows_per_slice`` rows or fewer.  Results never depend on these numbers.
    """

    hot_rows: int = 2_000_000
    rows_per_slice: int = 500_000


@dataclass(frozen=True)
class SlotRules:
    """The daily capture schedule."""

    slot_minutes: tuple[int, ...] = (600, 720, 840, 960, 1080, 1200, 1320)
    tolerance_minutes: int = 60
    min_gap_minutes: int = 60


# The metric tables and the measure that a checksum adds up.
MEASURES: dict[str, str] = {
    "stability_score": "cv_pct",
    "rain_premium": "rpi",
    "weekend_premium": "wpi",
    "temperature_effect": "temp_effect_score",
    "category_sensitivity": "sensitivity_score",
    "hourly_overall": "avg_price_change_pct",
    "hourly_per_entity": "avg_price_change_pct",
    "hourly_peak": "peak_change_pct",
    "peak_offpeak": "avg_price_change_pct",
    "sync_pairs_all": "correlation",
    "sync_pairs_rain": "correlation",
    "dynamic_pricing_index": "dpi",
    "entity_condition_price": "avg_price",
    "market_condition_price": "avg_price",
    "category_hour_heatmap": "avg_price",
}

# Dish types in order of precedence and the keywords naming them.
DISH_TYPES: tuple[tuple[str, str], ...] = (
    ("Combo", r"combo|meal|platter|thali"),
    ("Biryani", r"biryani|biriyani"),
    ("Momo", r"momo"),
    ("Burger", r"burger"),
    ("Fried Chicken", r"fried chicken|wings|strips|popcorn|bucket"),
    ("Roll", r"\broll|wrap|kathi"),
    ("Paneer", r"paneer"),
    ("Dessert", r"gulab jamun|ice cream|brownie|cake|phirni|kheer|dessert"),
    ("Beverage", r"coke|pepsi|sprite|water|lassi|juice|shake|tea|coffee|soda|beverage"),
)

# Weather condition names that mean rain.
RAIN_CONDITIONS: tuple[str, ...] = ("rain", "drizzle", "thunderstorm", "squall")

# Hours of the day making up each time window.
TIME_WINDOWS: tuple[tuple[str, tuple[int, ...]], ...] = (
    ("1-Morning Off-Peak", (10, 11)),
    ("2-Lunch Peak", (12, 13)),
    ("3-Afternoon Off-Peak", (14, 15, 16, 17, 18)),
    ("4-Dinner Peak", (19, 20)),
    ("5-Late Night Off-Peak", (21, 22)),
)
