"""Scalar column expressions used by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetide.config import DISH_TYPES, RAIN_CONDITIONS, TIME_WINDOWS, BandRules

# ---------------------------------------------------------------- numbers


def half_up(value: Column, digits: int) -> Column:
    """Round half-up in decimal, so ties do not depend on the binary form."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def half_up_by_floor(value: Column, digits: int) -> Column:
    """:func:`half_up` for values between -1 and 1, where only those next to a tie go by decimals."""
    scale = 10.0**digits
    size = F.abs(value) * F.lit(scale)
    near_tie = F.abs(size - F.floor(size) - 0.5) < 1e-5
    whole = F.floor(size + 0.5)
    return (
        F.when(near_tie, half_up(value, digits))
        .when(value < 0, -whole / F.lit(scale))
        .otherwise(whole / F.lit(scale))
    )


def rounded_or_zero(value: Column, digits: int) -> Column:
    return F.coalesce(half_up(value, digits), F.lit(0.0))


def capped_scale(value: Column, cap: float) -> Column:
    """Negative values count as 0; ``cap`` and above as 100."""
    scaled = F.greatest(value, F.lit(0.0)) / F.lit(cap) * F.lit(100.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), scaled))


def max_scale(value: Column, largest: Column) -> Column:
    """Percent of the largest value; 0 when there is nothing to scale by."""
    return F.coalesce(value / F.nullif(largest, F.lit(0)) * 100, F.lit(0.0))


def minmax_scale(value: Column, low: Column, high: Column) -> Column:
    """0-100 between ``low`` and ``high``; 0 when the series is constant."""
    return F.coalesce((value - low) / F.nullif(high - low, F.lit(0.0)) * 100, F.lit(0.0))


def zscore_scale(value: Column, mean: Column, deviation: Column) -> Column:
    """``15 z + 50`` clamped to [0, 100]; a constant series sits at 50."""
    z = F.coalesce((value - mean) / F.nullif(deviation, F.lit(0.0)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), z * 15 + 50))


def normal_two_sided_p(z: Column) -> Column:
    """P(|Z| > z) for z >= 0, by the Abramowitz-Stegun 7.1.26 polynomial."""
    x = z / F.sqrt(F.lit(2.0))
    q = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = F.lit(1.061405429) * q - F.lit(1.453152027)
    for coefficient in (1.421413741, -0.284496736, 0.254829592):
        poly = poly * q + F.lit(coefficient)
    return poly * q * F.exp(-x * x)


# ---------------------------------------------------------------- text


def currency_to_int(text: Column) -> Column:
    """``"₹123"`` to 123; NULL where the rest is not a whole number."""
    return F.trim(F.regexp_replace(text.cast("string"), "₹", "")).try_cast("int")


def is_rain(condition: Column) -> Column:
    return F.lower(condition).isin(*RAIN_CONDITIONS)


def dish_type(item: Column, rules: tuple[tuple[str, str], ...] = DISH_TYPES) -> Column:
    """First rule whose keyword occurs in the item name, else ``Other``."""
    name = F.lower(item)
    label = F.when(item.isNull(), F.lit(None).cast("string"))
    for kind, pattern in rules:
        label = label.when(name.rlike(pattern), kind)
    return label.otherwise("Other")


# ---------------------------------------------------------------- time


def epoch_micros_sql(at: str) -> str:
    """SQL text: microseconds since 1970 of a zone-less timestamp column.

    Put together from its fields, so it does not depend on the session's zone.
    """
    return (
        f"(unix_date(cast({at} AS date)) * 86400000000L + hour({at}) * 3600000000L"
        f" + minute({at}) * 60000000L + cast(extract(SECOND FROM {at}) * 1000000 AS bigint))"
    )


def epoch_micros(at: str) -> Column:
    return F.expr(epoch_micros_sql(at))


def session_id(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd_HHmm")


def to_minute(at: Column) -> Column:
    return F.date_trunc("minute", at).cast("timestamp_ntz")


def parse_minute(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm"))


def is_weekend(at: Column) -> Column:
    return F.dayofweek(at.cast("date")).isin(1, 7)


def time_window(hour: Column, numbered: bool = True) -> Column:
    """Named part of the day; ``Other`` outside the trading hours."""
    label = F.when(hour.isNull(), "Other")
    for name, hours in TIME_WINDOWS:
        shown = name if numbered else name.split("-", 1)[1]
        label = label.when(hour.isin(*hours), shown)
    return label.otherwise("Other")


# ---------------------------------------------------------------- labels


def temperature_band(celsius: str, rules: BandRules = BandRules()) -> Column:
    return F.expr(
        f"CASE WHEN {celsius} < {rules.cool_below}D THEN 'Cool'"
        f" WHEN {celsius} < {rules.hot_from}D THEN 'Normal'"
        f" WHEN {celsius} >= {rules.hot_from}D THEN 'Hot' END"
    )


def rain_label(rainy: Column) -> Column:
    """An unknown flag counts as ``Dry``."""
    return F.when(rainy, "Rain").otherwise("Dry")


def verdict(count: Column, mean: Column, least: int, up: str, down: str) -> Column:
    enough = count >= least
    return (
        F.when(enough & (mean > 0), up)
        .when(enough & (mean < 0), down)
        .otherwise("No significant change")
    )


def index_band(score: Column, right_closed: bool = False) -> Column:
    """Behaviour label of an index score; edges 25, 50, 75 belong to the upper
    band unless ``right_closed``."""

    def below(edge: float) -> Column:
        return score <= edge if right_closed else score < edge

    return (
        F.when(below(25), "Static Pricer")
        .when(below(50), "Low Dynamic")
        .when(below(75), "Moderate Dynamic")
        .otherwise("Aggressive Dynamic")
    )


def strength(r: Column, strong: float = 0.7) -> Column:
    return F.when(F.abs(r) >= strong, "Strong").otherwise("Moderate")
