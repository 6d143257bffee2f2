"""Per-entity and per-dish-type measures of how prices move.

``base`` supplies the entities, hours and dish types to report on (observations
with dimensions); ``changes`` are the price-change events.  The four measures of
an entity come from one aggregate, :func:`entity_profile`; each measure selects
its columns from it, and Spark prunes the rest.  Where a profile is needed more
than once (to scale by its maximum, to rank), it is written out first: one pass
over the observations, then work on one row per entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.config import VerdictRules
from pricetide.functions import scalars as S
from pricetide.operators.changes import ENTITY_KEYS, events_and_spine
from pricetide.session import materialise


def _mean_if(condition: Column) -> Column:
    return F.avg(F.when(condition, F.col("pct_change")))


def entity_profile(base: DataFrame, changes: DataFrame) -> DataFrame:
    """All aggregates of one entity's change events, unrounded, in one pass."""
    count_and_mean = {
        "rain": "is_rainy",
        "clear": "NOT is_rainy",
        "weekend": "is_weekend",
        "weekday": "NOT is_weekend",
        "cool": "temperature_band = 'Cool'",
        "normal": "temperature_band = 'Normal'",
        "hot": "temperature_band = 'Hot'",
    }
    return (
        events_and_spine(base, changes, *ENTITY_KEYS)
        .groupBy(*ENTITY_KEYS)
        .agg(
            F.expr("count(is_event) AS events"),
            F.expr("stddev_samp(pct_change) AS pct_stddev"),
            F.expr("avg(new_price) AS mean_new_price"),
            *[F.expr(f"count_if({when}) AS n_{name}") for name, when in count_and_mean.items()],
            *[
                F.expr(f"avg(pct_change) FILTER (WHERE {when}) AS mean_{name}")
                for name, when in count_and_mean.items()
            ],
        )
    )


def volatility(profile: DataFrame) -> Column:
    """Events as a percent of the busiest entity's events."""
    busiest = profile.agg(F.max("events")).scalar()
    return S.rounded_or_zero(S.max_scale(F.col("events"), busiest), 2)


def stability_from(profile: DataFrame) -> DataFrame:
    """``cv_pct`` is the deviation of the changes and ``avg_price`` the mean newer
    price at a change; the names are kept for readers of these tables."""
    return profile.select(
        *ENTITY_KEYS,
        F.col("events").alias("price_change_events"),
        S.rounded_or_zero(F.col("pct_stddev"), 4).alias("cv_pct"),
        S.rounded_or_zero(F.col("mean_new_price"), 2).alias("avg_price"),
        volatility(profile).alias("pvs_normalized"),
    )


def rain_from(
    profile: DataFrame, rules: VerdictRules = VerdictRules(), uplift: bool = False
) -> DataFrame:
    result = profile.select(
        *ENTITY_KEYS,
        F.col("n_rain").alias("rainy_records"),
        F.col("n_clear").alias("clear_records"),
        S.rounded_or_zero(F.col("mean_rain"), 2).alias("avg_change_rain"),
        S.rounded_or_zero(F.col("mean_clear"), 2).alias("avg_change_clear"),
        S.rounded_or_zero(F.col("mean_rain"), 2).alias("rpi"),
        (F.col("n_rain") >= rules.rain).alias("significant"),
        S.verdict(
            F.col("n_rain"), F.col("mean_rain"), rules.rain,
            "Surge confirmed", "Drop during rain",
        ).alias("verdict"),
    )
    return _with_uplift(result, "avg_change_rain", "avg_change_clear", "rpi", uplift)


def weekend_from(
    profile: DataFrame, rules: VerdictRules = VerdictRules(), uplift: bool = False
) -> DataFrame:
    result = profile.select(
        *ENTITY_KEYS,
        F.col("n_weekend").alias("weekend_records"),
        F.col("n_weekday").alias("weekday_records"),
        S.rounded_or_zero(F.col("mean_weekend"), 2).alias("avg_change_weekend"),
        S.rounded_or_zero(F.col("mean_weekday"), 2).alias("avg_change_weekday"),
        S.rounded_or_zero(F.col("mean_weekend"), 2).alias("wpi"),
        (F.col("n_weekend") >= rules.weekend).alias("significant"),
        S.verdict(
            F.col("n_weekend"), F.col("mean_weekend"), rules.weekend,
            "Weekend premium confirmed", "Cheaper on weekends",
        ).alias("verdict"),
    )
    return _with_uplift(result, "avg_change_weekend", "avg_change_weekday", "wpi", uplift)


def temperature_from(
    profile: DataFrame, rules: VerdictRules = VerdictRules(), uplift: bool = False
) -> DataFrame:
    """``avg_price_hot`` and ``avg_price_normal`` are mean changes in percent."""
    extreme = F.col("n_hot") + F.col("n_cool")
    result = profile.select(
        *ENTITY_KEYS,
        F.col("n_cool").alias("cool_records"),
        F.col("n_normal").alias("normal_records"),
        F.col("n_hot").alias("hot_records"),
        S.rounded_or_zero(F.col("mean_hot"), 2).alias("avg_price_hot"),
        S.rounded_or_zero(F.col("mean_normal"), 2).alias("avg_price_normal"),
        S.rounded_or_zero(F.col("mean_hot"), 2).alias("temp_effect_score"),
        (extreme >= rules.temperature).alias("significant"),
        S.verdict(
            extreme, F.col("mean_hot"), rules.temperature,
            "Price rises in heat", "Price drops in heat",
        ).alias("verdict"),
    )
    return _with_uplift(result, "avg_price_hot", "avg_price_normal", "temp_effect", uplift)


def _with_uplift(
    result: DataFrame, under: str, otherwise: str, prefix: str, wanted: bool
) -> DataFrame:
    """Optionally the difference to the opposite condition, in points."""
    if not wanted:
        return result
    return result.withColumn(
        f"{prefix}_uplift", S.half_up(F.col(under) - F.col(otherwise), 2)
    )


def stability_score(base: DataFrame, changes: DataFrame) -> DataFrame:
    needed = entity_profile(base, changes).select(
        *ENTITY_KEYS, "events", "pct_stddev", "mean_new_price"
    )
    return stability_from(materialise(needed, "stability"))


def rain_premium(base: DataFrame, changes: DataFrame, **options) -> DataFrame:
    return rain_from(entity_profile(base, changes), **options)


def weekend_premium(base: DataFrame, changes: DataFrame, **options) -> DataFrame:
    return weekend_from(entity_profile(base, changes), **options)


def temperature_effect(base: DataFrame, changes: DataFrame, **options) -> DataFrame:
    return temperature_from(entity_profile(base, changes), **options)


def category_sensitivity(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Mean change per dish type, in all, in rain and at weekends; not for Other."""
    named = F.col("dish_type") != "Other"
    return (
        events_and_spine(base.where(named), changes.where(named), "dish_type")
        .groupBy("dish_type")
        .agg(
            F.count("is_event").alias("total_change_events"),
            S.rounded_or_zero(_mean_if(F.col("is_rainy")), 2).alias("rpi"),
            S.rounded_or_zero(_mean_if(F.col("is_weekend")), 2).alias("wpi"),
            S.rounded_or_zero(F.avg("pct_change"), 2).alias("sensitivity_score"),
        )
    )
