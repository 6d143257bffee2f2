"""The whole refresh: observations and conditions to a published set of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricetide.config import BandRules, ChangeRules, IndexRules, PairRules, SkewRules
from pricetide.operators import changes as C
from pricetide.operators import comovement, hourly, metrics, prices, pricing_index
from pricetide.session import materialise, scratch_space
from pricetide.sources.publish import publish_set


def metric_tables(
    observations: DataFrame,
    conditions: DataFrame,
    rules: ChangeRules = ChangeRules(),
    bands: BandRules = BandRules(),
    index_rules: IndexRules = IndexRules(),
    pair_rules: PairRules = PairRules(),
    skew_rules: SkewRules = SkewRules(),
) -> dict[str, DataFrame]:
    """The fifteen metric tables.

    Change events and the spine (every entity, dish type and hour ever seen) are
    written once; all change metrics then read these two small tables, and only
    the three price-level tables read the observations again.
    """
    changes = materialise(
        C.price_changes(observations, conditions, rules, bands, skew_rules), "changes"
    )
    spine = materialise(
        C.spine(C.with_dimensions(observations), *C.ENTITY_KEYS, "dish_type", "hour_of_day"),
        "spine",
    )
    profile = materialise(metrics.entity_profile(spine, changes), "profile")
    grid = hourly.entity_hour_grid(spine, changes)
    index = pricing_index.score_components(pricing_index.index_components(profile), index_rules)
    return {
        "stability_score": metrics.stability_from(profile),
        "rain_premium": metrics.rain_from(profile),
        "weekend_premium": metrics.weekend_from(profile),
        "temperature_effect": metrics.temperature_from(profile),
        "category_sensitivity": metrics.category_sensitivity(spine, changes),
        "hourly_overall": hourly.hourly_overall(spine, changes),
        "hourly_per_entity": hourly.per_entity_from(grid),
        "hourly_peak": hourly.peak_from(grid),
        "peak_offpeak": hourly.windows_from(grid),
        "sync_pairs_all": comovement.sync_pairs_all(changes, pair_rules),
        "sync_pairs_rain": comovement.sync_pairs_rain(changes, pair_rules),
        "dynamic_pricing_index": index,
        "entity_condition_price": prices.entity_condition_price(observations, conditions),
        "market_condition_price": prices.market_condition_price(observations, conditions),
        "category_hour_heatmap": prices.category_hour_heatmap(observations),
    }


def refresh(
    spark: SparkSession,
    observations: DataFrame,
    conditions: DataFrame,
    root: str,
    rules: ChangeRules = ChangeRules(),
    run_id: str | None = None,
    **options,
) -> str:
    """Compute all tables and publish them as one set below ``root``.

    What is written on the way is removed at the end.
    """
    with scratch_space(spark):
        tables = metric_tables(observations, conditions, rules, **options)
        return publish_set(spark, tables, root, run_id)
