"""Operators over price levels: conditions, heatmap, latest price, history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.config import BandRules
from pricetide.functions import scalars as S
from pricetide.operators.changes import ENTITY_KEYS, with_conditions


def _mean_price(digits: int):
    return S.half_up(F.avg("price"), digits).alias("avg_price")


def _per_session(observations: DataFrame, *keys: str) -> DataFrame:
    """``total``, ``priced`` and ``n`` of each key and session: what is joined to readings."""
    return observations.groupBy(*keys, "session_id").agg(
        F.sum(F.col("price").cast("double")).alias("total"),
        F.count("price").alias("priced"),
        F.count("*").alias("n"),
    )


def _mean_of_sums(digits: int):
    mean = F.sum("total") / F.nullif(F.sum("priced"), F.lit(0))
    return S.half_up(mean, digits).alias("avg_price")


def entity_condition_price(observations: DataFrame, conditions: DataFrame) -> DataFrame:
    """Mean price of each entity in rain and in dry weather.

    An inner join: observations without a reading are left out, and a session
    read twice counts twice.  Prices are summed per entity and session before the join, so
    observations themselves are never shuffled.
    """
    return (
        _per_session(observations, "entity")
        .join(conditions.select("session_id", "is_rainy"), "session_id")
        .groupBy("entity", S.rain_label(F.col("is_rainy")).alias("weather_condition"))
        .agg(_mean_of_sums(0), F.sum("n").alias("observation_count"))
    )


def market_condition_price(observations: DataFrame, conditions: DataFrame) -> DataFrame:
    """The same over the whole market."""
    return (
        _per_session(observations)
        .join(conditions.select("session_id", "is_rainy"), "session_id")
        .groupBy(S.rain_label(F.col("is_rainy")).alias("weather_condition"))
        .agg(_mean_of_sums(0), F.sum("n").alias("observation_count"))
    )


def category_hour_heatmap(
    observations: DataFrame, first_hour: int = 10, last_hour: int = 22
) -> DataFrame:
    return (
        observations.withColumn("hour_of_day", F.hour("observed_at"))
        .where(F.col("hour_of_day").between(first_hour, last_hour))
        .groupBy("category", "hour_of_day")
        .agg(_mean_price(0), F.count("*").alias("observation_count"))
    )


def band_summary(
    observations: DataFrame, conditions: DataFrame, bands: BandRules = BandRules()
) -> DataFrame:
    """Count, temperature range, mean and deviation of the price per band.

    Prices are summed up per session before the join; the deviation is put together
    from the sessions' own.
    """
    sessions = observations.groupBy("session_id").agg(
        F.expr("count(*) AS n"),
        F.expr("count(price) AS priced"),
        F.expr("coalesce(sum(cast(price AS double)), 0D) AS total"),
        F.expr("coalesce(count(price) * var_pop(cast(price AS double)), 0D) AS inner_squares"),
    )
    squares = (
        "sum(inner_squares + coalesce(total * total / nullif(priced, 0), 0D))"
        " - sum(total) * sum(total) / nullif(sum(priced), 0)"
    )
    return (
        with_conditions(sessions, conditions, bands)
        .where(F.col("temperature_band").isNotNull())
        .groupBy("temperature_band")
        .agg(
            F.expr("sum(n) AS total_records"),
            F.min("temperature").alias("temp_min"),
            F.max("temperature").alias("temp_max"),
            S.half_up(F.expr("sum(total) / nullif(sum(priced), 0)"), 2).alias("avg_price"),
            S.rounded_or_zero(
                F.expr(f"sqrt(greatest({squares}, 0D) / nullif(sum(priced) - 1, 0))"), 2
            ).alias("price_stddev"),
        )
    )


def entity_band_price(
    observations: DataFrame, conditions: DataFrame, bands: BandRules = BandRules()
) -> DataFrame:
    """Number and mean of prices per entity and band, summed per session before the join."""
    return (
        with_conditions(_per_session(observations, *ENTITY_KEYS), conditions, bands)
        .where(F.col("temperature_band").isNotNull())
        .groupBy(*ENTITY_KEYS, "temperature_band")
        .agg(F.sum("n").alias("total_records"), _mean_of_sums(2))
    )


def latest_prices(observations: DataFrame) -> DataFrame:
    """Newest price per (entity, item); category is not part of the key."""
    newest = F.max_by(
        F.struct("category", "price", "observed_at"), F.struct("observed_at", "ordinal")
    )
    return (
        observations.groupBy("entity", "item")
        .agg(newest.alias("newest"))
        .select("entity", "newest.category", "item", "newest.price", "newest.observed_at")
    )


def daily_prices(observations: DataFrame, *keys: str) -> DataFrame:
    """Mean, lowest, highest and number of prices per item and day."""
    return (
        observations.groupBy(
            *keys, "item", "category", F.col("observed_at").cast("date").alias("history_date")
        )
        .agg(
            _mean_price(2),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.count("*").alias("observations_that_day"),
        )
    )


def trailing_days(observations: DataFrame, days: int) -> DataFrame:
    """Rows of the last ``days`` days before the newest observation of the table."""
    if not 1 <= days <= 30:
        raise ValueError("days must lie between 1 and 30")
    newest = observations.agg(F.max("observed_at")).scalar()
    return observations.where(
        F.col("observed_at") >= newest - F.make_dt_interval(days=F.lit(days))
    )


def price_history(observations: DataFrame, days: int = 7, entity=None) -> DataFrame:
    """Daily prices over the trailing days, of one entity or of all of them.

    The newest day is taken over the whole table, also for a single entity.
    """
    recent = trailing_days(observations, days)
    if entity is None:
        return daily_prices(recent, "entity")
    return daily_prices(recent.where(F.col("entity") == entity))


def history_in_order(history: DataFrame) -> DataFrame:
    return history.orderBy(F.col("history_date").desc_nulls_last(), "item")


def entity_listing(observations: DataFrame, index: DataFrame) -> DataFrame:
    """Every observed entity with its indexed category.

    ``total_observations`` counts index rows, as existing readers expect;
    ``price_observations`` is the number of observations.
    """
    seen = observations.groupBy("entity").agg(F.count("*").alias("price_observations"))
    return (
        index.select("entity", "category")
        .join(seen, "entity", "right")
        .groupBy("entity", "category")
        .agg(
            F.count("*").alias("total_observations"),
            F.max("price_observations").alias("price_observations"),
        )
    )


def keep_last(rows: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The last row of each key in the given order.

    A combinable aggregate: each map task sends one row per key at most.
    """
    rest = [c for c in rows.columns if c not in (*keys, *order)]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*order, *rest), F.struct(*order)).alias("_last"))
        .select(*keys, "_last.*")
    )
