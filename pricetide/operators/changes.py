"""From price observations to price-change events.

Observations have the columns ``entity, category, item, price, observed_at,
session_id, ordinal``; ``ordinal`` breaks ties between observations of an item
at the same time.  ``dish_type`` may be present, otherwise it is derived from
the item name.  Conditions have ``session_id, is_rainy, temperature,
recorded_at``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.config import BandRules, ChangeRules, SkewRules
from pricetide.functions import scalars as S
from pricetide.operators import skew

ITEM_KEYS = ("entity", "category", "item")
ENTITY_KEYS = ("entity", "category")


def one_reading_per_session(conditions: DataFrame) -> DataFrame:
    """The latest reading of each session, so that joining it adds no rows."""
    rest = ", ".join(c for c in conditions.columns if c not in ("session_id", "recorded_at"))
    return (
        conditions.where("session_id IS NOT NULL")
        .groupBy("session_id")
        .agg(F.expr(f"max(struct(recorded_at, {rest})) AS _reading"))
        .select("session_id", "_reading.*")
    )


def with_dimensions(observations: DataFrame) -> DataFrame:
    """Add what follows from the observation alone: hour, weekend, dish type."""
    if "dish_type" not in observations.columns:
        observations = observations.withColumn("dish_type", S.dish_type(F.col("item")))
    return observations.selectExpr(
        "*",
        "hour(observed_at) AS hour_of_day",
        "dayofweek(cast(observed_at AS date)) IN (1, 7) AS is_weekend",
    )


def with_conditions(
    rows: DataFrame, conditions: DataFrame, bands: BandRules = BandRules()
) -> DataFrame:
    """Add ``is_rainy``, ``temperature`` and ``temperature_band`` of the session.

    Rows of sessions without a reading keep NULLs.  There is no broadcast hint:
    conditions have one row per session, and Spark broadcasts them when their
    measured size allows.
    """
    readings = one_reading_per_session(conditions).select("session_id", "is_rainy", "temperature")
    return rows.join(readings, "session_id", "left").withColumn(
        "temperature_band", S.temperature_band("temperature", bands)
    )


def analysis_base(
    observations: DataFrame, conditions: DataFrame, bands: BandRules = BandRules()
) -> DataFrame:
    """Every observation with its own dimensions and the session's conditions."""
    return with_conditions(with_dimensions(observations), conditions, bands)


def with_previous(
    observations: DataFrame,
    keys: Sequence[str] = ITEM_KEYS,
    rules: SkewRules = SkewRules(),
) -> DataFrame:
    """Add ``prev_price``, ``prev_at`` and ``gap_micros`` of each item's last price.

    One shuffle on the item key.  Items holding very many rows are cut into time
    slices, each starting with the last row of the slice before.
    """
    timed = observations.selectExpr("*", f"{S.epoch_micros_sql('observed_at')} AS _at")
    sliced = skew.add_slices(timed, keys, "_at", rules)
    rows = skew.with_last_row_of_previous_slice(
        sliced, keys, ("_at", "ordinal"), ("price", "observed_at")
    )
    in_time = f"PARTITION BY {', '.join(keys)}, {skew.SLICE} ORDER BY _at, ordinal"
    return (
        rows.selectExpr(
            "*",
            f"lag(price) OVER ({in_time}) AS prev_price",
            f"lag(observed_at) OVER ({in_time}) AS prev_at",
            f"_at - lag(_at) OVER ({in_time}) AS gap_micros",
        )
        .where(f"{skew.CARRY} IS NULL")
        .drop("_at", skew.SLICE, skew.CARRY)
    )


def is_valid_change(rules: ChangeRules) -> str:
    """The change filter over ``price``, ``prev_price`` and ``gap_micros``, as SQL."""
    conditions = ["price <> prev_price", "prev_price <> 0"]
    if rules.min_price is not None:
        conditions += [f"price > {rules.min_price}D", f"prev_price > {rules.min_price}D"]
    if rules.max_abs_diff is not None:
        conditions.append(f"abs(price - prev_price) <= {rules.max_abs_diff}D")
    if rules.max_rel_diff is not None:
        # nullif: the order in which conjuncts are evaluated is not fixed
        conditions.append(
            f"abs((price - prev_price) / nullif(prev_price, 0)) <= {rules.max_rel_diff}D"
        )
    if rules.max_gap_seconds is not None:
        conditions.append(f"gap_micros <= {rules.max_gap_seconds}L * 1000000L")
    return " AND ".join(conditions)


def change_events(
    observations: DataFrame,
    rules: ChangeRules = ChangeRules(),
    skew_rules: SkewRules = SkewRules(),
) -> DataFrame:
    """Valid price changes without the session's conditions."""
    moved = with_previous(observations, rules=skew_rules).where(is_valid_change(rules))
    return (
        with_dimensions(moved)
        .withColumns(
            {
                "prev_price": F.expr("cast(prev_price AS double)"),
                "new_price": F.expr("cast(price AS double)"),
            }
        )
        .withColumn("pct_change", F.expr("(new_price - prev_price) / nullif(prev_price, 0) * 100"))
    )


def price_changes(
    observations: DataFrame,
    conditions: DataFrame,
    rules: ChangeRules = ChangeRules(),
    bands: BandRules = BandRules(),
    skew_rules: SkewRules = SkewRules(),
) -> DataFrame:
    """Valid price changes with the conditions of the newer price's session.

    Conditions are joined after the filter, to the few rows that are changes.
    """
    events = change_events(observations, rules, skew_rules)
    return with_conditions(events, conditions, bands).select(
        *ITEM_KEYS,
        "dish_type",
        "session_id",
        "ordinal",
        "observed_at",
        "prev_at",
        "hour_of_day",
        "is_weekend",
        "is_rainy",
        "temperature",
        "temperature_band",
        "prev_price",
        "new_price",
        "pct_change",
    )


def spine(base: DataFrame, *columns: str) -> DataFrame:
    """The distinct values a metric must report on even where nothing changed."""
    return base.select(*columns).distinct()


def events_and_spine(base: DataFrame, changes: DataFrame, *columns: str) -> DataFrame:
    """Change events plus one row per spine value that carries no event.

    Grouping this by ``columns`` gives what a left join of spine and events would,
    without the join: silent groups come out with zero events.  ``is_event`` is
    TRUE on events.  As in a join on equality, an event with a NULL in
    ``columns`` belongs to no group.
    """
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        changes.where(complete)
        .withColumn("is_event", F.lit(True))
        .unionByName(spine(base, *columns), allowMissingColumns=True)
    )
