"""The given tables seen as price observations and conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.config import ChangeRules
from pricetide.functions import scalars as S
from pricetide.sources.captures import embed_state

# Events change price by any amount; only the time gap is limited.
RELAXED = ChangeRules(
    min_price=None, max_abs_diff=None, max_rel_diff=None, max_gap_seconds=24 * 3600
)

# 2024-01-01 in epoch seconds and the length of a session.
FIRST_SECOND = 1_704_067_200
SESSION_SECONDS = 7_200

EVENTS_SCHEMA = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bucket(at: str) -> str:
    seconds = f"floor({S.epoch_micros_sql(at)} / 1000000)"
    return f"floor(({seconds} - {FIRST_SECOND}) / {SESSION_SECONDS})"


def event_observations(events: DataFrame) -> DataFrame:
    """``events`` as observations: users are entities, event types are items."""
    return events.selectExpr(
        "user_id AS entity",
        "concat('cat_', cast(user_id % 5 AS string)) AS category",
        "event_type AS item",
        "CASE WHEN event_type = 'signup' THEN 'Other' ELSE event_type END AS dish_type",
        "value AS price",
        "ts AS observed_at",
        f"cast({_bucket('ts')} AS string) AS session_id",
        "event_id AS ordinal",
    )


def event_conditions(events: DataFrame) -> DataFrame:
    """One reading per two-hour session between the first and last event.

    Only the time range of the events is aggregated, so the number of readings
    follows the calendar.  Some sessions have no reading.
    """
    return (
        events.agg(F.expr("min(ts) AS first_at"), F.expr("max(ts) AS last_at"))
        .selectExpr(f"explode(sequence({_bucket('first_at')}, {_bucket('last_at')})) AS bucket")
        .where("bucket % 11 <> 3")
        .selectExpr(
            "cast(bucket AS string) AS session_id",
            "bucket % 5 = 0 AS is_rainy",
            "cast(20 + (bucket * 7) % 25 AS double) AS temperature",
            "bucket AS recorded_at",
        )
    )


def lineitem_observations(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as observations: suppliers are entities, parts are items."""
    return lineitem.selectExpr(
        "l_suppkey AS entity",
        "l_returnflag AS category",
        "l_partkey AS item",
        "l_extendedprice / nullif(l_quantity, 0D) AS price",
        "l_shipdate AS observed_at",
        "date_format(l_shipdate, 'yyyyMMdd') AS session_id",
        "l_orderkey * 100 + l_linenumber AS ordinal",
    )


def embedded_pages(pages: DataFrame) -> DataFrame:
    """Captured pages whose state lists the page, its address and its length.

    The given pages carry no state, so one is built from their own columns and
    embedded into the whole page text.
    """
    state = F.to_json(
        F.struct(
            F.struct(
                F.col("url").alias("name"),
                (F.col("page_id") + 1).alias("price"),
                F.array(
                    F.struct(
                        F.concat(F.lit("häuser "), F.col("page_id").cast("string")).alias("title"),
                        (F.length("html") + 0.75).alias("Cost"),
                    ),
                    F.struct(
                        F.lit("free").alias("title"),
                        (F.col("page_id") * 0).alias("Cost"),
                    ),
                ).alias("items"),
            ).alias("page")
        )
    )
    return pages.select("page_id", embed_state(F.col("html"), state).alias("html"))
