"""The queries over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.config import MEASURES, ChangeRules, IndexRules
from pricetide.functions import scalars as S
from pricetide.operators import (
    changes as C,
    comovement,
    coverage,
    hourly,
    metrics,
    prices,
    pricing_index,
    ranktests,
)
from pricetide.plans import adapters as A
from pricetide.plans import reads
from pricetide.plans.refresh import metric_tables, refresh
from pricetide.session import materialise, scratch_dir, write_text
from pricetide.sources import captures, publish, readers, writers
from pricetide.streaming import admission, sinks
from pricetide.streaming import operators as stream_ops
from pricetide.streaming import sources as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@dataclass
class Market:
    """The frames most queries start from."""

    observations: DataFrame
    conditions: DataFrame
    base: DataFrame
    changes: DataFrame


def market(spark: SparkSession, sf_dir: str, rules: ChangeRules = A.RELAXED) -> Market:
    events = A.table(spark, sf_dir, "events")
    observations = A.event_observations(events)
    conditions = A.event_conditions(events)
    return Market(
        observations,
        conditions,
        C.with_dimensions(observations),
        C.price_changes(observations, conditions, rules),
    )


def _full_base(m: Market) -> DataFrame:
    return C.analysis_base(m.observations, m.conditions)


# ------------------------------------------------------------ base and changes


@query
def analysis_base(spark, sf_dir):
    return _full_base(market(spark, sf_dir)).select(
        "ordinal",
        "entity",
        "category",
        "item",
        "dish_type",
        "price",
        "hour_of_day",
        "is_weekend",
        "is_rainy",
        "temperature_band",
        S.rain_label(F.col("is_rainy")).alias("weather_condition"),
        S.time_window(F.col("hour_of_day")).alias("time_window"),
        S.session_id(F.col("observed_at")).alias("minute_session"),
    )


def _shown_changes(changes: DataFrame) -> DataFrame:
    return changes.select(
        "ordinal",
        "entity",
        "category",
        "item",
        "hour_of_day",
        "is_weekend",
        "is_rainy",
        "temperature_band",
        "prev_price",
        "new_price",
        S.half_up(F.col("pct_change"), 6).alias("pct_change"),
    )


@query
def price_changes(spark, sf_dir):
    return _shown_changes(market(spark, sf_dir).changes)


@query
def price_changes_strict(spark, sf_dir):
    return _shown_changes(market(spark, sf_dir, ChangeRules()).changes)


@query
def daily_price_changes(spark, sf_dir):
    """Changes between daily prices, whatever the gap."""
    observations = A.lineitem_observations(A.table(spark, sf_dir, "lineitem"))
    rules = ChangeRules(min_price=50, max_abs_diff=None, max_rel_diff=0.3, max_gap_seconds=None)
    return C.change_events(observations.withColumn("dish_type", F.lit("part")), rules).select(
        "ordinal",
        "entity",
        "category",
        "item",
        S.half_up(F.col("prev_price"), 6).alias("prev_price"),
        S.half_up(F.col("new_price"), 6).alias("new_price"),
        S.half_up(F.col("pct_change"), 6).alias("pct_change"),
    )


@query
def spine_entity(spark, sf_dir):
    return C.spine(market(spark, sf_dir).base, *C.ENTITY_KEYS)


@query
def spine_hour(spark, sf_dir):
    return C.spine(market(spark, sf_dir).base, "hour_of_day")


@query
def spine_type(spark, sf_dir):
    return C.spine(market(spark, sf_dir).base.where(F.col("dish_type") != "Other"), "dish_type")


# ------------------------------------------------------------ entity measures


@query
def stability_score(spark, sf_dir):
    m = market(spark, sf_dir)
    return metrics.stability_score(m.base, m.changes)


@query
def rain_premium(spark, sf_dir):
    m = market(spark, sf_dir)
    return metrics.rain_premium(m.base, m.changes)


@query
def weekend_premium(spark, sf_dir):
    m = market(spark, sf_dir)
    return metrics.weekend_premium(m.base, m.changes)


@query
def temperature_effect(spark, sf_dir):
    m = market(spark, sf_dir)
    return metrics.temperature_effect(m.base, m.changes)


@query
def condition_uplifts(spark, sf_dir):
    """Premiums against the opposite condition."""
    m = market(spark, sf_dir)
    profile = metrics.entity_profile(m.base, m.changes)
    points = {
        "rpi_uplift": ("mean_rain", "mean_clear"),
        "wpi_uplift": ("mean_weekend", "mean_weekday"),
        "temp_effect_uplift": ("mean_hot", "mean_normal"),
    }
    return profile.select(
        *C.ENTITY_KEYS,
        *[
            S.half_up(
                S.rounded_or_zero(F.col(under), 2) - S.rounded_or_zero(F.col(other), 2), 2
            ).alias(name)
            for name, (under, other) in points.items()
        ],
    )


@query
def category_sensitivity(spark, sf_dir):
    m = market(spark, sf_dir)
    return metrics.category_sensitivity(m.base, m.changes)


@query
def hourly_overall(spark, sf_dir):
    m = market(spark, sf_dir)
    return hourly.hourly_overall(m.base, m.changes)


@query
def hourly_per_entity(spark, sf_dir):
    m = market(spark, sf_dir)
    return hourly.hourly_per_entity(m.base, m.changes)


@query
def hourly_peak(spark, sf_dir):
    m = market(spark, sf_dir)
    return hourly.hourly_peak(m.base, m.changes)


@query
def peak_offpeak(spark, sf_dir):
    m = market(spark, sf_dir)
    return hourly.peak_offpeak(m.base, m.changes)


# ------------------------------------------------------------ co-movement


@query
def sync_pairs_all(spark, sf_dir):
    return comovement.sync_pairs_all(market(spark, sf_dir).changes)


@query
def sync_pairs_rain(spark, sf_dir):
    return comovement.sync_pairs_rain(market(spark, sf_dir).changes)


@query
def sync_input_counts(spark, sf_dir):
    return comovement.sync_input_counts(market(spark, sf_dir).changes)


@query
def sync_hours_per_entity(spark, sf_dir):
    return comovement.hours_per_entity(market(spark, sf_dir).changes)


# ------------------------------------------------------------ index


def _index(spark, sf_dir, rules: IndexRules = IndexRules()) -> DataFrame:
    m = market(spark, sf_dir)
    return pricing_index.dynamic_pricing_index(m.base, m.changes, rules)


@query
def dynamic_pricing_index(spark, sf_dir):
    return _index(spark, sf_dir)


@query
def dynamic_pricing_index_right_closed(spark, sf_dir):
    return _index(spark, sf_dir, IndexRules(right_closed_bands=True))


@query
def dynamic_pricing_index_zscore(spark, sf_dir):
    return _index(spark, sf_dir, IndexRules(mode="zscore"))


@query
def dynamic_pricing_index_minmax(spark, sf_dir):
    return _index(spark, sf_dir, IndexRules(mode="minmax"))


# ------------------------------------------------------------ price levels


@query
def entity_condition_price(spark, sf_dir):
    m = market(spark, sf_dir)
    return prices.entity_condition_price(m.observations, m.conditions)


@query
def market_condition_price(spark, sf_dir):
    m = market(spark, sf_dir)
    return prices.market_condition_price(m.observations, m.conditions)


@query
def category_hour_heatmap(spark, sf_dir):
    return prices.category_hour_heatmap(market(spark, sf_dir).observations)


@query
def band_summary(spark, sf_dir):
    m = market(spark, sf_dir)
    return prices.band_summary(m.observations, m.conditions)


@query
def entity_band_price(spark, sf_dir):
    m = market(spark, sf_dir)
    return prices.entity_band_price(m.observations, m.conditions)


@query
def latest_prices(spark, sf_dir):
    newest = prices.latest_prices(A.lineitem_observations(A.table(spark, sf_dir, "lineitem")))
    return newest.withColumn("price", S.half_up(F.col("price"), 6))


@query
def price_history(spark, sf_dir):
    """Daily prices of every supplier over the last 30 days."""
    observations = A.lineitem_observations(A.table(spark, sf_dir, "lineitem"))
    history = prices.price_history(observations, days=30)
    return history.withColumns(
        {
            "min_price": S.half_up(F.col("min_price"), 6),
            "max_price": S.half_up(F.col("max_price"), 6),
        }
    )


@query
def price_history_entity(spark, sf_dir):
    """The same for one supplier; the newest day is that of the whole table."""
    observations = A.lineitem_observations(A.table(spark, sf_dir, "lineitem"))
    history = prices.price_history(observations, days=30, entity=1)
    return prices.history_in_order(
        history.withColumns(
            {
                "min_price": S.half_up(F.col("min_price"), 6),
                "max_price": S.half_up(F.col("max_price"), 6),
            }
        )
    )


@query
def latest_read(spark, sf_dir):
    return reads.latest_read(latest_prices(spark, sf_dir))


@query
def daily_prices(spark, sf_dir):
    observations = A.lineitem_observations(A.table(spark, sf_dir, "lineitem"))
    return prices.daily_prices(observations).withColumns(
        {
            "min_price": S.half_up(F.col("min_price"), 6),
            "max_price": S.half_up(F.col("max_price"), 6),
        }
    )


@query
def entity_listing(spark, sf_dir):
    m = market(spark, sf_dir)
    return prices.entity_listing(m.observations, _index(spark, sf_dir))


@query
def dish_types(spark, sf_dir):
    """Dish type by keyword, over part names with a dish put in so that every rule can match."""
    dishes = ["thali", "Biryani", "momo", "burger", "Popcorn", "rolls", "paneer", "kheer", "Soda", "scroll", ""]
    named = F.element_at(F.array(*map(F.lit, dishes)), (F.col("p_partkey") % len(dishes) + 1).cast("int"))
    name = F.concat_ws(" ", "p_name", named)
    return A.table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), S.dish_type(name).alias("dish_type"))


# ------------------------------------------------------------ reads


@query
def listing_read(spark, sf_dir):
    return reads.listing_read(entity_listing(spark, sf_dir))


@query
def pairs_read(spark, sf_dir):
    # a sort looks at its input twice, to find the ranges and to sort; the pairs are computed once
    return reads.pairs_read(materialise(sync_pairs_all(spark, sf_dir), "pairs"))


@query
def rankings_read(spark, sf_dir):
    return reads.rankings_read(_index(spark, sf_dir))


@query
def rain_read(spark, sf_dir):
    return reads.rain_read(rain_premium(spark, sf_dir))


@query
def weekend_read(spark, sf_dir):
    return reads.weekend_read(weekend_premium(spark, sf_dir))


@query
def category_read(spark, sf_dir):
    return reads.category_read(category_sensitivity(spark, sf_dir))


@query
def hourly_read(spark, sf_dir):
    return reads.hourly_read(hourly_overall(spark, sf_dir))


@query
def market_read(spark, sf_dir):
    return reads.market_read(market_condition_price(spark, sf_dir))


@query
def leaders(spark, sf_dir):
    return reads.leaders(_index(spark, sf_dir))


@query
def market_summary(spark, sf_dir):
    m = market(spark, sf_dir)
    profile = materialise(metrics.entity_profile(m.base, m.changes), "summary")
    index = pricing_index.score_components(pricing_index.index_components(profile))
    return reads.market_summary(materialise(index, "summary"), metrics.weekend_from(profile))


# ------------------------------------------------------------ rank tests


@query
def mann_whitney(spark, sf_dir):
    return ranktests.mann_whitney(_full_base(market(spark, sf_dir)))


@query
def kruskal_wallis(spark, sf_dir):
    return ranktests.kruskal_wallis(_full_base(market(spark, sf_dir)))


@query
def rank_test_report(spark, sf_dir):
    return ranktests.rank_test_report(_full_base(market(spark, sf_dir)))


# ------------------------------------------------------------ schedule and log


@query
def slot_coverage(spark, sf_dir):
    return coverage.slot_coverage(market(spark, sf_dir).observations)


@query
def next_slot(spark, sf_dir):
    at = market(spark, sf_dir).observations.select("ordinal", "observed_at")
    return coverage.next_slot(at, "observed_at")


def _runs(spark, sf_dir) -> DataFrame:
    """Every event as a capture run of its user, lasting ``k`` minutes."""
    events = A.table(spark, sf_dir, "events")
    minutes = F.from_json("props", "k int")["k"] % 40
    return events.select(
        F.col("user_id").alias("entity"),
        "event_id",
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(mins=minutes)).alias("ended_at"),
        minutes.alias("duration_minutes"),
    )


@query
def min_gap_thinning(spark, sf_dir):
    return coverage.min_gap_thinning(_runs(spark, sf_dir).select("entity", "started_at", "ended_at"))


def _log(spark, sf_dir) -> DataFrame:
    return _runs(spark, sf_dir).select(
        "entity",
        "status",
        F.col("event_id").alias("session_id"),
        F.col("started_at").alias("time"),
        "duration_minutes",
    )


@query
def recent_runs(spark, sf_dir):
    return coverage.recent_runs(_log(spark, sf_dir))


@query
def run_status(spark, sf_dir):
    return coverage.run_status(_log(spark, sf_dir))


@query
def run_log_status(spark, sf_dir):
    """Run-log files of twenty stations, written and read back, with an empty and a broken one."""
    path = scratch_dir(spark, "logs")
    log = _log(spark, sf_dir).withColumn("station", F.col("entity") % 20).drop("entity")
    recent = coverage.recent_runs(log, 10, ["station"])
    entry = F.struct(
        "position",
        "status",
        F.col("session_id").cast("string").alias("session_id"),
        F.date_format("time", "yyyy-MM-dd HH:mm").alias("time"),
        "duration_minutes",
    )
    logs = F.transform(
        F.sort_array("entries"), lambda x: F.struct(*(x[c].alias(c) for c in ("status", "session_id", "time", "duration_minutes")))
    )
    newest = F.element_at(logs, 1)
    state = F.struct(
        newest["status"].alias("last_status"),
        newest["session_id"].alias("last_session_id"),
        newest["time"].alias("last_scrape_time"),
        newest["duration_minutes"].alias("last_duration_minutes"),
        F.size(logs).alias("restaurants_scraped"),
        F.when(newest["status"] != "success", "timeout").alias("last_error_type"),
        logs.alias("recent_logs"),
    )
    written = recent.groupBy("station").agg(F.collect_list(entry).alias("entries"))
    written.select("station", F.to_json(state).alias("value")).write.partitionBy("station").text(path)
    write_text(spark, f"{path}/station=empty/log.txt", "\n")
    write_text(spark, f"{path}/station=broken/log.txt", '{"last_status": "succ')
    return readers.run_status_files(spark, path, "station=([^/]+)/")


@query
def keep_last_dedupe(spark, sf_dir):
    """The last price of an item in each session of an entity."""
    rows = market(spark, sf_dir).observations.select(
        "session_id", "entity", "item", "ordinal", "price"
    )
    return prices.keep_last(rows, ["session_id", "entity", "item"], "ordinal")


# ------------------------------------------------------------ raw captures


@query
def currency_clean(spark, sf_dir):
    """Prices as captured text, read back; every seventh line number is unreadable."""
    lineitem = A.table(spark, sf_dir, "lineitem")
    whole = F.floor("l_extendedprice").cast("string")
    raw = lineitem.select(
        F.col("l_suppkey").cast("string").alias("restaurant"),
        F.col("l_returnflag").alias("category"),
        F.col("l_partkey").cast("string").alias("item_name"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
        .otherwise(F.concat(F.lit(" ₹ "), whole))
        .alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm").alias("scraped_at"),
        F.date_format("l_shipdate", "yyyyMMdd_HHmm").alias("scrape_session_id"),
    )
    cleaned = readers.clean_prices(raw)
    return cleaned.groupBy("entity", "rejected").agg(
        F.count("*").alias("n"),
        F.sum("price").cast("long").alias("total"),
        F.min("observed_at").alias("first_at"),
        F.max("session_id").alias("last_session"),
    )


@query
def session_id(spark, sf_dir):
    return market(spark, sf_dir).observations.select(
        "ordinal",
        S.session_id(F.col("observed_at")).alias("minute_session"),
        S.to_minute(F.col("observed_at")).alias("minute"),
        S.parse_minute(F.date_format("observed_at", "yyyy-MM-dd HH:mm")).alias("parsed"),
        F.hour("observed_at").alias("hour_of_day"),
    )


@query
def props_json(spark, sf_dir):
    """Nested JSON payloads built from the events' own JSON, flattened again."""
    events = A.table(spark, sf_dir, "events")
    k = F.from_json("props", "k int")["k"]
    kinds = F.element_at(
        F.array(*[F.lit(x) for x in ("Rain", "Clouds", "Drizzle", "Clear", "Squall")]),
        (k % 5 + 1).cast("int"),
    )
    body = F.to_json(
        F.struct(
            F.struct(F.col("value").alias("temp"), k.alias("humidity")).alias("main"),
            F.array(
                F.struct(kinds.alias("main"), F.lower(kinds).alias("description"))
            ).alias("weather"),
            F.struct((k / 4).alias("speed")).alias("wind"),
            F.col("event_type").alias("name"),
        )
    )
    return captures.flatten_weather(events.select("event_id", body.alias("body")))


@query
def nested_price_extract(spark, sf_dir):
    return captures.extract_prices(A.embedded_pages(A.table(spark, sf_dir, "pages")))


@query
def page_faults(spark, sf_dir):
    """Items and faults of captured pages: in turn sound, cut off, too deep, and too dear."""
    deep = '{"name": "top", "price": 5, "rest": ' + "[" * 20 + '{"name": "low", "price": 7}' + "]" * 20 + "}"
    kind = F.col("page_id") % 4
    state = (
        F.when(kind == 0, F.to_json(F.struct(F.col("url").alias("name"), (F.col("page_id") + 1).alias("price"))))
        .when(kind == 1, F.lit('{"name": "cut", "price": 1'))
        .when(kind == 2, F.lit(deep))
        .otherwise(F.lit('[{"name": "dear", "price": 1e30}, {"name": "cheap", "price": 2.5}]'))
    )
    pages = A.table(spark, sf_dir, "pages")
    captured = pages.select("page_id", captures.embed_state(F.col("html"), state).alias("html"))
    return (
        captures.walk_pages(captured)
        .groupBy("page_id")
        .agg(F.count("item").alias("items"), F.sum("price").alias("total"), F.max("reason").alias("reason"))
    )


# ------------------------------------------------------------ files and tables


@query
def csv_roundtrip(spark, sf_dir):
    """Observations written as captured price files and read back."""
    path = scratch_dir(spark, "prices-csv")
    raw = A.table(spark, sf_dir, "events").selectExpr(
        "concat('user ', user_id) AS restaurant",
        "cast(NULL AS string) AS category",
        "event_type AS item_name",
        "concat('₹', cast(floor(value) AS bigint)) AS price",
        "date_format(ts, 'yyyy-MM-dd HH:mm') AS scraped_at",
        "date_format(ts, 'yyyyMMdd_HHmm') AS scrape_session_id",
    )
    raw.write.option("header", True).csv(path)
    return readers.accepted_prices(
        readers.clean_prices(readers.read_prices_csv(spark, path))
    ).drop("ordinal")


@query
def file_order(spark, sf_dir):
    """Rises and falls within one minute, in the order of the captured files' lines."""
    path = scratch_dir(spark, "prices-in-order")
    raw = A.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('user ', user_id) AS restaurant",
        "cast(NULL AS string) AS category",
        "event_type AS item_name",
        "concat('₹', cast(floor(value) AS bigint)) AS price",
        "date_format(ts, 'yyyy-MM-dd 00:00') AS scraped_at",
        "date_format(ts, 'yyyyMMdd') AS scrape_session_id",
    )
    # Files follow each other by name, as captures of later runs do.
    ordered = raw.repartitionByRange("event_id").sortWithinPartitions("event_id").drop("event_id")
    ordered.write.option("header", True).csv(path)
    captured = readers.accepted_prices(readers.clean_prices(readers.read_prices_csv(spark, path)))
    line = Window.partitionBy("entity", "item", "observed_at").orderBy("ordinal")
    step = F.col("price") - F.lag("price").over(line)
    return (
        captured.select("entity", "observed_at", step.alias("step"))
        .groupBy("entity", "observed_at")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("step") > 0).alias("rises"),
            F.count_if(F.col("step") < 0).alias("falls"),
            F.sum(F.greatest("step", F.lit(0))).cast("long").alias("risen"),
        )
    )


@query
def conditions_roundtrip(spark, sf_dir):
    """Readings written as a condition file without header and read back."""
    path = scratch_dir(spark, "conditions-csv")
    conditions = market(spark, sf_dir).conditions
    conditions.selectExpr(
        "'town' AS city",
        "temperature",
        "40 AS humidity",
        "CASE WHEN is_rainy THEN 'Rain' ELSE 'Clear' END AS condition",
        "'sky, mostly' AS description",
        "2.5D AS wind_speed",
        "CASE WHEN is_rainy THEN 'True' ELSE 'False' END AS is_rainy",
        f"date_format(timestampadd(SECOND, recorded_at * {A.SESSION_SECONDS},"
        " timestamp_ntz'2024-01-01 00:00:00'), 'yyyy-MM-dd HH:mm') AS recorded_at",
        "session_id",
    ).write.csv(path)
    return readers.read_conditions_csv(spark, path)


#: Those that are exported as files too: all but the price levels.
EXPORTED = list(MEASURES)[:12]


def _summed_up(tables: dict[str, DataFrame]) -> DataFrame:
    """Name, rows and checksum of each table."""
    parts = [
        table.agg(
            F.lit(name).alias("name"),
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.round(F.col(MEASURES[name]) * 10_000).cast("long")), F.lit(0)).alias("checksum"),
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def csv_export(spark, sf_dir):
    """The twelve metric tables exported as CSV folders and read back."""
    m = market(spark, sf_dir)
    tables = metric_tables(m.observations, m.conditions, A.RELAXED)
    written = writers.export_csv({name: tables[name] for name in EXPORTED}, scratch_dir(spark, "export"))
    return _summed_up(
        {
            name: spark.read.schema(tables[name].schema).option("header", True).csv(path)
            for name, path in written.items()
        }
    )


@query
def append_by_day(spark, sf_dir):
    """Observations appended below one folder per day, counted per day."""
    path = scratch_dir(spark, "by-day")
    writers.append_batch(market(spark, sf_dir).observations, path)
    return (
        spark.read.parquet(path)
        .groupBy("obs_date")
        .agg(F.count("*").alias("n"), S.half_up(F.sum("price"), 2).alias("total"))
    )


@query
def schema_backfill(spark, sf_dir):
    """Older files, written before a column existed, read together with newer ones."""
    path = scratch_dir(spark, "grown")
    observations = market(spark, sf_dir).observations
    older = observations.where("observed_at < timestamp_ntz'2024-01-15'").drop("session_id")
    older.write.parquet(f"{path}/part=1")
    observations.where("observed_at >= timestamp_ntz'2024-01-15'").write.parquet(f"{path}/part=2")
    return readers.read_grown_table(spark, path).select("ordinal", "entity", "price", "session_id")


@query
def publish_set(spark, sf_dir):
    """All fifteen metric tables computed and published as one set, and read back."""
    m = market(spark, sf_dir)
    root = scratch_dir(spark, "published")
    refresh(spark, m.observations, m.conditions, root, A.RELAXED)
    return _summed_up({name: publish.read_published(spark, root, name) for name in MEASURES})


# ------------------------------------------------------------ streams


#: Days per micro-batch of a replayed backlog; the tables span about a month.
SLICE_DAYS = 10
SLICE_DELAY = f"{SLICE_DAYS} days"
LATE_SECONDS = 2 * 86_400


def _stream(spark, sf_dir, closed: bool = False) -> DataFrame:
    """The events as a stream of several micro-batches, in the order of their days."""
    path = scratch_dir(spark, "replay")
    observations = A.event_observations(A.table(spark, sf_dir, "events"))
    _, files = admission.replay_in_slices(observations, path, days=SLICE_DAYS)
    if closed:
        admission.close(spark, path, observations.schema)
    return streams.stream_table(spark, path, observations.schema, batch_files=files)


def _ran(spark, stream: DataFrame, mode: str = "append") -> str:
    path = scratch_dir(spark, "stream")
    sinks.run_available(stream, path, f"{path}-checkpoint", mode)
    return path


def _streamed_changes(spark, sf_dir) -> tuple[str, T.StructType]:
    """Change events of the replayed backlog; a row behind the watermark would be an error."""
    changes = stream_ops.stream_changes(_stream(spark, sf_dir, closed=True), A.RELAXED, SLICE_DELAY)
    return _ran(spark, changes), changes.schema


@query
def stream_changes(spark, sf_dir):
    path, schema = _streamed_changes(spark, sf_dir)
    return sinks.read_batches(spark, path, schema).withColumn(
        "pct_change", S.half_up(F.col("pct_change"), 6)
    )


@query
def stream_changes_keyed_state(spark, sf_dir):
    """The same events by keyed state."""
    changes = stream_ops.stream_changes_keyed(_stream(spark, sf_dir, closed=True), A.RELAXED, SLICE_DELAY)
    return sinks.read_batches(spark, _ran(spark, changes), changes.schema).withColumn(
        "pct_change", S.half_up(F.col("pct_change"), 6)
    )


@query
def stream_admission(spark, sf_dir):
    """Two deliveries, even days and then odd ones: what of them is on time and what is late."""
    observations = A.event_observations(A.table(spark, sf_dir, "events"))
    path, out = scratch_dir(spark, "deliveries"), scratch_dir(spark, "admission")
    for odd in (0, 1):
        part = observations.where(F.dayofmonth("observed_at") % 2 == odd)
        part.write.mode("append").parquet(path)
        # a delivery is one batch whatever its size, so the parts are the same everywhere
        delivered = streams.stream_table(spark, path, observations.schema, batch_bytes=2**62)
        admitted, late = admission.admit(delivered, out, f"{out}-checkpoint", LATE_SECONDS)
    counted = [
        sinks.read_batches(spark, folder, observations.schema)
        .groupBy("entity")
        .agg(F.count("*").alias("n"), F.sum("ordinal").alias("ordinals"))
        .withColumn("late", F.lit(is_late))
        for is_late, folder in ((False, admitted), (True, late))
    ]
    return counted[0].unionByName(counted[1])


@query
def stream_hourly(spark, sf_dir):
    """Windows over the table that the change stream fills."""
    path, schema = _streamed_changes(spark, sf_dir)
    windows = stream_ops.stream_hourly(
        # a batch of changes spans what had waited and a slice, in files of any order
        streams.stream_table(spark, f"{path}/*/*", schema),
        delay=f"{3 * SLICE_DAYS} days",
    )
    latest = sinks.read_latest(
        spark, _ran(spark, windows, "update"), windows.schema, ["window_start"]
    )
    return latest.withColumn("mean_change", S.half_up(F.col("mean_change"), 4))


@query
def stream_alerts(spark, sf_dir):
    path, schema = _streamed_changes(spark, sf_dir)
    reported = stream_ops.alerts(streams.stream_table(spark, f"{path}/*/*", schema))
    return sinks.read_batches(spark, _ran(spark, reported), reported.schema).select(
        "entity", "item", "ordinal", "direction", S.half_up(F.col("pct_change"), 6).alias("pct_change")
    )


@query
def stream_ingest(spark, sf_dir):
    """Price files with broken lines, prices and times taken in as a stream; each line accounted for."""
    path, out = scratch_dir(spark, "arrivals"), scratch_dir(spark, "ingested")
    fields = F.concat_ws(
        ",",
        F.concat(F.lit("user "), "user_id"),
        F.lit("snacks"),
        "event_type",
        F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.concat(F.lit("₹"), F.floor("value").cast("string"))),
        F.when(F.col("event_id") % 11 == 1, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm")),
        F.date_format("ts", "yyyyMMdd_HHmm"),
    )
    short = F.concat(F.lit("user "), "user_id", F.lit(",cut"))
    A.table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 13 == 2, short).otherwise(fields).alias("value")
    ).write.text(path)
    streams.ingest_prices(spark, path, out, f"{out}-checkpoint", header=False)
    accepted = streams.read_ingested(spark, out, rejected=False).withColumn("reason", F.lit("accepted"))
    rejected = streams.read_ingested(spark, out, rejected=True)
    columns = ["entity", "reason", "price", "observed_at"]
    return (
        accepted.select(columns)
        .unionByName(rejected.select(columns))
        .groupBy("entity", "reason")
        .agg(F.count("*").alias("n"), F.sum("price").alias("total"), F.max("observed_at").alias("last_at"))
    )


@query
def stream_join(spark, sf_dir):
    """Observations and readings, both as streams, joined on the session."""
    readings = market(spark, sf_dir).conditions.withColumn(
        "recorded_at",
        F.expr(
            f"timestampadd(SECOND, recorded_at * {A.SESSION_SECONDS},"
            " timestamp_ntz'2024-01-01 00:00:00')"
        ),
    )
    stored = scratch_dir(spark, "conditions")
    _, files = admission.replay_in_slices(readings, stored, "recorded_at", SLICE_DAYS)
    joined = stream_ops.stream_join(
        _stream(spark, sf_dir),
        streams.stream_table(spark, stored, readings.schema, batch_files=files),
        before="0 hours",
        after="2 hours",
        delay=SLICE_DELAY,
    )
    return sinks.read_batches(spark, _ran(spark, joined), joined.schema).select(
        "ordinal", "entity", "observed_at", "session_id", "is_rainy", "temperature"
    )


@query
def stream_dedupe(spark, sf_dir):
    first = stream_ops.stream_dedupe(_stream(spark, sf_dir), SLICE_DELAY)
    return sinks.read_batches(spark, _ran(spark, first), first.schema).select(
        "session_id", "entity", "item"
    )
