"""Stateful operators over streams of observations."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pricetide.config import AlertRules, ChangeRules
from pricetide.operators.changes import ITEM_KEYS, is_valid_change
from pricetide.streaming.sources import with_event_time

#: What a row that waits keeps, and what stands for an ordinal that is null.
WAITING = ["item", "at", "ordinal", "price", "session_id"]
NO_ORDINAL = -(2**63)


def _prices(observations: DataFrame, delay: str) -> DataFrame:
    return with_event_time(
        observations.select(
            *ITEM_KEYS,
            F.col("price").cast("double").alias("price"),
            "observed_at",
            F.unix_micros(F.col("observed_at").cast("timestamp")).alias("at"),
            "session_id",
            "ordinal",
        ),
        delay,
    )


def _events(paired: DataFrame, rules: ChangeRules) -> DataFrame:
    """Valid changes of rows with ``price, at`` and ``prev_price, prev_at``."""
    return (
        paired.withColumn("gap_micros", F.col("at") - F.col("prev_at"))
        .where(is_valid_change(rules))
        .select(
            *ITEM_KEYS,
            "session_id",
            "ordinal",
            F.timestamp_micros("at").cast("timestamp_ntz").alias("observed_at"),
            "prev_price",
            F.col("price").alias("new_price"),
            F.expr("(price - prev_price) / nullif(prev_price, 0) * 100").alias("pct_change"),
        )
    )


def stream_changes(
    observations: DataFrame,
    rules: ChangeRules = ChangeRules(),
    delay: str = "6 hours",
    slice_seconds: int | None = None,
) -> DataFrame:
    """Price-change events of a stream of observations.

    Time is cut into slices of ``slice_seconds``, as long as the gap by default.  A sliding
    window is a slice together with at least the gap before it: of an item it collects the
    rows of the slice and keeps the last row before.  Once the watermark has passed it, each row
    is paired with the one before, so the events do not depend on how the rows came in
    batches.  All of it is Spark's own aggregation; maps send on one row before the slice per
    item and window.

    A slice of an item is one row of state.  Shorter slices make it smaller where an item has
    very many rows, at the price of more windows per row.  Rows behind the watermark are
    dropped by Spark, which :func:`pricetide.streaming.sinks.run_available` reports.  Rules
    without a gap set no end to the windows; these go to :func:`stream_changes_keyed`.
    """
    gap = rules.max_gap_seconds
    if gap is None:
        return stream_changes_keyed(observations, rules, delay)
    own = max(1, slice_seconds or math.ceil(gap))
    ahead = max(1, math.ceil(gap / own)) * own
    rows = _prices(observations, delay).withColumn(
        "slice", F.window("observed_at", f"{ahead + own} seconds", f"{own} seconds")
    )
    inside = F.col("at") >= F.unix_micros(F.col("slice.start")) + ahead * 1_000_000
    runs = (
        rows.groupBy("slice", *ITEM_KEYS)
        .agg(
            F.collect_list(F.when(inside, F.struct("at", "ordinal", "price", "session_id"))).alias("run"),
            F.max(F.when(~inside, F.struct("at", "ordinal", "price"))).alias("last"),
        )
        .where(F.size("run") > 0)
        .select(*ITEM_KEYS, F.sort_array("run").alias("run"), "last")
    )

    def with_previous(row, place):
        previous = F.when(place == 0, F.col("last")).otherwise(
            F.get("run", place - 1).dropFields("session_id")
        )
        return row.withField("prev_at", previous["at"]).withField("prev_price", previous["price"])

    return _events(runs.select(*ITEM_KEYS, F.inline(F.transform("run", with_previous))), rules)


def stream_changes_keyed(
    observations: DataFrame,
    rules: ChangeRules = ChangeRules(),
    delay: str = "6 hours",
    buckets: int = 256,
) -> DataFrame:
    """The same events by keyed state, which also holds without a greatest gap.

    Rows wait until the watermark has passed them and are then paired in the order
    of their times.  Items are hashed into ``buckets``, each one row of state: the last price of
    every item and the rows that wait, as Arrow data.  A bucket is sorted and paired as a whole,
    so Python is called per bucket and batch, not per item.  The last price of an item
    is dropped when none within the gap can follow.  Python only pairs neighbouring
    prices, the change filter runs on Spark.
    """
    priced = _prices(observations, delay)
    item = T.StructType([f for f in priced.schema.fields if f.name in ITEM_KEYS])
    # Items as texts and ordinals without nulls: pandas would turn whole numbers with nulls into doubles.
    rows = priced.where(F.col("at").isNotNull()).select(
        F.pmod(F.xxhash64(*ITEM_KEYS), F.lit(buckets)).alias("bucket"),
        F.to_json(F.struct(*ITEM_KEYS)).alias("item"),
        "at",
        F.coalesce("ordinal", F.lit(NO_ORDINAL)).alias("ordinal"),
        "price",
        F.col("session_id").cast("string").alias("session_id"),
        "observed_at",
    )
    schema = "item string, session_id string, ordinal long, at long, price double, prev_at long, prev_price double"
    gap = rules.max_gap_seconds

    def pair(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        # rows of one bucket within the delay and one micro-batch, whose size the source limits
        parts = []
        if state.exists:
            with pa.ipc.open_stream(state.get[0]) as held:
                parts.append(held.read_pandas())
        if not state.hasTimedOut:
            parts += [new[WAITING].assign(done=False) for new in batches]
        found = pd.concat(parts, ignore_index=True)
        items = pd.factorize(found["item"])[0]
        prices = found["price"].to_numpy(float)
        first_nulls = np.where(np.isnan(prices), -np.inf, prices)
        order = np.lexsort((first_nulls, found["ordinal"], found["at"], items))
        found, items = found.take(order).reset_index(drop=True), items[order]
        passed = state.getCurrentWatermarkMs() * 1000
        at, done = found["at"].to_numpy(), found["done"].to_numpy(bool)
        ready = at <= passed
        follows = np.append(False, items[1:] == items[:-1])
        last = ready & ~np.append(follows[1:] & ready[1:], False)
        kept = ~ready
        kept |= last if gap is None else last & (at >= passed - gap * 1_000_000)
        if not kept.any():
            state.remove()
        else:
            left = pa.Table.from_pandas(found[kept].assign(done=ready[kept]), preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, left.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(left)
            state.update((sink.getvalue().to_pybytes(),))
            ends = None
            if not ready.all():
                ends = int(at[~ready].min()) // 1000
            elif gap is not None:
                ends = int(at[kept].max()) // 1000 + gap * 1000 + 1
            if ends is not None:
                state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        new = np.flatnonzero(ready & ~done & follows)
        if len(new):
            paired = found.loc[new, ["item", "session_id", "ordinal", "at", "price"]].reset_index(drop=True)
            yield paired.assign(prev_at=at[new - 1], prev_price=found["price"].to_numpy()[new - 1])

    paired = rows.groupBy("bucket").applyInPandasWithState(
        pair, schema, "held binary", "append", GroupStateTimeout.EventTimeTimeout
    )
    session_type = priced.schema["session_id"].dataType
    return _events(
        paired.select(
            F.from_json("item", item).alias("item"),
            F.col("session_id").cast(session_type).alias("session_id"),
            F.nullif("ordinal", F.lit(NO_ORDINAL)).alias("ordinal"),
            "at",
            "price",
            "prev_at",
            "prev_price",
        ).select("item.*", "session_id", "ordinal", "at", "price", "prev_at", "prev_price"),
        rules,
    )


def stream_hourly(
    changes: DataFrame, delay: str = "6 hours", length: str = "1 hour"
) -> DataFrame:
    """Events and mean change per tumbling window.

    In append mode a window appears once it is complete; in update mode at every
    change (see :func:`pricetide.streaming.sinks.read_latest`).
    """
    return (
        with_event_time(changes.select("observed_at", "pct_change"), delay)
        .groupBy(F.window("observed_at", length).alias("w"))
        .agg(F.count("*").alias("events"), F.avg("pct_change").alias("mean_change"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"), "events", "mean_change"
        )
    )


def stream_join(
    observations: DataFrame,
    conditions: DataFrame,
    before: str = "1 hour",
    after: str = "1 hour",
    delay: str = "1 hour",
    how: str = "inner",
    salts: int = 32,
) -> DataFrame:
    """Observations with the reading of their session, both arriving as streams.

    At any time nearly all arriving prices belong to the session just captured, so
    a session is spread over ``salts`` groups by item and each reading is repeated
    for all of them.

    A reading matches prices taken from ``before`` it to ``after`` it.  That bound
    lets Spark forget both sides in time; with ``how="leftOuter"`` an observation
    appears without a reading once none can come any more.
    """
    left = with_event_time(
        observations.withColumn("_salt", F.expr(f"pmod(xxhash64(entity, item), {salts}L)")), delay
    )
    right = with_event_time(
        conditions.select(
            F.expr(f"explode(sequence(0L, {salts - 1}L)) AS _group"),
            F.col("session_id").alias("_session"),
            F.col("recorded_at").alias("_recorded_at"),
            "is_rainy",
            "temperature",
        ),
        delay,
        "_recorded_at",
    )
    matching = F.expr(
        f"session_id = _session AND _salt = _group AND observed_at >= _recorded_at - INTERVAL {before}"
        f" AND observed_at <= _recorded_at + INTERVAL {after}"
    )
    return (
        left.join(right, matching, how)
        .drop("_session", "_recorded_at", "_salt", "_group")
        .withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))
    )


def stream_join_static(observations: DataFrame, conditions: DataFrame) -> DataFrame:
    """Streamed observations with readings from a table, none where it has none."""
    readings = conditions.select("session_id", "is_rainy", "temperature")
    return observations.join(readings, "session_id", "left")


def stream_dedupe(observations: DataFrame, delay: str = "6 hours") -> DataFrame:
    """The first capture of an item per session; repeats within ``delay`` are dropped."""
    return (
        with_event_time(observations, delay)
        .dropDuplicatesWithinWatermark(["session_id", "entity", "item"])
        .withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))
    )


def alerts(changes: DataFrame, rules: AlertRules = AlertRules()) -> DataFrame:
    """Changes large enough to report; works on streams and tables alike."""
    return changes.where(F.abs("pct_change") >= rules.min_abs_pct).withColumn(
        "direction", F.when(F.col("pct_change") > 0, "up").otherwise("down")
    )
