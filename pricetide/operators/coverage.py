"""Questions about the capture schedule and its run log."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.config import SkewRules, SlotRules
from pricetide.functions import scalars as S
from pricetide.operators import skew
from pricetide.session import materialise


def nearest_slot(at, rules: SlotRules = SlotRules()):
    """Minute of the day of the nearest slot within the tolerance, else NULL.

    The earlier slot wins a tie.
    """
    minute = F.hour(at) * 60 + F.minute(at)
    slots = [
        F.struct(F.abs(minute - slot).alias("off"), F.lit(slot).alias("slot"))
        for slot in rules.slot_minutes
    ]
    nearest = F.least(*slots) if len(slots) > 1 else slots[0]
    return F.when(nearest["off"] <= rules.tolerance_minutes, nearest["slot"])


def slot_coverage(
    observations: DataFrame, rules: SlotRules = SlotRules(), keys: Sequence[str] = ("entity",)
) -> DataFrame:
    """Scheduled slots without an observation, per key and day.

    Days run from the first to the last day of the whole table.  The slots seen, a
    table bounded by keys and calendar, are written out, so the observations are
    read once.
    """
    seen = materialise(
        observations.select(
            *keys,
            F.col("observed_at").cast("date").alias("obs_date"),
            nearest_slot(F.col("observed_at"), rules).alias("slot_minute"),
        ).distinct(),
        "slots",
    )
    days = seen.agg(F.sequence(F.min("obs_date"), F.max("obs_date"))).scalar()
    slots = F.array(*[F.lit(s) for s in rules.slot_minutes])
    expected = (
        seen.select(*keys)
        .distinct()
        .withColumn("obs_date", F.explode(days))
        .withColumn("slot_minute", F.explode(slots))
    )
    taken = seen.where(F.col("slot_minute").isNotNull())
    return expected.join(taken, [*keys, "obs_date", "slot_minute"], "left_anti")


def next_slot(rows: DataFrame, at: str, rules: SlotRules = SlotRules()) -> DataFrame:
    """Add the next slot after the hour of ``at``, minutes until it, slots left.

    A slot in the current hour is already taken; NULL after the last slot.
    """
    hour, minute = F.hour(at), F.hour(at) * 60 + F.minute(at)
    later = [F.when(F.lit(s // 60) > hour, F.lit(s)) for s in rules.slot_minutes]
    upcoming = F.least(*later) if len(later) > 1 else later[0]
    left = sum(F.when(F.lit(s // 60) > hour, 1).otherwise(0) for s in rules.slot_minutes)
    return rows.withColumn("next_slot_minute", upcoming).withColumns(
        {
            "minutes_until": F.col("next_slot_minute") - minute,
            "slots_left": left,
        }
    )


def min_gap_thinning(
    runs: DataFrame, rules: SlotRules = SlotRules(), skew_rules: SkewRules = SkewRules()
) -> DataFrame:
    """Keep a run only if enough time passed since the last *kept* run ended.

    ``runs`` has ``entity, started_at, ended_at``.  Times count as they are; only the
    time between two runs is cut to whole minutes, all of it, also beyond a day.  Of
    runs that start together the one that ends first comes first.

    The greedy choice is sequential, but only within an island: a run that starts the gap or
    more after the end of *all* runs before it is kept whatever was kept of those.  Spark cuts an
    entity there, the greatest end being handed on over time slices of hot entities, and
    islands are thinned apart, batch by batch, jumping from kept run to kept run.
    """
    micros = runs.select(
        "entity",
        F.expr(S.epoch_micros_sql("started_at")).alias("start"),
        F.expr(S.epoch_micros_sql("ended_at")).alias("end"),
        "started_at",
        "ended_at",
    ).where("start is not null and end is not null")
    gap = rules.min_gap_minutes * 60_000_000
    order = ("start", "end")
    sliced = skew.add_slices(micros, ["entity"], "start", skew_rules)
    known = skew.running_max_before(sliced, ["entity"], order, "end", "busy_until").withColumn(
        "opens", F.expr(f"if(busy_until is null or start >= busy_until + {gap}, start, null)")
    )
    islands = skew.running_max_before(known, ["entity"], order, "opens", "opened").select(
        "entity", F.coalesce("opens", "opened").alias("island"), "start", "end", "started_at", "ended_at"
    )

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, free = None, None
        for batch in batches:
            if batch.empty:
                continue
            entity, known = batch["entity"].to_numpy(), batch["entity"].notna().to_numpy()
            island, start, end = (batch[c].to_numpy() for c in ("island", "start", "end"))
            changes = (entity[1:] != entity[:-1]) & (known[1:] | known[:-1]) | (island[1:] != island[:-1])
            edges = [0, *(np.flatnonzero(changes) + 1), len(batch)]
            keep = np.zeros(len(batch), dtype=bool)
            for low, high in zip(edges, edges[1:]):
                here = (known[low], entity[low] if known[low] else None, island[low])
                if here != current:
                    current, free = here, start[low]
                i = low + int(np.searchsorted(start[low:high], free))
                while i < high:
                    keep[i] = True
                    free = end[i] + gap
                    i = max(i + 1, low + int(np.searchsorted(start[low:high], free)))
            yield batch[keep]

    return (
        islands.repartition("entity", "island")
        .sortWithinPartitions("entity", "island", "start", "end")
        .mapInPandas(thin, islands.schema)
        .select("entity", "started_at", "ended_at")
    )


def recent_runs(log: DataFrame, k: int = 5, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """The last ``k`` log entries of each source, newest first.

    Spark limits each source to ``k`` rows before the shuffle.
    """
    newest = Window.partitionBy(*keys).orderBy(
        F.col("time").desc_nulls_last(), F.col("session_id").desc_nulls_last()
    )
    return log.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= k)


def run_status(log: DataFrame, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """State of each source after its last run, with counts over all runs."""
    last = F.max_by(
        F.struct("status", "session_id", "time", "duration_minutes"),
        F.struct("time", "session_id"),
    )
    return (
        log.groupBy(*keys)
        .agg(
            last.alias("last"),
            F.count("*").alias("runs"),
            F.count_if(F.col("status") == "success").alias("successes"),
        )
        .select(
            *keys,
            F.col("last.status").alias("last_status"),
            F.col("last.session_id").alias("last_session_id"),
            F.col("last.time").alias("last_time"),
            F.col("last.duration_minutes").alias("last_duration_minutes"),
            "runs",
            "successes",
        )
    )
