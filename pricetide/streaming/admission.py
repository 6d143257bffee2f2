"""Order and lateness of streams, before any stateful operator sees them.

A stateful operator forgets what lies behind its watermark, and what comes later still is
lost.  :func:`replay` lays out a backlog in the order of its times, so that little is
late; :func:`admit` divides a stream into rows that are on time and a table of late ones,
so that none is lost without a trace.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.session import path_bytes, path_exists, read_text, remove_path, write_text
from pricetide.streaming.sinks import batch_folder, run_available


#: A slice is written as files of about this size.
FILE_BYTES = 8 * 1024 * 1024


def replay_in_slices(rows: DataFrame, path: str, at: str = "observed_at", days: int = 7) -> tuple[int, int]:
    """Write a backlog as slices of ``days`` days, the earliest first; slices and files of a slice.

    Files streams take files by their age, so a stream over ``path`` sees the slices
    in the order of their times.  Within a slice rows come in any order: a delay of
    ``days`` covers that.  Rows without a time come first.  ``rows`` are read once; the
    number of slices follows the calendar.  Every slice is dealt out to the same number of files,
    which follows the size of the largest, so a stream that takes so many files at a time has a
    micro-batch per slice however many rows there are.
    """
    spark = rows.sparkSession
    slice_of = F.floor(F.unix_micros(F.col(at).cast("timestamp")) / (days * 86_400_000_000))
    staged = f"{path}-staged"
    rows.withColumn("_slice", F.coalesce(slice_of, F.lit(-(2**62)))).write.partitionBy("_slice").parquet(staged)
    schema = T.StructType([*rows.schema.fields, T.StructField("_slice", T.LongType())])
    sliced = spark.read.schema(schema).parquet(staged)
    slices = sorted(r[0] for r in sliced.select("_slice").distinct().collect())
    largest = max((path_bytes(spark, f"{staged}/_slice={number}") for number in slices), default=0)
    files = max(1, -(-largest // FILE_BYTES))
    for number in slices:
        part = sliced.where(F.col("_slice") == number).drop("_slice")
        part.repartition(files).write.mode("append").parquet(path)
    remove_path(spark, staged)
    return len(slices), files


def replay(rows: DataFrame, path: str, at: str = "observed_at", days: int = 7) -> int:
    """:func:`replay_in_slices`; the number of slices."""
    return replay_in_slices(rows, path, at, days)[0]


def close(spark: SparkSession, path: str, schema, at: str = "observed_at", after: str = "365 days") -> None:
    """End a stream of files: a last row, all null but its time, moves the watermark on.

    What waits for later rows is then finished.  Nothing may follow it.
    """
    newest = spark.read.schema(schema).parquet(path).agg(F.max(at).alias("newest"))
    row = newest.where("newest is not null").select(
        *(
            (F.expr(f"newest + INTERVAL {after}") if f.name == at else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
    row.write.mode("append").parquet(path)


def admit(
    stream: DataFrame, path: str, checkpoint: str, delay_seconds: int, at: str = "observed_at"
) -> tuple[str, str]:
    """Divide what is there now; the folders of admitted and of late rows.

    A row is late if it is ``delay_seconds`` or more behind the newest row of all
    batches before, or has no time.  A stream over the admitted rows with the same
    delay drops none: its watermark is never ahead of this one.  Each batch is read once,
    and again only where it has late rows, and keeps the newest time so far in a file, so a
    repeated batch divides alike.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        admitted, late, clock = (
            batch_folder(spark, f"{path}/{part}", checkpoint, batch_id) for part in ("admitted", "late", "clock")
        )
        if path_exists(spark, f"{clock}/newest"):
            return
        newest = None
        if batch_id:
            before = batch_folder(spark, f"{path}/clock", checkpoint, batch_id - 1)
            newest = json.loads(read_text(spark, f"{before}/newest"))
        micros = F.unix_micros(F.col(at).cast("timestamp"))
        on_time = micros.isNotNull()
        if newest is not None:
            on_time &= micros > newest - delay_seconds * 1_000_000
        seen = Observation()
        counted = batch.observe(
            seen, F.max(micros).alias("newest"), F.count_if(~on_time).alias("late")
        ).where(on_time)
        if path_exists(spark, f"{admitted}/_SUCCESS"):
            # written by an attempt that failed later; streams may have read it
            counted.write.format("noop").mode("overwrite").save()
        else:
            counted.write.mode("overwrite").parquet(admitted)
        found = seen.get
        if found["late"]:
            batch.where(~on_time).write.mode("overwrite").parquet(late)
        times = [x for x in (found["newest"], newest) if x is not None]
        write_text(spark, f"{clock}/newest", json.dumps(max(times, default=None)))

    run_available(stream, path, checkpoint, write=write)
    return f"{path}/admitted", f"{path}/late"
